"""Job settings.

Key names are fixed values: they are those of the settings files that job owners
already keep. Defaults are our own.
"""

from __future__ import annotations

import dataclasses
import json
import warnings
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Project:
    name: str = "market_bars"
    environment: str = "dev"


@dataclass(frozen=True)
class Stocks:
    tickers: tuple[str, ...] = ("AAPL", "TSLA", "MSFT")
    start_date: str | None = "2021-01-01"
    end_date: str | None = None
    interval: str = "1d"
    # Where the bars come from: any path and format Spark can read.
    source_path: str = "source"
    source_format: str = "parquet"
    # "bars", or "ticks" with columns ticker, ts, price and maybe sequence; ticks
    # are made into bars of the interval above.
    source_kind: str = "bars"
    source_options: dict[str, str] = field(default_factory=dict)
    source_system: str = "file"


@dataclass(frozen=True)
class Storage:
    base_path: str = "."
    raw_parquet_path: str = "lake/bars"
    processed_parquet_path: str = "lake/features"
    # Bars and features that runs bring up to date, a directory per ticker and year, or
    # per bucket of tickers and year where the first run had too many of those.
    clean_store_path: str = "lake/clean-parts"
    feature_store_path: str = "lake/feature-parts"
    delta_feature_path: str = "warehouse/features"
    delta_prediction_path: str = "warehouse/predictions"
    model_path: str = "runs/model"
    metrics_json_path: str = "runs/scores-json"
    metrics_parquet_path: str = "runs/scores"
    predictions_export_path: str = "runs/predictions"
    dashboard_path: str = "runs/charts"
    ingestion_manifest_path: str = "runs/ingestion"
    delta_database: str = "marketbars"
    delta_feature_table: str = "features"
    delta_prediction_table: str = "predictions"
    # Used only where the session sets no spark.checkpoint.dir.
    checkpoint_path: str = "runs/checkpoints"
    table_format: str = "parquet"
    # One directory per ticker suits a configured ticker list. With very many
    # series set this to false: raw bars are then kept in buckets of tickers and
    # feature files are clustered and sorted by ticker.
    partition_by_ticker: bool = True
    raw_buckets: int = 64
    # Bucket the feature table by ticker so that training needs no shuffle.
    feature_buckets: int | None = None


@dataclass(frozen=True)
class Features:
    ma_windows: tuple[int, ...] = (10, 20)
    lag_days: tuple[int, ...] = (1, 2, 3)
    rsi_window: int = 14
    # Cut series that are longer than this into slices for windows and places; null
    # takes each series whole.
    rows_per_slice: int | None = None


@dataclass(frozen=True)
class RandomForest:
    num_trees: int = 150
    max_depth: int = 8


@dataclass(frozen=True)
class Gbt:
    max_iter: int = 120
    max_depth: int = 5


@dataclass(frozen=True)
class Model:
    label_col: str = "target_close"
    train_ratio: float = 0.8
    random_seed: int = 42
    random_forest: RandomForest = RandomForest()
    gbt: Gbt = Gbt()
    # Number of partitions the models are fitted on. Tree results depend on it, so
    # it does not follow the session; raise it with the data.
    fit_partitions: int = 32
    # "index", "hash" or "sparse". An index is exact, sits on the driver and needs as
    # many tree bins as there are tickers; take one of the others for very many tickers:
    # the hash is one number, sparse is a vector of ticker_buckets zeros and ones.
    ticker_encoding: str = "index"
    ticker_buckets: int = 256
    # Models that are fitted at the same time.
    fits_at_once: int = 3
    # Bins of numeric inputs in trees; raised to the number of indexed tickers.
    max_bins: int = 32


@dataclass(frozen=True)
class Dashboard:
    lookback_days: int = 180


@dataclass(frozen=True)
class Api:
    default_limit: int = 200
    max_limit: int = 2000


@dataclass(frozen=True)
class Config:
    project: Project = Project()
    stocks: Stocks = Stocks()
    storage: Storage = Storage()
    features: Features = Features()
    model: Model = Model()
    dashboard: Dashboard = Dashboard()
    api: Api = Api()

    @property
    def tickers(self) -> list[str]:
        """The configured tickers as the bars spell them."""
        return list(map(str.upper, self.stocks.tickers))

    def path(self, key: str) -> str:
        """Full path of a storage entry; absolute paths and URIs stay as they are."""
        return self.under_base(getattr(self.storage, key))

    def under_base(self, target: str) -> str:
        if target.startswith("/") or ":/" in target:
            return target
        return f"{self.storage.base_path.rstrip('/') or '/'}/{target}"

    def table(self, key: str) -> str:
        return f"{self.storage.delta_database}.{getattr(self.storage, key)}"

    def with_base_path(self, base_path: str | None) -> Config:
        """The same settings under another base path; none leaves them as they are."""
        moved = dataclasses.replace(
            self.storage, base_path=str(base_path or self.storage.base_path)
        )
        return dataclasses.replace(self, storage=moved)


def _build(cls: type, values: dict[str, Any]) -> Any:
    """Fill a settings class from a mapping; a key it does not know gives a warning."""
    defaults = cls()
    unknown = sorted(set(values) - {item.name for item in dataclasses.fields(cls)})
    if unknown:
        warnings.warn(f"{cls.__name__}: unknown settings {', '.join(unknown)}", stacklevel=2)
    known: dict[str, Any] = {}
    for item in dataclasses.fields(cls):
        if item.name not in values:
            continue
        value, default = values[item.name], getattr(defaults, item.name)
        if dataclasses.is_dataclass(default):
            value = _build(type(default), value or {})
        elif isinstance(default, tuple):
            value = tuple(value)
        known[item.name] = value
    return cls(**known)


def config_from_dict(values: dict[str, Any]) -> Config:
    return _build(Config, values)


def load_config(path: str | None = None, base_path: str | None = None) -> Config:
    """Read settings from a JSON or YAML file; without a path, the defaults."""
    if path is None:
        return Config().with_base_path(base_path)
    with open(path, encoding="utf-8") as stream:
        if str(path).endswith(".json"):
            values = json.load(stream)
        else:
            import yaml  # only YAML files need PyYAML

            values = yaml.safe_load(stream)
    return config_from_dict(values or {}).with_base_path(base_path)
