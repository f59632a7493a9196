"""Readers of raw bars, and bars built from ticks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.functions.columns import as_date, as_double, as_timestamp
from marketbars.schema import PRICE_COLUMNS, RAW_BAR


def bars_between(
    df: DataFrame,
    tickers: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    column: str = "trade_date",
) -> DataFrame:
    """Rows of the wanted tickers with ``start <= column < end``; null is open.

    On date and timestamp columns the comparison is on the column itself, so the
    range reaches the scan.
    """
    if tickers is not None:
        df = df.filter(F.col("ticker").isin(list(tickers)))
    if start is None and end is None:
        return df
    day = F.col(column)
    bound = df.schema[column].dataType
    if isinstance(bound, T.StringType):
        day, bound = as_date(day, bound), T.DateType()
    if start is not None:
        df = df.filter(day >= F.lit(start).cast(bound))
    if end is not None:
        df = df.filter(day < F.lit(end).cast(bound))
    return df


def spellings(df: DataFrame, tickers: Sequence[str], most: int = 10_000) -> list[str] | None:
    """How ``df`` spells the tickers, which are in upper case; None if in over ``most`` ways.

    A filter on these values reaches the files, which one on the upper-cased column does
    not. Reads one column, or only the listing where tickers are directories.
    """
    found = df.where(F.upper("ticker").isin(list(tickers))).select("ticker").distinct()
    rows = found.limit(most + 1).collect()
    return None if len(rows) > most else sorted(row.ticker for row in rows)


def read_bars(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    schema: T.StructType | None = RAW_BAR,
    tickers: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read bars in any Spark format.

    The explicit schema also keeps ticker directories such as ``ticker=0700``
    strings instead of numbers. It takes ``trade_date`` as a time without zone;
    read files that hold it as text with ``schema=None``.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    bars = reader.load(path if isinstance(path, str) else list(path))
    if schema is not None:
        bars = bars.select(*schema.names)
    return bars_between(bars, tickers, start, end)


def conform_raw(df: DataFrame) -> DataFrame:
    """Raw bars in the stored raw schema; columns a source lacks become null."""
    dtype = {field.name: field.dataType for field in df.schema}

    def typed(field: T.StructField) -> Column:
        name = field.name
        if name not in dtype:
            return F.lit(None).cast(field.dataType)
        if name in PRICE_COLUMNS:
            return as_double(F.col(name))
        if name == "ingestion_timestamp":
            return as_timestamp(F.col(name), dtype[name])
        return F.col(name).try_cast(field.dataType)

    return df.select(*(typed(field).alias(field.name) for field in RAW_BAR))


def stamp_provenance(
    df: DataFrame, ingested_at: Column | str, source_system: str
) -> DataFrame:
    """Upper-case the ticker and record when and from where the rows came.

    The run passes its own timestamp, so a recomputed task stamps the same value.
    """
    at = F.lit(ingested_at) if isinstance(ingested_at, str) else ingested_at
    return (
        df.withColumn("ticker", F.upper("ticker"))
        .withColumn("ingestion_timestamp", at.cast("timestamp"))
        .withColumn("source_system", F.lit(source_system))
    )


def missing_tickers(df: DataFrame, requested: Sequence[str]) -> DataFrame:
    """Requested tickers without a single row.

    The present side is filtered to the requested list first, so it holds at most
    that many rows and may be broadcast.
    """
    wanted = df.sparkSession.createDataFrame([(t,) for t in requested], "ticker string")
    present = df.filter(F.col("ticker").isin(list(requested))).select("ticker").distinct()
    return wanted.join(F.broadcast(present), "ticker", "left_anti")


def require_tickers(df: DataFrame, requested: Sequence[str]) -> None:
    """Raise ``ValueError`` when a requested ticker has no data."""
    absent = sorted(row.ticker for row in missing_tickers(df, requested).collect())
    if absent:
        raise ValueError(f"no bars for {', '.join(absent)}")


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# Bar intervals, as a window length or as a calendar unit.
WINDOW_INTERVALS = {
    "1m": "1 minute",
    "2m": "2 minutes",
    "5m": "5 minutes",
    "15m": "15 minutes",
    "30m": "30 minutes",
    "60m": "1 hour",
    "90m": "90 minutes",
    "1h": "1 hour",
}
DAY_INTERVALS = {"1d": 1, "5d": 5}
CALENDAR_INTERVALS = {"1wk": "week", "1mo": "month", "3mo": "quarter"}


def is_intraday(interval: str) -> bool:
    """Whether bars of the interval are shorter than a day."""
    return interval in WINDOW_INTERVALS


def bar_start(ts: Column, interval: str) -> Column:
    """Start of the bar a timestamp belongs to.

    Days, weeks and months are those of the calendar that the session reads zoned
    times in; several days count from the first of 1970.
    """
    if interval in DAY_INTERVALS:
        day, length = F.to_date(ts), DAY_INTERVALS[interval]
        if length == 1:
            return day
        return F.date_sub(day, F.pmod(F.unix_date(day), F.lit(length)))
    if interval in CALENDAR_INTERVALS:
        return F.date_trunc(CALENDAR_INTERVALS[interval], ts)
    if interval in WINDOW_INTERVALS:
        return F.window(ts, WINDOW_INTERVALS[interval])["start"]
    raise ValueError(f"unknown interval {interval}")


def epoch_micros(ts: Column, dtype: T.DataType) -> Column:
    """Microseconds on a straight time line; zoneless values are taken as they read."""
    if not isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(ts.cast("timestamp"))
    whole_minutes = F.unix_date(F.to_date(ts)) * F.lit(1440).cast("long")
    whole_minutes = whole_minutes + F.hour(ts) * 60 + F.minute(ts)
    seconds = F.extract(F.lit("SECOND"), ts)
    return whole_minutes * 60_000_000 + (seconds * 1_000_000).cast("long")


# Wider than any two sequence numbers of 64 bits are apart.
STEP = Decimal(2 * 10**19)
UNNUMBERED = Decimal(-(10**19))


def tick_order(micros: Column, sequence: Column) -> Column:
    """Time then sequence number as one fixed-width number.

    A struct would say the same, but it forces a sort-based aggregation; a
    decimal keeps the bars in a hash aggregation with map-side combine. A number that is
    missing or cannot be read comes before all others of its time.
    """
    shifted = micros.cast("decimal(18,0)") * F.lit(STEP)
    number = F.coalesce(sequence.try_cast("decimal(19,0)"), F.lit(UNNUMBERED))
    return shifted + number


def partial_bars(
    ticks: DataFrame,
    interval: str = "1d",
    ticker: str = "ticker",
    ts: str = "ts",
    price: str = "price",
    sequence: str | None = None,
) -> DataFrame:
    """What ticks say about each bar, in a form that later ticks can be merged into.

    Besides open and close it keeps the order keys of their ticks. Times and prices
    may be text; ticks without a readable time or price do not count.
    """
    kind = ticks.schema[ts].dataType
    zoneless = isinstance(kind, T.TimestampNTZType)
    columns = {
        "ticker": F.col(ticker),
        "at": F.col(ts) if zoneless else as_timestamp(F.col(ts), kind),
        "value": as_double(F.col(price)),
    }
    if sequence is not None:
        columns["number"] = F.col(sequence)
    read = ticks.select(*(column.alias(name) for name, column in columns.items())).where(
        F.col("at").isNotNull() & F.col("value").isNotNull()
    )
    if sequence is None:
        order = F.struct("at", "value")
    else:
        order = tick_order(epoch_micros(F.col("at"), read.schema["at"].dataType), F.col("number"))
    start_type = "timestamp_ntz" if is_intraday(interval) else "date"
    found = read.groupBy("ticker", bar_start(F.col("at"), interval).alias("start")).agg(
        F.min(order).alias("open_key"),
        F.min_by("value", order).alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max(order).alias("close_key"),
        F.max_by("value", order).alias("close"),
        F.count(F.lit(1)).alias("ticks"),
        F.max("at").cast("timestamp").alias("last_tick"),
    )
    return found.withColumn("start", F.col("start").cast(start_type)).withColumnRenamed(
        "start", "trade_date"
    )


def merged_partials(partials: DataFrame) -> DataFrame:
    """Partial bars of any number of pieces, one for each ticker and bar.

    The order of the pieces does not matter: the earliest open and the latest close win.
    """
    return partials.groupBy("ticker", "trade_date").agg(
        F.min("open_key").alias("open_key"),
        F.min_by("open", "open_key").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max("close_key").alias("close_key"),
        F.max_by("close", "close_key").alias("close"),
        F.sum("ticks").alias("ticks"),
        F.max("last_tick").alias("last_tick"),
    )


def finished_bars(partials: DataFrame, source_system: str = "ticks") -> DataFrame:
    """Raw bars of merged partial bars; the tick count is the volume."""
    return partials.select(
        "trade_date",
        "ticker",
        "open",
        "high",
        "low",
        "close",
        F.col("close").alias("adj_close"),
        F.col("ticks").cast("double").alias("volume"),
        F.lit(0.0).alias("dividends"),
        F.lit(0.0).alias("stock_splits"),
        F.col("last_tick").alias("ingestion_timestamp"),
        F.lit(source_system).alias("source_system"),
    )


def bars_from_ticks(
    ticks: DataFrame,
    interval: str = "1d",
    ticker: str = "ticker",
    ts: str = "ts",
    price: str = "price",
    sequence: str | None = None,
    source_system: str = "ticks",
) -> DataFrame:
    """Open, high, low, close and tick count per ticker and interval.

    Times, prices and sequence numbers may be text. Ticks without a readable time or
    price do not count; those without a readable number come first of their time.
    Without a sequence column ticks of equal time are ordered by price, so
    the result does not depend on how rows were spread; that order is a struct,
    which costs a sort on either side of the shuffle.
    """
    partials = partial_bars(ticks, interval, ticker, ts, price, sequence)
    return finished_bars(partials, source_system)
