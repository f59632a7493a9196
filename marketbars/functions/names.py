"""Column headers of vendor files brought to the names the engine uses."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame

# Headers that stand for the bar's date, and the name of an empty header.
DATE_HEADERS = ("date", "datetime")
UNNAMED = "value"


def header_name(header: str | Sequence[object]) -> str:
    """Lower case with underscores for spaces.

    A layered header goes by its first layer that says anything.
    """
    text = header
    if not isinstance(header, str):
        text = UNNAMED
        for layer in header:
            if layer is not None and layer != "" and layer != "None":
                text = str(layer)
                break
    return "_".join(text.strip().lower().split(" "))


def normalize_columns(
    df: DataFrame, labels: Sequence[str | Sequence[object]] | None = None
) -> DataFrame:
    """Rename all columns; ``labels`` gives layered headers by position.

    Raises ``ValueError`` when two headers come to the same name.
    """
    names = list(map(header_name, df.columns if labels is None else labels))
    for place, name in enumerate(names):
        if name in DATE_HEADERS:
            names[place] = "trade_date"
    twice = [name for name, n in Counter(names).items() if n > 1]
    if twice:
        raise ValueError(f"several headers mean {', '.join(twice)}")
    return df.toDF(*names)
