"""Training rows with their chronological split, per ticker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketbars.operators.features import series
from marketbars.schema import KEY_COLUMNS

# Names of stored columns.
PLACE, LENGTH, LAST_TRAIN, SIDE = "row_num", "row_count", "split_boundary", "dataset_split"
TRAIN, TEST = "train", "test"


def split_series(
    features: DataFrame, inputs: Sequence[str], label: str, train_ratio: float
) -> DataFrame:
    """Rows complete in inputs and label, each on its side of its series' split.

    A series' first ``floor(length * train_ratio)`` complete rows, in time order,
    are for training. Place and length come from one pass over the series: the
    length needs no order, and takes that of the place to share its sort.
    """
    rows = complete_rows(features, inputs, label)
    entire = series().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place, length = F.row_number().over(series()), F.count("*").over(entire)
    return split_columns(rows, place, length, train_ratio)


def complete_rows(features: DataFrame, inputs: Sequence[str], label: str) -> DataFrame:
    """Rows with a value in all inputs, label and key, and only those columns."""
    columns = [*inputs, label, *KEY_COLUMNS]
    return features.na.drop(subset=columns).select(*columns)


def split_columns(
    rows: DataFrame, place: Column, length: Column, train_ratio: float
) -> DataFrame:
    """Rows with their place, their series' length, and the side these put them on."""
    numbered = rows.select("*", place.alias(PLACE), length.alias(LENGTH))
    last = F.floor(F.col(LENGTH) * float(train_ratio))
    side = F.when(F.col(PLACE) > last, TEST).otherwise(TRAIN)
    return numbered.select("*", last.alias(LAST_TRAIN), side.alias(SIDE))


def train_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(SIDE) == TRAIN)


def test_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(SIDE) == TEST)
