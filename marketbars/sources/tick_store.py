"""Partial bars kept between runs, so that each run reads new ticks only.

Every batch of ticks becomes a folder of partial bars. A small versioned record
names the folders that count; it is written after them, so a run that fails leaves the
store as it was, and a batch that is added again does nothing. Reading merges the
partial bars of all folders, and compaction writes that merge as one folder. Late ticks
need no care: bars merge in any order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from marketbars.sources.bars import merged_partials
from marketbars.workspace import children, remove

RECORD = "batches array<string>, folders array<string>"


def _record(spark: SparkSession, path: str) -> tuple[int, list[str], list[str]]:
    """Version, batches merged so far, and folders that hold them."""
    done = [
        int(name) for name in children(spark, f"{path}/record")
        if "_SUCCESS" in children(spark, f"{path}/record/{name}")
    ]
    if not done:
        return 0, [], []
    row = spark.read.schema(RECORD).json(f"{path}/record/{max(done)}").first()
    return max(done), list(row.batches), list(row.folders)


def _publish(spark, path: str, version: int, batches: list[str], folders: list[str]) -> None:
    """Two runs that publish the same version cannot both succeed."""
    row = spark.createDataFrame([(batches, folders)], RECORD)
    row.coalesce(1).write.mode("error").json(f"{path}/record/{version}")


def add_batch(partials: DataFrame, path: str, batch: str) -> bool:
    """Add one batch of partial bars; whether it was new."""
    spark = partials.sparkSession
    version, batches, folders = _record(spark, path)
    if batch in batches:
        return False
    folder = f"bars-{uuid.uuid4().hex}"
    partials.write.parquet(f"{path}/{folder}")
    _publish(spark, path, version + 1, [*batches, batch], [*folders, folder])
    return True


def stored_partials(spark: SparkSession, path: str) -> DataFrame:
    """Partial bars of all batches, one for each ticker and bar."""
    _, batches, folders = _record(spark, path)
    if not batches:
        raise ValueError(f"there are no ticks in {path}")
    return merged_partials(spark.read.parquet(*(f"{path}/{folder}" for folder in folders)))


def compact(spark: SparkSession, path: str) -> None:
    """Write all batches as one folder, then let the old ones go."""
    version, batches, folders = _record(spark, path)
    if len(folders) < 2:
        return
    folder = f"bars-{uuid.uuid4().hex}"
    stored_partials(spark, path).write.parquet(f"{path}/{folder}")
    _publish(spark, path, version + 1, batches, [folder])
    for old in folders:
        remove(spark, f"{path}/{old}")
