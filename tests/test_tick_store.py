"""Partial bars merge in any order, and stored batches count once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marketbars.sources import tick_store
from marketbars.sources.bars import (
    bars_from_ticks,
    finished_bars,
    merged_partials,
    partial_bars,
    union_frames,
)


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture(scope="module")
def ticks(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.col("event_type").alias("ticker"), "ts", F.col("value").alias("price"),
        F.col("event_id").alias("sequence"),
    ).checkpoint()


@pytest.mark.parametrize("sequence", ["sequence", None])
@pytest.mark.parametrize("interval", ["1d", "1h", "1wk"])
def test_shuffled_pieces_equal_one_pass(ticks, interval, sequence):
    options = {"interval": interval, "sequence": sequence}
    piece = F.pmod(F.hash("sequence"), F.lit(5))
    parts = [partial_bars(ticks.where(piece == k), **options) for k in range(5)]
    twice = merged_partials(union_frames([merged_partials(union_frames(parts[3:])), *parts[:3]]))
    assert same(finished_bars(twice), bars_from_ticks(ticks, **options))


def test_batches_count_once_and_late_ticks_merge(spark, ticks, tmp_path):
    path = str(tmp_path / "store")
    with pytest.raises(ValueError):
        tick_store.stored_partials(spark, path)
    first = ticks.where("sequence % 3 > 0")
    assert tick_store.add_batch(partial_bars(first, sequence="sequence"), path, "one")
    assert not tick_store.add_batch(partial_bars(ticks, sequence="sequence"), path, "one")
    tick_store.compact(spark, path)  # nothing to do
    late = ticks.where("sequence % 3 = 0")
    assert tick_store.add_batch(partial_bars(late, sequence="sequence"), path, "two")
    whole = bars_from_ticks(ticks, sequence="sequence")
    assert same(finished_bars(tick_store.stored_partials(spark, path)), whole)
    tick_store.compact(spark, path)
    assert same(finished_bars(tick_store.stored_partials(spark, path)), whole)
    assert len([p for p in (tmp_path / "store").iterdir() if p.name.startswith("bars-")]) == 1
    # known also after compaction
    assert not tick_store.add_batch(partial_bars(late, sequence="sequence"), path, "two")


def test_a_run_that_failed_leaves_the_store(spark, ticks, tmp_path):
    path = str(tmp_path / "store")
    tick_store.add_batch(partial_bars(ticks, sequence="sequence"), path, "one")
    # written, but not recorded
    partial_bars(ticks, sequence="sequence").write.parquet(f"{path}/bars-lost")
    (tmp_path / "store" / "record" / "2").mkdir()
    whole = bars_from_ticks(ticks, sequence="sequence")
    assert same(finished_bars(tick_store.stored_partials(spark, path)), whole)


def test_sequences_that_are_missing_or_text(spark):
    rows = [
        ("a", "2024-01-01 10:00:00", 5.0, "2"),
        ("a", "2024-01-01 10:00:00", 6.0, "10"),
        ("a", "2024-01-01 10:00:00", 4.0, "not one"),
        ("a", "2024-01-01 11:00:00", 9.0, None),
        ("a", "2024-01-01 11:00:00", 8.0, "-9000000000000000000"),
        ("a", "2024-01-02 11:00:00", 3.0, None),
    ]
    ticks = spark.createDataFrame(rows, "ticker string, ts string, price double, number string")
    bars = bars_from_ticks(ticks, sequence="number").orderBy("trade_date").collect()
    assert [(r.open, r.high, r.low, r.close, r.volume) for r in bars] == [
        (4.0, 9.0, 4.0, 8.0, 5.0), (3.0, 3.0, 3.0, 3.0, 1.0),
    ]


def test_far_apart_sequences_keep_the_order_of_time(spark):
    rows = [("a", 1_000_000, 1.0, 2**63 - 1), ("a", 1_000_001, 2.0, -(2**63))]
    ticks = spark.createDataFrame(rows, "ticker string, us long, price double, number long")
    ticks = ticks.withColumn("ts", F.timestamp_micros("us"))
    row = bars_from_ticks(ticks, sequence="number").first()
    assert (row.open, row.close) == (1.0, 2.0)
