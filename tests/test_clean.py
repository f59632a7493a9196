from __future__ import annotations

from datetime import date, datetime

import pytest
from helpers import RAW_TEXT, raw_bar, raw_bars

from marketbars.operators.clean import clean_projection, clean_raw_prices, dedup_bars
from marketbars.schema import CLEAN_BAR


def closes(df):
    return {(r.ticker, r.trade_date): r.close for r in df.collect()}


def test_schema_and_upper_case(spark):
    cleaned = clean_raw_prices(raw_bars(spark, raw_bar("abc", "2024-01-02", 5.0)))
    assert [(f.name, f.dataType) for f in cleaned.schema] == [
        (f.name, f.dataType) for f in CLEAN_BAR
    ]
    assert closes(cleaned) == {("ABC", date(2024, 1, 2)): 5.0}


def test_latest_copy_wins_and_case_variants_are_one_ticker(spark):
    raw = raw_bars(
        spark,
        raw_bar("abc", "2024-01-02", 1.0, "2024-02-01 00:00:00"),
        raw_bar("ABC", "2024-01-02", 2.0, "2024-02-03 00:00:00"),
        raw_bar("Abc", "2024-01-02", 3.0, "2024-02-02 00:00:00"),
    )
    assert closes(clean_raw_prices(raw)) == {("ABC", date(2024, 1, 2)): 2.0}


def test_copy_without_close_never_displaces_a_valid_one(spark):
    raw = raw_bars(
        spark,
        raw_bar("A", "2024-01-02", 1.0, "2024-02-01 00:00:00"),
        raw_bar("A", "2024-01-02", None, "2024-02-09 00:00:00"),
        raw_bar("A", "2024-01-03", float("nan"), "2024-02-09 00:00:00"),
    )
    assert closes(clean_raw_prices(raw)) == {("A", date(2024, 1, 2)): 1.0}


def test_unreadable_values_become_null_and_rows_without_date_go(spark):
    raw = raw_bars(
        spark,
        raw_bar("A", "no date", 1.0),
        raw_bar("A", None, 1.0),
        raw_bar("A", "2024-01-05", 2.0, at="never"),
    )
    (kept,) = clean_raw_prices(raw).collect()
    assert kept.trade_date == date(2024, 1, 5)
    assert kept.ingestion_timestamp is None


def test_text_numbers_are_read_and_bad_ones_are_null(spark):
    schema = RAW_TEXT.replace("double", "string")
    row = ("A", "2024-01-02", "1.5", "x", "NaN", "2", "", None, "0", "0", None, "test")
    (kept,) = clean_raw_prices(spark.createDataFrame([row], schema)).collect()
    assert (kept.open, kept.high, kept.low, kept.close) == (1.5, None, None, 2.0)
    assert (kept.adj_close, kept.volume) == (None, None)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_typed_dates_are_accepted(spark, kind):
    raw = raw_bars(spark, raw_bar("A", "2024-01-02", 1.0))
    typed = raw.withColumn("trade_date", raw.trade_date.cast(kind)).withColumn(
        "ingestion_timestamp", raw.ingestion_timestamp.cast("timestamp_ntz")
    )
    (kept,) = clean_raw_prices(typed).collect()
    assert kept.trade_date == date(2024, 1, 2)
    assert kept.ingestion_timestamp == datetime(2024, 2, 1)


def test_all_timestamps_missing_still_keeps_one_fixed_row(spark):
    rows = [raw_bar("A", "2024-01-02", c, at=None) for c in (3.0, 9.0, 5.0)]
    for order in (rows, rows[::-1]):
        cleaned = clean_raw_prices(raw_bars(spark, *order).repartition(3))
        assert closes(cleaned) == {("A", date(2024, 1, 2)): 9.0}


def test_clean_is_idempotent(spark, sf_dir):
    from marketbars.checks.inputs import clean_orders

    once = clean_orders(spark, sf_dir)
    twice = clean_raw_prices(once)
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()
    assert once.count() == once.select("ticker", "trade_date").distinct().count()


def test_dedup_does_not_depend_on_row_placement(spark, sf_dir):
    from marketbars.checks.inputs import supplier_bars

    typed = clean_projection(supplier_bars(spark, sf_dir))
    base = dedup_bars(typed)
    spread = dedup_bars(typed.orderBy("volume").repartition(7))
    assert base.exceptAll(spread).isEmpty() and spread.exceptAll(base).isEmpty()


def test_numeric_looking_ticker_stays_text(spark):
    cleaned = clean_raw_prices(raw_bars(spark, raw_bar("0700", "2024-01-02", 1.0)))
    assert cleaned.first().ticker == "0700"
