from __future__ import annotations

from datetime import date, datetime

import pytest
from helpers import clean_bars, raw_bar, raw_bars

from marketbars.functions.names import header_name, normalize_columns
from marketbars.schema import RAW_BAR
from marketbars.sources import bars, sinks


@pytest.mark.parametrize(
    ("label", "name"),
    [
        (" Adj Close ", "adj_close"),
        ("Volume", "volume"),
        (("Adj Close", "AAPL"), "adj_close"),
        (("", "AAPL"), "aapl"),
        ((None, ""), "value"),
    ],
)
def test_header_names(label, name):
    assert header_name(label) == name


def test_headers_are_renamed_and_date_becomes_trade_date(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert normalize_columns(df.toDF("Date", "Stock Splits", "Close")).columns == [
        "trade_date", "stock_splits", "close",
    ]
    layered = [("Datetime", ""), ("Open", "AAPL"), ("Close", "AAPL")]
    assert normalize_columns(df, layered).columns == ["trade_date", "open", "close"]


@pytest.mark.parametrize("kind", ["string", "date", "timestamp"])
def test_range_is_half_open_and_ends_may_be_open(spark, kind):
    raw = raw_bars(spark, *(raw_bar("A", f"2024-01-0{n}", 1.0) for n in range(1, 6)))
    raw = raw.withColumn("trade_date", raw.trade_date.cast(kind))

    def count(**how):
        return bars.bars_between(raw, **how).count()

    assert count(start="2024-01-02", end="2024-01-04") == 2
    assert count(start="2024-01-02") == 4
    assert count(end="2024-01-02") == 1
    assert count() == 5
    assert count(tickers=["B"]) == 0


def test_missing_tickers(spark):
    raw = raw_bars(spark, raw_bar("A", "2024-01-01", 1.0))
    missing = bars.missing_tickers(raw, ["A", "C", "B"])
    assert sorted(r.ticker for r in missing.collect()) == ["B", "C"]
    bars.require_tickers(raw, ["A"])
    with pytest.raises(ValueError, match="B, C"):
        bars.require_tickers(raw, ["A", "C", "B"])


def test_provenance_is_the_runs_own_timestamp(spark):
    raw = raw_bars(spark, raw_bar("a", "2024-01-01", 1.0))
    row = bars.stamp_provenance(raw, "2024-05-06T07:08:09+00:00", "vendor").first()
    assert (row.ticker, row.source_system) == ("A", "vendor")
    assert row.ingestion_timestamp == datetime(2024, 5, 6, 7, 8, 9)


def test_conform_fills_absent_columns_with_null(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-01 09:30:00", "7")], "ticker string, trade_date string, close string"
    )
    conformed = bars.conform_raw(df)
    assert conformed.schema.simpleString() == RAW_BAR.simpleString()
    row = conformed.first()
    assert (row.trade_date, row.close, row.open) == (datetime(2024, 1, 1, 9, 30), 7.0, None)


def test_union_by_name_keeps_copies(spark):
    a = spark.createDataFrame([("A", 1.0)], "ticker string, close double")
    b = spark.createDataFrame([(2.0, "B", 9.0)], "close double, ticker string, volume double")
    union = bars.union_frames([a, a, b])
    assert sorted((r.ticker, r.close, r.volume is None) for r in union.collect()) == [
        ("A", 1.0, True), ("A", 1.0, True), ("B", 2.0, False),
    ]


TICKS = [
    # ticker, ts, price, sequence
    ("A", "2024-01-01 09:00:00", 5.0, 1),
    ("A", "2024-01-01 09:00:00", 4.0, 0),
    ("A", "2024-01-01 16:00:00", 7.0, 3),
    ("A", "2024-01-01 16:00:00", 9.0, 2),
    ("A", "2024-01-03 00:00:00", 1.0, 4),
    ("B", "2024-01-01 23:59:59.999999", 2.0, 5),
]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_daily_bars_follow_the_sequence_within_equal_times(spark, kind):
    ticks = spark.createDataFrame(TICKS, "ticker string, ts string, price double, sequence long")
    ticks = ticks.withColumn("ts", ticks.ts.cast(kind))
    got = {
        (r.ticker, r.trade_date): (r.open, r.high, r.low, r.close, r.volume)
        for r in bars.bars_from_ticks(ticks, sequence="sequence").collect()
    }
    assert got == {
        ("A", date(2024, 1, 1)): (4.0, 9.0, 4.0, 7.0, 4.0),
        ("A", date(2024, 1, 3)): (1.0, 1.0, 1.0, 1.0, 1.0),
        ("B", date(2024, 1, 1)): (2.0, 2.0, 2.0, 2.0, 1.0),
    }


def test_without_sequence_equal_times_go_by_price(spark):
    ticks = spark.createDataFrame(TICKS, "ticker string, ts string, price double, sequence long")
    ticks = ticks.withColumn("ts", ticks.ts.cast("timestamp"))
    first = bars.bars_from_ticks(ticks).orderBy("ticker", "trade_date").first()
    assert (first.open, first.close) == (4.0, 9.0)


@pytest.mark.parametrize(
    ("interval", "start"),
    [
        ("15m", datetime(2024, 3, 14, 15, 15)),
        ("90m", datetime(2024, 3, 14, 15, 0)),
        ("1h", datetime(2024, 3, 14, 15)),
        ("1d", date(2024, 3, 14)),
        ("1wk", date(2024, 3, 11)),
        ("1mo", date(2024, 3, 1)),
        ("3mo", date(2024, 1, 1)),
    ],
)
def test_bar_starts(spark, interval, start):
    ticks = spark.sql("SELECT 'A' ticker, timestamp_ntz'2024-03-14 15:29:00' ts, 1D price")
    assert bars.bars_from_ticks(ticks, interval).first().trade_date == start


def test_unknown_interval(spark):
    ticks = spark.sql("SELECT 'A' ticker, timestamp'2024-03-14 15:29:00' ts, 1D price")
    with pytest.raises(ValueError, match="7q"):
        bars.bars_from_ticks(ticks, "7q")


def raw_for(spark, *tickers, close=1.0):
    return bars.conform_raw(
        raw_bars(spark, *(raw_bar(t, f"2024-01-0{n}", close) for t in tickers for n in (1, 2)))
    )


def test_raw_write_replaces_only_its_tickers(spark, tmp_path):
    path = str(tmp_path / "raw")
    sinks.write_raw(raw_for(spark, "0700", "AAPL"), path)
    sinks.write_raw(raw_for(spark, "AAPL", close=2.0), path)
    rows = bars.read_bars(spark, path).collect()
    assert sorted({(r.ticker, r.close) for r in rows}) == [("0700", 1.0), ("AAPL", 2.0)]
    assert len(rows) == 4


def test_raw_write_without_ticker_directories(spark, tmp_path):
    path = str(tmp_path / "raw")
    sinks.write_raw_bucketed(raw_for(spark, "0700", "AAPL"), path, buckets=4)
    assert not list((tmp_path / "raw").glob("ticker=*"))
    assert bars.read_bars(spark, path, tickers=["0700"]).count() == 2


@pytest.mark.parametrize("fmt", ["csv", "json", "orc", "parquet"])
def test_bars_are_read_in_any_format(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    raw_for(spark, "0700", "AAPL").write.format(fmt).save(path)
    got = bars.read_bars(spark, path, fmt, tickers=["0700"], start="2024-01-02")
    assert [(r.ticker, r.trade_date) for r in got.collect()] == [("0700", datetime(2024, 1, 2))]


def test_table_overwrite_may_change_its_schema(spark, tmp_path):
    sinks.create_database(spark, "sink_checks")
    name, path = "sink_checks.t", str(tmp_path / "t")
    sinks.save_table(spark.range(3), name, path)
    sinks.save_table(spark.range(2).selectExpr("id", "'x' AS tag"), name, path)
    assert sorted(map(tuple, spark.table(name).collect())) == [(0, "x"), (1, "x")]


def test_metrics_files(spark, tmp_path):
    metrics = sinks.metrics_frame(
        spark, [{"model_name": "b", "rmse": 2.0}, {"model_name": "a", "rmse": 1.0}]
    )
    sinks.write_metrics_parquet(metrics, str(tmp_path / "p"))
    sinks.write_metrics_json(
        spark, [r.asDict() for r in metrics.collect()], "a", str(tmp_path / "j")
    )
    assert [r.model_name for r in spark.read.parquet(str(tmp_path / "p")).collect()] == ["a", "b"]
    record = spark.read.json(str(tmp_path / "j")).first()
    assert record.best_model == "a"
    # The record keeps the order of training.
    assert [(m.model_name, m.rmse) for m in record.metrics] == [("b", 2.0), ("a", 1.0)]


def test_text_ticks_are_read_as_numbers_and_unreadable_ones_do_not_count(spark):
    ticks = spark.createDataFrame(
        [
            ("A", "2024-01-01 10:00:00", "9.5"),
            ("A", "2024-01-01 11:00:00", "10.2"),
            ("A", "2024-01-01 12:00:00", "8.0"),
            ("A", "2024-01-01 09:00:00", None),
            ("A", "2024-01-01 08:00:00", "?"),
            ("A", None, "99"),
        ],
        "ticker string, ts string, price string",
    )
    (bar,) = bars.bars_from_ticks(ticks).collect()
    assert (bar.open, bar.high, bar.low, bar.close, bar.volume) == (9.5, 10.2, 8.0, 8.0, 3.0)


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Bangkok"])
def test_zoned_days_are_those_of_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ticks = spark.sql(
            "SELECT 'A' AS ticker, explode(array(timestamp'2024-01-03 00:30', "
            "timestamp'2024-01-03 12:00', timestamp'2024-01-03 23:30')) AS ts, 1.0 AS price"
        )
        for interval in ("1d", "5d"):
            (bar,) = bars.bars_from_ticks(ticks, interval).collect()
            assert bar.volume == 3
        (day,) = bars.bars_from_ticks(ticks).selectExpr("string(trade_date) AS d").collect()
        assert day.d == "2024-01-03"
        assert bars.bars_from_ticks(ticks, "1h").count() == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bucketed_store_keeps_the_other_tickers(spark, tmp_path):
    path = str(tmp_path / "raw")
    both = bars.conform_raw(clean_bars(spark, {"A": [1, 2], "B": [3], "0700": [5]}))
    sinks.write_raw_bucketed(both, path, 2)
    again = bars.conform_raw(clean_bars(spark, {"A": [9]}))
    sinks.write_raw_bucketed(again, path, 2)
    stored = bars.read_bars(spark, path)
    assert sorted((r.ticker, r.close) for r in stored.collect()) == [
        ("0700", 5.0), ("A", 9.0), ("B", 3.0),
    ]


def test_headers_that_mean_the_same_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "`Date` int, ` date ` int")
    with pytest.raises(ValueError, match="trade_date"):
        normalize_columns(df)
