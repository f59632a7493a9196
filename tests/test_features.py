from __future__ import annotations

import random
from datetime import timedelta

import pytest
from helpers import START, clean_bars

from marketbars.operators.features import add_technical_features, in_series_order
from marketbars.schema import feature_schema


def features_of(spark, closes, ticker="A", ma=(10, 20), lags=(1, 2, 3), rsi=14, **how):
    df = add_technical_features(clean_bars(spark, {ticker: closes}, **how), ma, lags, rsi)
    return in_series_order(df).collect()


def test_columns_follow_the_configured_windows(spark):
    df = add_technical_features(clean_bars(spark, {"A": [1, 2]}), [3], [1, 5], 7)
    wanted = feature_schema([3], [1, 5], 7)
    assert df.columns == wanted.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in wanted]


def test_flat_series_has_rsi_100_and_no_return(spark):
    rows = features_of(spark, [10] * 30)
    assert len(rows) == 29
    assert {r.rsi_14 for r in rows} == {100.0}
    assert rows[0].daily_return is None
    assert {r.daily_return for r in rows[1:]} == {0.0}
    assert {r.ma_10 for r in rows} == {10.0}


def test_rising_series_has_rsi_100(spark):
    assert {r.rsi_14 for r in features_of(spark, range(1, 25))} == {100.0}


def test_falling_series_has_rsi_0_after_the_first_row(spark):
    rows = features_of(spark, range(25, 1, -1))
    assert rows[0].rsi_14 == 100.0
    assert {r.rsi_14 for r in rows[1:]} == {0.0}


def test_alternating_series(spark):
    rows = features_of(spark, [10, 12, 11, 14, 10, 9])
    # gains 0 2 0 3 0, losses 0 0 1 0 4: the divisor cancels out
    assert rows[2].rsi_14 == pytest.approx(100 - 100 / (1 + 2 / 1))
    assert rows[3].rsi_14 == pytest.approx(100 - 100 / (1 + 5 / 1))
    assert rows[4].rsi_14 == pytest.approx(100 - 100 / (1 + 5 / 5))
    assert [r.daily_return for r in rows[1:3]] == [pytest.approx(0.2), pytest.approx(-1 / 12)]


def test_averages_use_partial_frames_at_the_start(spark):
    rows = features_of(spark, range(1, 27))
    assert [r.ma_10 for r in rows[:3]] == [1.0, 1.5, 2.0]
    assert rows[9].ma_10 == 5.5 and rows[10].ma_10 == 6.5
    assert rows[9].ma_20 == 5.5 and rows[20].ma_20 == 11.5


def test_lags_target_and_last_row(spark):
    rows = features_of(spark, [5, 6, 7, 8])
    assert [(r.lag_1, r.lag_2, r.lag_3, r.target_close) for r in rows] == [
        (None, None, None, 6.0),
        (5.0, None, None, 7.0),
        (6.0, 5.0, None, 8.0),
    ]


def test_zero_previous_close_gives_no_return(spark):
    rows = features_of(spark, [0, 5, 0, 0, 1])
    assert [r.daily_return for r in rows] == [None, None, -1.0, None]


def test_single_bar_has_no_feature_row(spark):
    assert features_of(spark, [5]) == []


def test_a_missing_day_is_bridged(spark):
    rows = features_of(spark, [1, 2, 3], skip={1, 2})
    assert [r.trade_date for r in rows] == [START, START + timedelta(days=3)]
    assert rows[1].lag_1 == 1.0 and rows[0].target_close == 2.0


def test_calendar_starts_the_week_on_sunday(spark):
    rows = features_of(spark, range(9))
    # 2024-01-01 was a Monday
    assert [r.day_of_week for r in rows] == [2, 3, 4, 5, 6, 7, 1, 2]
    assert {(r.month_of_year, r.year) for r in rows} == {(1, 2024)}


def brute_force(closes, ma, lags, window):
    rows, moves = [], [0.0]
    moves += [b - a for a, b in zip(closes, closes[1:])]
    for i in range(len(closes) - 1):
        recent = moves[max(0, i - window + 1) : i + 1]
        gain = sum(m for m in recent if m > 0) / len(recent)
        loss = sum(-m for m in recent if m < 0) / len(recent)
        row = {
            f"rsi_{window}": 100.0 if loss == 0 else 100 - 100 / (1 + gain / loss),
            "target_close": closes[i + 1],
        }
        for w in ma:
            frame = closes[max(0, i - w + 1) : i + 1]
            row[f"ma_{w}"] = sum(frame) / len(frame)
        for k in lags:
            row[f"lag_{k}"] = closes[i - k] if i >= k else None
        rows.append(row)
    return rows


def test_random_series_against_brute_force_at_any_partitioning(spark):
    rng = random.Random(7)
    series = {
        t: [round(rng.uniform(1, 100), 2) for _ in range(rng.randint(2, 90))] for t in "ABCDE"
    }
    series["A"] = [round(rng.uniform(1, 100), 2) for _ in range(600)]  # two thirds of all rows
    bars = clean_bars(spark, series)
    for layout in (bars, bars.orderBy("close").repartition(13)):
        got = add_technical_features(layout, [5, 20, 50], [1, 4], 9)
        rows = in_series_order(got).collect()
        for ticker, closes in series.items():
            mine = [r for r in rows if r.ticker == ticker]
            wanted = brute_force(closes, [5, 20, 50], [1, 4], 9)
            assert len(mine) == len(wanted) == len(closes) - 1
            for row, want in zip(mine, wanted):
                assert 0 <= row.rsi_9 <= 100
                for name, value in want.items():
                    assert row[name] == (value if value is None else pytest.approx(value))
