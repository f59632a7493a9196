from __future__ import annotations

import time
from datetime import date, timedelta

from marketbars.schema import CLEAN_BAR, PRICE_COLUMNS

START = date(2024, 1, 1)


def clean_bars(spark, series, skip=()):
    """Clean bars from closes per ticker, one per day, but for skipped day numbers."""
    rows = []
    for ticker, closes in series.items():
        days = (START + timedelta(days=n) for n in range(10**6) if n not in skip)
        for day, close in zip(days, closes):
            prices = [float(close)] * 5 + [1000.0, 0.0, 0.0]
            rows.append((day, ticker, *prices, None, "test"))
    return spark.createDataFrame(rows, CLEAN_BAR)


def raw_bar(ticker, day, close, at="2024-02-01 00:00:00", **other):
    row = dict.fromkeys(PRICE_COLUMNS, 1.0)
    row.update(ticker=ticker, trade_date=day, close=close, source_system="test")
    row.update(ingestion_timestamp=at, **other)
    return row


RAW_TEXT = (
    "ticker string, trade_date string, open double, high double, low double, close double, "
    "adj_close double, volume double, dividends double, stock_splits double, "
    "ingestion_timestamp string, source_system string"
)


def raw_bars(spark, *rows):
    names = [part.split()[0] for part in RAW_TEXT.split(", ")]
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], RAW_TEXT)


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_bytes(spark):
    """Bytes of the shuffle files that lie on this machine."""
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    sizes = [files.apply(k) for k in range(files.size())]
    return {f.getName(): f.length() for f in sizes if f.getName().startswith("shuffle_")}


def shuffles_left(spark, before, enough):
    """Bytes of the shuffle files that came since; they may go shortly after."""
    until = time.time() + 20
    while True:
        left = sum(n for name, n in shuffle_bytes(spark).items() if name not in before)
        if left < enough or time.time() > until:
            return left
        time.sleep(0.2)
