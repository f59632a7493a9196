"""What a change of bars changes in the features, and only that.

A feature row depends on its own bar, on some bars before it and on the next one. So a
bar that is added, corrected or deleted changes the row before it and a bounded number
of rows after it. Those rows are computed anew from a stretch of bars with the halo
that their windows need; all others stay as stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketbars.operators.features import add_technical_features, look_back
from marketbars.schema import KEY_COLUMNS

AFFECTED = "_affected"


def changed_keys(old: DataFrame, new: DataFrame) -> DataFrame:
    """Keys of the bars that are in one table only, or differ in any column."""
    rest = sorted(set(new.columns) - set(KEY_COLUMNS))
    was = old.select(*KEY_COLUMNS, F.struct(*rest).alias("was"))
    now = new.select(*KEY_COLUMNS, F.struct(*rest).alias("now"))
    both = was.join(now, list(KEY_COLUMNS), "full")
    return both.where(~F.col("was").eqNullSafe(F.col("now"))).select(*KEY_COLUMNS)


def affected_bars(bars: DataFrame, changed: DataFrame, back: int) -> DataFrame:
    """Bars that are needed to recompute, flagged where their own row is affected.

    Changed keys are marks among a ticker's bars, each just before its bar. Places
    count bars, not marks, so a mark of a deleted bar has a place too. Only tickers
    with a change are looked at.
    """
    touched = bars.join(changed.select("ticker").distinct(), "ticker", "left_semi")
    marked = touched.withColumn("_real", F.lit(1)).unionByName(
        changed.withColumn("_real", F.lit(0)), allowMissingColumns=True
    )
    ticker, start, here = Window.partitionBy("ticker"), Window.unboundedPreceding, Window.currentRow
    so_far = ticker.orderBy("trade_date", "_real").rowsBetween(start, here)
    # In the other order, as a frame that ends with the series costs the square of its length.
    from_here = ticker.orderBy(F.desc("trade_date"), F.desc("_real")).rowsBetween(start, here)
    mark = F.when(F.col("_real") == 0, F.col("_place"))
    hit = F.when(F.col(AFFECTED), F.col("_place"))
    found = (
        marked.withColumn("_place", F.sum("_real").over(so_far))
        .withColumn("_last", F.max(mark).over(so_far))
        .withColumn("_next", F.min(mark).over(from_here))
        .where("_real = 1")
        .withColumn(
            AFFECTED,
            F.coalesce(F.col("_place") - F.col("_last") <= back + 1, F.lit(False))
            | F.coalesce(F.col("_next") == F.col("_place"), F.lit(False)),
        )
        .withColumn("_last", F.max(hit).over(so_far))
        .withColumn("_next", F.min(hit).over(from_here))
    )
    needed = F.coalesce(F.col("_next") - F.col("_place") <= back, F.lit(False)) | F.coalesce(
        F.col("_place") - F.col("_last") <= 1, F.lit(False)
    )
    return found.where(needed).select(*bars.columns, AFFECTED)


def changed_features(
    bars: DataFrame,
    changed: DataFrame,
    ma_windows: Sequence[int],
    lag_days: Sequence[int],
    rsi_window: int,
) -> tuple[DataFrame, DataFrame]:
    """Keys whose stored rows no longer hold, and the rows to put in their place."""
    needed = affected_bars(bars, changed, look_back(ma_windows, lag_days, rsi_window))
    made = add_technical_features(needed, ma_windows, lag_days, rsi_window)
    stale = needed.where(AFFECTED).select(*KEY_COLUMNS).unionByName(changed).distinct()
    return stale, made.where(AFFECTED).drop(AFFECTED)
