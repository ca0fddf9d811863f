"""Daily series operators (E1, E3, W1, W2) and back-test origins.

A series is ``[*keys, ds, y]``; ``keys=[]`` is the single-restaurant case.
Series work is bounded by (#keys x #days), never by fact-row volume: the only
data-proportional step is the partially aggregated daily mart upstream.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescast.functions.dates import day_range, yyyymmdd_to_date


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal keys where NULL equals NULL, keeping the left side's keys.
    Without keys the right side is one row and applies to all."""
    if not keys:
        return left.join(right, how=how)
    other = right.withColumnsRenamed({k: f"{k}__r" for k in keys})
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[f"{k}__r"]) for k in keys])
    return left.join(other, cond, how).drop(*[f"{k}__r" for k in keys])


def outer_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join on equal keys where NULL equals NULL; each key comes from the side that has the row."""
    other = right.withColumnsRenamed({k: f"{k}__r" for k in keys})
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[f"{k}__r"]) for k in keys])
    both = left.join(other, cond, "full_outer")
    return both.withColumns({k: F.coalesce(left[k], other[f"{k}__r"]) for k in keys}).drop(*[f"{k}__r" for k in keys])


def to_series(daily: DataFrame, keys: list[str], date_col: str = "business_date", value_col: str = "net_sales") -> DataFrame:
    """Mart rows -> [*keys, ds DATE, y DOUBLE]."""
    return daily.select(*keys, yyyymmdd_to_date(date_col).alias("ds"), F.col(value_col).cast("double").alias("y"))


def numbered_series(series: DataFrame, keys: list[str]) -> DataFrame:
    """E1 + W1: continuous daily calendar from each key's first to last day;
    gap days and NULL values become 0.0. Adds the 1-based position ``rn``
    (= row_number by ds on the dense calendar, produced by ``posexplode``
    without a sort), the series length ``n`` and its first day ``ds0``."""
    bounds = series.groupBy(*keys).agg(F.min("ds").alias("ds0"), F.max("ds").alias("ds1"))
    cal = bounds.select(
        *keys, "ds0", (F.datediff("ds1", "ds0") + 1).alias("n"),
        F.posexplode(day_range(F.col("ds0"), F.col("ds1"))).alias("pos", "ds"),
    )
    return join_on(cal, series, [*keys, "ds"], "left").select(
        *keys, "ds", F.coalesce(F.col("y"), F.lit(0.0)).alias("y"), (F.col("pos") + 1).alias("rn"), "n", "ds0"
    )


def densify_daily(series: DataFrame, keys: list[str]) -> DataFrame:
    """E1 as a user-facing frame: [*keys, ds, y]."""
    return numbered_series(series, keys).select(*keys, "ds", "y")


def last_n(series: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The last ``n`` rows of each series (row_number over ds desc <= n;
    one window partition per key, bounded by the calendar)."""
    w = Window.partitionBy(*keys).orderBy(F.col("ds").desc()) if keys else Window.orderBy(F.col("ds").desc())
    return series.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def series_heads(ns: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: length and first day."""
    return ns.select(*keys, "n", "ds0").distinct() if not keys else ns.groupBy(*keys).agg(F.first("n").alias("n"), F.first("ds0").alias("ds0"))


def backtest_origins(ns: DataFrame, keys: list[str], horizon: int = 14, n_folds: int = 8, step: int | None = None,
                     min_train: int = 60) -> DataFrame:
    """E4 fold table: [*keys, fold, cutoff, ds0]. cutoff_k = n - horizon -
    (n_folds-1-k)*step; folds with cutoff < min_train are skipped but keep
    their number. Rows per key <= n_folds (a bounded explode)."""
    step = horizon if step is None else step
    heads = series_heads(ns, keys)
    f = heads.select(*keys, "n", "ds0", F.explode(F.sequence(F.lit(0), F.lit(n_folds - 1))).alias("fold"))
    f = f.withColumn("cutoff", F.col("n") - horizon - (n_folds - 1 - F.col("fold")) * step)
    return f.where((F.col("cutoff") >= min_train) & (F.col("cutoff") >= 1)).select(*keys, F.col("fold").cast("int").alias("fold"), "cutoff", "ds0")


FUTURE_FOLD = -1


def future_origins(ns: DataFrame, keys: list[str]) -> DataFrame:
    """E3 origin: forecast the days after each series' last observed day."""
    return series_heads(ns, keys).select(*keys, F.lit(FUTURE_FOLD).cast("int").alias("fold"), F.col("n").alias("cutoff"), "ds0")


def targets(origins: DataFrame, keys: list[str], horizon: int) -> DataFrame:
    """``horizon`` target days per origin: [*keys, fold, cutoff, h, rn, ds]."""
    t = origins.select(*keys, "fold", "cutoff", "ds0", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    return t.select(
        *keys, "fold", "cutoff", "h", (F.col("cutoff") + F.col("h")).alias("rn"),
        F.date_add("ds0", (F.col("cutoff") + F.col("h") - 1).cast("int")).alias("ds"),
    )
