"""Data-quality operators (L1-L4, L6, L8, L9). Each returns rows describing
violations (or a per-check summary); an empty violation set means pass.
All checks are aggregations that run where the data lives."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.operators.series import outer_on


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda x, y: x.unionByName(y), frames)


def not_null_summary(checks: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    """L1: one row per (model, column) with the count of NULLs (0 = pass).
    Each model is scanned once for all of its columns."""
    frames = []
    for model, df, cols in checks:
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        frames.append(agg.select(F.explode(F.array(*[
            F.struct(F.lit(model).alias("model"), F.lit(c).alias("column"), F.col(c).cast("bigint").alias("failures")) for c in cols
        ])).alias("r")).select("r.*"))
    return _union(frames)


def unique_summary(checks: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    """One row per (model, key columns) with the number of key values
    that occur more than once (0 = pass). Keys are pre-aggregated per task."""
    frames = []
    for model, df, cols in checks:
        frames.append(duplicate_keys(df, cols).agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(model).alias("model"), F.lit(",".join(cols)).alias("column"), "failures"))
    return _union(frames)


def duplicate_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """The duplicated key values themselves."""
    return df.groupBy(*cols).count().where(F.col("count") > 1)


def non_negative(mart: DataFrame, col: str = "net_sales", keys: list[str] | None = None) -> DataFrame:
    """L3: days with negative net sales."""
    return mart.where(F.col(col) < 0).select(*(keys or []), "business_date", col)


def no_fanout(serving: DataFrame, mart: DataFrame, horizon: int, keys: list[str]) -> DataFrame:
    """Serving rows per key must equal mart rows + horizon."""
    on = keys or ["_all"]  # without keys both sides are one group
    s = serving.withColumn("_all", F.lit(0)).groupBy(*on).agg(F.count(F.lit(1)).alias("serving_rows"))
    m = mart.withColumn("_all", F.lit(0)).groupBy(*on).agg(F.count(F.lit(1)).alias("mart_rows"))
    return outer_on(s, m, on).select(
        *keys, F.coalesce("serving_rows", F.lit(0)).alias("serving_rows"), F.coalesce("mart_rows", F.lit(0)).alias("mart_rows"),
        (F.coalesce("serving_rows", F.lit(0)) == F.coalesce("mart_rows", F.lit(0)) + horizon).alias("ok"),
    )


def drift_audit(raw: DataFrame, schema: T.StructType, day_col: str = "business_date") -> DataFrame:
    """In ONE pass, rows, distinct days and, per column, the count of
    present values that do not convert to the pinned type (try_cast)."""
    aggs = [F.count(F.lit(1)).alias("rows"), F.countDistinct(day_col).alias("days")]
    for f in schema.fields:
        c = F.col(f.name)
        aggs.append(F.count_if(c.isNotNull() & c.try_cast(f.dataType).isNull()).alias(f"bad_{f.name}"))
    return raw.agg(*aggs)


def parity_by_day(left: DataFrame, right: DataFrame, value: str = "net", keys: list[str] | None = None) -> DataFrame:
    """Per-day totals of two copies (e.g. landing vs bronze) joined FULL
    OUTER; reports days missing on a side or with a non-zero difference."""
    keys = keys or []
    on = [*keys, "business_date"]
    lft = left.select(*on, F.col(value).alias("left_value"))
    rgt = right.select(*on, F.col(value).alias("right_value"))
    j = outer_on(lft, rgt, on)
    diff = F.round(F.coalesce("left_value", F.lit(0.0)) - F.coalesce("right_value", F.lit(0.0)), 2)
    return j.select(*on, "left_value", "right_value", diff.alias("diff")).where(
        F.col("left_value").isNull() | F.col("right_value").isNull() | (F.col("diff") != 0)
    )


def live_net_by_day(orders: DataFrame) -> DataFrame:
    """Per-day live net-of-deferred sales, exact decimal then 2 dp."""
    from salescast.functions.money import money_sum, rounded

    live = orders.where(~F.col("voided") & ~F.col("deleted"))
    return live.groupBy(F.col("business_date").cast("bigint").alias("business_date")).agg(
        rounded(money_sum("net_amount") - money_sum("deferred_amount"), 2).alias("net")
    )
