"""DataFrame forecasters (E2, E5b, E6) with one signature:

    model(ns, origins, keys, horizon) -> [*keys, fold, ds, yhat, yhat_lower, yhat_upper]

``ns`` is a numbered series (``series.numbered_series``); ``origins`` holds
one cutoff per (key, fold). Only rows with ``rn <= cutoff`` are used for an
origin, so the same code serves back-test folds and the live forecast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescast.operators.series import join_on, targets

# Weekly season length and the two-sided 80 % normal quantile.
SEASON = 7
Z80 = 1.2815515655446004


def clip_nonnegative(df: DataFrame, cols: tuple[str, ...] = ("yhat", "yhat_lower", "yhat_upper")) -> DataFrame:
    """Floor the point forecast and any band column present at 0."""
    present = [c for c in cols if c in df.columns]
    return df.select(*[F.greatest(F.lit(0.0), F.col(c)).alias(c) if c in present else F.col(c) for c in df.columns])


def seasonal_naive(ns: DataFrame, origins: DataFrame, keys: list[str], horizon: int, season: int = SEASON) -> DataFrame:
    """yhat(h) = y at position cutoff - season + 1 + (h-1) % season; a
    history shorter than one season is first tiled to season length
    (position 1 + ((h-1) % season) % cutoff). One equi-join by position."""
    t = targets(origins, keys, horizon)
    hm = (F.col("h") - 1) % season
    src = F.when(F.col("cutoff") >= season, F.col("cutoff") - season + 1 + hm).otherwise(1 + hm % F.col("cutoff"))
    t = t.withColumn("src", src)
    y = ns.select(*keys, F.col("rn").alias("src"), F.col("y").alias("yhat"))
    return join_on(t, y, [*keys, "src"], "left").select(
        *keys, "fold", "ds", "yhat", F.lit(None).cast("double").alias("yhat_lower"), F.lit(None).cast("double").alias("yhat_upper")
    )


def _running(keys: list[str], extra: list[str] | None = None):
    parts = [*keys, *(extra or [])]
    w = Window.partitionBy(*parts) if parts else Window.partitionBy()
    return w.orderBy("rn").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def trend_weekday(ns: DataFrame, origins: DataFrame, keys: list[str], horizon: int, z: float = Z80, clip: bool = True) -> DataFrame:
    """Linear trend x weekday index, with an 80 % band and E6 clip.

    Per origin (cutoff c), over rows rn <= c with t = rn:
      b = (c*Sty - St*Sy) / (c*Stt - St^2)  (0 when undefined), a = (Sy - b*St)/c
      index(w) = Sy_w / (a*n_w + b*St_w)    = avg(y | w) / avg(trend | w), 1 when <= 0
      yhat = (a + b*(c+h)) * index(weekday(ds)),  band = yhat -/+ z*sigma,
      sigma = sqrt(SSE/c) of the trend fit.
    All sums are running sums at rn = c (windows per key ordered by rn), so
    no training row is copied per fold."""
    t = F.col("rn").cast("double")
    w_all, w_wd = _running(keys), _running(keys, ["wd"])
    stats = ns.select(*keys, "rn", "y", F.weekday("ds").alias("wd")).select(
        *keys, "rn", "wd",
        F.sum(t).over(w_all).alias("St"), F.sum("y").over(w_all).alias("Sy"),
        F.sum(t * t).over(w_all).alias("Stt"), F.sum(t * F.col("y")).over(w_all).alias("Sty"),
        F.sum(F.col("y") * F.col("y")).over(w_all).alias("Syy"),
        F.count(F.lit(1)).over(w_wd).alias("n_w"), F.sum(t).over(w_wd).alias("St_w"), F.sum("y").over(w_wd).alias("Sy_w"),
    )
    c = F.col("cutoff").cast("double")
    fit = join_on(origins, stats.withColumnRenamed("rn", "cutoff"), [*keys, "cutoff"], "inner").select(
        *keys, "fold", "cutoff", "St", "Sy", "Stt", "Sty", "Syy"
    )
    den = c * F.col("Stt") - F.col("St") * F.col("St")
    fit = fit.withColumn("b", F.when(den != 0, (c * F.col("Sty") - F.col("St") * F.col("Sy")) / den).otherwise(F.lit(0.0)))
    fit = fit.withColumn("a", (F.col("Sy") - F.col("b") * F.col("St")) / c)
    a, b = F.col("a"), F.col("b")
    sse = (F.col("Syy") - 2 * a * F.col("Sy") - 2 * b * F.col("Sty") + c * a * a + 2 * a * b * F.col("St") + b * b * F.col("Stt"))
    fit = fit.withColumn("sigma", F.sqrt(F.greatest(F.lit(0.0), sse / c)))
    # Weekday sums at the last row of each weekday on or before the cutoff:
    # that row is one of the 7 positions cutoff-6 .. cutoff (dense calendar).
    last7 = origins.select(*keys, "fold", "cutoff", F.explode(F.sequence(F.lit(0), F.lit(SEASON - 1))).alias("d"))
    last7 = last7.withColumn("rn", F.col("cutoff") - F.col("d")).where(F.col("rn") >= 1)
    wd = join_on(last7, stats.select(*keys, "rn", "wd", "n_w", "St_w", "Sy_w"), [*keys, "rn"], "inner").select(
        *keys, "fold", "wd", "n_w", "St_w", "Sy_w"
    )
    tg = targets(origins, keys, horizon).withColumn("wd", F.weekday("ds"))
    j = join_on(join_on(tg, fit, [*keys, "fold", "cutoff"], "inner"), wd, [*keys, "fold", "wd"], "left")
    idx_den = F.col("a") * F.col("n_w") + F.col("b") * F.col("St_w")
    index = F.when(idx_den > 0, F.col("Sy_w") / idx_den).otherwise(F.lit(1.0))
    yhat = (F.col("a") + F.col("b") * F.col("rn").cast("double")) * index
    out = j.select(
        *keys, "fold", "ds", yhat.alias("yhat"),
        (yhat - z * F.col("sigma")).alias("yhat_lower"), (yhat + z * F.col("sigma")).alias("yhat_upper"),
    )
    return clip_nonnegative(out) if clip else out


def round_forecast(df: DataFrame, dp: int = 2) -> DataFrame:
    """Money-rounded forecast columns (keeps DOUBLE)."""
    def r(c: str) -> Column:
        return F.round(F.col(c), dp).alias(c)

    return df.select(*[r(c) if c in ("yhat", "yhat_lower", "yhat_upper") else F.col(c) for c in df.columns])
