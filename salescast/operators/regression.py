"""E5 family: multiplicative seasonal regression with a prediction band.

Features are Spark columns (weekday, yearly Fourier terms, a bit mask of US
holidays); the fits run in numpy, one ``applyInPandas`` group per series
(bounded by the calendar) that holds all of its origins. The rows between two
cutoffs are summed up once; a fold is the sum of its slices and one solve.

Model, per origin (cutoff c) over rows rn <= c:
  trend      g(t) = a + b t                        (least squares)
  effects    y ~ g(t) * (X(t) . beta)              (ridge, X = [1, weekday dummies,
                                                    Fourier terms if ``yearly``, holidays])
  band       yhat -/+ z * sigma(residuals), then E6 clip at 0.
It is linear in beta yet multiplicative in effect, and tolerates zero days.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.functions.dates import day_range
from salescast.operators.forecasters import Z80
from salescast.operators.series import join_on

# Yearly period, Fourier order, ridge strength.
YEAR_DAYS = 365.25
FOURIER_ORDER = 3
RIDGE = 1e-3


def fourier_terms(ds: Column | str, order: int = FOURIER_ORDER, period: float = YEAR_DAYS) -> list[Column]:
    """sin/cos(2 pi k t / period), t = days since 1970-01-01."""
    d = F.col(ds) if isinstance(ds, str) else ds
    t = F.datediff(d, F.lit("1970-01-01").cast("date")).cast("double")
    out = []
    for k in range(1, order + 1):
        ang = F.lit(2 * math.pi * k / period) * t
        out += [F.sin(ang).alias(f"sin{k}"), F.cos(ang).alias(f"cos{k}")]
    return out


# US federal holidays. Fixed-date ones (month, day, first year)
# move to Friday/Monday when they fall on Saturday/Sunday.
FIXED_HOLIDAYS = [
    ("New Year's Day", 1, 1, 1870),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, 1870),
    ("Veterans Day", 11, 11, 1938),
    ("Christmas Day", 12, 25, 1870),
]
# (name, month, weekday with Monday=0, n-th occurrence; -1 = last)
NTH_WEEKDAY_HOLIDAYS = [
    ("Martin Luther King Jr. Day", 1, 0, 3),
    ("Washington's Birthday", 2, 0, 3),
    ("Memorial Day", 5, 0, -1),
    ("Labor Day", 9, 0, 1),
    ("Columbus Day", 10, 0, 2),
    ("Thanksgiving", 11, 3, 4),
]


def _observed(d: Column) -> Column:
    wd = F.weekday(d)
    return F.when(wd == 5, F.date_sub(d, 1)).when(wd == 6, F.date_add(d, 1)).otherwise(d)


def _nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    if n > 0:
        first = F.make_date(year, F.lit(month), F.lit(1))
        shift = (F.lit(weekday) - F.weekday(first) + 7) % 7 + 7 * (n - 1)
        return F.date_add(first, shift.cast("int"))
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.date_sub(last, ((F.weekday(last) - F.lit(weekday) + 7) % 7).cast("int"))


def holiday_calendar(spark, start, end) -> DataFrame:
    """E5d: [ds DATE, holiday STRING] for every year touching [start, end]
    (date literals or one-row Columns). A fixed holiday on a weekend has its
    actual date and, as "<name> (observed)", the weekday it moves to; the year
    after the last is computed too, since its New Year may be observed before."""
    last = F.year(F.lit(end).cast("date"))
    years = spark.range(1).select(F.explode(F.sequence(F.year(F.lit(start).cast("date")), last + 1)).alias("y"), last.alias("last"))
    rows = []
    for name, m, d, since in FIXED_HOLIDAYS:
        day = F.make_date("y", F.lit(m), F.lit(d))
        valid = years.where(F.col("y") >= since)
        rows.append(valid.select(day.alias("ds"), F.lit(name).alias("holiday"), "last"))
        rows.append(valid.where(F.weekday(day) >= 5).select(_observed(day).alias("ds"), F.lit(f"{name} (observed)").alias("holiday"), "last"))
    for name, m, wd, n in NTH_WEEKDAY_HOLIDAYS:
        rows.append(years.select(_nth_weekday(F.col("y"), m, wd, n).alias("ds"), F.lit(name).alias("holiday"), "last"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.where(F.year("ds") <= F.col("last")).select("ds", "holiday")


#: Every name that holiday_calendar gives: one effect each, one bit of a day's mask.
HOLIDAYS = [n for name, *_ in FIXED_HOLIDAYS for n in (name, f"{name} (observed)")] + [name for name, *_ in NTH_WEEKDAY_HOLIDAYS]


def feature_frame(ns: DataFrame, keys: list[str], horizon: int, holidays: DataFrame) -> DataFrame:
    """Series rows plus ``horizon`` future days per key, with feature columns;
    ``hol`` has a bit for each holiday on the day, in the order of HOLIDAYS."""
    heads = ns.groupBy(*keys).agg(F.first("n").alias("n"), F.first("ds0").alias("ds0")) if keys else ns.select("n", "ds0").limit(1)
    cal = heads.select(*keys, "n", F.posexplode(day_range(F.col("ds0"), F.date_add("ds0", (F.col("n") + horizon - 1).cast("int")))).alias("pos", "ds"))
    cal = cal.select(*keys, (F.col("pos") + 1).alias("rn"), "ds")
    ys = ns.select(*keys, "rn", "y")
    place = F.array_position(F.lit(HOLIDAYS), F.col("holiday")).cast("int")  # 1-based, 0 for a name that has no effect
    bit = F.when(F.col("place") > 0, F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place") - 1))
    hol = holidays.select("ds", place.alias("place")).groupBy("ds").agg(F.bit_or(bit).alias("hol"))
    return (
        join_on(cal, ys, [*keys, "rn"], "left").join(hol, "ds", "left")
        .select(*keys, "rn", "ds", "y", F.weekday("ds").alias("wd"), F.coalesce("hol", F.lit(0).cast("long")).alias("hol"), *fourier_terms("ds"))
    )


def design(rows: pd.DataFrame, yearly: bool) -> np.ndarray:
    """The effects' columns: level, weekdays, yearly terms, holidays."""
    wd, hol = rows["wd"].to_numpy(), rows["hol"].to_numpy(np.int64)
    cols = [np.ones((len(rows), 1)), (wd[:, None] == np.arange(1, 7)).astype(float)]
    if yearly:
        cols.append(rows[[f"{f}{k}" for k in range(1, FOURIER_ORDER + 1) for f in ("sin", "cos")]].to_numpy(float))
    cols.append(((hol[:, None] >> np.arange(len(HOLIDAYS))) & 1).astype(float))
    return np.hstack(cols)


@dataclass
class Sums:
    """What a fit needs of some rows, in sums that add up: those of a fold are its earlier slices' sums plus its own.

    The trend g = a + b t weighs every row and is another one in every fold; but its powers are polynomials in t, so
    the weighted Gram matrix of any fold comes from three unweighted ones: sum x x', sum t x x' and sum t^2 x x'.
    """

    line: np.ndarray  # n, t, t^2, y, t y, y^2
    gram: np.ndarray  # 3 x p x p
    cross: np.ndarray  # sum x y, sum t x y

    @classmethod
    def of(cls, t: np.ndarray, x: np.ndarray, y: np.ndarray) -> Sums:
        line = np.array([len(t), t.sum(), t @ t, y.sum(), t @ y, y @ y])
        return cls(line, np.stack([(x * (t**k)[:, None]).T @ x for k in range(3)]), np.stack([x.T @ y, x.T @ (t * y)]))

    def __add__(self, other: Sums) -> Sums:
        return Sums(self.line + other.line, self.gram + other.gram, self.cross + other.cross)

    def solve(self, ridge: float) -> tuple[float, float, np.ndarray, float]:
        """(a, b) of the trend, the effects, and the deviation of the residuals."""
        n, t, tt, y, ty, yy = self.line
        den = n * tt - t * t
        b = (n * ty - t * y) / den if n > 1 and den > 0 else 0.0
        a = (y - b * t) / n
        gram = a * a * self.gram[0] + 2 * a * b * self.gram[1] + b * b * self.gram[2]
        cross = a * self.cross[0] + b * self.cross[1]
        p = len(gram)
        effects = np.linalg.solve(gram + (ridge * np.trace(gram) / p + 1e-12) * np.eye(p), cross)
        rest = yy - 2 * effects @ cross + effects @ gram @ effects
        return a, b, effects, float(np.sqrt(max(rest, 0.0) / n))


def predict_folds(rows: pd.DataFrame, folds: pd.DataFrame, horizon: int, z: float = Z80, ridge: float = RIDGE, yearly: bool = True) -> pd.DataFrame:
    """Every origin of one series in one pass over its rows: [fold, ds, yhat, yhat_lower, yhat_upper]. A holiday that
    the training rows never see has no effect (ridge)."""
    rows = rows.sort_values("rn", ignore_index=True)
    rn, ds = rows["rn"].to_numpy(), rows["ds"].to_numpy()
    t, y, x = rn / rn[-1], rows["y"].fillna(0.0).to_numpy(float), design(rows, yearly)
    out, held, at = [], None, 0
    for cutoff, same in folds.sort_values("cutoff").groupby("cutoff"):
        end = int(np.searchsorted(rn, cutoff, "right"))
        if end > at:
            part = Sums.of(t[at:end], x[at:end], y[at:end])
            held, at = part if held is None else held + part, end
        to = int(np.searchsorted(rn, cutoff + horizon, "right"))
        if held is None or to == end:
            continue
        a, b, effects, sigma = held.solve(ridge)
        yhat = (a + b * t[end:to]) * (x[end:to] @ effects)
        for fold in same["fold"]:
            out.append(pd.DataFrame({
                "fold": int(fold), "ds": ds[end:to], "yhat": np.maximum(yhat, 0.0),
                "yhat_lower": np.maximum(yhat - z * sigma, 0.0), "yhat_upper": np.maximum(yhat + z * sigma, 0.0),
            }))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({c: pd.Series(dtype="object") for c in ("fold", "ds", "yhat", "yhat_lower", "yhat_upper")})


def seasonal_regression_model(keys_schema: list[tuple[str, T.DataType]], holidays: DataFrame, yearly: bool = True):
    """E5 as a DataFrame model (same signature as operators.forecasters): one
    group per series, met with the series' origins; no row is copied per fold."""
    knames = [k for k, _ in keys_schema]
    cols = [*knames, "fold", "ds", "yhat", "yhat_lower", "yhat_upper"]
    schema = T.StructType([T.StructField(k, t) for k, t in keys_schema] + [
        T.StructField("fold", T.IntegerType()), T.StructField("ds", T.DateType()), T.StructField("yhat", T.DoubleType()),
        T.StructField("yhat_lower", T.DoubleType()), T.StructField("yhat_upper", T.DoubleType())])

    def model(ns: DataFrame, origins: DataFrame, keys: list[str], horizon: int) -> DataFrame:
        one = F.lit(0).alias("_all")  # a run without keys is one group
        feats = feature_frame(ns, keys, horizon, holidays).select("*", one)
        folds = origins.select(*[F.col(k).alias(f"{k}__o") for k in keys], "fold", "cutoff", F.lit(0).alias("_all__o"))

        def per_series(rows: pd.DataFrame, folds: pd.DataFrame) -> pd.DataFrame:
            if rows.empty or folds.empty:
                return pd.DataFrame({c: pd.Series(dtype="object") for c in cols})
            res = predict_folds(rows, folds, horizon, yearly=yearly)
            for k in knames:
                res[k] = rows[k].iloc[0]
            return res[cols]

        return feats.groupBy("_all", *keys).cogroup(folds.groupBy("_all__o", *[f"{k}__o" for k in keys])).applyInPandas(per_series, schema)

    return model


def trend_fit(ns: DataFrame, keys: list[str]) -> DataFrame:
    """Least-squares trend per key over the whole series (t = rn)."""
    g = ns.groupBy(*keys) if keys else ns.groupBy()
    return g.agg(F.regr_slope("y", "rn").alias("slope"), F.regr_intercept("y", "rn").alias("intercept"), F.count(F.lit(1)).alias("n"))


def weekday_index(ns: DataFrame, keys: list[str]) -> DataFrame:
    """avg(y) / avg(trend) per weekday (Monday = 0) over the whole series."""
    fit = trend_fit(ns, keys)
    if keys:
        j = join_on(ns, fit.drop("n"), keys, "inner")
    else:  # one-row fit joined on a constant key
        j = ns.withColumn("_k", F.lit(0)).join(F.broadcast(fit.drop("n").withColumn("_k", F.lit(0))), "_k")
    trend = F.col("intercept") + F.col("slope") * F.col("rn")
    g = j.groupBy(*keys, F.weekday("ds").alias("wd"))
    return g.agg((F.avg("y") / F.avg(trend)).alias("index"))
