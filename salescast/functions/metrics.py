"""Forecast error metrics as aggregate expressions.

Rows are pooled: the metric of a group is computed over all its rows, not as
a mean of per-fold metrics. Undefined MAPE/WAPE is NULL (the reference's NaN).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _err(y: str, yhat: str) -> Column:
    return F.col(y) - F.col(yhat)


def mae(y: str = "y", yhat: str = "yhat") -> Column:
    return F.avg(F.abs(_err(y, yhat)))


def rmse(y: str = "y", yhat: str = "yhat") -> Column:
    return F.sqrt(F.avg(_err(y, yhat) * _err(y, yhat)))


def mape(y: str = "y", yhat: str = "yhat") -> Column:
    """Mean absolute % error over rows with a non-zero actual."""
    return F.avg(F.when(F.col(y) != 0, F.abs(_err(y, yhat) / F.col(y)))) * 100


def wape(y: str = "y", yhat: str = "yhat") -> Column:
    """sum|err| / sum|y| * 100, NULL when the actuals sum to zero."""
    denom = F.sum(F.abs(F.col(y)))
    return F.when(denom != 0, F.sum(F.abs(_err(y, yhat))) / denom * 100)
