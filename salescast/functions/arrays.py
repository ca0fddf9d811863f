"""Higher-order-function helpers over the nested order document (B1a-B1e).

A check/selection/payment is "live" unless its flag is true; a missing or NULL
flag counts as live. Array sums treat a NULL array, NULL element field or empty
array as 0 and are exact decimals (see functions.money).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from salescast.functions.money import ACC, dec, zero


def is_live(node: Column) -> Column:
    return ~F.coalesce(node["voided"], F.lit(False)) & ~F.coalesce(node["deleted"], F.lit(False))


def live(arr: Column) -> Column:
    """Elements that are neither voided nor deleted."""
    return F.filter(arr, is_live)


def array_sum(arr: Column, value: Callable[[Column], Column]) -> Column:
    """Exact sum of ``value(element)`` with NULL -> 0; NULL array -> 0."""
    total = F.aggregate(arr, zero(), lambda acc, x: (acc + F.coalesce(dec(value(x)), zero())).cast(ACC))
    return F.coalesce(total, zero())


def nested_sum(arr: Column, inner: Callable[[Column], Column], value: Callable[[Column], Column]) -> Column:
    """B1c/B1d: two-level sum, e.g. tips over checks x payments."""
    return array_sum(arr, lambda outer: array_sum(inner(outer), value))


def count_elements(arr: Column) -> Column:
    """B1e: array length with NULL -> 0 (size(NULL) is NULL under ANSI)."""
    return F.coalesce(F.size(arr), F.lit(0)).cast("bigint")
