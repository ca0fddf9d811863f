"""B1/B2: nested order document -> privacy-safe flat order row.

One ``select`` of higher-order functions: no explode, no shuffle, no Python.
Only allow-listed leaves are referenced, so nested-schema pruning keeps the
PII fields out of the scan as well as out of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.functions.arrays import array_sum, count_elements, live, nested_sum
from salescast.functions.money import rounded
from salescast.schemas import ORDER_COLUMNS, PII_TOKENS


def live_checks(checks: Column) -> Column:
    return live(checks)


def _net(lc: Column) -> Column:
    return array_sum(lc, lambda c: c["amount"])


def tips(lc: Column) -> Column:
    """Every payment's tip on live checks (no payment-level void test)."""
    return nested_sum(lc, lambda c: c["payments"], lambda p: p["tipAmount"])


def deferred(lc: Column) -> Column:
    """B1d: deferred, non-voided selections on live checks; modifiers ignored."""
    return nested_sum(
        lc,
        lambda c: F.filter(
            c["selections"],
            lambda s: F.coalesce(s["deferred"], F.lit(False)) & ~F.coalesce(s["voided"], F.lit(False)),
        ),
        lambda s: s["price"],
    )


def flatten_orders(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Flatten nested documents to the 15-column landing row (int64 counts).
    ``carry`` names non-PII document columns kept in front (e.g. a version)."""
    lc = live_checks(F.col("checks"))
    out = docs.select(
        *carry,
        F.col("businessDate").cast("bigint").alias("business_date"),
        F.col("guid").alias("order_guid"),
        F.col("openedDate").alias("opened_date"),
        F.col("closedDate").alias("closed_date"),
        F.col("source"),
        F.col("diningOption.guid").alias("dining_option_guid"),
        F.col("numberOfGuests").cast("bigint").alias("num_guests"),
        count_elements(F.col("checks")).alias("num_checks"),
        rounded(_net(lc), 4).alias("net_amount"),
        rounded(array_sum(lc, lambda c: c["totalAmount"]), 4).alias("total_amount"),
        rounded(array_sum(lc, lambda c: c["taxAmount"]), 4).alias("tax_amount"),
        rounded(tips(lc), 4).alias("tip_amount"),
        rounded(deferred(lc), 4).alias("deferred_amount"),
        F.coalesce(F.col("voided"), F.lit(False)).alias("voided"),
        F.coalesce(F.col("deleted"), F.lit(False)).alias("deleted"),
    )
    assert_no_pii(out.drop(*carry))
    return out


def assert_no_pii(df: DataFrame) -> DataFrame:
    """B2 guard: the allow-list is exact and no column name carries a PII token."""
    cols = df.columns
    if cols != ORDER_COLUMNS:
        raise ValueError(f"flat order columns drifted from the allow-list: {cols}")
    bad = [c for c in cols if any(t in c.lower() for t in PII_TOKENS)]
    if bad:
        raise ValueError(f"PII-looking columns present: {bad}")
    return df


def pii_allowlist(docs: DataFrame) -> DataFrame:
    """B2 as a query: exactly the allow-listed keys, pruned at the scan."""
    return flatten_orders(docs).select(*ORDER_COLUMNS)
