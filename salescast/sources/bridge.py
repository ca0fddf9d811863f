"""Bridge: driver tables -> point-of-sale order data.

The driver supplies TPC-H-like ``orders`` and ``lineitem``. An order becomes
one order document and each of its line items one check. The rules below are
deterministic so an SQL oracle can restate them without nesting.

Two equivalent products:

* ``nested_orders``  one nested document per order (the source's own record
  shape, read by the flatten operator).
* ``landing_orders`` the flat 15-column landing row computed straight from the
  line items with mergeable aggregates. It equals ``flatten(nested_orders)``
  (asserted in tests) but never materialises an order's checks as an array,
  so partial aggregation runs before the shuffle and a hot order key cannot
  overload one task. Every mart/forecast query reads this path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.functions.dates import date_to_yyyymmdd, iso_utc_text
from salescast.functions.money import ACC, MONEY, rounded
from salescast.schemas import ORDER_COLUMNS
from salescast.sources.tables import table

# Bridge rules (order header).
OPEN_HOUR_BASE = 11  # opened at o_orderdate + (11 + o_orderkey % 10) hours
OPEN_HOUR_SPREAD = 10
CLOSE_AFTER_HOURS = 1  # closed one hour later unless the order is still open ('O')
DINING_OPTIONS = 4  # dining option guid 'do-' || o_custkey % 4, NULL when o_custkey % 10 = 0
VOID_EVERY = 17  # order voided when o_orderkey % 17 = 0
DELETE_EVERY = 23  # order deleted when o_orderkey % 23 = 0
# Bridge rules (checks, one per line item).
DEFERRED_PRICE = 25.0  # second selection: gift card, deferred when l_partkey % 10 = 0
TIP_RATE = 0.1  # tip = l_quantity * 0.1, NULL when l_quantity < 5
TIP_MIN_QTY = 5


def _money(c: Column) -> Column:
    return c.cast(MONEY)


def check_lines(lineitem: DataFrame) -> DataFrame:
    """One row per line item with the check's money as exact 4-dp decimals."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    disc = F.col("l_discount").cast("decimal(18,2)")
    tax_rate = F.col("l_tax").cast("decimal(18,2)")
    amount = _money(F.round(price * (F.lit(1) - disc), 4))
    tax = _money(F.round(amount * tax_rate, 4))
    tip = F.when(F.col("l_quantity") >= TIP_MIN_QTY, _money(F.col("l_quantity").cast("decimal(18,2)") * F.lit(TIP_RATE).cast("decimal(4,2)")))
    deferred_sel = (F.col("l_partkey") % 10 == 0)
    deferred_voided = (F.col("l_suppkey") % 5 == 0)
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        amount.alias("amount"),
        tax.alias("tax"),
        _money(amount + tax).alias("total"),
        tip.alias("tip"),
        ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).alias("check_voided"),
        (F.col("l_linenumber") == 7).alias("check_deleted"),
        deferred_sel.alias("sel_deferred"),
        deferred_voided.alias("sel_voided"),
        F.col("l_quantity"),
    )


def order_header(orders: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Order-level fields of the document, in source naming."""
    opened = F.col("o_orderdate") + F.make_interval(
        hours=(F.lit(OPEN_HOUR_BASE) + F.col("o_orderkey") % OPEN_HOUR_SPREAD).cast("int")
    )
    closed = F.when(F.col("o_orderstatus") != "O", opened + F.make_interval(hours=F.lit(CLOSE_AFTER_HOURS)))
    return orders.select(
        F.col("o_orderkey"),
        F.col("o_orderkey").cast("string").alias("guid"),
        date_to_yyyymmdd("o_orderdate").alias("businessDate"),
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey") % 6 + 1).alias("numberOfGuests"),
        iso_utc_text(opened).alias("openedDate"),
        iso_utc_text(closed).alias("closedDate"),
        F.col("o_orderpriority").alias("source"),
        (F.col("o_orderkey") % VOID_EVERY == 0).alias("voided"),
        (F.col("o_orderkey") % DELETE_EVERY == 0).alias("deleted"),
        F.when(
            F.col("o_custkey") % 10 != 0,
            F.struct(
                F.concat(F.lit("do-"), (F.col("o_custkey") % DINING_OPTIONS).cast("string")).alias("guid"),
                F.lit("DiningOption").alias("entityType"),
            ),
        ).alias("diningOption"),
        F.struct(
            F.concat(F.col("o_custkey").cast("string"), F.lit(" Main St")).alias("address1"),
            F.lit("Springfield").alias("city"),
            F.lpad((F.col("o_custkey") % 100000).cast("string"), 5, "0").alias("zipCode"),
        ).alias("deliveryInfo"),
        F.col("o_custkey"),
        *extra,
    )


def _line_struct() -> Column:
    """What tells the checks of one order apart, in the order in which the document's checks are sorted."""
    return F.struct(
        F.col("l_linenumber").alias("n"),
        F.col("amount").cast("double").alias("amount"),
        F.col("total").cast("double").alias("total"),
        F.col("tax").cast("double").alias("tax"),
        "check_voided",
        "check_deleted",
        F.col("tip").cast("double").alias("tip"),
        "l_quantity",
        "sel_deferred",
        "sel_voided",
    )


def _check(orderkey: Column, line: Column) -> Column:
    """One check of the document from its compact line."""
    order = orderkey.cast("string")
    key = F.concat(order, F.lit("-"), line["n"].cast("string"))
    return F.struct(
        key.alias("guid"),
        line["amount"].alias("amount"),
        line["total"].alias("totalAmount"),
        line["tax"].alias("taxAmount"),
        line["check_voided"].alias("voided"),
        line["check_deleted"].alias("deleted"),
        F.struct(
            F.concat(F.lit("c-"), key).alias("guid"),
            F.concat(F.lit("guest"), order, F.lit("@example.com")).alias("email"),
            F.lit("Pat").alias("firstName"),
            F.concat(F.lit("Guest"), order).alias("lastName"),
            F.lit("555-0100").alias("phone"),
        ).alias("customer"),
        F.array(
            F.struct(
                F.concat(F.lit("p-"), key).alias("guid"),
                line["total"].alias("amount"),
                line["tip"].alias("tipAmount"),
                F.lit("CREDIT").alias("type"),
                F.lpad((orderkey % 10000).cast("string"), 4, "0").alias("last4Digits"),
            )
        ).alias("payments"),
        F.array(
            F.struct(
                F.concat(F.lit("s0-"), key).alias("guid"),
                F.lit("Entree").alias("displayName"),
                line["l_quantity"].alias("quantity"),
                line["amount"].alias("price"),
                F.lit(False).alias("deferred"),
                F.lit(False).alias("voided"),
            ),
            F.struct(
                F.concat(F.lit("s1-"), key).alias("guid"),
                F.lit("Gift Card").alias("displayName"),
                F.lit(1.0).alias("quantity"),
                F.lit(DEFERRED_PRICE).alias("price"),
                line["sel_deferred"].alias("deferred"),
                line["sel_voided"].alias("voided"),
            ),
        ).alias("selections"),
    )


def nested_orders_from(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One nested document per order; orders without line items get NULL checks.

    Only compact lines are shuffled and sorted; the documents' texts are built after the join, so that a document's
    size is that of the output and of nothing before it."""
    lines = check_lines(lineitem).groupBy("l_orderkey").agg(F.sort_array(F.collect_list(_line_struct())).alias("_lines"))
    head = order_header(orders)
    # merged, never broadcast: the documents are built where the lines are, by as many tasks as the lines have
    docs = head.join(lines.hint("merge"), head["o_orderkey"] == lines["l_orderkey"], "left")
    return docs.select(
        "guid", "businessDate", "numberOfGuests", "openedDate", "closedDate", "source",
        "voided", "deleted", "diningOption", "deliveryInfo",
        F.transform("_lines", lambda x: _check(F.col("l_orderkey"), x)).alias("checks"),
    )


def nested_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_orders_from(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))


def _acc(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast(ACC)


def landing_orders_from(orders: DataFrame, lineitem: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Flat landing rows by mergeable aggregation over line items (see module
    doc). ``extra`` order columns (e.g. series keys) are carried through."""
    lines = check_lines(lineitem)
    live = ~F.col("check_voided") & ~F.col("check_deleted")
    deferred = live & F.col("sel_deferred") & ~F.col("sel_voided")
    per_order = lines.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_checks"),
        _acc(F.when(live, F.col("amount"))).alias("net"),
        _acc(F.when(live, F.col("total"))).alias("total"),
        _acc(F.when(live, F.col("tax"))).alias("tax"),
        _acc(F.when(live, F.col("tip"))).alias("tip"),
        _acc(F.when(deferred, F.lit(DEFERRED_PRICE).cast(MONEY))).alias("deferred"),
    )
    head = order_header(orders, extra)
    j = head.join(per_order, head["o_orderkey"] == per_order["l_orderkey"], "left")
    z = F.lit(0).cast(ACC)
    return j.select(
        F.col("businessDate").alias("business_date"),
        F.col("guid").alias("order_guid"),
        F.col("openedDate").alias("opened_date"),
        F.col("closedDate").alias("closed_date"),
        F.col("source"),
        F.col("diningOption.guid").alias("dining_option_guid"),
        F.col("numberOfGuests").alias("num_guests"),
        F.coalesce(F.col("n_checks"), F.lit(0)).cast("bigint").alias("num_checks"),
        rounded(F.coalesce(F.col("net"), z), 4).alias("net_amount"),
        rounded(F.coalesce(F.col("total"), z), 4).alias("total_amount"),
        rounded(F.coalesce(F.col("tax"), z), 4).alias("tax_amount"),
        rounded(F.coalesce(F.col("tip"), z), 4).alias("tip_amount"),
        rounded(F.coalesce(F.col("deferred"), z), 4).alias("deferred_amount"),
        F.col("voided"),
        F.col("deleted"),
        *extra,
    ).select(*extra, *ORDER_COLUMNS)


def landing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_orders_from(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))


# The multi-series key of an order (market segment x region).
SERIES_KEYS = ("c_mktsegment", "n_regionkey")


def keyed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders + (c_mktsegment, n_regionkey). customer and nation are joined by
    key; the planner (with AQE) picks broadcast or sort-merge on measured
    size, so no hint is forced on a table that grows with the data."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, F.col("c_nationkey") == n["n_nationkey"])


def keyed_landing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing rows with the series key columns in front."""
    return landing_orders_from(keyed_orders(spark, sf_dir), table(spark, sf_dir, "lineitem"), SERIES_KEYS)
