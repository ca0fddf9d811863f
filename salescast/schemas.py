"""Pinned schemas for every persisted table and for the nested order document.

All tables are written with these StructTypes, never with inference: an
all-NULL band column or an integral money day must not change a column type.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The flat order row (landing and bronze share names and order).
ORDER_COLUMNS = [
    "business_date",
    "order_guid",
    "opened_date",
    "closed_date",
    "source",
    "dining_option_guid",
    "num_guests",
    "num_checks",
    "net_amount",
    "total_amount",
    "tax_amount",
    "tip_amount",
    "deferred_amount",
    "voided",
    "deleted",
]

MONEY_COLUMNS = ["net_amount", "total_amount", "tax_amount", "tip_amount", "deferred_amount"]

# Landing files carry the two counts as int64; bronze narrows them to INT.
LANDING_ORDERS = T.StructType(
    [
        T.StructField("business_date", T.LongType()),
        T.StructField("order_guid", T.StringType()),
        T.StructField("opened_date", T.StringType()),
        T.StructField("closed_date", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("dining_option_guid", T.StringType()),
        T.StructField("num_guests", T.LongType()),
        T.StructField("num_checks", T.LongType()),
        T.StructField("net_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("tax_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("deferred_amount", T.DoubleType()),
        T.StructField("voided", T.BooleanType()),
        T.StructField("deleted", T.BooleanType()),
    ]
)

BRONZE_ORDERS = T.StructType(
    [
        T.StructField(f.name, T.IntegerType() if f.name in ("num_guests", "num_checks") else f.dataType)
        for f in LANDING_ORDERS.fields
    ]
)

# Nested order document. Only the fields named here are ever read; the PII
# leaves (customer contact, delivery address, card digits) are present so that
# tests can prove they never reach an output column.
_CUSTOMER = T.StructType(
    [
        T.StructField("guid", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("phone", T.StringType()),
    ]
)
_PAYMENT = T.StructType(
    [
        T.StructField("guid", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("tipAmount", T.DoubleType()),
        T.StructField("type", T.StringType()),
        T.StructField("last4Digits", T.StringType()),
    ]
)
_SELECTION = T.StructType(
    [
        T.StructField("guid", T.StringType()),
        T.StructField("displayName", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("deferred", T.BooleanType()),
        T.StructField("voided", T.BooleanType()),
    ]
)
CHECK = T.StructType(
    [
        T.StructField("guid", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("totalAmount", T.DoubleType()),
        T.StructField("taxAmount", T.DoubleType()),
        T.StructField("voided", T.BooleanType()),
        T.StructField("deleted", T.BooleanType()),
        T.StructField("customer", _CUSTOMER),
        T.StructField("payments", T.ArrayType(_PAYMENT)),
        T.StructField("selections", T.ArrayType(_SELECTION)),
    ]
)
NESTED_ORDER = T.StructType(
    [
        T.StructField("guid", T.StringType()),
        T.StructField("businessDate", T.LongType()),
        T.StructField("numberOfGuests", T.LongType()),
        T.StructField("openedDate", T.StringType()),
        T.StructField("closedDate", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("voided", T.BooleanType()),
        T.StructField("deleted", T.BooleanType()),
        T.StructField(
            "diningOption",
            T.StructType([T.StructField("guid", T.StringType()), T.StructField("entityType", T.StringType())]),
        ),
        T.StructField(
            "deliveryInfo",
            T.StructType(
                [
                    T.StructField("address1", T.StringType()),
                    T.StructField("city", T.StringType()),
                    T.StructField("zipCode", T.StringType()),
                ]
            ),
        ),
        T.StructField("checks", T.ArrayType(CHECK)),
    ]
)

# Words that identify personal or card data in a column name.
PII_TOKENS = ["email", "phone", "name", "address", "city", "zip", "last4", "card", "customer", "delivery", "first", "last", "digits", "payment"]

# Forecast and serving tables.
FORECAST = T.StructType(
    [
        T.StructField("forecast_date", T.LongType()),
        T.StructField("yhat", T.DoubleType()),
        T.StructField("yhat_lower", T.DoubleType()),
        T.StructField("yhat_upper", T.DoubleType()),
        T.StructField("model", T.StringType()),
        T.StructField("run_ts", T.TimestampNTZType()),
    ]
)
METRICS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("mape", T.DoubleType()),
        T.StructField("wape", T.DoubleType()),
        T.StructField("horizon", T.IntegerType()),
        T.StructField("n_folds", T.IntegerType()),
        T.StructField("run_ts", T.TimestampNTZType()),
    ]
)
BACKTEST = T.StructType(
    [
        T.StructField("forecast_date", T.LongType()),
        T.StructField("yhat", T.DoubleType()),
        T.StructField("model", T.StringType()),
        T.StructField("fold", T.IntegerType()),
        T.StructField("run_ts", T.TimestampNTZType()),
    ]
)
SEED_SUMMARY = T.StructType(
    [T.StructField("business_date", T.LongType()), T.StructField("net_sales", T.DoubleType())]
)

# Table names of the reference's warehouse layout.
BRONZE_TABLE = "bronze_orders"
FORECAST_TABLE = "forecast_daily_sales"
HISTORY_TABLE = "forecast_history"
METRICS_TABLE = "model_metrics"
BACKTEST_TABLE = "backtest_predictions"


#: The tables that a forecast run writes; the archives keep every run.
FORECAST_TABLES = {FORECAST_TABLE: FORECAST, HISTORY_TABLE: FORECAST, METRICS_TABLE: METRICS, BACKTEST_TABLE: BACKTEST}
ARCHIVES = (HISTORY_TABLE, METRICS_TABLE)


def with_keys(schema: T.StructType, keys: list[tuple[str, T.DataType]]) -> T.StructType:
    """Prefix a table schema with series-key columns (multi-series tables)."""
    return T.StructType([T.StructField(k, t) for k, t in keys] + list(schema.fields))


def ddl(table: str, schema: T.StructType, partitioned_by: list[str] | None = None, fmt: str = "parquet", location: str | None = None) -> str:
    """CREATE TABLE IF NOT EXISTS text for a pinned schema (A10)."""
    cols = ",\n  ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in schema.fields)
    part = f"\nPARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    return f"CREATE TABLE IF NOT EXISTS {table} (\n  {cols}\n) USING {fmt}{part}" + (f"\nLOCATION '{location}'" if location else "")
