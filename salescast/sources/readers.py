"""Readers with pinned schemas (A1-A4)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.operators.series import densify_daily, to_series
from salescast.schemas import LANDING_ORDERS, NESTED_ORDER, SEED_SUMMARY


def scan_raw_orders(spark: SparkSession, root: str) -> DataFrame:
    """A1: every ``business_date=*`` directory under ``root`` with the pinned
    landing schema. The directory value is authoritative and comes back as
    BIGINT because the pinned schema says so (inference would give INT).
    Spark moves partition columns last; the pinned column order is restored."""
    return spark.read.schema(LANDING_ORDERS).parquet(root).select(*LANDING_ORDERS.fieldNames())


def read_nested_orders(spark: SparkSession, path: str) -> DataFrame:
    """A2: order documents (JSON lines) read with the pinned nested schema;
    integral JSON money is read as DOUBLE. Unknown fields are ignored."""
    return spark.read.schema(NESTED_ORDER).option("mode", "PERMISSIVE").json(path)


CORRUPT = "_corrupt_record"


def rescue_documents(df: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """A2 for a string column of JSON documents (e.g. a message value): (good, quarantine).

    Good rows have the document's columns after the frame's others. A document
    that cannot be taken whole, be it no JSON, JSON with a field of another type
    or no text at all, goes to quarantine with its row as it came and a reason
    ("malformed", "mistyped" or "missing"), never silently into nulls."""
    schema = T.StructType([*NESTED_ORDER.fields, T.StructField(CORRUPT, T.StringType())])
    # as a generator's output a document is parsed once: a plain column would be parsed again for the filter
    parsed = df.select(*df.columns, F.explode(F.array(F.from_json(F.col(col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))).alias("_doc"))
    bad = F.col("_doc").isNull() | F.col(f"_doc.{CORRUPT}").isNotNull()
    reason = F.when(F.col(col).isNull() | (F.trim(F.col(col)) == ""), F.lit("missing")) \
        .when(F.try_parse_json(F.col(col)).isNull(), F.lit("malformed")).otherwise(F.lit("mistyped"))
    good = parsed.where(~bad).select(*[c for c in df.columns if c != col], *[F.col(f"_doc.{f.name}").alias(f.name) for f in NESTED_ORDER.fields])
    return good, parsed.where(bad).select(*df.columns, reason.alias("reason"))


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """A3: the two-column daily summary CSV with a header."""
    return spark.read.schema(SEED_SUMMARY).option("header", True).csv(path)


@dataclass(frozen=True)
class Warehouse:
    """A4: where the tables are. Bronze and forecast tables are in ``schema``,
    the marts in ``<schema>_marts``."""

    catalog: str = "spark_catalog"
    schema: str = "default"

    def base(self, name: str) -> str:
        return f"{self.catalog}.{self.schema}.{name}"

    def mart(self, name: str = "fct_daily_sales") -> str:
        return f"{self.catalog}.{self.schema}_marts.{name}"


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    """A4: a catalog table by its full name, as a parameter of the statement."""
    return spark.sql(f"SELECT {', '.join(columns or ['*'])} FROM IDENTIFIER(:name)", args={"name": name})


def load_daily_series(spark: SparkSession, warehouse: Warehouse = Warehouse(), keys: list[str] | None = None) -> DataFrame:
    """A4: the daily mart as a continuous series [*keys, ds, y]: closed days and
    NULL sales count 0."""
    keys = keys or []
    mart = read_table(spark, warehouse.mart(), [*keys, "business_date", "net_sales"])
    return densify_daily(to_series(mart, keys), keys)
