"""Date keys and business-day helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The business time zone and the ISO text layout of source timestamps.
BUSINESS_TZ = "America/Chicago"
ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
ISO_UTC_SUFFIX = "+0000"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def yyyymmdd_to_date(c: Column | str) -> Column:
    """BIGINT/INT yyyymmdd -> DATE."""
    return F.to_date(_c(c).cast("string"), "yyyyMMdd")


def date_to_yyyymmdd(c: Column | str) -> Column:
    """DATE/TIMESTAMP -> BIGINT yyyymmdd."""
    return F.date_format(_c(c), "yyyyMMdd").cast("bigint")


def iso_utc_text(ts_ntz: Column | str) -> Column:
    """UTC wall-clock timestamp -> source text such as 2026-06-26T17:32:00.000+0000."""
    return F.concat(F.date_format(_c(ts_ntz), ISO_UTC_FORMAT), F.lit(ISO_UTC_SUFFIX))


def parse_iso_utc(text: Column | str) -> Column:
    """Source ISO text (with offset) -> UTC wall-clock TIMESTAMP_NTZ.

    The instant is parsed with its offset, then rendered in the session zone,
    which this library pins to UTC."""
    return _c(text).cast("timestamp").cast("timestamp_ntz")


def utc_to_local(ts_ntz: Column | str, tz: str = BUSINESS_TZ) -> Column:
    """UTC wall clock -> local wall clock, staying TIMESTAMP_NTZ."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts_ntz))


def local_business_day(ts_ntz: Column | str, tz: str = BUSINESS_TZ) -> Column:
    """The local business date (yyyymmdd BIGINT) of a UTC instant."""
    return date_to_yyyymmdd(utc_to_local(ts_ntz, tz))


def day_range(start: Column, end: Column) -> Column:
    """Inclusive daily DATE array [start, end]."""
    return F.sequence(start, end, F.expr("INTERVAL 1 DAY"))
