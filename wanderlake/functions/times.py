"""Date and time expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Integer text is an epoch; its size tells the unit (seconds, milli-, micro-, else nanoseconds).
EPOCH_SECONDS_BELOW = 31_536_000_000
EPOCH_MILLIS_BELOW = 31_536_000_000_000
EPOCH_MICROS_BELOW = 31_536_000_000_000_000


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def moment(as_of: datetime) -> Column:
    """A fixed zone-less point in time."""
    return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")


def utc_now() -> Column:
    """The query's start as zone-less UTC, whatever the session's zone."""
    now = F.current_timestamp().cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), now)


def iso_text(ts: Column) -> Column:
    """ISO 8601 text of a zone-less time; six digits of fraction when there is one."""
    text = F.replace(ts.cast("string"), F.lit(" "), F.lit("T"))
    return F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text)


def parse_timestamp_text(value: Column) -> Column:
    """Zone-less timestamp from text; a zone suffix is dropped, bad text gives NULL."""
    number = value.try_cast("bigint")
    size = F.abs(number)
    micros = (
        F.when(size < EPOCH_SECONDS_BELOW, number * 1_000_000)
        .when(size < EPOCH_MILLIS_BELOW, number * 1_000)
        .when(size < EPOCH_MICROS_BELOW, number)
        .otherwise((number / 1_000).cast("bigint"))
    )
    seconds = (micros.cast("decimal(24,6)") / 1_000_000).cast("decimal(18,6)")
    since_epoch = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return F.when(
        value.rlike(r"^\s*-?\d+\s*$"), _epoch() + since_epoch
    ).otherwise(value.try_cast("timestamp_ntz"))


def timestamp_of(df: DataFrame, name: str) -> Column:
    """Tolerant zone-less timestamp of a column.

    Only text needs parsing; a column that already is a timestamp keeps its plain form so
    filters on it still reach the scan.
    """
    if isinstance(df.schema[name].dataType, T.StringType):
        return parse_timestamp_text(F.col(name))
    return F.col(name).try_cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds between zone-less times; the session's zone plays no part."""
    return (end - start).cast("interval second").cast("bigint")


def bucket_number(ts: Column, seconds: int) -> Column:
    """Number of the epoch bucket a wall-clock time falls in, cut toward zero; NULL stays NULL."""
    return F.call_function("div", seconds_between(_epoch(), ts), F.lit(seconds).cast("bigint"))


def bucket_start(ts: Column, seconds: int) -> Column:
    offset = (bucket_number(ts, seconds) * seconds).cast("decimal(18,6)")
    return _epoch() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), offset)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def days_to_process(claim_date: Column, processed_raw: Column, processed_at: Column) -> Column:
    return F.when(processed_raw.isNotNull(), F.datediff(F.to_date(processed_at), claim_date))


def age_in_years(born: Column, as_of: datetime) -> Column:
    """Calendar years between birth year and this year, not below zero; NULL when unknown."""
    years = F.lit(as_of.year) - F.year(born)
    return F.when(born.isNotNull(), F.greatest(years, F.lit(0)))


def weekday_number(day: Column) -> Column:
    """Sunday 0 … Saturday 6."""
    return F.dayofweek(day) - 1


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def hours_before(as_of: datetime, hours: int) -> Column:
    return moment(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))


def minutes_before(as_of: datetime, minutes: int) -> Column:
    return moment(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
