"""JSON messages and API responses."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderlake.fixed_values import POLICY_EVENT_TYPE
from wanderlake.functions.text import ALL_WHITE_SPACE
from wanderlake.functions.times import iso_text, moment, utc_now
from wanderlake.schemas import FLIGHT_MESSAGE_FIELDS, STATE_VECTOR_POSITIONS

KEEP_NULLS = {"ignoreNullFields": "false"}


def decode_flights(messages: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Decode flight messages; adds ``accepted`` and keeps the raw text as ``raw_value``.

    A message is accepted when it is one JSON object in valid UTF-8 and every present field
    fits its column; absent fields are NULL. Everything else is a reject with all fields NULL
    or partly filled, told apart by ``accepted``.
    """
    as_text = ", ".join(f"`{name}` string" for name in FLIGHT_MESSAGE_FIELDS)
    text = F.col("value").cast("string")
    parsed = F.from_json(
        text, f"{as_text}, `__broken` string", {"columnNameOfCorruptRecord": "__broken"}
    )
    # Wrapped in brackets the text must be an array of exactly one value: this finds anything
    # that follows the object, which from_json alone would ignore.
    values = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    # Exploding a one-element array keeps a later filter from being pushed below the parser,
    # where it would parse every message once per field it tests.
    decoded = (
        messages.select(text.alias("raw_value"), F.array(F.struct(parsed, values)).alias("__once"))
        .select("raw_value", F.explode_outer("__once").alias("__once"))
        .select("raw_value", F.col("__once.col1").alias("__json"), F.col("__once.col2").alias("__values"))
    )
    fits = F.lit(True)
    columns = []
    for name, wanted in FLIGHT_MESSAGE_FIELDS.items():
        field = F.col(f"__json.{name}")
        value = field if wanted == "string" else field.try_cast(wanted)
        column = "event_timestamp" if name == "timestamp" else name
        columns.append(value.alias(column))
        if wanted != "string":
            fits = fits & (field.isNull() | value.isNotNull())
    whole = (
        F.is_valid_utf8("raw_value")
        & F.col("__json.__broken").isNull()
        & (F.col("__values") == 1)
        & F.ltrim("raw_value").startswith("{")
    )
    return decoded.select(
        *columns,
        (utc_now() if ingested_at is None else ingested_at).alias("ingested_at"),
        F.coalesce(whole & fits, F.lit(False)).alias("accepted"),
        "raw_value",
    )


def accepted_flights(decoded: DataFrame) -> DataFrame:
    return decoded.filter("accepted").drop("accepted", "raw_value")


def rejected_messages(decoded: DataFrame) -> DataFrame:
    return decoded.filter("not accepted").select("raw_value")


def flight_states(responses: DataFrame) -> DataFrame:
    """State vectors of API responses; empty vectors and those without an aircraft go."""
    vectors = F.from_json("value", "states array<array<string>>").getField("states")
    # An outer explode parses once; a plain one would first filter on the parsed array's size.
    exploded = responses.select(F.explode_outer(vectors).alias("state"))
    return exploded.filter(F.coalesce(F.get("state", F.lit(0)), F.lit("")) != "")


def normalise_states(states: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Positional state vectors to named records; positions beyond a short vector are NULL."""

    def at(name: str) -> Column:
        return F.get("state", F.lit(STATE_VECTOR_POSITIONS[name]))

    numbers = ("longitude", "latitude", "altitude", "velocity", "heading")
    flag = F.lower(at("on_ground"))
    callsign = F.when(
        F.size("state") > STATE_VECTOR_POSITIONS["callsign"],
        F.btrim(F.coalesce(at("callsign"), F.lit("")), F.lit(ALL_WHITE_SPACE)),
    )
    now = utc_now() if as_of is None else moment(as_of)
    return states.select(
        at("icao24").alias("icao24"),
        callsign.alias("callsign"),
        at("origin_country").alias("origin_country"),
        *[at(name).try_cast("double").alias(name) for name in numbers],
        F.coalesce(~flag.isin("false", "0", "0.0", ""), F.lit(False)).alias("on_ground"),
        F.concat(iso_text(now), F.lit("+00:00")).alias("timestamp"),
    )


def keyed_json(records: DataFrame, key: str) -> DataFrame:
    """(key, value) messages; NULL fields are written out."""
    return records.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*records.columns), KEEP_NULLS).alias("value"),
    )


def policy_records(policies: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Policies as event records: ISO dates and times, plain numbers, event time and type."""
    now = utc_now() if as_of is None else moment(as_of)
    fields = [_plain(f).alias(f.name) for f in policies.schema.fields]
    return policies.select(
        *fields,
        F.concat(iso_text(now), F.lit("+00:00")).alias("event_timestamp"),
        F.lit(POLICY_EVENT_TYPE).alias("event_type"),
    )


def _plain(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(column)
    if isinstance(field.dataType, T.DateType):
        return F.date_format(column, "yyyy-MM-dd")
    if isinstance(field.dataType, T.DecimalType):
        return column.cast("double")
    return column
