"""Raw inputs as projections of the given tables.

Every function reads the whole table and maps each row to one raw row (or two, where a later
version of the same record is part of the input). The oddities that the jobs must clean up
are a function of the row's key.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake.fixed_values import CONTINENT_BY_DESTINATION, ISO_CODE_BY_COUNTRY
from wanderlake.functions.times import iso_text

SHIFT_DAYS = 10_227  # 28 years: 1995 becomes 2023


def _as_entered(names: Iterable[str]) -> tuple[str, ...]:
    """Names as people enter them: in turn as they are, blank before, in lower case, blank after."""
    forms = (str.title, " {}".format, str.lower, "{} ".format)
    return tuple(forms[i % len(forms)](name) for i, name in enumerate(names))


COUNTRIES = (*_as_entered(ISO_CODE_BY_COUNTRY), "Atlantis", None)
DESTINATIONS = (*_as_entered(CONTINENT_BY_DESTINATION), "Narnia")
CLAIM_TYPES = (" medical", "CANCELLATION ", "baggage", "Delay")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(values: tuple, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), index.cast("int"))


def _versions(has_second: Column) -> Column:
    return F.explode(F.when(has_second, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


def _seconds(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, name = F.col("c_custkey"), F.col("c_name")
    rows = read(spark, sf_dir, "customer").select("c_custkey", "c_name", _versions(key % 10 == 0).alias("v"))
    hours = F.make_dt_interval(F.lit(0), (key + F.col("v") * 24).cast("int"))
    return rows.select(
        key.alias("customer_id"),
        F.concat(F.lit("  "), F.split_part(name, F.lit("#"), F.lit(1))).alias("first_name"),
        F.concat(
            F.split_part(name, F.lit("#"), F.lit(2)),
            F.when(F.col("v") == 1, "-B ").otherwise(" "),
        ).alias("last_name"),
        F.concat(F.lit("  "), F.upper(name), F.lit("@EXAMPLE.COM ")).alias("email"),
        F.when(
            key % 61 != 0, F.date_add(F.lit("1955-01-01").cast("date"), (key * 37 % 18600).cast("int"))
        ).alias("date_of_birth"),
        _pick(COUNTRIES, key % 22).alias("country_of_residence"),
        F.when(key % 7 != 0, F.concat(F.lit(" +44-"), key.cast("string"), F.lit(" "))).alias("phone"),
        (F.lit("2023-01-01").cast("timestamp_ntz") + hours).alias("created_at"),
    )


def raw_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").withColumn("v", _versions(F.col("o_orderkey") % 20 == 0))
    return orders.select(*_policy_columns())


def first_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first version of every policy."""
    return read(spark, sf_dir, "orders").withColumn("v", F.lit(0)).select(*_policy_columns())


def _policy_columns() -> list[Column]:
    key, customer, v = F.col("o_orderkey"), F.col("o_custkey"), F.col("v")
    start = F.date_add(F.to_date("o_orderdate"), SHIFT_DAYS)
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return [
        key.alias("policy_id"),
        customer.alias("customer_id"),
        F.concat(F.lit(" POL-"), F.lpad(key.cast("string"), 9, "0"), F.lit(" ")).alias("policy_number"),
        F.when(customer % 41 != 0, _pick(DESTINATIONS, customer % 11)).alias("destination_country"),
        start.alias("trip_start_date"),
        F.date_add(start, (key % 29 + 2).cast("int")).alias("trip_end_date"),
        F.when(priority == "1-URGENT", " Medical")
        .when(priority == "2-HIGH", "cancellation ")
        .when(priority == "3-MEDIUM", "BAGGAGE")
        .otherwise("comprehensive")
        .alias("coverage_type"),
        F.when(key % 53 == 0, F.lit(None).cast("string"))
        .when(key % 97 == 0, "n/a")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("premium_amount"),
        F.when(v == 1, "active ")
        .when(status == "P", "Active")
        .when(status == "F", " EXPIRED")
        .otherwise("cancelled ")
        .alias("status"),
        (key % 120).alias("broker_id"),
        (F.col("o_orderdate") + _days(F.lit(SHIFT_DAYS) + v * 3) + _seconds(key % 86400)).alias("created_at"),
    ]


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    claim_date = F.date_add(F.to_date("l_shipdate"), SHIFT_DAYS)
    flag = F.col("l_returnflag")
    return read(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("claim_id"),
        F.col("l_orderkey").alias("policy_id"),
        _pick(CLAIM_TYPES, part % 4).alias("claim_type"),
        F.when(part % 211 == 0, "0")
        .when(part % 223 == 0, "-12.505")
        .when(part % 199 == 0, "n/a")
        .otherwise(F.col("l_extendedprice").cast("string"))
        .alias("claim_amount"),
        claim_date.alias("claim_date"),
        F.when(flag == "A", "Approved ").when(flag == "R", " rejected").otherwise("PENDING").alias("status"),
        F.when(supplier % 3 != 0, F.concat(F.lit("line "), F.col("l_linestatus"))).alias("description"),
        F.when(
            flag != "N",
            claim_date.cast("timestamp_ntz") + _days(supplier % 30) + _seconds(part % 86400),
        ).alias("processed_at"),
        (F.col("l_shipdate") + _days(F.lit(SHIFT_DAYS)) + _seconds(part % 86400)).alias("created_at"),
    )


def raw_brokers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reports per broker; the country comes from the nation table."""
    suppliers = read(spark, sf_dir, "supplier").withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key, v = F.col("s_suppkey"), F.col("v")
    value = (F.abs("s_acctbal").cast("decimal(12,2)") * (v + 1) * 10).cast("decimal(12,2)")
    hundredths = (key % 16 + 5).cast("decimal(4,0)")
    earned = F.round(value * hundredths / 100, 2).cast("decimal(12,2)")
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        key.alias("broker_id"),
        F.concat(F.lit(" "), F.col("s_name")).alias("broker_name"),
        F.concat(F.lit("Company "), (key % 7).cast("string"), F.lit(" ")).alias("broker_company"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("country"),
        (key % 40 + 1).alias("policies_sold_today"),
        value.alias("total_premium_value"),
        ((key % 16 + 5) / F.lit(100.0)).alias("commission_rate"),
        earned.alias("commission_earned"),
        F.date_add(F.lit("2024-01-01").cast("date"), v).alias("report_date"),
    )


def _flight_columns() -> list[Column]:
    key, kind = F.col("event_id"), F.col("event_type")
    return [
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("icao24"),
        F.when(key % 9 == 0, "   ")
        .otherwise(F.concat(F.lit(" FL"), key.cast("string"), F.lit(" ")))
        .alias("callsign"),
        F.concat(kind, F.lit(" ")).alias("origin_country"),
        (key % 360 - 180).cast("double").alias("longitude"),
        F.when(key % 11 != 0, (key % 11).cast("double")).alias("latitude"),
        F.col("value").alias("altitude"),
        F.get_json_object("props", "$.k").cast("double").alias("velocity"),
        (key % 360).cast("double").alias("heading"),
        F.when(kind == "click", "TRUE")
        .when(kind == "view", "1")
        .when(kind == "error", "no")
        .when(kind == "purchase", "Yes")
        .alias("on_ground"),
        F.col("ts").alias("event_timestamp"),
        (F.col("ts") + _seconds(key % 120)).alias("ingested_at"),
    ]


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(*_flight_columns())


def raw_flight_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_stream(spark, sf_dir).select(*_flight_columns())


def flight_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed JSON messages, some of them broken."""
    return _messages(read(spark, sf_dir, "events"))


def flight_message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(_event_stream(spark, sf_dir))


def api_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One API response per event: its state vector, an empty one and one without aircraft."""
    return _responses(read(spark, sf_dir, "events"))


def api_response_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _responses(_event_stream(spark, sf_dir))


def stream_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets as if the events were a topic of eight partitions, consumed in part."""
    partition = (F.col("user_id") % 8).cast("int").alias("partition")
    done = F.count_if(F.col("event_id") % 5 != 0)
    counted = read(spark, sf_dir, "events").groupBy(partition).agg(
        F.count(F.lit(1)).alias("high"), done.alias("done")
    )
    number = F.col("partition")
    return counted.select(
        number,
        F.lit(0).cast("bigint").alias("low"),
        "high",
        F.when(number == 3, F.lit(-1))
        .when(number == 5, F.col("high") + 10)
        .otherwise(F.col("done"))
        .cast("bigint")
        .alias("committed"),
    )


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream(spark, sf_dir, "events")


def _stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    reader = spark.readStream.schema(read(spark, sf_dir, table).schema)
    return reader.option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)


def _messages(events: DataFrame) -> DataFrame:
    rows = events.select("event_id", *_flight_columns())
    key = F.col("event_id")
    stamp = iso_text(F.col("event_timestamp")).alias("timestamp")
    telemetry = ["longitude", "latitude", "altitude", "velocity", "heading"]
    ground = (F.col("on_ground") == "TRUE").alias("on_ground")
    whole = F.to_json(
        F.struct("icao24", "callsign", "origin_country", *telemetry, ground, stamp),
        {"ignoreNullFields": "false"},
    )
    short = F.to_json(F.struct("icao24", stamp))
    value = (
        F.when(key % 100 == 0, F.concat(F.lit('{"icao24": "'), "icao24"))
        .when(key % 101 == 0, "[1]")
        .when(key % 107 == 0, F.lit('{"icao24": "bad", "altitude": "high"}'))
        .when(key % 103 == 0, short)
        .otherwise(whole)
    )
    return rows.select(F.col("icao24").alias("key"), value.alias("value"))


def _responses(events: DataFrame) -> DataFrame:
    rows = events.select("event_id", *_flight_columns())
    key = F.col("event_id")

    def text(name: str) -> Column:
        return F.col(name).cast("string")

    unused = F.lit("0")
    ground = F.when(F.col("on_ground") == "TRUE", "true").otherwise("false")
    state = F.array(
        "icao24", "callsign", "origin_country", unused, unused, text("longitude"), text("latitude"),
        text("altitude"), ground, text("velocity"), text("heading"),
    )
    cut = F.when(key % 17 == 0, F.slice(state, 1, 0)).when(key % 13 == 0, F.slice(state, 1, 3)).otherwise(state)
    blank = F.array(F.lit(""), F.lit("ghost"))
    value = F.to_json(F.struct(F.array(cut, F.slice(state, 1, 0), blank).alias("states")))
    return rows.select(value.alias("value"))
