from __future__ import annotations

import json
from datetime import datetime, timedelta
from functools import partial

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import plan_of
from wanderlake import schemas
from wanderlake.functions.times import moment
from wanderlake.plans import bronze
from wanderlake.sources import messages
from wanderlake.sources.tables import create_if_missing
from wanderlake.streaming import flights, policies, topics

T0 = datetime(2024, 1, 1)
FLIGHT_DDL = schemas.ddl({**schemas.RAW_FLIGHTS, "on_ground": "string"})
POLICY_DDL = (
    "policy_id bigint, customer_id bigint, policy_number string, destination_country string, "
    "trip_start_date date, trip_end_date date, coverage_type string, premium_amount decimal(10,2), "
    "status string, broker_id bigint, created_at timestamp_ntz"
)


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def add_file(spark, rows, ddl, path):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)


def message(icao):
    return json.dumps({"icao24": icao, "timestamp": "2024-01-01T00:00:00"})


def test_ingest_restarts_where_it_stopped(spark, folder):
    source, table, mark = f"{folder}/in", f"{folder}/t", f"{folder}/c"
    add_file(spark, [("a", message("a")), ("b", "broken")], "key string, value string", source)

    def run():
        flights.start_ingest(stream_of(spark, source, "key string, value string"), table, mark).awaitTermination()
        landed = flights.landed_flights(spark, table)
        return sorted(r["icao24"] for r in landed.collect()), flights.landed_rejects(spark, table).count()

    assert run() == (["a"], 1)
    assert run() == (["a"], 1)  # nothing new
    add_file(spark, [("c", message("c"))], "key string, value string", source)
    assert run() == (["a", "c"], 1)
    row = flights.landed_flights(spark, table).first()
    assert list(row.asDict()) == list(schemas.RAW_FLIGHTS) and row["ingested_at"] is not None


def test_stream_deduplication_equals_batch_on_closed_windows(spark, folder):
    rows = [
        (f"u{i % 7}", f"c{i % 3}", "X", 1.0, None if i % 11 == 0 else 2.0, float(i % 5), 1.0, 1.0,
         ("true", "no", None)[i % 3], T0 + timedelta(seconds=3 * (i // 2)), T0)
        for i in range(600)
    ]
    source, table, mark = f"{folder}/in", f"{folder}/t", f"{folder}/c"
    for start in range(0, 600, 200):
        add_file(spark, rows[start:start + 200], FLIGHT_DDL, source)
    latest = flights.deduplicate(stream_of(spark, source, FLIGHT_DDL), delay="2 minutes")
    flights.start_sink(latest, table, mark).awaitTermination()
    streamed = spark.read.schema(latest.schema).parquet(table)
    closed = rows[-1][9] - timedelta(minutes=2)
    batch = bronze.clean_flights(spark.createDataFrame(rows, FLIGHT_DDL), T0)
    window_end = F.window(F.col("event_timestamp").cast("timestamp"), "30 seconds")["end"]
    expected = batch.filter(window_end.cast("timestamp_ntz") <= F.lit(closed).cast("timestamp_ntz")).select(streamed.columns)
    assert streamed.count() > 100
    assert streamed.exceptAll(expected).isEmpty() and expected.exceptAll(streamed).isEmpty()


def test_state_stream(spark, folder):
    source = f"{folder}/in"
    add_file(spark, [('{"states": [["a1", " X ", "UK"], []]}',)], "value string", source)
    keyed = flights.state_messages(stream_of(spark, source, "value string"), T0)
    flights.start_sink(keyed, f"{folder}/t", f"{folder}/c").awaitTermination()
    stored = spark.read.schema(keyed.schema).parquet(f"{folder}/t")
    assert [r["key"] for r in stored.collect()] == ["a1"]
    assert messages.accepted_flights(messages.decode_flights(stored)).first()["callsign"] == "X"


def policy(pid, minutes_ago):
    return (pid, 1, f"P{pid}", "UK", None, None, "medical", None, "active", 1, T0 - timedelta(minutes=minutes_ago))


def test_recent_policies(spark):
    df = spark.createDataFrame([policy(i, i) for i in range(100)], POLICY_DDL)
    assert [r["policy_id"] for r in policies.recent_policies(df, T0).collect()] == list(range(61))
    assert [r["policy_id"] for r in policies.recent_policies(df, T0, limit=2).collect()] == [0, 1]


def test_due_policies_start_again_when_all_were_sent(spark, folder):
    df = spark.createDataFrame([policy(1, 1), policy(2, 2), policy(3, 300)], POLICY_DDL)
    recent = policies.recent_policies(df, T0)
    due, again = policies.due_policies(recent, spark.createDataFrame([(1,)], "policy_id bigint"))
    assert ([r["policy_id"] for r in due.collect()], again) == ([2], False)

    def published():
        return sorted(json.loads(r["value"])["policy_id"] for r in spark.read.json(f"{folder}/topic").collect())

    def sent():
        return sorted(r["policy_id"] for r in spark.read.parquet(f"{folder}/sent").collect())

    create_if_missing(spark, f"{folder}/sent", policies.SENT_SCHEMA)
    policies.publish_due(df, T0, f"{folder}/topic", f"{folder}/sent")
    assert (published(), sent()) == ([1, 2], [1, 2])
    grown = df.union(spark.createDataFrame([policy(4, 0)], POLICY_DDL))
    policies.publish_due(grown, T0, f"{folder}/topic", f"{folder}/sent")
    assert (published(), sent()) == ([1, 2, 4], [1, 2, 4])
    policies.publish_due(grown, T0, f"{folder}/topic", f"{folder}/sent")
    assert (published(), sent()) == ([1, 1, 2, 2, 4, 4], [1, 2, 4])


def test_purchases_are_streamed_once(spark, folder):
    source = f"{folder}/in"
    add_file(spark, [policy(1, 10), policy(2, 9)], POLICY_DDL, source)
    add_file(spark, [policy(2, 9), policy(3, 8)], POLICY_DDL, source)
    events = policies.purchase_stream(stream_of(spark, source, POLICY_DDL))
    flights.start_sink(events, f"{folder}/t", f"{folder}/c").awaitTermination()
    keys = sorted(r["key"] for r in spark.read.schema(events.schema).parquet(f"{folder}/t").collect())
    assert keys == ["1", "2", "3"]


def test_topics_need_their_connector(spark):
    options = {"kafka.bootstrap.servers": "nowhere:1"}
    with pytest.raises(AnalysisException, match="kafka"):
        topics.read_topic(spark, topics.FLIGHT_TOPIC, options, 100)
    batch = spark.createDataFrame([("k", "v")], "key string, value string")
    with pytest.raises(AnalysisException, match="kafka"):
        topics.write_topic(batch, topics.POLICY_TOPIC, options)


def test_message_files_in_bounded_batches(spark, folder):
    for icao in ("a", "b", "c"):
        df = spark.createDataFrame([(icao, message(icao))], "key string, value string")
        topics.write_message_files(df.coalesce(1), f"{folder}/in")
    source = topics.read_message_files(spark, f"{folder}/in", max_files_per_batch=1)
    query = flights.start_ingest(source, f"{folder}/t", f"{folder}/c")
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1]
    assert sorted(r["icao24"] for r in flights.landed_flights(spark, f"{folder}/t").collect()) == ["a", "b", "c"]


def test_landed_days_are_pruned_and_archived(spark, folder):
    batches = [("a", datetime(2024, 1, 1, 5)), ("b", datetime(2024, 1, 2, 5)), ("c", datetime(2024, 1, 3, 5))]
    for icao, arrived in batches:
        topics.write_message_files(spark.createDataFrame([(icao, message(icao))], "key string, value string"), f"{folder}/in")
        source = topics.read_message_files(spark, f"{folder}/in")
        flights.start_ingest(source, f"{folder}/t", f"{folder}/c", moment(arrived), keep="30d").awaitTermination()
    recent = flights.landed_flights(spark, f"{folder}/t", datetime(2024, 1, 2, 4))
    assert sorted(r["icao24"] for r in recent.collect()) == ["b", "c"]
    partitions = plan_of(recent).split("PartitionFilters")[1].split("PushedFilters")[0]
    assert f"isnotnull({flights.LANDED_DAY}" in partitions and ">=" in partitions
    for _ in range(2):
        flights.compact_days(spark, f"{folder}/t", datetime(2024, 1, 3), f"{folder}/archive")
        assert sorted(r["icao24"] for r in flights.landed_flights(spark, f"{folder}/archive").collect()) == ["a", "b"]
        both = flights.landed_flights(spark, f"{folder}/t", archive_path=f"{folder}/archive")
        assert sorted(r["icao24"] for r in both.collect()) == ["a", "b", "c"]


def test_a_late_event_after_retention_keeps_its_day(spark, folder):
    live, archive, root = f"{folder}/t", f"{folder}/archive", f"{folder}/root"
    first, late = datetime(2024, 1, 1, 5), datetime(2024, 2, 20, 5)

    def land(icao, at, table):
        value = json.dumps({**json.loads(message(icao)), "latitude": 1.5, "longitude": 2.5})
        topics.write_message_files(spark.createDataFrame([(icao, value)], "key string, value string"), f"{table}-in")
        flights.start_ingest(topics.read_message_files(spark, f"{table}-in"), table, f"{table}-c", moment(at)).awaitTermination()

    land("a", first, live)
    land("b", first, live)
    bronze.refresh_flights(flights.landed_flights(spark, live), root, first)
    flights.compact_days(spark, live, datetime(2024, 1, 2), archive)
    # The live table has forgotten its old files; only the late event stands in it.
    land("c", late, f"{live}2")
    raw = flights.landed_flights(spark, f"{live}2", archive_path=archive)
    since = partial(flights.landed_flights, spark, f"{live}2", archive_path=archive)
    bronze.refresh_flights(raw, root, late, landed_since=since)
    assert sorted(r["icao24"] for r in bronze.read_clean_flights(raw, root).collect()) == ["a", "b", "c"]
    # A second copy of the days does not lose what the live table has forgotten.
    flights.compact_days(spark, f"{live}2", datetime(2024, 3, 1), archive)
    assert sorted(r["icao24"] for r in flights.landed_flights(spark, archive).collect()) == ["a", "b", "c"]


def test_drops_of_a_stream_are_written_by_many_tasks(spark, folder, monkeypatch):
    from wanderlake.registry import queries

    spark.read.parquet("/root/testdata/sf0.001/orders.parquet").repartition(6).write.parquet(f"{folder}/orders.parquet")
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(6).write.parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, purpose: f"{folder}/{purpose}")
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        events = queries.stream_policy_events(spark, folder).collect()
        landed = queries.stream_flight_restart(spark, folder).collect()
        drops = {"purchase-files": spark.read.parquet(f"{folder}/purchase-files/in"), "restart": spark.read.json(f"{folder}/restart/in")}
        sizes = {name: [r["count"] for r in rows.groupBy(F.input_file_name()).count().collect()] for name, rows in drops.items()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    assert len(events) == spark.read.parquet(f"{folder}/orders.parquet").count() == len({r["key"] for r in events})
    assert len(landed) == queries.flight_messages_accepted(spark, folder).count()
    assert max(sizes["purchase-files"]) < 0.3 * sum(sizes["purchase-files"])
    assert max(sizes["restart"]) < 0.15 * sum(sizes["restart"])
