from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal

from wanderlake.sources import messages

NOW = datetime(2024, 1, 30, 23, 59)


def decode(spark, values, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"value {kind}")
    decoded = messages.decode_flights(df)
    return [r.asDict() for r in decoded.collect()]


GOOD = {
    "icao24": "abc", "callsign": "X1", "origin_country": "UK", "longitude": 1, "latitude": 2.5,
    "altitude": None, "velocity": 1e2, "heading": 0.0, "on_ground": True,
    "timestamp": "2024-01-01T10:00:00+00:00",
}


def test_good_message(spark):
    row = decode(spark, [json.dumps(GOOD)])[0]
    assert row["accepted"]
    assert (row["longitude"], row["altitude"], row["velocity"], row["on_ground"]) == (1.0, None, 100.0, True)
    assert row["event_timestamp"] == datetime(2024, 1, 1, 10)


def test_absent_keys_and_extra_keys(spark):
    rows = decode(spark, ['{"icao24": "a"}', "{}", '{"icao24": 12, "other": [1]}', ' {"icao24": "a"} '])
    assert [r["accepted"] for r in rows] == [True] * 4
    assert rows[1]["icao24"] is None and rows[2]["icao24"] == "12"


def test_numbers_as_text_fit(spark):
    rows = decode(spark, ['{"altitude": "12.5"}', '{"altitude": "high"}', '{"altitude": {"m": 1}}', '{"on_ground": 1}', '{"timestamp": "soon"}'])
    assert [r["accepted"] for r in rows] == [True, False, False, True, False]
    assert rows[0]["altitude"] == 12.5 and rows[3]["on_ground"] is True


def test_rejects(spark):
    bad = ['{"icao24": "a"', "[1]", "null", "", "  ", '"text"', "12", '{"a":1} tail', '{"a":1}{"b":2}',
           '{"a":1},{"b":2}', '[{"icao24":"a"}]', None]
    rows = decode(spark, bad)
    assert [r["accepted"] for r in rows] == [False] * len(bad)
    assert [r["raw_value"] for r in rows] == bad


def test_invalid_utf8_is_rejected(spark):
    rows = decode(spark, [bytearray(b'{"icao24": "a\xff"}'), bytearray(b'{"icao24": "ok"}')], "binary")
    assert [r["accepted"] for r in rows] == [False, True]


def test_split(spark):
    df = spark.createDataFrame([(json.dumps(GOOD),), ("broken",)], "value string")
    decoded = messages.decode_flights(df)
    assert messages.accepted_flights(decoded).count() == 1
    assert [r[0] for r in messages.rejected_messages(decoded).collect()] == ["broken"]


def test_states(spark):
    full = ["a1", " CALL \t", "UK", 1, 2, 3.5, 4.5, 5.5, True, 6.5, 7.5]
    response = {"time": 1, "states": [full, [], None, ["", "ghost"], [None, "x"], ["b2"], ["c3", None, "FR"], full[:8] + [False] + full[9:]]}
    df = spark.createDataFrame([(json.dumps(response),), ('{"states": null}',), ("{}",)], "value string")
    rows = [r.asDict() for r in messages.normalise_states(messages.flight_states(df), NOW).collect()]
    assert [r["icao24"] for r in rows] == ["a1", "b2", "c3", "a1"]
    assert rows[0] == {
        "icao24": "a1", "callsign": "CALL", "origin_country": "UK", "longitude": 3.5, "latitude": 4.5,
        "altitude": 5.5, "velocity": 6.5, "heading": 7.5, "on_ground": True,
        "timestamp": "2024-01-30T23:59:00+00:00",
    }
    assert rows[1]["callsign"] is None and rows[1]["on_ground"] is False
    assert rows[2]["callsign"] == "" and rows[2]["origin_country"] == "FR"
    assert rows[3]["on_ground"] is False


def test_keyed_json_round_trip(spark):
    states = spark.createDataFrame([(["a1", "X", "UK"],)], "state array<string>")
    row = messages.keyed_json(messages.normalise_states(states, NOW), "icao24").first()
    assert row["key"] == "a1"
    assert json.loads(row["value"])["longitude"] is None
    assert decode(spark, [row["value"]])[0]["accepted"]


def test_policy_record(spark):
    df = spark.createDataFrame(
        [(1, date(2024, 1, 2), Decimal("10.50"), datetime(2024, 1, 1, 1, 2, 3, 4), datetime(2024, 1, 1), None)],
        "policy_id bigint, trip_start_date date, premium_amount decimal(10,2), created_at timestamp_ntz, "
        "seen_at timestamp_ntz, note string",
    )
    value = messages.keyed_json(messages.policy_records(df, NOW), "policy_id").first()["value"]
    assert json.loads(value) == {
        "policy_id": 1, "trip_start_date": "2024-01-02", "premium_amount": 10.5,
        "created_at": "2024-01-01T01:02:03.000004", "seen_at": "2024-01-01T00:00:00", "note": None,
        "event_timestamp": "2024-01-30T23:59:00+00:00", "event_type": "policy_purchase",
    }
