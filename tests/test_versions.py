"""Whole JSON events through upgrade and downgrade."""

import json

import pytest
from pyspark.sql import functions as F

from fareflow.operators import versions

NOW = "timestamp'2024-03-01 10:20:30'"


def through(spark, *texts, back=True):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    up = versions.upgrade_json(df, now=F.expr(NOW))
    rows = up.orderBy("i").collect()
    return [(r.upgrade, r.from_version, r.value) for r in rows], [r.value for r in versions.downgrade_json(up).orderBy("i").collect()] if back else None


V1 = {"driver_id": "d", "lat": 28.61, "lon": 77.23, "status": "on_trip", "timestamp": "2025-04-16T00:00:00Z", "heading": 12.5,
      "nested": {"a": [1, None, {"b": "ü\"x"}], "e": {}}, "big": 12345678901234567890, "flag": True, "none": None, "text": "", "list": []}


def test_round_trip_is_the_identity(spark):
    """For a version 1 event with a text time, up and down again gives every field back."""
    up, down = through(spark, json.dumps(V1), json.dumps({**V1, "schema_version": 1}))
    for kind, version, text in up:
        got = json.loads(text)
        assert (kind, version) == ("upgraded", 1)
        assert got == {**{k: v for k, v in V1.items() if k != "timestamp"}, "event_time": V1["timestamp"], "schema_version": 2,
                       "vehicle_type": "unknown", "battery_level": -1, "zone_id": "Z_D8310B"}
    assert [json.loads(t) for t in down] == [{**V1, "schema_version": 1}] * 2


def test_upgrade_twice_is_upgrade_once(spark):
    up, _ = through(spark, json.dumps(V1), back=False)
    again, _ = through(spark, up[0][2], back=False)
    assert again[0] == ("same", 2, up[0][2])


@pytest.mark.parametrize("text, kind", [
    ('{"schema_version": 3, "x" :1}', "same"), ('{"schema_version": 0}', "unsupported"), ('{"schema_version": "two"}', "unsupported"),
    ("not json", "malformed"), ("[1, 2]", "malformed"), ("7", "malformed"), ("null", "malformed"), (None, "malformed")])
def test_other_events_keep_their_text(spark, text, kind):
    up, _ = through(spark, text, back=False)
    assert (up[0][0], up[0][2]) == (kind, text)


def test_times_and_defaults(spark):
    up, down = through(spark, '{"timestamp": 1744800000, "vehicle_type": "cab", "zone_id": null}', '{"timestamp": null}', "{}")
    got = [json.loads(t) for _, _, t in up]
    assert [g["event_time"] for g in got] == ["2025-04-16T10:40:00+00:00", "2024-03-01T10:20:30+00:00", "2024-03-01T10:20:30+00:00"]
    assert got[0]["vehicle_type"] == "cab" and got[0]["zone_id"] is None and got[1]["zone_id"] is None
    assert [sorted(json.loads(t)) for t in down] == [["schema_version", "timestamp"]] * 3


def test_malformed_stays_in_downgrade(spark):
    df = spark.createDataFrame([("[1]",), (None,), ('{"a":1}',)], "value string")
    assert [r.value for r in versions.downgrade_json(df).collect()] == ["[1]", None, '{"a":1,"schema_version":1}']


def test_fields_to_add_are_computed_only_where_missing(spark):
    """No lambda over maps holds the new fields: those run interpreted and compute all of them for every row."""
    df = spark.createDataFrame([('{"a":1}',)], "value string")
    down = versions.downgrade_json(versions.upgrade_json(df, now=F.expr(NOW)))
    plan = down._jdf.queryExecution().optimizedPlan().toString()
    assert "map_filter(map(" not in plan and "schema_of_variant(__v" not in plan
