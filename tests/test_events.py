"""Single-event rules on hand-made cases."""

import json

from pyspark.sql import functions as F

from fareflow.operators import alerts, events, lineage, observability
from fareflow.operators.joins import join_status

NOW = "timestamp'2024-03-01 00:00:00'"


def bodies(spark, *values):
    return spark.createDataFrame([(i, v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)],
                                 "i int, value string")


def test_validation(spark):
    full = {"driver_id": "D1", "lat": 1.0, "lon": 2.0, "status": "on_trip"}
    cases = [full] + [{k: v for k, v in full.items() if k != gone} for gone in full]
    cases += [{**full, "status": None}, {**full, "schema_version": 2}, "not json", {}]
    rows = events.check_requests(events.parse_requests(bodies(spark, *cases))).orderBy("i").collect()
    assert [r.accepted for r in rows] == [True, False, False, False, False, True, True, False, False]
    assert rows[1].reason == "Missing fields: driver_id"
    assert rows[8].reason == "Missing fields: driver_id, lat, lon, status"
    assert [r.schema_version for r in rows[:1] + rows[6:7]] == [1, 2]
    assert rows[0].ingestion_id != rows[5].ingestion_id and rows[1].ingestion_id is None


def test_upgrade_paths(spark):
    base = {"driver_id": "D001", "lat": 28.61, "lon": 77.23, "status": "on_trip"}
    cases = [{**base, "speed": 42.5, "timestamp": 1744800000, "schema_version": 1},
             {**base, "timestamp": "2025-04-16T10:40:00Z"}, base,
             {**base, "timestamp": "1744800000"},
             {**base, "event_time": "x", "schema_version": 2}, {**base, "schema_version": 3},
             {**base, "schema_version": 0}, {**base, "vehicle_type": None, "zone_id": "Z_OWN"}]
    parsed = events.parse_requests(bodies(spark, *cases))
    up = events.upgrade_events(parsed, now=F.expr(NOW))
    rows = up.orderBy("i").collect()
    assert [r.upgrade for r in rows] == ["upgraded"] * 4 + ["same", "same", "unsupported", "upgraded"]
    assert [r.event_time for r in rows] == [
        "2025-04-16T10:40:00+00:00", "2025-04-16T10:40:00Z", "2024-03-01T00:00:00+00:00", "1744800000",
        "x", None, None, "2024-03-01T00:00:00+00:00"]
    assert rows[0].zone_id == "Z_D8310B" and rows[0].vehicle_type == "unknown" and rows[0].battery_level == -1
    assert rows[7].vehicle_type is None and rows[7].zone_id == "Z_OWN"
    assert rows[5].schema_version == 3 and rows[0].timestamp is None
    valid = up.select("i", events.satisfies_version(2).alias("ok")).orderBy("i").collect()
    assert [r.ok for r in valid] == [True, True, True, True, True, False, False, True]
    again = events.upgrade_events(up.drop("from_version", "upgrade"), now=F.expr(NOW))
    assert up.filter("upgrade <> 'unsupported'").drop("from_version", "upgrade").exceptAll(
        again.filter("upgrade <> 'unsupported'").drop("from_version", "upgrade")).isEmpty()
    assert {r.upgrade for r in events.upgrade_events(parsed, target=3).collect()} == {"unsupported", "same"}


def test_downgrade(spark):
    parsed = events.parse_requests(bodies(spark, {"driver_id": "D", "lat": 1, "lon": 2, "status": "s", "event_time": "t",
                                                  "schema_version": 2, "vehicle_type": "cab"}))
    down = events.downgrade_events(parsed)
    row = down.first()
    assert row.timestamp == "t" and row.schema_version == 1 and "vehicle_type" not in down.columns
    assert sorted(row["keys"]) == ["driver_id", "lat", "lon", "schema_version", "status", "timestamp"]


def test_faults_cover_everything(spark):
    good = {"event_id": "e", "zone_id": "Z", "status": "on_trip", "speed_kmh": 5}
    values = [json.dumps(good), "not json", json.dumps({**good, "speed_kmh": "7"}), json.dumps({**good, "speed_kmh": 3.5}),
              json.dumps({"event_id": "e"}), None]
    env = spark.createDataFrame([(v,) for v in values], "value string").withColumn("timestamp", F.expr(NOW))
    decoded = events.decode_with_faults(env)
    assert [r.fault for r in decoded.collect()] == [None, "malformed", "malformed", "malformed", "missing_key", "malformed"]
    assert events.accepted_events(decoded).count() + events.dead_letters(decoded).count() == len(values)
    assert events.drop_keyless(events.decode_events(env)).count() == 3


def test_batch_limits(spark):
    asked = spark.createDataFrame([("none",), ("some",), ("many",)], "request_id string")
    sent = spark.createDataFrame([("some",)] * 3 + [("many",)] * 4, "request_id string")
    verdicts = events.request_verdicts(asked, sent, limit=3)
    assert {r.request_id: r.code for r in verdicts.collect()} == {"none": 422, "some": 202, "many": 413}
    assert events.admit(sent, verdicts).count() == 3


def test_join_status_is_exact(spark):
    """All pairs within reach, none twice, for a driver with most of the rows."""
    import random
    rng = random.Random(1)
    make = lambda n: [(rng.choice(["hot", "hot", "hot", "x", "y"]), i, 1_700_000_000 + rng.randint(0, 4000)) for i in range(n)]
    left, right = make(300), make(300)
    frame = lambda rows, a, b: spark.createDataFrame(rows, f"driver_id string, {a} int, s long").select(
        "driver_id", a, F.timestamp_seconds("s").alias(b))
    pairs = join_status(frame(left, "g", "gps_ts"), frame(right, "s_id", "status_ts"), 30)
    got = sorted((r.g, r.s_id) for r in pairs.collect())
    want = sorted((g, s) for d, g, t in left for e, s, u in right if d == e and abs(t - u) <= 30)
    assert got == want


def test_change_defaults(spark):
    schema = "eventName string, NewImage map<string, struct<S: string, N: string>>"
    rows = [("INSERT", {"surge_multiplier": (None, "2.5"), "zone_id": ("Z1", None)}), ("REMOVE", {"zone_id": ("Z2", None)}),
            ("MODIFY", {}), ("MODIFY", None), ("MODIFY", {"waiting_riders": (None, "4")})]
    got = alerts.read_changes(spark.createDataFrame(rows, schema)).collect()
    assert [tuple(r)[1:] for r in got] == [("Z1", "UNKNOWN", 2.5, 0, 0, 0.0, "unknown"),
                                           ("UNKNOWN", "UNKNOWN", 1.0, 4, 0, 0.0, "unknown")]
    message = alerts.alert_message(alerts.surge_alerts(alerts.read_changes(spark.createDataFrame(rows, schema)))).first()
    assert message.subject == "SURGE 2.5x — Z1" and "Waiting:    0 riders" in message.body


def test_lineage_rules(spark):
    at = lambda s: F.timestamp_seconds(F.lit(s))
    rows = [("a", "start", 100.0), ("a", "end", 100.25), ("a", "end", 300.0), ("b", "start", 5.0), ("ghost", "end", 9.0)]
    df = spark.createDataFrame(rows, "batch_id string, kind string, s double").select(
        "batch_id", "kind", F.lit("streaming").alias("stage"), F.lit("in").alias("input_source"),
        F.lit("out").alias("output_sink"), F.lit(5).cast("bigint").alias("record_count"),
        F.lit(2).alias("schema_version"), F.lit("success").alias("status"), F.repeat(F.lit("e"), 600).alias("error"),
        F.timestamp_seconds("s").alias("at"))
    (done,) = lineage.lineage(df).collect()
    assert (done.batch_id, done.duration_ms, len(done.error)) == ("a", 250, 500)
    assert [tuple(r) for r in lineage.open_batches(df).collect()] == [("streaming", 1)]


def test_metrics_text(spark):
    text = ['spark_batch_latency_ms 12.5', 'gps_events_sent_total{topic="a",city="B"} 3 1700', "# TYPE x gauge", "",
            "active_drivers_count", "events_per_minute oops", "unknown_metric 4", "  spark_active_surge_zones   7  ",
            'gps_events_sent_total{topic="a"']
    df = spark.createDataFrame([(t,) for t in text], "value string")
    got = [tuple(r) for r in observability.parse_metrics_text(df).collect()]
    assert got == [("spark_batch_latency_ms", 12.5, ""), ("gps_events_sent_total", 3.0, 'topic="a",city="B"'),
                   ("active_drivers_count", 0.0, ""), ("spark_active_surge_zones", 7.0, "")]
