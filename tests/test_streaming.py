"""Streams: late data, restarts, update mode, equality with batch."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from checks import projections as p
from fareflow.operators import events, joins, lineage, surge
from fareflow.sources import keyed, streams
from fareflow.streaming import flows
from fareflow.streaming import late as late_stream
from fareflow.streaming import surge as surge_stream
from tests.conftest import SF

ENVELOPE = "key STRING, value STRING, topic STRING, `partition` INT, offset BIGINT, timestamp TIMESTAMP"


def drop_file(spark, folder, rows, n):
    """One file per call, later calls with later times."""
    value = lambda zone, status: json.dumps({"event_id": "e", "zone_id": zone, "city_id": "MUM", "status": status,
                                             "timestamp": "2024-01-01T00:00:00Z"})
    df = spark.createDataFrame([("MUM", value(z, s), "gps-normal", 0, i, None) for i, (z, s, _) in enumerate(rows)], ENVELOPE)
    df = df.withColumn("timestamp", F.element_at(F.array(*[F.timestamp_seconds(F.lit(t)) for _, _, t in rows]),
                                                 (F.col("offset") + 1).cast("int")))
    df.coalesce(1).write.parquet(f"{folder}/f{n}")
    for name in os.listdir(f"{folder}/f{n}"):
        os.utime(f"{folder}/f{n}/{name}", (time.time() - 1000 + n, time.time() - 1000 + n))


def run(spark, folder, job):
    source = streams.read_events(spark, path=f"{folder}/*", files_per_trigger=1)
    query = surge_stream.start_from_envelope(source, job, availableNow=True)
    query.awaitTermination()
    return query


def counts(spark, job):
    return {(r.zone_id, int(r.window_start.timestamp())): (r.on_trip_count, r.total_events)
            for r in surge_stream.windows_table(spark, job).collect()}


def test_update_late_and_restart(spark, tmp_path):
    folder, job = str(tmp_path / "in"), surge_stream.SurgeJob(str(tmp_path / "out"), str(tmp_path / "cp"), 10)
    drop_file(spark, folder, [("A", "on_trip", 1000), ("A", "available", 1003), ("B", "on_trip", 1001)], 1)
    drop_file(spark, folder, [("A", "on_trip", 1009), ("A", "on_trip", 1061)], 2)   # same window again, then ahead
    drop_file(spark, folder, [("A", "on_trip", 1065)], 3)
    drop_file(spark, folder, [("A", "on_trip", 1002), ("A", "on_trip", 1066)], 4)   # 1002 is behind the watermark
    late = surge_stream.LateRows()
    spark.streams.addListener(late)
    run(spark, folder, job)
    first = counts(spark, job)
    assert first == {("A", 1000): (2, 3), ("B", 1000): (1, 1), ("A", 1060): (3, 3)}
    for _ in range(50):  # progress arrives after the batch
        if late.total:
            break
        time.sleep(0.2)
    spark.streams.removeListener(late)
    assert late.total == 1
    done = lineage.lineage(surge_stream.lineage_events(spark, job)).collect()
    assert len(done) == 4 and {r.status for r in done} == {"success"}
    run(spark, folder, job)
    assert counts(spark, job) == first
    drop_file(spark, folder, [("B", "on_trip", 1071), ("A", "on_trip", 1068)], 5)
    run(spark, folder, job)
    assert counts(spark, job) == {**first, ("A", 1060): (4, 4), ("B", 1070): (1, 1)}
    latest = surge_stream.surge_table(spark, job)
    assert {r.zone_id for r in latest.collect()} == {"A", "B"}
    assert keyed.read_current(spark, f"{job.root}/kpis", ["batch"]).count() == 5


def test_replayed_batch_changes_nothing(spark, tmp_path):
    job = surge_stream.SurgeJob(str(tmp_path / "out"), "unused", 3600)
    zones = surge.zone_surge(p.pings(spark, SF, few_zones=True), 3600)
    write = surge_stream.write_batch(job)
    write(zones, 7)
    before = counts(spark, job)
    write(zones, 7)
    assert counts(spark, job) == before and sum(n for _, n in before.values()) == 1000
    per_zone = surge_stream.surge_table(spark, job).groupBy("zone_id").count().collect()
    assert {r["count"] for r in per_zone} == {1}


def test_failed_batch_leaves_lineage(spark, tmp_path):
    job = surge_stream.SurgeJob(str(tmp_path / "out"), "cp", 3600)
    broken = surge.zone_surge(p.pings(spark, SF, few_zones=True), 3600).withColumn("zone_id", F.raise_error("gone").cast("string"))
    with pytest.raises(Exception, match="gone"):
        surge_stream.write_batch(job)(broken, 3)
    rows = lineage.lineage(surge_stream.lineage_events(spark, job)).collect()
    assert [(r.batch_id, r.status) for r in rows] == [("cp/3", "failed")] and "gone" in rows[0].error


def test_every_attempt_leaves_lineage(spark, tmp_path):
    """A batch that fails, as in another process, and then succeeds: both attempts stay."""
    job = surge_stream.SurgeJob(str(tmp_path / "out"), "cp", 3600, with_kpis=False, compact_every=4)
    zones = surge.zone_surge(p.pings(spark, SF, few_zones=True), 3600)
    broken = zones.withColumn("zone_id", F.raise_error("gone").cast("string"))
    surge_stream.write_batch(job)(zones, 3)
    for _ in range(2):
        with pytest.raises(Exception, match="gone"):
            surge_stream.write_batch(job)(broken, 4)
    surge_stream.write_batch(job)(zones, 4)
    rows = lambda: sorted((r.batch_id, r.status, r.record_count) for r in lineage.lineage(surge_stream.lineage_events(spark, job)).collect())
    want = [("cp/3", "success", 1000), ("cp/4", "failed", None), ("cp/4#2", "failed", None), ("cp/4#3", "success", 1000)]
    assert rows() == want
    surge_stream.write_batch(job)(zones.limit(0), 8)  # an empty batch whose turn it is compacts too
    assert rows() == want and not lineage.open_batches(surge_stream.lineage_events(spark, job)).collect()
    assert os.path.exists(f"{job.root}/lineage/manifests") and os.path.exists(f"{job.root}/windows/manifests")


def status_events(spark, rows):
    """driver, status, second as decoded events."""
    return spark.createDataFrame([(d, "MUM", "Z", s, f"e{i}", t) for i, (d, s, t) in enumerate(rows)],
                                 "driver_id string, city_id string, zone_id string, status string, event_id string, t long").withColumn(
        "kafka_ts", F.timestamp_seconds("t")).drop("t")


def test_late_status_does_not_undo_a_newer_one(spark, tmp_path):
    batches = [[("a", "on_trip", 1005), ("b", "available", 1001)], [("a", "offline", 1000), ("b", "on_trip", 1002)],
               [("c", "available", 900)], [("a", "available", 1004), ("c", "on_trip", 901)]]
    for i, rows in enumerate(batches):
        status_events(spark, rows).coalesce(1).write.parquet(str(tmp_path / f"in/f{i}"))
        for name in os.listdir(tmp_path / f"in/f{i}"):
            os.utime(tmp_path / f"in/f{i}/{name}", (time.time() - 100 + i,) * 2)
    root = str(tmp_path / "t")
    source = spark.readStream.schema(status_events(spark, [("a", "x", 1)]).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    flows.driver_status_table(source, root, str(tmp_path / "cp"), compact_every=2).awaitTermination()
    state = lambda **kw: {r.driver_id: r.status for r in flows.driver_statuses(spark, root, **kw).collect()}
    assert state() == {"a": "on_trip", "b": "on_trip", "c": "on_trip"}
    assert os.path.exists(f"{root}/manifests")
    assert state(now=F.timestamp_seconds(F.lit(1250)), life_seconds=300) == {"a": "on_trip", "b": "on_trip"}
    assert state(drivers=spark.createDataFrame([("b",), ("x",)], "driver_id string")) == {"b": "on_trip"}


def test_split_tables_are_compacted(spark, tmp_path):
    p.envelope_of(p.pings(spark, SF)).repartition(7).write.parquet(str(tmp_path / "in"))
    source = streams.read_events(spark, path=str(tmp_path / "in"), files_per_trigger=1)
    good, dead = str(tmp_path / "good"), str(tmp_path / "dead")
    flows.split_faults(source, good, dead, str(tmp_path / "cp"), compact_every=2).awaitTermination()
    for root in (good, dead):
        assert len(os.listdir(f"{root}/changes")) <= 4
    assert sum(keyed.read_current(spark, root, []).count() for root in (good, dead)) == 1000


def test_router_splits_as_the_watermark_would(spark, tmp_path):
    """The rows that the plain stream drops are those the router keeps apart; replays change nothing."""
    folder = str(tmp_path / "in")
    job = surge_stream.SurgeJob(str(tmp_path / "out"), str(tmp_path / "cp"), 10, compact_every=2, keep_hours=10**6)
    drop_file(spark, folder, [("A", "on_trip", 1000), ("A", "available", 1003), ("B", "on_trip", 1001)], 1)
    drop_file(spark, folder, [("A", "on_trip", 1009), ("A", "on_trip", 1061)], 2)
    drop_file(spark, folder, [("A", "on_trip", 1002), ("A", "on_trip", 1065), ("A", "available", 1046)], 3)
    drop_file(spark, folder, [("A", "on_trip", 1002), ("B", "on_trip", 1066), ("A", "on_trip", 1055)], 4)
    decoded = lambda: events.drop_keyless(events.decode_events(streams.read_events(spark, path=f"{folder}/*", files_per_trigger=1)))
    late_stream.route(decoded(), job).awaitTermination()
    seconds = lambda df: sorted(int(r.kafka_ts.timestamp()) for r in df.select("kafka_ts").collect())
    assert seconds(late_stream.late_rows(spark, job)) == [1002, 1002, 1046]
    assert seconds(keyed.read_current(spark, f"{job.root}/on_time", [])) == [1000, 1001, 1003, 1009, 1055, 1061, 1065, 1066]
    surge_stream.start(late_stream.on_time_events(spark, job, decoded().schema, 1), job, availableNow=True).awaitTermination()
    full = {(r.zone_id, int(r.window_start.timestamp())): (r.on_trip_count, r.total_events, r.changed)
            for r in late_stream.with_late(spark, job).collect()}
    assert full == {("A", 1000): (4, 5, True), ("B", 1000): (1, 1, False), ("A", 1040): (0, 1, True), ("A", 1050): (1, 1, False),
                    ("A", 1060): (2, 2, False), ("B", 1060): (1, 1, False)}
    assert late_stream.with_late(spark, job, changed_only=True).count() == 2
    # Batch 3 again, as after a crash: split by the same marks, nothing counted twice.
    again = events.drop_keyless(events.decode_events(spark.read.schema(ENVELOPE).parquet(f"{folder}/f4")))
    late_stream.router(job)(again, 3)
    assert seconds(late_stream.late_rows(spark, job)) == [1002, 1002, 1046]


def test_history_is_renewed_per_batch(spark, tmp_path):
    """A new day of demand shows in the next batch; a batch that runs again keeps its version."""
    job = surge_stream.SurgeJob(str(tmp_path / "out"), "cp", 3600, with_kpis=False, history_root=str(tmp_path / "demand"))
    zones = surge.zone_surge(p.pings(spark, SF, few_zones=True), 3600)
    write = surge_stream.write_batch(job)
    trips = lambda: {r.history_trips for r in surge_stream.history_table(spark, job).select("history_trips").collect()}
    demand = zones.select("zone_id", "city_id", F.date_format("window_start", "yyyy-MM-dd'T'HH").alias("hour_bucket"),
                          F.lit(1.0).alias("avg_surge"), F.lit(2.0).alias("avg_fare_inr")).distinct()
    write(zones, 1)
    assert trips() == {None}  # no daily run yet
    for day, n in ((20240101, 5), (20240102, 6)):
        keyed.upsert(demand.withColumn("trip_count", F.lit(n)), job.history_root, day)
        write(zones, n)
        assert trips() == {n}
    write(zones, 6)
    keyed.upsert(demand.withColumn("trip_count", F.lit(9)), job.history_root, 20240103)
    write(zones, 6)
    assert trips() == {6}
    write(zones, 7)
    assert trips() == {9}


def test_tables_stay_small(spark, tmp_path):
    job = surge_stream.SurgeJob(str(tmp_path / "out"), "cp", 3600, with_kpis=False, compact_every=4, keep_hours=10**6)
    zones = surge.zone_surge(p.pings(spark, SF, few_zones=True), 3600)
    write = surge_stream.write_batch(job)
    for n in range(1, 14):
        write(zones, n)
    for name, per_batch in (("windows", 1), ("surge_pricing", 1), ("lineage", 2)):
        assert len(os.listdir(f"{job.root}/{name}/changes")) <= 2 * job.compact_every * per_batch
    assert sum(n for _, n in counts(spark, job).values()) == 1000


def test_empty_batch_writes_nothing(spark, tmp_path):
    job = surge_stream.SurgeJob(str(tmp_path / "out"), "unused", 3600)
    surge_stream.write_batch(job)(surge.zone_surge(p.pings(spark, SF).limit(0), 3600), 0)
    assert not os.path.exists(job.root)


def test_topics_are_filtered(spark, tmp_path):
    folder = str(tmp_path / "in")
    drop_file(spark, folder, [("A", "on_trip", 1000)], 1)
    assert streams.read_events(spark, topics=("gps-surge",), path=f"{folder}/*").isStreaming
    with pytest.raises(ValueError):
        streams.read_events(spark)


def test_split_keeps_every_record(spark, tmp_path):
    env = p.envelope_of(p.pings(spark, SF))
    env.repartition(3).write.parquet(str(tmp_path / "in"))
    source = streams.read_events(spark, path=str(tmp_path / "in"), files_per_trigger=1)
    flows.split_faults(source, str(tmp_path / "good"), str(tmp_path / "dead"), str(tmp_path / "cp")).awaitTermination()
    good = spark.read.parquet(str(tmp_path / "good" / "changes"))
    dead = spark.read.parquet(str(tmp_path / "dead" / "changes"))
    assert good.count() + dead.count() == 1000 and dead.count() == events.dead_letters(events.decode_with_faults(env)).count()


def test_driver_table_over_batches(spark, tmp_path):
    p.pings(spark, SF).repartition(4).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    flows.driver_status_table(source, str(tmp_path / "t"), str(tmp_path / "cp")).awaitTermination()
    table = keyed.read_current(spark, str(tmp_path / "t"), ["driver_id"])
    want = events.last_driver_status(p.pings(spark, SF))
    assert table.count() == want.count()


def test_history_lookup_on_a_stream(spark, tmp_path):
    """The lookup keeps zones without history and gives what batch gives."""
    zones = surge.with_surge(surge.zone_surge(p.pings(spark, SF, few_zones=True), 3600))
    zones.write.parquet(str(tmp_path / "zones"))
    history = zones.filter("zone_id < 'Z5'").groupBy(
        "zone_id", F.date_format("window_start", "yyyy-MM-dd'T'HH").alias("hour_bucket")).agg(
        F.sum("total_events").alias("trip_count"), F.lit(1.0).alias("avg_surge"), F.lit(2.0).alias("avg_fare_inr"))
    stream = spark.readStream.schema(zones.schema).parquet(str(tmp_path / "zones"))
    flows.to_parquet(joins.enrich_with_history(stream, history), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got, want = spark.read.parquet(str(tmp_path / "out")), joins.enrich_with_history(zones, history)
    assert got.count() == zones.count() and got.exceptAll(want).isEmpty()
    assert not got.filter("history_trips is null").isEmpty()
