"""The adaptive stream: another window after a restart, decisions from progress."""

import os
import time

import pytest
from pyspark.sql import functions as F

from fareflow.operators import surge
from fareflow.streaming import adaptive

SCHEMA = "zone_id string, city_id string, status string, timestamp string, t double"


def events(spark, rows):
    df = spark.createDataFrame([(z, "MUM", s, None, float(t)) for z, s, t in rows], SCHEMA)
    return df.withColumn("kafka_ts", F.timestamp_micros((F.col("t") * 1_000_000).cast("bigint"))).drop("t").withColumn(
        "timestamp", F.date_format("kafka_ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))


def drop(spark, folder, rows, n):
    df = events(spark, rows)
    df.coalesce(1).write.parquet(f"{folder}/f{n}")
    for name in os.listdir(f"{folder}/f{n}"):
        os.utime(f"{folder}/f{n}/{name}", (time.time() - 1000 + n,) * 2)
    return df


def source(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def rows_of(df):
    return sorted((r.zone_id, int(r.window_start.timestamp()), r.on_trip_count, r.available_count, r.total_events) for r in df.collect())


def test_restart_with_another_window(spark, tmp_path):
    """Windows of the new width that began before the restart have the rows of both runs."""
    folder = str(tmp_path / "in")
    job = adaptive.AdaptiveJob(str(tmp_path / "out"), str(tmp_path / "cp"), watermark_seconds=30, compact_every=2, keep_hours=10**6)
    narrow = adaptive.record(spark, job, adaptive.Decision(1, 500, 2, 4, 1000, 2))
    first = drop(spark, folder, [("A", "on_trip", 1000), ("A", "available", 1001.5), ("A", "on_trip", 1003), ("B", "on_trip", 1002)], 1)
    adaptive.start(source(spark, folder, first.schema), job, availableNow=True).awaitTermination()
    assert rows_of(adaptive.windows_table(spark, job)) == rows_of(surge.zone_surge(first, 2))
    assert adaptive.current_decision(spark, job) == narrow

    adaptive.record(spark, job, adaptive.Decision(2, 5000, 5, 10, 5000, 5))
    second = drop(spark, folder, [("A", "on_trip", 1004), ("A", "on_trip", 1011), ("B", "available", 1002.2)], 2)
    third = drop(spark, folder, [("A", "available", 1013), ("C", "on_trip", 1014)], 3)
    adaptive.start(source(spark, folder, first.schema), job, availableNow=True).awaitTermination()
    every = first.unionByName(second).unionByName(third)
    published = adaptive.windows_table(spark, job)
    assert rows_of(published.filter("window_seconds = 5")) == rows_of(surge.zone_surge(every, 5))
    assert rows_of(published.filter("window_seconds = 2")) == rows_of(surge.zone_surge(first, 2))
    for seconds in (1, 2, 5, 10):
        assert rows_of(adaptive.windows_of(spark, job, seconds)) == rows_of(surge.zone_surge(every, seconds))


@pytest.mark.parametrize("rate, took, window, rows", [(50.0, 100, 2, 4 * 1000 * 2), (500.0, 100, 4, 10 * 5000 * 4), (50.0, 6500, 7, 4 * 1000 * 5)])
def test_decisions(spark, tmp_path, rate, took, window, rows):
    """Input rate to drivers to configuration; a slow batch widens the window."""
    job = adaptive.AdaptiveJob(str(tmp_path / "out"), "unused")
    report = {"numInputRows": 10, "inputRowsPerSecond": rate, "durationMs": {"triggerExecution": took}}
    got = adaptive.decide(spark, job, [report, {"numInputRows": 0, "inputRowsPerSecond": 1e9}])
    assert (got.n, got.drivers, got.window_seconds, got.rows_per_trigger) == (1, rate * 10, window, rows)
    assert adaptive.decide(spark, job, []).same_as(adaptive.current_decision(spark, job))
    adaptive.record(spark, job, got)
    assert adaptive.current_decision(spark, job) == got


def test_supervisor_restarts_on_new_load(spark, tmp_path):
    """A run that sees a higher rate than it was set up for is restarted with another decision."""
    folder = str(tmp_path / "in")
    df = drop(spark, folder, [("A", "on_trip", 1000 + i % 30) for i in range(400)], 1)
    job = adaptive.AdaptiveJob(str(tmp_path / "out"), str(tmp_path / "cp"), drivers=6000, keep_hours=10**6)
    seen = []

    def make(decision):
        seen.append(decision.window_seconds)
        return source(spark, folder, df.schema)

    end = time.time() + 90
    last = adaptive.supervise(spark, job, make, patience=1, poll_seconds=1.0, rounds=1, stop=lambda: time.time() > end)
    assert seen == [4] and last.n == 1 and not last.same_as(adaptive.Decision(0, 6000, 4, 12, 5000, 4))
