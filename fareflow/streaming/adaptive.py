"""A surge stream that fits its window and rate to the load.

The state of the stream holds fixed slots (a second each, say), never windows. Windows
of the width in force are made from the slots they consist of, so another width
needs no other state: the stream restarts on the same checkpoint, and a window that
began before the restart still has all its rows. What Spark ties to a checkpoint, the
number of state partitions, stays what the first start chose.

A control table keeps every decision. ``decide`` makes one from the progress reports of a
run: the highest input rate gives the number of drivers, ``adaptive_config`` the window,
parallelism and rate for it, and a window is never shorter than a batch takes.
``supervise`` runs the stream and restarts it when a new decision differs.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareflow.functions.timeparts import trigger_seconds
from fareflow.operators import experiments, surge
from fareflow.sources import keyed

SLOT_KEYS = ["zone_id", "city_id", "window_start"]
WINDOW_KEYS = [*SLOT_KEYS, "window_seconds"]
COUNTS = ["on_trip_count", "available_count", "total_events"]
CONTROL = "n bigint, drivers bigint, window_seconds int, parallelism int, max_rate_per_partition int, trigger_s int, decided_at timestamp"
#: Fixed value: a driver sends one position in ten seconds.
SECONDS_PER_PING = 10


@dataclass(frozen=True)
class AdaptiveJob:
    """Tables under ``root``: ``slots``, ``windows``, ``surge_pricing``, ``control``. Slots and
    windows older than ``keep_hours`` leave at compaction."""
    root: str
    checkpoint: str
    ram_gb: int = 8
    drivers: int = 1000
    slot_seconds: int = 1
    watermark_seconds: int = 10
    scale_level: str = "5K"
    compact_every: int = 50
    keep_hours: int = 24


@dataclass(frozen=True)
class Decision:
    n: int
    drivers: int
    window_seconds: int
    parallelism: int
    max_rate_per_partition: int
    trigger_s: int

    @property
    def rows_per_trigger(self) -> int:
        """The rate cap for a source that takes one."""
        return self.max_rate_per_partition * self.parallelism * self.trigger_s

    def same_as(self, other: Decision) -> bool:
        return (self.window_seconds, self.rows_per_trigger) == (other.window_seconds, other.rows_per_trigger)


# -- control loop ------------------------------------------------------------

def _configured(spark: SparkSession, job: AdaptiveJob, n: int, drivers: int, least_window: int = 0) -> Decision:
    config = experiments.adaptive_config(spark.createDataFrame([(drivers, job.ram_gb)], "drivers bigint, ram_gb int"))
    # A window is made of whole slots.
    slots = F.ceil(F.greatest("window_seconds", F.lit(least_window)) / F.lit(job.slot_seconds)) * job.slot_seconds
    row = config.withColumn("window_seconds", slots.cast("int")).withColumn("trigger_s", trigger_seconds(F.col("window_seconds"))).first()
    return Decision(n, drivers, row.window_seconds, row.parallelism, row.max_rate_per_partition, row.trigger_s)


def current_decision(spark: SparkSession, job: AdaptiveJob) -> Decision:
    """The newest decision; before the first one, what the job's own number of drivers gives."""
    root = f"{job.root}/control"
    if not keyed.has_batches(spark, root):
        return _configured(spark, job, 0, job.drivers)
    row = keyed.read_current(spark, root, ["n"]).orderBy(F.desc("n")).drop("decided_at", keyed.VERSION).first()
    return Decision(**row.asDict())


def record(spark: SparkSession, job: AdaptiveJob, d: Decision) -> Decision:
    row = (d.n, d.drivers, d.window_seconds, d.parallelism, d.max_rate_per_partition, d.trigger_s, datetime.now(timezone.utc))
    keyed.upsert(spark.createDataFrame([row], CONTROL), f"{job.root}/control", d.n)
    keyed.maintain(spark, f"{job.root}/control", ["n"], d.n, job.compact_every)
    return d


def decide(spark: SparkSession, job: AdaptiveJob, progress: list[dict]) -> Decision:
    """What the newest reports of a run ask for; without any rows, what is in force."""
    now = current_decision(spark, job)
    fed = [p for p in progress if p.get("numInputRows")]
    if not fed:
        return now
    took = max(p.get("durationMs", {}).get("triggerExecution", 0) for p in fed) / 1000
    # A first batch has no input rate yet; its rows came in a trigger's time at least.
    rates = [p["inputRowsPerSecond"] for p in fed if math.isfinite(p.get("inputRowsPerSecond") or math.nan)]
    rates += [p["numInputRows"] / max(took, now.trigger_s) for p in fed]
    drivers = max(1, math.ceil(max(rates) * SECONDS_PER_PING))
    return _configured(spark, job, now.n + 1, drivers, math.ceil(took))


def supervise(spark: SparkSession, job: AdaptiveJob, source: Callable[[Decision], DataFrame], patience: int = 3,
              poll_seconds: float = 5.0, rounds: int | None = None,
              stop: Callable[[], bool] = lambda: False) -> Decision:
    """Run the stream; when ``patience`` looks in a row ask for another configuration, record it
    and restart on the same checkpoint. Ends after ``rounds`` runs, or when ``stop`` says so."""
    done = 0
    while rounds is None or done < rounds:
        current = current_decision(spark, job)
        query, asked = start(source(current), job, current), 0
        while asked < patience and query.isActive and not stop():
            time.sleep(poll_seconds)
            wanted = decide(spark, job, [p if isinstance(p, dict) else p.jsonValue for p in query.recentProgress[-5:]])
            asked = 0 if wanted.same_as(current) else asked + 1
        if query.exception() is not None:
            raise query.exception()
        if not query.isActive:
            return current
        query.stop()
        if asked < patience:
            return current
        record(spark, job, wanted)
        done += 1
    return current_decision(spark, job)


# -- the stream --------------------------------------------------------------

def start(events: DataFrame, job: AdaptiveJob, decision: Decision | None = None, **trigger) -> StreamingQuery:
    """Run on decoded events with ``kafka_ts``, with the decision in force."""
    decision = decision or current_decision(events.sparkSession, job)
    slots = surge.zone_surge(events.withWatermark("kafka_ts", f"{job.watermark_seconds} seconds"), job.slot_seconds)
    return (slots.writeStream.outputMode("update").option("checkpointLocation", job.checkpoint)
            .trigger(**(trigger or {"processingTime": f"{decision.trigger_s} seconds"}))
            .foreachBatch(write_batch(job, decision)).start())


def _width(seconds: int, ts: str = "window_start"):
    """The start of the window of a slot."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / F.lit(seconds)) * seconds)


def windows_from(slots: DataFrame, seconds: int) -> DataFrame:
    """Windows of a width from the slots they consist of."""
    return (slots.withColumn("window_start", _width(seconds)).groupBy(*SLOT_KEYS).agg(
        *[F.sum(c).alias(c) for c in COUNTS], F.min("min_event_ts").alias("min_event_ts"))
        .withColumns({"window_end": F.col("window_start") + F.expr(f"INTERVAL {seconds} SECONDS"), "window_seconds": F.lit(seconds)}))


def write_batch(job: AdaptiveJob, decision: Decision):
    """The per-batch callback: changed slots go to their table, and the windows they lie in are
    made anew from all their slots."""
    seconds = decision.window_seconds

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, now = batch.sparkSession, datetime.now(timezone.utc)
        slots = batch.select(*SLOT_KEYS, "window_end", *COUNTS, "min_event_ts").persist()
        try:
            if not slots.isEmpty():
                keyed.upsert(slots, f"{job.root}/slots", batch_id)
                touched = slots.select("zone_id", "city_id", _width(seconds).alias("first")).distinct()
                parts = F.sequence("first", F.col("first") + F.expr(f"INTERVAL {seconds - job.slot_seconds} SECONDS"),
                                   F.expr(f"INTERVAL {job.slot_seconds} SECONDS"))
                wanted = touched.select("zone_id", "city_id", F.explode(parts).alias("window_start"))
                whole = keyed.read_current(spark, f"{job.root}/slots", SLOT_KEYS, only=wanted)
                windows = surge.with_latency(surge.with_surge(windows_from(whole, seconds)), F.lit(now)).persist()
                try:
                    keyed.upsert(windows, f"{job.root}/windows", batch_id)
                    keyed.upsert(surge.surge_records(surge.dedupe_zone(windows), seconds, job.scale_level, F.lit(batch_id), F.lit(now)),
                                 f"{job.root}/surge_pricing", batch_id)
                finally:
                    windows.unpersist()
        finally:
            slots.unpersist()
        oldest = F.lit(now - timedelta(hours=job.keep_hours))
        for name, keys, time_column in (("slots", SLOT_KEYS, "window_end"), ("windows", WINDOW_KEYS, "window_end"),
                                        ("surge_pricing", ["zone_id", "city_id", "timestamp"], "computed_at")):
            keyed.maintain(spark, f"{job.root}/{name}", keys, batch_id, job.compact_every, F.col(time_column) >= oldest)

    return write


def windows_table(spark: SparkSession, job: AdaptiveJob) -> DataFrame:
    """Windows as they were published, each with its width."""
    return keyed.read_current(spark, f"{job.root}/windows", WINDOW_KEYS)


def windows_of(spark: SparkSession, job: AdaptiveJob, seconds: int) -> DataFrame:
    """Windows of any width that is a multiple of the slots, over all times kept."""
    return surge.with_surge(windows_from(keyed.read_current(spark, f"{job.root}/slots", SLOT_KEYS), seconds))
