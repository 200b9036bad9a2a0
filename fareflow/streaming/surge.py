"""The surge stream: events to zone windows to the hot table and its KPIs."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from fareflow import schemas
from fareflow.operators import surge
from fareflow.operators.events import decode_events, drop_keyless
from fareflow.operators.joins import enrich_with_history
from fareflow.sources import keyed

WINDOW_KEYS = ["zone_id", "city_id", "window_start"]
HISTORY_KEYS = ["zone_id", "hour_bucket", "city_id"]
RECORD_KEYS = ["zone_id", "city_id", "timestamp"]


@dataclass(frozen=True)
class SurgeJob:
    """Where and how the stream writes. Keyed tables live under ``root``:
    ``windows`` (every zone window), ``surge_pricing`` (the busiest window of
    each zone and batch), ``kpis`` and ``lineage`` (start and end of every attempt
    at a batch, failed ones too). Every ``compact_every`` batches all are compacted;
    rows older than ``keep_hours`` expire then.

    With ``history_root``, the keyed demand table of the daily job, all windows also go
    to ``with_history``, joined with the usual demand of their zone and hour. The demand
    is read anew in every batch, as of its newest day, so a daily run shows without a
    restart; a batch that runs again takes the day it took before."""

    root: str
    checkpoint: str
    window_seconds: int = 2
    scale_level: str = "5K"
    watermark_seconds: int | None = None
    with_kpis: bool = True
    source: str = "gps-normal"
    compact_every: int = 500
    keep_hours: int = 24
    history_root: str | None = None

    @property
    def delay(self) -> str:
        return f"{self.watermark_seconds or self.window_seconds} seconds"


def zone_windows(events: DataFrame, job: SurgeJob) -> DataFrame:
    """Windowed counts; events later than the watermark leave the state."""
    return surge.zone_surge(events.withWatermark("kafka_ts", job.delay), job.window_seconds)


def write_batch(job: SurgeJob):
    """The per-batch callback. Everything stays a DataFrame; each table is keyed,
    so a batch that runs again after a failure leaves the same content. The batch is
    counted in the job that caches it; its tables and the start of its lineage are then
    written side by side."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, begun = batch.sparkSession, datetime.now(timezone.utc)
        started = F.lit(begun)
        zones = surge.with_latency(surge.with_surge(batch), started).persist()
        note = None
        try:
            note = _Notes(spark, job, batch_id, begun)
            count = zones.agg(F.sum("total_events")).first()[0]
            if count is not None:
                busiest = surge.dedupe_zone(zones)
                tables = {
                    "windows": zones.hint("rebalance"),
                    "surge_pricing": surge.surge_records(busiest, job.window_seconds, job.scale_level,
                                                         F.lit(batch_id), started)}
                if job.with_kpis:
                    kpis = surge.batch_kpis(busiest.withColumn("batch_id", F.lit(batch_id)), job.window_seconds)
                    tables["kpis"] = kpis.select(F.lit(batch_id).alias("batch"), started.alias("computed_at"),
                                                 F.lit(job.scale_level).alias("scale_level"), "*")
                if job.history_root:
                    tables["with_history"] = with_history(zones, job, batch_id)
                writes = [lambda name=name: keyed.upsert(tables[name], f"{job.root}/{name}", batch_id) for name in tables]
                writes.append(lambda: note.start(count))
                with ThreadPoolExecutor(len(writes)) as pool:
                    list(pool.map(inheritable_thread_target(spark)(lambda put: put()), writes))
                note.end(None)
            tidy(spark, job, batch_id)
        except Exception as error:
            if note is not None:
                note.start(None)
                note.end(str(error))
            raise
        finally:
            zones.unpersist()

    return write


def with_history(zones: DataFrame, job: SurgeJob, batch_id: int) -> DataFrame:
    """The zones of a batch with the usual demand as of the version that the batch is bound to."""
    spark = zones.sparkSession
    version = _history_version(spark, job, batch_id)
    if version is None:
        demand = spark.createDataFrame([], "zone_id string, hour_bucket string, trip_count bigint, avg_surge double, avg_fare_inr double")
    else:
        demand = keyed.read_current(spark, job.history_root, HISTORY_KEYS, as_of=version)
    return enrich_with_history(zones, demand).withColumn("history_version", F.lit(version).cast("bigint"))


def _history_version(spark: SparkSession, job: SurgeJob, batch_id: int) -> int | None:
    """The newest version, marked for the batch when it first asks; what is marked is kept."""
    marks = f"{job.root}/with_history/versions"
    fs, here = keyed.hadoop_path(spark, f"{marks}/{batch_id}")
    found = [int(s.getPath().getName()) for s in fs.listStatus(here)] if fs.exists(here) else []
    if found:
        return min(found)
    version = keyed.newest_batch(spark, job.history_root)
    if version is not None:
        fs.mkdirs(keyed.hadoop_path(spark, f"{marks}/{batch_id}/{version}")[1])
    fs.delete(keyed.hadoop_path(spark, f"{marks}/{batch_id - 1}")[1], True)
    return version


def start(events: DataFrame, job: SurgeJob, **trigger) -> StreamingQuery:
    """Run on decoded events with a ``kafka_ts`` column."""
    seconds = min(job.window_seconds, 5)
    return (zone_windows(events, job).writeStream.outputMode("update")
            .option("checkpointLocation", job.checkpoint)
            .trigger(**(trigger or {"processingTime": f"{seconds} seconds"}))
            .foreachBatch(write_batch(job)).start())


def start_from_envelope(envelope: DataFrame, job: SurgeJob, **trigger) -> StreamingQuery:
    """Run on raw records as they come from the topics."""
    return start(drop_keyless(decode_events(envelope)), job, **trigger)


def windows_table(spark, job: SurgeJob) -> DataFrame:
    return keyed.read_current(spark, f"{job.root}/windows", WINDOW_KEYS)


def history_table(spark, job: SurgeJob) -> DataFrame:
    return keyed.read_current(spark, f"{job.root}/with_history", WINDOW_KEYS)


def surge_table(spark, job: SurgeJob) -> DataFrame:
    return keyed.read_current(spark, f"{job.root}/surge_pricing", RECORD_KEYS)


#: Folder numbers that a batch takes in the lineage table: two per attempt.
PER_BATCH = 10_000


class _Notes:
    """Lineage events of one attempt at a batch. An attempt leaves a marker when it begins, so
    that the next one, also of another process, gets its own number; the first attempt's id
    is the batch's, later ones add ``#2`` and so on."""

    def __init__(self, spark: SparkSession, job: SurgeJob, batch_id: int, begun: datetime) -> None:
        self.spark, self.job, self.batch_id, self.begun, self.table = spark, job, batch_id, begun, f"{job.root}/lineage"
        self.attempt = None

    def _number(self) -> int:
        if self.attempt is None:
            marks = f"{self.table}/attempts"
            fs, here = keyed.hadoop_path(self.spark, f"{marks}/{self.batch_id}")
            self.attempt = 1 + (len(fs.listStatus(here)) if fs.exists(here) else 0)
            fs.mkdirs(keyed.hadoop_path(self.spark, f"{marks}/{self.batch_id}/{self.attempt}")[1])
            fs.delete(keyed.hadoop_path(self.spark, f"{marks}/{self.batch_id - 1}")[1], True)
        return self.attempt

    def _put(self, kind: str, source, sink, count, version, status, error, at: datetime) -> None:
        n = self._number()
        key = f"{self.job.checkpoint}/{self.batch_id}" + (f"#{n}" if n > 1 else "")
        row = (key, kind, "streaming", source, sink, count, version, status, error, at)
        keyed.upsert(self.spark.createDataFrame([row], schemas.LINEAGE_EVENT).withColumnRenamed(keyed.VERSION, "batch").coalesce(1),
                     self.table, self.batch_id * PER_BATCH + 2 * min(n, PER_BATCH // 2 - 1) + (kind == "end"))

    def start(self, count: int | None) -> None:
        self._put("start", self.job.source, None, count, 2, None, None, self.begun)

    def end(self, error: str | None) -> None:
        self._put("end", None, "surge_pricing", None, None, "failed" if error else "success", error, datetime.now(timezone.utc))


def tidy(spark: SparkSession, job: SurgeJob, batch_id: int) -> None:
    """Compaction and expiry of all tables, when it is their turn."""
    oldest = F.lit(datetime.now(timezone.utc) - timedelta(hours=job.keep_hours))
    for name, keys, time in (("windows", WINDOW_KEYS, "window_end"), ("surge_pricing", RECORD_KEYS, "computed_at"),
                             ("kpis", ["batch"], "computed_at"), ("with_history", WINDOW_KEYS, "window_end")):
        keyed.maintain(spark, f"{job.root}/{name}", keys, batch_id, job.compact_every, F.col(time) >= oldest)
    keyed.maintain(spark, f"{job.root}/lineage", [], batch_id, job.compact_every, F.col("at") >= oldest, stride=PER_BATCH)


def lineage_events(spark: SparkSession, job: SurgeJob) -> DataFrame:
    """Lineage events of all attempts so far."""
    return keyed.read_current(spark, f"{job.root}/lineage", []).drop(keyed.VERSION).withColumnRenamed("batch", keyed.VERSION)


class LateRows(StreamingQueryListener):
    """Counts aggregated rows that came behind the watermark, over all batches of the
    queries that run while it is registered with ``spark.streams.addListener``."""

    def __init__(self) -> None:
        self.total = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.total += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
