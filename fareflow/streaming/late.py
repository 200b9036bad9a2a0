"""Late rows kept instead of dropped.

A router stands before the surge stream. It carries its own watermark from batch to
batch, by the same rule as Spark's (newest event time of all earlier batches minus the
delay), and sends a row whose window that watermark has closed to the table ``late``, all
others to ``on_time``. The surge stream reads ``on_time``: it sees the same rows in the same
order, so its own watermark is never ahead of the router's, and it drops nothing.

The watermark of a batch is a function of the marks that earlier batches left in the
table ``marks``, so a batch that runs again is split alike. A batch whose rows are
complete in ``on_time`` is not written again, since the surge stream may have read them.

``with_late`` folds both together: the windows as they would be had no row been late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareflow.operators import surge
from fareflow.sources import keyed
from fareflow.streaming.surge import WINDOW_KEYS, SurgeJob, windows_table


def router(job: SurgeJob):
    """The per-batch callback on decoded events with ``kafka_ts``."""
    delay = (job.watermark_seconds or job.window_seconds) * 1_000_000

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = _newest_before(spark, job, batch_id)
        size = job.window_seconds * 1_000_000
        closed = F.floor(F.unix_micros("kafka_ts") / F.lit(size)) * size + size  # end of the row's window
        late = F.lit(False) if newest is None else F.coalesce(closed <= F.lit(newest - delay), F.lit(False))
        rows = batch.withColumn("__late", late).persist()
        try:
            if not _complete(spark, job, batch_id):
                keyed.upsert(rows.filter(F.col("__late")).drop("__late"), f"{job.root}/late", batch_id)
                top = rows.agg(F.max(F.unix_micros("kafka_ts")).alias("newest"))
                keyed.upsert(top.select(F.lit(batch_id).alias("batch"), "newest"), f"{job.root}/marks", batch_id)
                keyed.upsert(rows.filter(~F.col("__late")).drop("__late"), f"{job.root}/on_time", batch_id)
        finally:
            rows.unpersist()
        keyed.maintain(spark, f"{job.root}/late", [], batch_id, job.compact_every)
        keyed.maintain(spark, f"{job.root}/marks", ["batch"], batch_id, job.compact_every)

    return write


def _complete(spark: SparkSession, job: SurgeJob, batch_id: int) -> bool:
    fs, mark = keyed.hadoop_path(spark, f"{job.root}/on_time/changes/{keyed.VERSION}={batch_id}/_SUCCESS")
    return fs.exists(mark)


def _newest_before(spark: SparkSession, job: SurgeJob, batch_id: int) -> int | None:
    """The newest event time of the batches before, in microseconds."""
    if not batch_id or not keyed.has_batches(spark, f"{job.root}/marks"):
        return None
    marks = keyed.read_current(spark, f"{job.root}/marks", ["batch"])
    return marks.filter(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]


def route(events: DataFrame, job: SurgeJob, **trigger) -> StreamingQuery:
    """Split decoded events into the tables ``on_time`` and ``late`` under the job's root."""
    return (events.writeStream.option("checkpointLocation", f"{job.checkpoint}-router").foreachBatch(router(job))
            .trigger(**(trigger or {"availableNow": True})).start())


def on_time_events(spark: SparkSession, job: SurgeJob, schema, files_per_trigger: int | None = None) -> DataFrame:
    """The on-time rows as a stream, for ``surge.start``."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{job.root}/on_time/changes/*")


def late_rows(spark: SparkSession, job: SurgeJob) -> DataFrame:
    """All late rows so far."""
    return keyed.read_current(spark, f"{job.root}/late", []).drop(keyed.VERSION)


def late_windows(spark: SparkSession, job: SurgeJob) -> DataFrame:
    """The windows that late rows fall in, counted from these alone."""
    return surge.zone_surge(late_rows(spark, job), job.window_seconds)


def with_late(spark: SparkSession, job: SurgeJob, changed_only: bool = False) -> DataFrame:
    """The windows of the surge table with the late rows counted in, and their ratio and multiplier
    worked out anew. ``changed_only`` keeps those that late rows change: what a backfill has to write."""
    counts = ["on_trip_count", "available_count", "total_events"]
    columns = [*WINDOW_KEYS, "window_end", *counts, "min_event_ts"]
    late = late_windows(spark, job).select(*columns, F.lit(True).alias("changed"))
    both = windows_table(spark, job).select(*columns, F.lit(False).alias("changed")).unionByName(late)
    folded = both.groupBy(*WINDOW_KEYS, "window_end").agg(
        *[F.sum(c).alias(c) for c in counts], F.min("min_event_ts").alias("min_event_ts"), F.max("changed").alias("changed"))
    return surge.with_surge(folded.filter("changed") if changed_only else folded)
