"""Batch lineage from start and end events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.functions.places import truncate_error


def _by_batch(events: DataFrame) -> DataFrame:
    """First start and first end of every batch id, in one aggregate."""
    started, ended = F.col("kind") == "start", F.col("kind") == "end"
    first = lambda cond, *cols: F.min_by(F.struct("at", *cols), F.when(cond, F.col("at")))
    return events.groupBy("batch_id").agg(
        first(started, "stage", "input_source", "record_count", "schema_version").alias("s"),
        first(ended, "output_sink", "status", "error").alias("e"),
        F.max(started).alias("has_start"), F.max(ended).alias("has_end"))


def lineage(events: DataFrame) -> DataFrame:
    """One record per finished batch. An end without a start is ignored."""
    done = _by_batch(events).filter(F.col("has_start") & F.col("has_end"))
    return done.select(
        "batch_id", F.col("s.stage").alias("stage"), F.col("s.input_source").alias("input_source"),
        F.col("e.output_sink").alias("output_sink"), F.col("s.record_count").alias("record_count"),
        F.col("s.at").alias("started_at"), F.col("e.at").alias("completed_at"),
        F.timestamp_diff("MILLISECOND", F.col("s.at"), F.col("e.at")).alias("duration_ms"),
        F.col("s.schema_version").alias("schema_version"), F.col("e.status").alias("status"),
        truncate_error(F.col("e.error")).alias("error"))


def open_batches(events: DataFrame) -> DataFrame:
    """Batches started and not ended, counted per stage."""
    return (_by_batch(events).filter(F.col("has_start") & ~F.col("has_end"))
            .groupBy(F.col("s.stage").alias("stage")).agg(F.count("*").alias("open_batches")))
