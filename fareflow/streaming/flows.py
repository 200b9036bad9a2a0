"""The other streams: status join, dead letters, archive, alerts, driver table."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareflow.operators import alerts, events, joins
from fareflow.sources import keyed


def status_join(gps: DataFrame, status: DataFrame, seconds: int = 30, delay: str = "10 seconds",
                gps_ts: str = "gps_ts", status_ts: str = "status_ts", key: str = "driver_id") -> DataFrame:
    """The interval join on two streams. Watermarks and the time range together
    bound how long either side is kept."""
    return joins.join_status(gps.withWatermark(gps_ts, delay), status.withWatermark(status_ts, delay),
                             seconds, key, gps_ts, status_ts)


def to_parquet(df: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = (),
               **trigger) -> StreamingQuery:
    """Append a stream to Parquet; the sink's commit log makes restarts exact."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def archive_events(decoded: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Raw events by city and day, as the cold copy."""
    dated = decoded.withColumn("date", F.to_date("kafka_ts"))
    return to_parquet(dated, path, checkpoint, ("city_id", "date"), **trigger)


def split_faults(envelope: DataFrame, accepted_path: str, dead_path: str, checkpoint: str,
                 compact_every: int = 500, keep_hours: int | None = None, **trigger) -> StreamingQuery:
    """Good events to one table and dead letters to another, decoding once. Both are tables
    without keys: every row stays, until it is ``keep_hours`` old if that is given."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        decoded = events.decode_with_faults(batch).persist()
        try:
            keyed.upsert(events.accepted_events(decoded), accepted_path, batch_id)
            keyed.upsert(events.dead_letters(decoded), dead_path, batch_id)
        finally:
            decoded.unpersist()
        keep = None if keep_hours is None else F.col("kafka_ts") >= F.lit(datetime.now(timezone.utc) - timedelta(hours=keep_hours))
        for path in (accepted_path, dead_path):
            keyed.maintain(spark, path, [], batch_id, compact_every, keep)

    return (envelope.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
            .trigger(**(trigger or {"availableNow": True})).start())


def alert_stream(changes: DataFrame) -> DataFrame:
    """Messages for zones that surge; works on any change-record stream."""
    return alerts.alert_message(alerts.surge_alerts(alerts.read_changes(alerts.feed(changes))))


# The newest event wins, not the newest batch: late events must not undo a newer status.
STATUS_KEYS, STATUS_ORDER = ["driver_id"], ("kafka_ts",)


def driver_status_table(decoded: DataFrame, root: str, checkpoint: str, compact_every: int = 500,
                        life_seconds: int | None = None, **trigger) -> StreamingQuery:
    """Keep the newest status per driver up to date. With ``life_seconds``, statuses older than
    that leave the table when it is compacted."""

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed.upsert(events.last_driver_status(batch), root, batch_id)
        keep = None if life_seconds is None else F.col("kafka_ts") >= F.lit(datetime.now(timezone.utc) - timedelta(seconds=life_seconds))
        keyed.maintain(batch.sparkSession, root, STATUS_KEYS, batch_id, compact_every, keep, STATUS_ORDER)

    return (decoded.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
            .trigger(**(trigger or {"availableNow": True})).start())


def driver_statuses(spark: SparkSession, root: str, now: Column | None = None, life_seconds: int = 300,
                    drivers: DataFrame | None = None) -> DataFrame:
    """The table's current rows: with ``now`` those still alive, with ``drivers`` those of these
    drivers, read from their buckets alone."""
    table = keyed.read_current(spark, root, STATUS_KEYS, order=STATUS_ORDER, only=drivers)
    return table if now is None else events.unexpired(table, "kafka_ts", life_seconds, now)
