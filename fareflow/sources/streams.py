"""Event stream sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from fareflow import schemas
from fareflow.operators.events import TOPICS

MAX_PER_TRIGGER = 10_000


def read_events(spark: SparkSession, topics=TOPICS, servers: str | None = None, path: str | None = None,
                starting: str = "latest", max_offsets: int = MAX_PER_TRIGGER,
                files_per_trigger: int | None = None, file_format: str = "parquet") -> DataFrame:
    """The (key, value, topic, partition, offset, timestamp) envelope of all topics.

    Reads Kafka when ``servers`` is given, and otherwise files of the same shape
    under ``path``, with files per trigger as the rate cap.
    """
    if servers:
        return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("subscribe", ",".join(topics)).option("startingOffsets", starting)
                .option("failOnDataLoss", "false").option("maxOffsetsPerTrigger", max_offsets).load()
                .selectExpr("CAST(key AS STRING) key", "CAST(value AS STRING) value", "topic",
                            "partition", "offset", "timestamp"))
    if not path:
        raise ValueError("give servers or path")
    reader = spark.readStream.format(file_format).schema(schemas.ENVELOPE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).filter(F.col("topic").isin(*topics))


def write_routed(routed: DataFrame, checkpoint: str, servers: str | None = None, path: str | None = None,
                 **trigger) -> StreamingQuery:
    """Send (topic, key, value) rows to their topics: Kafka, or a folder per topic."""
    writer: DataStreamWriter = routed.writeStream.option("checkpointLocation", checkpoint)
    if servers:
        writer = writer.format("kafka").option("kafka.bootstrap.servers", servers)
    elif path:
        writer = writer.format("parquet").partitionBy("topic").option("path", path)
    else:
        raise ValueError("give servers or path")
    return writer.trigger(**(trigger or {"availableNow": True})).start()
