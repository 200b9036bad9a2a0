"""Interval join of positions with status updates, and history lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.operators.keys import join_on_keys


def join_status(gps: DataFrame, status: DataFrame, seconds: int = 30, key: str = "driver_id",
                gps_ts: str = "gps_ts", status_ts: str = "status_ts") -> DataFrame:
    """Pairs of the same driver at most ``seconds`` apart, in batch or streaming.

    Time is part of the join key: both sides fall into slots four intervals
    wide, and a status that lies near a border is copied to the neighbouring
    slot. A busy driver is thus spread over many small groups. A position has
    exactly one slot, so no pair appears twice. For streams, set the watermarks
    on both inputs first; the range condition bounds the state.
    """
    reach = seconds * 1_000_000
    width = max(4 * reach, 1)

    def slot(micros):
        return F.floor(micros / F.lit(width)).cast("bigint")

    at = F.unix_micros(F.col(status_ts))
    left = gps.withColumn("__slot", slot(F.unix_micros(F.col(gps_ts)))).alias("g")
    right = (status.withColumn("__slot", F.explode(F.array_distinct(
        F.array(slot(at - F.lit(reach)), slot(at + F.lit(reach)))))).alias("s"))
    span = F.expr(f"INTERVAL {seconds} SECONDS")
    near = (F.col(f"s.{status_ts}") >= F.col(f"g.{gps_ts}") - span) & (
        F.col(f"s.{status_ts}") <= F.col(f"g.{gps_ts}") + span)
    same = (F.col(f"g.{key}") == F.col(f"s.{key}")) & (F.col("g.__slot") == F.col("s.__slot"))
    return left.join(right, same & near).select(
        *[F.col(f"g.{c}") for c in gps.columns],
        *[F.col(f"s.{c}") for c in status.columns if c not in gps.columns])


def enrich_with_history(zones: DataFrame, zone_demand: DataFrame) -> DataFrame:
    """Add the usual demand of the zone and hour; zones without history stay.

    ``zone_demand`` has one row per (zone_id, hour_bucket), so the join never
    multiplies rows. Works with a streaming left side.
    """
    bucket = F.date_format("window_start", "yyyy-MM-dd'T'HH")
    history = zone_demand.select(
        "zone_id", "hour_bucket", F.col("trip_count").alias("history_trips"),
        F.col("avg_surge").alias("history_surge"), F.col("avg_fare_inr").alias("history_fare_inr"))
    return join_on_keys(zones.withColumn("hour_bucket", bucket), history, ["zone_id", "hour_bucket"], "left")
