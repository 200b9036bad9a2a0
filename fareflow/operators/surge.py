"""Supply, demand and surge per zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.functions.numeric import count_if, exact_mean, rounded, sink_decimal
from fareflow.functions.pricing import NO_SURGE, demand_ratio, surge_multiplier
from fareflow.functions.timeparts import latency_ms, parse_event_ts
from fareflow.operators.keys import best_row, join_on_keys
from fareflow.operators.quantiles import exact_quantiles


def on_trip() -> Column:
    return F.col("status") == "on_trip"


def available() -> Column:
    return F.col("status") == "available"


def zone_surge(events: DataFrame, window_seconds: int, ts: str = "kafka_ts") -> DataFrame:
    """Riders and free drivers per zone in tumbling windows.

    The oldest event is found on the parsed time: text order is only right when
    every event writes its time with the same width.
    """
    grouped = (events.withColumn("__event_ts", parse_event_ts(F.col("timestamp")))
               .groupBy("zone_id", "city_id", F.window(ts, f"{window_seconds} seconds").alias("w"))
               .agg(count_if(on_trip()).alias("on_trip_count"),
                    count_if(available()).alias("available_count"),
                    F.count("*").alias("total_events"),
                    F.min("__event_ts").alias("min_event_ts")))
    return grouped.select("zone_id", "city_id", F.col("w.start").alias("window_start"),
                          F.col("w.end").alias("window_end"), "on_trip_count", "available_count",
                          "total_events", "min_event_ts")


def with_surge(zones: DataFrame) -> DataFrame:
    """Add demand ratio and multiplier; the tier uses the unrounded ratio."""
    ratio = demand_ratio(F.col("on_trip_count"), F.col("available_count"))
    return zones.withColumn("demand_ratio", F.round(ratio, 4)).withColumn(
        "surge_multiplier", surge_multiplier(ratio))


def dedupe_zone(zones: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The busiest window per zone; the earliest window, then city, on ties."""
    return best_row(zones, keys or ["zone_id"],
                    [-F.coalesce("on_trip_count", F.lit(0)), F.col("window_start"), F.col("city_id")])


def with_latency(zones: DataFrame, batch_start: Column) -> DataFrame:
    return zones.withColumn("e2e_latency_ms", latency_ms(batch_start, F.col("min_event_ts")))


def batch_kpis(zones: DataFrame, window_seconds: int, batch: str = "batch_id") -> DataFrame:
    """One row per micro-batch from deduplicated zones with surge and latency.

    Average demand is the ratio of the sums, not the mean of the zone ratios.
    """
    waiting, free = F.sum("on_trip_count"), F.sum("available_count")
    seconds = max(window_seconds, 1)
    points = {"p95_latency_ms": 0.95, "p99_latency_ms": 0.99}
    totals = zones.groupBy(batch).agg(
        F.sum("total_events").alias("events"),
        rounded(F.sum("total_events") / F.lit(float(seconds)), 2).alias("events_per_second"),
        F.count("*").alias("zones"),
        count_if(F.col("surge_multiplier") > NO_SURGE).alias("surge_zones"),
        waiting.alias("waiting_riders"),
        free.alias("available_drivers"),
        rounded(waiting / F.greatest(free, F.lit(1)), 4).alias("avg_demand_ratio"),
        rounded(exact_mean(F.col("e2e_latency_ms")), 2).alias("avg_latency_ms"))
    # One row per zone and batch, so a single plan will do.
    tails = exact_quantiles(zones, [batch], "e2e_latency_ms", points, method="nearest", refine=False)
    totals = join_on_keys(totals, tails, [batch], "left")
    return totals.withColumns({name: rounded(F.col(name), 2) for name in points}).withColumn(
        "window_size_sec", F.lit(window_seconds))


def surge_records(zones: DataFrame, window_seconds: int, scale_level: str, batch_id: Column,
                  computed_at: Column) -> DataFrame:
    """Rows of the hot table. The key ends in the window start, not in the wall
    clock, so a replayed batch writes the same keys again."""
    return zones.select(
        "zone_id",
        F.concat_ws("_", F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "zone_id")
        .alias("timestamp"),
        "city_id", "window_start", "window_end",
        sink_decimal(F.col("surge_multiplier"), 2).alias("surge_multiplier"),
        F.col("on_trip_count").alias("waiting_riders"),
        F.col("available_count").alias("available_drivers"),
        sink_decimal(F.col("demand_ratio"), 4).alias("demand_ratio"),
        F.lit(window_seconds).alias("window_size_sec"),
        F.lit(scale_level).alias("scale_level"),
        batch_id.cast("bigint").alias("batch_id"),
        computed_at.alias("computed_at"),
        sink_decimal(F.col("e2e_latency_ms"), 2).alias("e2e_latency_ms"))
