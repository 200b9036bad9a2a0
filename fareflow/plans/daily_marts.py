"""The daily job: gate, read, four marts, hourly zone demand."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fareflow.functions.numeric import sink_decimal
from fareflow.functions.timeparts import hour_bucket
from fareflow.operators import marts
from fareflow.sources import files, keyed
from fareflow.session import shared_dir

ZONE_DEMAND_KEYS = ["zone_id", "hour_bucket"]


@dataclass(frozen=True)
class RunReport:
    date: str
    ran: bool
    reason: str
    input_bytes: int = 0
    trips: int = 0


def build_marts(trips: DataFrame, rollup: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four marts; three of them come from one shared rollup."""
    rollup = marts.trip_rollup(trips) if rollup is None else rollup
    return {"driver_earnings": marts.driver_earnings(trips),
            "zone_heatmap": marts.zone_heatmap_from(rollup),
            "city_stats": marts.city_stats_from(rollup),
            "surge_analysis": marts.surge_effectiveness_from(rollup)}


def zone_demand(heatmap: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Hourly demand rows for the keyed table; missing averages become 0."""
    zero = lambda c: sink_decimal(F.coalesce(F.col(c), F.lit(0.0)), 2).alias(c)
    return heatmap.select(F.col("pickup_zone").alias("zone_id"),
                          hour_bucket(F.col("date"), F.col("pickup_hour")).alias("hour_bucket"), "city_id",
                          "trip_count", zero("avg_surge"), zero("avg_fare_inr"),
                          (F.current_timestamp() if processed_at is None else processed_at)
                          .alias("processed_at"))


def upsert_zone_demand(heatmap: DataFrame, root: str, date: str) -> None:
    """A run replaces its own day: the batch number is the date as YYYYMMDD."""
    keyed.upsert(zone_demand(heatmap), root, int(date.replace("-", "")))


def run(spark: SparkSession, trips_root: str, out: str, date: str,
        min_bytes: int = files.MIN_INPUT_BYTES) -> RunReport:
    """Process one day. Trips are scanned twice: once for the drivers, once for
    the rollup, which is written to the shared folder and feeds the other three
    marts and the zone demand table."""
    size = files.input_bytes(spark, trips_root, date).first().input_bytes
    if size < min_bytes:
        return RunReport(date, False, "input below minimum size", size)
    trips = files.read_trips(spark, trips_root, date)
    if not files.empty_input_gate(trips):
        return RunReport(date, False, "no rows", size)

    seen = Observation("trips")
    staged = shared_dir(spark, "trip-rollup")
    marts.trip_rollup(trips.observe(seen, F.count("*").alias("n"))).write.parquet(staged)
    built = build_marts(trips, spark.read.parquet(staged))
    files.write_marts(built, out, date)
    heatmap = files.read_mart(spark, out, "zone_heatmap").filter(F.col("date") == F.lit(date).cast("date"))
    upsert_zone_demand(heatmap, f"{out}/zone_demand", date)
    return RunReport(date, True, "done", size, seen.get["n"])
