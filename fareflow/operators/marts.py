"""The four trip marts.

Money and multipliers are DECIMAL inside, so sums do not depend on row order;
results are DOUBLE. Each mart is one hash aggregate with map-side combining.
``trip_rollup`` lets the daily job compute three of them from one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.functions.numeric import count_if, mean, percent, rounded
from fareflow.functions.pricing import surge_bucket


def completed() -> Column:
    return F.col("status") == "completed"


def cancelled() -> Column:
    return F.col("status") == "cancelled"


def with_pickup_hour(trips: DataFrame) -> DataFrame:
    return trips.withColumn("pickup_hour", F.hour("start_time"))


def driver_earnings(trips: DataFrame) -> DataFrame:
    """Completed trips per driver, city and day."""
    return (trips.filter(completed()).groupBy("driver_id", "city_id", "date").agg(
        F.count("trip_id").alias("total_trips"),
        rounded(F.sum("final_fare_inr"), 2).alias("total_earnings_inr"),
        rounded(mean(F.col("final_fare_inr")), 2).alias("avg_fare_inr"),
        rounded(mean(F.col("surge_multiplier")), 2).alias("avg_surge"),
        rounded(F.sum("distance_km"), 2).alias("total_distance_km"),
        rounded(mean(F.col("driver_rating")), 2).alias("avg_rating")))


def zone_heatmap(trips: DataFrame) -> DataFrame:
    """Demand per pickup zone and hour; cancelled trips count as demand."""
    return (with_pickup_hour(trips).groupBy("pickup_zone", "city_id", "pickup_hour", "date").agg(
        F.count("trip_id").alias("trip_count"),
        rounded(mean(F.col("surge_multiplier")), 2).alias("avg_surge"),
        rounded(mean(F.col("final_fare_inr")), 2).alias("avg_fare_inr"),
        rounded(F.sum("final_fare_inr"), 2).alias("total_revenue_inr"),
        count_if(cancelled()).alias("cancellation_count")))


def city_stats(trips: DataFrame) -> DataFrame:
    """One row per city and day. Revenue includes cancelled trips."""
    return (trips.groupBy("city_id", "date").agg(
        F.count("trip_id").alias("total_trips"),
        count_if(completed()).alias("completed_trips"),
        count_if(cancelled()).alias("cancelled_trips"),
        rounded(F.sum("final_fare_inr"), 2).alias("total_revenue_inr"),
        rounded(mean(F.col("final_fare_inr")), 2).alias("avg_fare_inr"),
        rounded(mean(F.col("surge_multiplier")), 2).alias("avg_surge"),
        rounded(mean(F.col("distance_km")), 2).alias("avg_distance_km"),
        rounded(mean(F.col("driver_rating")), 2).alias("avg_driver_rating"))
        .withColumn("completion_rate_pct", percent(F.col("completed_trips"), F.col("total_trips"))))


def surge_effectiveness(trips: DataFrame) -> DataFrame:
    """Fare and cancellation rate per city, day and surge level."""
    return (trips.groupBy("city_id", "date", surge_bucket(F.col("surge_multiplier")).alias("surge_bucket"))
            .agg(F.count("trip_id").alias("trip_count"),
                 rounded(mean(F.col("final_fare_inr")), 2).alias("avg_fare"),
                 percent(count_if(cancelled()), F.count("trip_id")).alias("cancellation_rate_pct")))


# -- one pass for three marts ------------------------------------------------

def trip_rollup(trips: DataFrame) -> DataFrame:
    """Counts and exact sums per zone, hour and surge level.

    Its size follows zones x hours x surge levels, not trips.
    """
    measures = ("final_fare_inr", "surge_multiplier", "distance_km", "driver_rating")
    return (with_pickup_hour(trips)
            .groupBy("city_id", "date", "pickup_zone", "pickup_hour",
                     surge_bucket(F.col("surge_multiplier")).alias("surge_bucket"))
            .agg(F.count("trip_id").alias("n"),
                 count_if(completed()).alias("n_completed"),
                 count_if(cancelled()).alias("n_cancelled"),
                 *[F.sum(m).alias(f"sum_{m}") for m in measures],
                 *[F.count(m).alias(f"n_{m}") for m in measures]))


def _pooled(measure: str) -> Column:
    return rounded(F.sum(f"sum_{measure}") / F.nullif(F.sum(f"n_{measure}"), F.lit(0)), 2)


def zone_heatmap_from(rollup: DataFrame) -> DataFrame:
    return (rollup.groupBy("pickup_zone", "city_id", "pickup_hour", "date").agg(
        F.sum("n").alias("trip_count"),
        _pooled("surge_multiplier").alias("avg_surge"),
        _pooled("final_fare_inr").alias("avg_fare_inr"),
        rounded(F.sum("sum_final_fare_inr"), 2).alias("total_revenue_inr"),
        F.sum("n_cancelled").alias("cancellation_count")))


def city_stats_from(rollup: DataFrame) -> DataFrame:
    return (rollup.groupBy("city_id", "date").agg(
        F.sum("n").alias("total_trips"),
        F.sum("n_completed").alias("completed_trips"),
        F.sum("n_cancelled").alias("cancelled_trips"),
        rounded(F.sum("sum_final_fare_inr"), 2).alias("total_revenue_inr"),
        _pooled("final_fare_inr").alias("avg_fare_inr"),
        _pooled("surge_multiplier").alias("avg_surge"),
        _pooled("distance_km").alias("avg_distance_km"),
        _pooled("driver_rating").alias("avg_driver_rating"))
        .withColumn("completion_rate_pct", percent(F.col("completed_trips"), F.col("total_trips"))))


def surge_effectiveness_from(rollup: DataFrame) -> DataFrame:
    return (rollup.groupBy("city_id", "date", "surge_bucket").agg(
        F.sum("n").alias("trip_count"),
        _pooled("final_fare_inr").alias("avg_fare"),
        percent(F.sum("n_cancelled"), F.sum("n")).alias("cancellation_rate_pct")))
