"""Report queries on zone summaries, pipeline metrics and costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.functions.numeric import (cost_per_gb, count_if, exact_mean, gigabytes, mean, rounded,
                                        utilisation)
from fareflow.operators.quantiles import exact_quantiles
from fareflow.operators.keys import join_on_keys


def surging() -> Column:
    return F.col("surge_multiplier") >= 2.0


def top_surge_zones(summary: DataFrame, limit: int = 20) -> DataFrame:
    """Zones with most surge periods; names break ties."""
    return (summary.filter(surging()).groupBy("city_id", "zone_id").agg(
        F.count("*").alias("surge_events"),
        rounded(mean(F.col("demand_ratio")), 2).alias("avg_demand"),
        rounded(F.max("demand_ratio"), 2).alias("peak_demand"))
        .orderBy(F.desc("surge_events"), "city_id", "zone_id").limit(limit))


def city_utilisation(summary: DataFrame) -> DataFrame:
    return (summary.groupBy("city_id").agg(
        F.count("*").alias("total_trips"),
        rounded(exact_mean(utilisation(F.col("on_trip_count"), F.col("total_count")), 12), 3).alias("avg_utilization"),
        count_if(surging()).alias("surge_periods"),
        rounded(mean(F.col("demand_ratio")), 3).alias("avg_demand"))
        .orderBy(F.desc("total_trips"), "city_id"))


def city_demand_summary(summary: DataFrame) -> DataFrame:
    return summary.groupBy("city_id").agg(F.count("*").alias("zone_periods"),
                                          rounded(mean(F.col("demand_ratio")), 4).alias("avg_demand"))


POINTS = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}


def latency_percentiles(metrics: DataFrame, exact: bool = False) -> DataFrame:
    """Mean, median and tails per experiment, from sketches unless ``exact``."""
    key, value = "experiment_name", "processing_latency_ms"
    plain = metrics.groupBy(key).agg(rounded(exact_mean(F.col(value)), 0).alias("avg_ms"),
                                     F.count("*").alias("sample_count"),
                                     *([] if exact else [F.percentile_approx(value, p, 10000).alias(n)
                                                         for n, p in POINTS.items()]))
    if exact:
        plain = join_on_keys(plain, exact_quantiles(metrics, [key], value, POINTS), [key], "left")
    return plain.select(key, "avg_ms", *[rounded(F.col(n), 0).alias(n) for n in POINTS], "sample_count")


def cost_per_gb_report(costs: DataFrame) -> DataFrame:
    size = F.col("total_bytes_processed")
    return (costs.select("experiment_name", "infrastructure",
                         rounded(F.col("total_cost_usd"), 4).alias("total_cost"),
                         rounded(gigabytes(size), 3).alias("gb_processed"),
                         rounded(cost_per_gb(F.col("total_cost_usd"), size), 4).alias("cost_per_gb"))
            .orderBy(F.asc_nulls_last("cost_per_gb"), "experiment_name"))
