"""Latency percentiles from stored sketches.

A KLL sketch per day and group is made once, when the day's rows are there, and
merged at read for any span of days: a report over a year reads a few kilobytes per
group and day instead of the rows. Beside the sketch lie count and exact sum, so means
stay exact. A day that runs again replaces its own sketches only.

Sketches are mergeable and of bounded size, and their percentiles are values of the
data. Which ones differs from run to run within the rank error below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.functions.numeric import rounded

#: Size parameter of the sketches.
K = 1000
#: A sum that stays exact, and holds values up to 10^20.
SUM = "decimal(38,12)"


def rank_error(k: int = K, sure: float = 1.0) -> float:
    """By how much the rank of a percentile can be off, as a share of the rows, with 99 %
    confidence; ``sure`` widens it."""
    return sure * 2.296 / k**0.9723


def daily_sketches(rows: DataFrame, keys: list[str], value: str, ts: str, k: int = K) -> DataFrame:
    """One row per group and day. Null and NaN values are left out."""
    v = F.col(value).cast("double")
    return (rows.filter(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, F.to_date(ts).alias("date"))
            .agg(F.kll_sketch_agg_double(v, k).alias("sketch"), F.count("*").alias("n"), F.sum(v.cast(SUM)).alias("total"),
                 F.min(v).alias("lowest"), F.max(v).alias("highest")))


def write_sketches(sketches: DataFrame, root: str) -> None:
    """Replace the days that ``sketches`` has; other days stay."""
    (sketches.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date").parquet(root))


def merged(spark: SparkSession, root: str, keys: list[str], since: Column | None = None, until: Column | None = None) -> DataFrame:
    """One sketch per group over the days from ``since`` to ``until``; other days are not read."""
    days = spark.read.parquet(root)
    if since is not None:
        days = days.filter(F.col("date") >= since)
    if until is not None:
        days = days.filter(F.col("date") <= until)
    return days.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.min("lowest").alias("lowest"), F.max("highest").alias("highest"))


def percentiles(sketches: DataFrame, points: dict[str, float]) -> DataFrame:
    """The sketches' rows with a column per point (name -> 0..1)."""
    return sketches.withColumns({name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for name, p in points.items()})


def latency_report(spark: SparkSession, root: str, points: dict[str, float], keys: list[str],
                   since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Mean, percentiles and count per group, as the report over rows has them."""
    found = percentiles(merged(spark, root, keys, since, until), points)
    return found.select(*keys, rounded(F.col("total") / F.col("n"), 0).alias("avg_ms"),
                        *[rounded(F.col(name), 0).alias(name) for name in points], F.col("n").alias("sample_count"))


def within_rank_error(rows: DataFrame, estimates: DataFrame, keys: list[str], value: str, points: dict[str, float],
                      error: float) -> DataFrame:
    """Per group: does each estimate's true rank lie within ``error`` of its point? One pass over
    the rows that counts those below and up to each estimate."""
    renamed = estimates.select(*[F.col(c).alias(f"__{c}") for c in keys], *points)
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys]
    v = F.col(value)
    counted = rows.filter(v.isNotNull() & ~F.isnan(v)).join(renamed, same).groupBy(*keys).agg(
        F.count("*").alias("n"), *[F.count(F.when(v < F.col(p), 1)).alias(f"{p}_below") for p in points],
        *[F.count(F.when(v <= F.col(p), 1)).alias(f"{p}_upto") for p in points])
    ok = lambda p, at: (F.col(f"{p}_below") / F.col("n") <= at + error) & (F.col(f"{p}_upto") / F.col("n") >= at - error)
    return counted.select(*keys, "n", *[ok(p, at).alias(f"{p}_within") for p, at in points.items()])
