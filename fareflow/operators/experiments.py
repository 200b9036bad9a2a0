"""Experiment analysis: summaries, comparisons, frontiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareflow.functions.numeric import eps_per_dollar, exact_mean, rounded
from fareflow.functions.places import infra_of
from fareflow.operators.keys import join_on_keys
from fareflow.operators.ordered import (BLOCK, SERIES, before, carry, in_block, over_neighbours, whole,
                                        with_block, with_index)
from fareflow.operators.quantiles import BINS, bin_of, cut_points, exact_quantiles

LATENCY, THROUGHPUT, SURGE = ("spark_batch_latency_ms", "spark_kafka_events_per_second",
                              "spark_active_surge_zones")
DEFAULT_WINDOW, DEFAULT_COST = 5, 0.0

# What was run where. (experiment, drivers, window_s, cost_hr)
RUNS = (("local_sub5s", 500, 2, 0.0), ("local_1k", 1000, 2, 0.0), ("local_5k", 5000, 5, 0.0),
        ("ec2_5k", 5000, 5, 0.20), ("ec2_50k", 50000, 10, 0.20), ("emr_50k", 50000, 10, 1.25),
        ("fault_local", 1000, None, 0.0), ("fault_ec2", 5000, None, 0.20))


def known_runs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RUNS, "experiment_name string, drivers int, window_s int, cost_hr double")


def adaptive_config(configs: DataFrame) -> DataFrame:
    """Window, parallelism and rate for (drivers, ram_gb).

    One second of window per thousand drivers, at least two, and less when the
    events of a window (ten per driver and second) pass 60 % of what memory
    holds (50,000 per GB).
    """
    drivers, per_second = F.col("drivers"), F.col("drivers") * F.lit(10)
    budget = F.col("ram_gb") * F.lit(50000) * F.lit(0.6)
    wanted = F.greatest(F.lit(2), F.ceil(drivers / F.lit(1000)))
    fits = F.greatest(F.lit(2), F.floor(F.try_divide(budget, per_second)))
    window = F.when(per_second * wanted > budget, fits).otherwise(wanted)
    return (configs.withColumn("window_seconds", window.cast("int"))
            .withColumn("parallelism", F.greatest(F.lit(4), F.least(F.floor(drivers / 500), F.lit(200)))
                        .cast("int"))
            .withColumn("max_rate_per_partition",
                        F.greatest(F.lit(500), F.least(drivers * 2, F.lit(5000))).cast("int")))


def experiment_summary(metrics: DataFrame) -> DataFrame:
    """Throughput, latency percentiles and peak surge zones per experiment. NaN values are left out."""
    metrics = metrics.filter(~F.isnan("value") | F.col("value").isNull())
    name, value = F.col("metric_name"), F.col("value")
    plain = metrics.groupBy("experiment_name").agg(
        rounded(exact_mean(F.when(name == THROUGHPUT, value)), 1).alias("avg_eps"),
        F.max(F.when(name == SURGE, value)).cast("int").alias("max_surge"))
    tails = exact_quantiles(metrics.filter(name == LATENCY), ["experiment_name"], "value",
                            {"p50_lat": 0.50, "p95_lat": 0.95, "p99_lat": 0.99})
    joined = join_on_keys(plain, tails, ["experiment_name"], "left")
    return joined.select("experiment_name", "avg_eps",
                         *[rounded(F.bround(F.col(c), 0), 0).alias(c) for c in ("p50_lat", "p95_lat", "p99_lat")],
                         "max_surge")


def with_experiment_meta(summary: DataFrame, meta: DataFrame) -> DataFrame:
    """Attach drivers, window and cost; unknown runs get the defaults."""
    joined = join_on_keys(summary, meta.select("experiment_name", "drivers", "window_s", "cost_hr"),
                          ["experiment_name"], "left")
    return (joined.withColumn("infra", infra_of(F.col("experiment_name")))
            .withColumn("drivers", F.coalesce("drivers", F.lit(0)))
            .withColumn("window_s", F.coalesce("window_s", F.lit(DEFAULT_WINDOW)))
            .withColumn("cost_hr", F.coalesce("cost_hr", F.lit(DEFAULT_COST))))


def with_cost_efficiency(summary: DataFrame) -> DataFrame:
    return summary.withColumn("eps_per_dollar",
                              rounded(eps_per_dollar(F.col("avg_eps"), F.col("cost_hr")), 1))


def pearson(df: DataFrame, x: str, y: str, keys: list[str] | None = None, alpha: float = 0.05) -> DataFrame:
    """Correlation, sample size, two-sided p-value and verdict per key."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    stats = df.filter(both).groupBy(*(keys or [])).agg(F.corr(x, y).alias("r"), F.count("*").alias("n"))
    return stats.withColumn("p_value", correlation_p_value(F.col("r"), F.col("n"))).withColumn(
        "significant", F.col("p_value") < alpha)


def correlation_p_value(r: Column, n: Column, panels: int = 1000) -> Column:
    """Chance of a correlation at least this strong between unrelated normals.

    With r = sin(a), the null density in a is proportional to cos(a)^(n-3), so
    the p-value is one integral over another; both use Simpson's rule on the
    part of the range that carries weight. Null below three samples.
    """
    power = (n - F.lit(3)).cast("double")
    start = F.asin(F.least(F.abs(r), F.lit(1.0)))
    reach = F.lit(40.0) / F.sqrt(F.greatest(power, F.lit(1.0)))
    quarter = F.pi() / 2

    def log_cos(a: Column) -> Column:
        return F.log(F.greatest(F.cos(a), F.lit(1e-300)))

    def area(low: Column) -> Column:
        step = F.least(quarter - low, reach) / F.lit(panels)
        def add(acc: Column, i: Column) -> Column:
            weight = F.when((i == 0) | (i == panels), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
            return acc + weight * F.exp(power * log_cos(low + i * step))
        return F.aggregate(F.sequence(F.lit(0), F.lit(panels)), F.lit(0.0), add) * step

    return F.when(n > 2, F.least(area(start) / area(F.lit(0.0)), F.lit(1.0)))


def latency_reduction(summary: DataFrame, base: str, optimised: str, latency: str = "p50_lat") -> DataFrame:
    """Percent saved by one experiment over another."""
    of = lambda name: F.max(F.when(F.col("experiment_name") == name, F.col(latency)))
    return (summary.agg(of(base).alias("base_ms"), of(optimised).alias("optimised_ms"))
            .withColumn("reduction_pct", rounded((1 - F.try_divide(F.col("optimised_ms"), F.col("base_ms")))
                                                 * 100, 1)))


def reduction_vs_baseline(points: DataFrame, group: str = "infra", window: str = "window_s",
                          latency: str = "latency_ms") -> DataFrame:
    """Percent saved by the smallest window over the largest, per group."""
    known = points.filter(F.col(latency).isNotNull())
    return (known.groupBy(group).agg(F.min_by(latency, window).alias("smallest_window_ms"),
                                     F.max_by(latency, window).alias("largest_window_ms"),
                                     F.count("*").alias("points"))
            .withColumn("reduction_pct", rounded(
                (1 - F.try_divide(F.col("smallest_window_ms"), F.col("largest_window_ms"))) * 100, 0)))


def scaling_efficiency(summary: DataFrame, group: str = "infra", drivers: str = "drivers",
                       eps: str = "avg_eps") -> DataFrame:
    """Throughput gain over driver gain between consecutive scales of a group.

    The input has one row per experiment, so the window is small.
    """
    w = Window.partitionBy(group).orderBy(drivers, eps)
    gain = F.try_divide(F.col(eps), F.lag(eps).over(w))
    growth = F.try_divide(F.col(drivers), F.lag(drivers).over(w))
    return (summary.select(group, drivers, eps, F.lag(drivers).over(w).alias("from_drivers"),
                           rounded(F.try_divide(gain, growth) * 100, 0).alias("efficiency_pct"))
            .filter(F.col("from_drivers").isNotNull()))


def pareto_frontier(df: DataFrame, x: str, y: str, bins: int = BINS) -> DataFrame:
    """Rows that no other row beats or equals on both axes (lower is better).

    Exact duplicates do not beat each other. Keeps the lowest y per x, cuts the
    x range into bins, and compares each row with the best y of the bins before
    (one short ordered list) and of smaller x in its own bin. No pairs are built.
    """
    best = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).alias("__x")).agg(
        F.min(y).alias("__y"))
    cuts = best.agg(cut_points("__x", bins).alias("cuts"))
    binned = best.withColumn("__cuts", cuts.scalar()).select(
        "__x", "__y", bin_of("__x", "__cuts", bins).alias("__bin"))
    earlier = Window.orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    floors = binned.groupBy("__bin").agg(F.min("__y").alias("__floor")).select(
        "__bin", F.min("__floor").over(earlier).alias("__floor"))
    within = Window.partitionBy("__bin").orderBy("__x").rowsBetween(Window.unboundedPreceding, -1)
    front = (join_on_keys(binned, floors, ["__bin"])
             .withColumn("__beat", F.least("__floor", F.min("__y").over(within)))
             .filter(F.col("__beat").isNull() | (F.col("__y") < F.col("__beat")))
             .select("__x", "__y"))
    return df.join(front, (F.col(x) == F.col("__x")) & (F.col(y) == F.col("__y"))).drop("__x", "__y")


def minmax_scores(df: DataFrame, higher_better: tuple[str, ...] = ("avg_eps",),
                  lower_better: tuple[str, ...] = ("p95_lat", "p99_lat", "cost_hr", "window_s"),
                  neutral: tuple[str, ...] = ("drivers",)) -> DataFrame:
    """Scale columns to 0..1 with 1 best; a constant column and a missing value
    score 0.5. The limits come as one row from a scalar subquery."""
    cols = (*higher_better, *lower_better, *neutral)
    limits = df.agg(F.struct(*[F.min(c).cast("double").alias(f"lo_{c}") for c in cols],
                             *[F.max(c).cast("double").alias(f"hi_{c}") for c in cols]).alias("s"))
    scored = df.withColumn("__s", limits.scalar())
    for c in cols:
        low, high = F.col(f"__s.lo_{c}"), F.col(f"__s.hi_{c}")
        share = F.try_divide(F.col(c) - low, high - low)
        score = 1 - share if c in lower_better else share
        scored = scored.withColumn(f"{c}_score", F.coalesce(score, F.lit(0.5)))
    return scored.drop("__s")


def rolling_latency(samples: DataFrame, keys: list[str], ts: str = "timestamp", value: str = "value",
                    rows: int = 3, ties: list | None = None) -> DataFrame:
    """Mean of this and the ``rows - 1`` samples before it, fewer at the start."""
    indexed = with_index(samples, keys, ts, ties)
    return over_neighbours(indexed, keys, "idx", rows - 1, {
        "rolling": lambda w: F.avg(value).over(w.rowsBetween(-(rows - 1), 0))})


def elapsed_axis(samples: DataFrame, keys: list[str], ts: str = "timestamp", step_seconds: int = 10,
                 ties: list | None = None) -> DataFrame:
    """Nominal seconds (position times step) and true seconds since the first sample."""
    rows = carry(with_block(samples, keys, ts), {"__n": F.count("*"), "__min": F.min(ts)},
                 {"__start": F.coalesce(F.sum("__n").over(before()), F.lit(0)),
                  "__first": F.min("__min").over(whole())})
    place = F.col("__start") + F.row_number().over(in_block([ts, *(ties or [])])) - 1
    true_seconds = (F.unix_micros(ts) - F.unix_micros("__first")) / F.lit(1e6)
    return (rows.withColumn("idx", place.cast("bigint")).withColumn("elapsed_s", F.col("idx") * step_seconds)
            .withColumn("true_elapsed_s", true_seconds).drop("__start", "__first", SERIES, BLOCK))


def pair_fault_events(events: DataFrame, key: str = "experiment_name", order: str = "row_id") -> DataFrame:
    """First injection, recovery start and recovery end per experiment, by file order."""
    name = F.col("event")
    first = lambda cond: F.min_by("ts", F.when(cond, F.col(order)))
    picked = events.groupBy(key).agg(
        first(name == "FAULT_INJECT").alias("inject_ts"),
        first(name == "RECOVERY_START").alias("recovery_start"),
        first(name.startswith("RECOVERY_COMPLETE")).alias("recovery_end"))
    return picked.withColumn("recovery_s", F.col("recovery_end") - F.col("recovery_start"))
