"""Published results that can be recomputed from published inputs."""

import pytest
from pyspark.sql import functions as F

from fareflow.operators import experiments as ex
from fareflow.plans import serving

# Published summary rows.
SUMMARY = [("local_sub5s", 500, 2, 60.7, 3047.0, 4328.0, 4761.0, 19, 0.0),
           ("local_1k", 1000, 2, 105.0, 2767.0, 3813.0, 4323.0, 42, 0.0),
           ("local_5k", 5000, 5, 464.2, 5991.0, 6675.0, 6828.0, 72, 0.0),
           ("ec2_5k", 5000, 5, 470.1, 5847.0, 6147.0, 7091.0, 78, 0.2),
           ("ec2_50k", 50000, 10, 1836.8, 20630.0, 33374.0, 33891.0, 39, 0.2),
           ("emr_50k", 50000, 10, 2045.7, 75238.0, 132500.0, 137526.0, 47, 1.25)]
SCHEMA = ("experiment_name string, drivers int, window_s int, avg_eps double, p50_lat double, p95_lat double, "
          "p99_lat double, max_surge int, cost_hr double")

# Published trips / average fare / cancellation rate by city, for
# surge levels 1.0, 1.5, 2.0 and 2.5.
SURGE_BY_CITY = """
AMD 49/139.81/18.4 27/196.79/14.8 21/284.05/23.8 3/173.38/33.3
BLR 45/110.82/15.6 31/214.43/12.9 17/297.8/11.8 7/194.06/28.6
CHN 42/155.77/21.4 29/298.7/17.2 25/207.47/8.0 4/136.96/25.0
DEL 47/140.6/14.9 25/226.3/28.0 27/356.93/7.4 1/341.1/0.0
HYD 45/140.14/13.3 35/212.28/2.9 14/294.61/21.4 6/572.51/16.7
JAI 40/140.66/17.5 29/191.58/10.3 23/237.41/21.7 8/368.47/12.5
KOL 43/161.03/25.6 27/230.02/7.4 23/244.63/26.1 7/333.18/28.6
MUM 47/139.65/6.4 25/224.59/12.0 21/346.17/19.1 7/477.86/14.3
PUN 52/114.97/19.2 32/224.66/9.4 14/179.73/7.1 2/237.6/0.0
SRT 52/142.17/9.6 25/196.85/8.0 17/308.16/5.9 6/313.94/33.3
"""


@pytest.fixture(scope="module")
def summary(spark):
    return spark.createDataFrame(SUMMARY, SCHEMA)


def test_correlation(summary):
    r = ex.pearson(summary, "drivers", "p50_lat").first()
    assert round(r.r, 3) == 0.793 and round(r.p_value, 4) == 0.0597 and r.significant is False


@pytest.mark.parametrize("r,n,p", [(0.5, 10, 0.1411), (-0.5, 10, 0.1411), (0.0, 5, 1.0), (1.0, 6, 0.0), (0.9, 3, 0.2871),
                                   (0.01, 1_000_000, 1.52e-23), (0.001, 1_000_000, 0.3173), (0.5, 2, None)])
def test_p_value(spark, r, n, p):
    got = spark.range(1).select(ex.correlation_p_value(F.lit(r), F.lit(n)).alias("p")).first().p
    assert got is None if p is None else got == pytest.approx(p, rel=2e-3, abs=1e-9)


def test_cost_efficiency(summary):
    got = {r.experiment_name: r.eps_per_dollar for r in ex.with_cost_efficiency(summary).collect()}
    assert got == {"local_sub5s": None, "local_1k": None, "local_5k": None, "ec2_5k": 2350.5,
                   "ec2_50k": 9184.0, "emr_50k": 1636.6}


def test_latency_reduction(summary):
    assert ex.latency_reduction(summary, "local_5k", "local_sub5s").first().reduction_pct == 49.1


def test_pareto(summary):
    assert [r.experiment_name for r in ex.pareto_frontier(summary, "cost_hr", "p50_lat").collect()] == ["local_1k"]


def test_scaling(summary):
    rows = summary.withColumn("infra", F.substring_index("experiment_name", "_", 1))
    got = {(r.infra, r.drivers): r.efficiency_pct for r in ex.scaling_efficiency(rows).collect()}
    assert got == {("local", 1000): 86.0, ("local", 5000): 88.0, ("ec2", 50000): 39.0}


def test_meta_defaults(spark, summary):
    meta = spark.createDataFrame([("ec2_5k", 5000, None, 0.2)], "experiment_name string, drivers int, window_s int, cost_hr double")
    got = {r.experiment_name: (r.drivers, r.window_s, r.cost_hr, r.infra) for r in ex.with_experiment_meta(
        summary.select("experiment_name", "avg_eps"), meta).collect()}
    assert got["ec2_5k"] == (5000, 5, 0.2, "ec2") and got["local_1k"] == (0, 5, 0.0, "local")


def test_scores(summary):
    got = {r.experiment_name: r for r in ex.minmax_scores(summary).collect()}
    assert got["emr_50k"].avg_eps_score == 1.0 and got["emr_50k"].p95_lat_score == 0.0
    assert got["local_1k"].p99_lat_score == 1.0 and got["local_1k"].cost_hr_score == 1.0
    same = ex.minmax_scores(summary.withColumn("drivers", F.lit(7)))
    assert {r.drivers_score for r in same.collect()} == {0.5}


def test_cancellation_by_surge_level(spark):
    rows = [(line.split()[0], "2026-04-08", level, int(t), float(f), float(c))
            for line in SURGE_BY_CITY.strip().splitlines()
            for level, (t, f, c) in zip((1.0, 1.5, 2.0, 2.5), (x.split("/") for x in line.split()[1:]))]
    df = spark.createDataFrame(rows, "city_id string, date string, surge_bucket double, trip_count long, "
                                     "avg_fare double, cancellation_rate_pct double")
    got = [tuple(r) for r in serving.query(spark, "surge_cancellation", surge_analysis=df).collect()]
    assert got == [(1.0, 462, 16.2), (1.5, 285, 12.3), (2.0, 202, 15.2), (2.5, 51, 19.2)]


def test_fault_pairs(spark):
    log = [("a", 0, "FAULT_INJECT", 100), ("a", 1, "RECOVERY_START", 110), ("a", 2, "RECOVERY_COMPLETE_SPARK", 140),
           ("a", 3, "RECOVERY_START", 500), ("b", 0, "RECOVERY_START", 7)]
    df = spark.createDataFrame(log, "experiment_name string, row_id long, event string, ts long")
    got = {r.experiment_name: (r.inject_ts, r.recovery_start, r.recovery_end, r.recovery_s)
           for r in ex.pair_fault_events(df).collect()}
    assert got == {"a": (100, 110, 140, 30), "b": (None, 7, None, None)}


def test_window_reduction(spark):
    rows = [("local", 2, 3047.0), ("local", 5, 5991.0), ("local", 30, 31000.0), ("emr", 10, None), ("emr", 30, 9.0)]
    df = spark.createDataFrame(rows, "infra string, window_s int, latency_ms double")
    got = {r.infra: r.reduction_pct for r in ex.reduction_vs_baseline(df).collect()}
    assert got == {"local": 90.0, "emr": 0.0}
