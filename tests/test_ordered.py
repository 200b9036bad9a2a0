"""Operators that must match a one-machine calculation on skewed input."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fareflow.operators import experiments, observability, ordered, quantiles


@pytest.fixture(scope="module")
def skewed():
    """One key holds most rows; values repeat and some are missing."""
    rng = random.Random(5)
    keys = ["hot"] * 4000 + ["warm"] * 300 + ["one"] + [None] * 40
    return pd.DataFrame({"key": keys, "value": [None if rng.random() < .02 else round(rng.paretovariate(1.1), 1)
                                                for _ in keys],
                         "n": range(len(keys))})


def frame(spark, pdf, schema):
    rows = [tuple(None if v is None or (isinstance(v, float) and math.isnan(v)) else v for v in r)
            for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, schema).repartition(4)


POINTS = {"a": 0.0, "b": 0.5, "c": 0.95, "d": 0.99, "e": 1.0}


@pytest.mark.parametrize("bins", [2, 70, 1024])
def test_exact_quantiles(spark, skewed, bins):
    df = frame(spark, skewed, "key string, value double, n long")
    linear = {r.key: r for r in quantiles.exact_quantiles(df, ["key"], "value", POINTS, bins=bins).collect()}
    nearest = {r.key: r for r in quantiles.exact_quantiles(df, ["key"], "value", POINTS, "nearest", bins).collect()}
    for key, group in skewed.groupby("key", dropna=False):
        key = None if not isinstance(key, str) else key
        values = np.sort(group["value"].dropna().to_numpy())
        for name, p in POINTS.items():
            assert linear[key][name] == pytest.approx(np.quantile(values, p), rel=1e-12)
            assert nearest[key][name] == values[min(int(len(values) * p), len(values) - 1)]


def test_image_keeps_order(spark):
    """Also for powers of two and their neighbours, where a logarithm is off."""
    powers = [2.0**e for e in range(-1074, 1024)]
    values = powers + [np.nextafter(x, np.inf) for x in powers] + [np.nextafter(x, 0) for x in powers] + [0.1, 3.3e-310, 1e17]
    values += [-v for v in values] + [0.0, -0.0, float("inf"), float("-inf")]
    got = {r.v: r.i for r in frame(spark, pd.DataFrame({"v": values}), "v double").select(
        "v", quantiles.ordered_image(F.col("v")).alias("i")).collect()}
    bits = lambda v: int(np.float64(abs(v)).view(np.int64)) * (-1 if v < 0 else 1)
    assert all(i == bits(v) for v, i in got.items())


@pytest.mark.parametrize("bins", [256, 1 << 16])
def test_narrow_and_repeated_values(spark, bins):
    """Bins that hold too many rows are split down to single values, which need no sort."""
    rng = random.Random(3)
    values = [rng.uniform(0, 5e-4) for _ in range(3000)] + [1000 + rng.random() * 1e-9 for _ in range(3000)] + [7.25] * 3000
    df = frame(spark, pd.DataFrame({"k": ["a"] * 9000 + ["b"] * 4, "v": values + [1.0, 2.0, 3.0, None]}), "k string, v double")
    got = {r.k: r for r in quantiles.exact_quantiles(df, ["k"], "v", POINTS, bins=bins, leaf=20).collect()}
    for name, p in POINTS.items():
        assert got["a"][name] == pytest.approx(np.quantile(values, p), rel=1e-13)
        assert got["b"][name] == pytest.approx(np.quantile([1, 2, 3], p))


def test_rows_outside_bins_are_not_shuffled(spark):
    df = spark.range(20000).select((F.col("id") % 3).alias("k"), (F.col("id") * 1.0).alias("v"))
    plan = quantiles.exact_quantiles(df, ["k"], "v", {"p": 0.5}, leaf=500)._jdf.queryExecution().toString()
    first = plan[plan.index("== Physical Plan"):].split("Range (")[0]
    assert first.count("Exchange") - first.count("BroadcastExchange") <= 3 and "SortMergeJoin" not in first
    assert "BroadcastHashJoin" in first.split("Exchange hashpartitioning")[-1]


def test_one_plan_for_small_inputs(spark, skewed):
    df = frame(spark, skewed, "key string, value double, n long")
    runs = [sorted(map(str, quantiles.exact_quantiles(df, ["key"], "value", POINTS, refine=r).collect())) for r in (True, False)]
    assert runs[0] == runs[1]


def test_three_percentiles_differ(spark):
    df = spark.createDataFrame([(1, float(v)) for v in (1, 2, 3, 4, 10)], "k int, v double")
    assert quantiles.exact_quantiles(df, ["k"], "v", {"p": 0.95}, "nearest").first().p == 10
    assert quantiles.exact_quantiles(df, ["k"], "v", {"p": 0.95}).first().p == pytest.approx(8.8)
    assert quantiles.approx_quantiles(df, ["k"], "v", {"p": 0.95}).first().p == 10


@pytest.fixture(scope="module")
def series():
    """Samples at uneven times, with gaps over many blocks and equal times."""
    rng = random.Random(9)
    rows, n = [], 0
    for key, count in (("a", 700), ("b", 60), ("c", 1)):
        at = 1_700_000_000
        for _ in range(count):
            at += rng.choice([0, 5, 10, 10, 10, 40, 4000])
            rows.append((key, n, at, 0.0 if rng.random() < .4 else float(rng.randint(1, 60)), float(rng.randint(0, 50))))
            n += 1
    return pd.DataFrame(rows, columns=["key", "n", "at", "value", "done"])


@pytest.fixture(scope="module")
def samples(spark, series):
    return frame(spark, series, "key string, n long, at long, value double, done double").withColumn(
        "timestamp", F.timestamp_seconds("at"))


def test_index_and_rolling(samples, series):
    got = {r.n: (r.idx, r.rolling) for r in experiments.rolling_latency(samples, ["key"], ties=["n"]).collect()}
    for _, g in series.groupby("key"):
        g = g.sort_values(["at", "n"]).reset_index(drop=True)
        rolling = g["value"].rolling(3, min_periods=1).mean()
        for i, n in enumerate(g["n"]):
            assert got[n][0] == i and got[n][1] == pytest.approx(rolling[i])


@pytest.mark.parametrize("size", [3, 50])
def test_look_back_crosses_parts(samples, series, size):
    indexed = ordered.with_index(samples, ["key"], "timestamp", ["n"], seconds=60)
    out = ordered.over_neighbours(indexed, ["key"], "idx", 2, {
        "low": lambda w: F.min("value").over(w.rowsBetween(-2, 0))}, size=size)
    got = {r.n: r.low for r in out.collect()}
    assert len(got) == len(series)
    for _, g in series.groupby("key"):
        g = g.sort_values(["at", "n"])
        assert [got[n] for n in g["n"]] == list(g["value"].rolling(3, min_periods=1).min())


def test_counter_rate(samples, series):
    got = {r.n: r.rate for r in observability.counter_rate(samples, ["key"], ties=["n"]).collect()}
    for _, g in series.groupby("key"):
        prev = None
        for r in g.sort_values(["at", "n"]).itertuples():
            if prev is None or r.at == prev.at:
                assert got[r.n] is None
            else:
                gain = r.value - prev.value if r.value >= prev.value else r.value
                assert got[r.n] == pytest.approx(gain / (r.at - prev.at))
            prev = r


def test_outages(samples, series):
    runs = observability.outage_intervals(samples, ["key"], ties=["n"]).collect()
    got = sorted((r.key, int(r.detected_at.timestamp()), r.zero_samples, r.downtime_s) for r in runs)
    want = []
    for key, g in series.groupby("key"):
        start = count = None
        for r in g.sort_values(["at", "n"]).itertuples():
            if r.value == 0 and start is None:
                start, count = r.at, 1
            elif r.value == 0:
                count += 1
            elif start is not None:
                want.append((key, start, count, float(r.at - start)))
                start = None
        if start is not None:
            want.append((key, start, count, None))
    assert [g[0] for g in got] == [w[0] for w in sorted(want, key=str)] and len(got) == len(want)
    assert sorted(map(str, [(g[0], g[2], g[3]) for g in got])) == sorted(map(str, [(w[0], w[2], w[3]) for w in want]))


def test_backlog(samples, series):
    got = {r.n: r.backlog for r in observability.backlog_growth(
        samples, ["key"], incoming="value", processed="done", ties=["n"]).collect()}
    for _, g in series.groupby("key"):
        queue = 0.0
        for r in g.sort_values(["at", "n"]).itertuples():
            queue = max(0.0, queue + r.value - r.done)
            assert got[r.n] == pytest.approx(queue)


def test_no_data(samples, series):
    rows = observability.no_data_streak(samples, ["key"]).collect()
    got = sorted((r.key, int(r.warned_at.timestamp()), r.empty_scrapes) for r in rows)
    want = []
    for key, g in series.groupby("key"):
        slots = sorted({a // 10 for a in g["at"]})
        want += [(key, (a + 3) * 10, b - a - 1) for a, b in zip(slots, slots[1:]) if b - a - 1 >= 3]
    assert got == sorted(want)


def test_alarms(spark):
    base = 28_333_333  # minutes
    def rollup(metric, values):
        rows = [("5K", metric, (base + i) * 60, v) for i, v in values.items()]
        return spark.createDataFrame(rows, "scale string, metric_name string, at long, avg_value double").withColumn(
            "window_start", F.timestamp_seconds("at"))
    high = observability.high_latency_alarm(rollup("AvgLatencyMs", {0: 20000., 1: 20000., 3: 20000., 4: 9000., 5: 20000., 6: 10001.}))
    states = [r.state for r in high.orderBy("window_start").collect()]
    assert states == ["OK", "ALARM", "OK", "OK", "OK", "OK", "ALARM"]
    low = observability.low_throughput_alarm(rollup("KafkaEventsPerSecond", {0: 5., 1: 50., 4: 9., 5: 10., 6: 9.}))
    states = [r.state for r in low.orderBy("window_start").collect()]
    assert states == ["OK", "OK", "OK", "OK", "ALARM", "OK", "OK"]


@pytest.mark.parametrize("bins", [4, 70])
def test_pareto(spark, bins):
    rng = random.Random(3)
    points = [(i, float(rng.randint(0, 30)), float(rng.randint(0, 30)) + rng.choice([0, 0, 9])) for i in range(120)]
    points += [(900 + i, *points[0][1:]) for i in range(3)] + [(999, 0.0, 40.0), (998, 31.0, 0.0), (997, 31.0, 0.0)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    got = sorted(r.id for r in experiments.pareto_frontier(df, "x", "y", bins).collect())
    want = [i for i, x, y in points if not any(a <= x and b <= y and (a, b) != (x, y) for _, a, b in points)]
    assert got == sorted(want)


def test_quantiles_do_not_depend_on_row_order(spark):
    values = [float("-inf"), -1e300, -3.5, -0.0, 0.0, 1e-9, 2e-9, 0.5, 1.0, 1.0000001, 7.0, 7.1, 1e6, 1e300, float("inf"), float("nan")]
    points = {f"p{i}": i / 15 for i in range(16)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for seed in (1, 2):
            rows = [("g", v) for v in values]
            random.Random(seed).shuffle(rows)
            df = spark.createDataFrame(rows, "key string, value double").repartition(5)
            got = list(quantiles.exact_quantiles(df, ["key"], "value", points, "nearest").first())[1:]
            want = sorted(values[:-1]) + [values[-1]]
            assert [str(abs(g) if g == 0 else g) for g in got] == [str(abs(w) if w == 0 else w) for w in (want[min(int(16 * i / 15), 15)] for i in range(16))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_means_of_special_values(spark):
    from fareflow.functions.numeric import exact_mean
    rows = [("tiny", 4e-7), ("tiny", 4e-7), ("huge", 1e17), ("huge", 3e17), ("nan", 1.0), ("nan", float("nan")), ("inf", 1.0), ("inf", float("inf")), ("none", None)]
    got = {r.k: r.m for r in spark.createDataFrame(rows, "k string, v double").groupBy("k").agg(exact_mean(F.col("v")).alias("m")).collect()}
    assert got["tiny"] == pytest.approx(4e-7) and got["huge"] == pytest.approx(2e17)
    assert math.isnan(got["nan"]) and got["inf"] == float("inf") and got["none"] is None


def test_alarm_of_a_scale_that_stopped(spark):
    rows = [("A", m, 50.0) for m in range(2)] + [("B", m, 50.0) for m in range(30)]
    rollup = spark.createDataFrame(rows, "scale string, m long, avg_value double").select(
        "scale", F.lit("KafkaEventsPerSecond").alias("metric_name"), F.timestamp_seconds(F.col("m") * 60).alias("window_start"), "avg_value")
    now = F.timestamp_seconds(F.lit(29 * 60))
    states = [(r.scale, r.state) for r in observability.low_throughput_alarm(rollup, until=now).orderBy("scale", "window_start").collect()]
    assert states == [("A", "OK")] * 4 + [("A", "ALARM")] * 26 + [("B", "OK")] * 30
    assert observability.low_throughput_alarm(rollup).count() == 32


def test_empty_scrapes_at_both_ends(spark):
    rows = spark.createDataFrame([("a", 100), ("a", 110), ("b", 30)], "k string, s long").select("k", F.timestamp_seconds("s").alias("timestamp"))
    at = lambda s: F.timestamp_seconds(F.lit(s))
    found = observability.no_data_streak(rows, ["k"], since=at(0), until=at(145)).select(
        "k", F.unix_seconds("warned_at").alias("w"), "empty_scrapes", F.unix_seconds("resumed_at").alias("r"))
    assert set(map(tuple, found.collect())) == {("a", 20, 10, 100), ("a", 140, 3, None), ("b", 20, 3, 30), ("b", 60, 11, None)}
    assert observability.no_data_streak(rows, ["k"]).count() == 0
