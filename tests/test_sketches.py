"""Stored sketches: rank error, merging by day, replaced days."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareflow.operators import reports, sketches

POINTS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


@pytest.fixture(scope="module")
def rows(spark):
    """Three groups, one of them null, over five days; some values null or NaN."""
    day = (F.col("id") % 5 + 1).cast("int")
    v = F.exp(F.rand(3) * 8)
    return spark.range(60_000).select(
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(None).cast("string")), (F.col("id") % 3 + 1).cast("int")).alias("g"),
        F.make_date(F.lit(2024), F.lit(1), day).cast("timestamp").alias("ts"),
        F.when(F.col("id") % 97 == 0, F.lit(None)).when(F.col("id") % 89 == 0, F.lit(float("nan"))).otherwise(v).alias("v")).cache()


def test_rank_error_and_merge(spark, rows, tmp_path):
    root = str(tmp_path / "s")
    sketches.write_sketches(sketches.daily_sketches(rows, ["g"], "v", "ts", k=200), root)
    found = sketches.percentiles(sketches.merged(spark, root, ["g"]), POINTS)
    ok = sketches.within_rank_error(rows, found, ["g"], "v", POINTS, sketches.rank_error(200, 2)).collect()
    assert len(ok) == 3 and all(r[f"{p}_within"] for r in ok for p in POINTS)
    pdf = rows.toPandas()
    for r in found.collect():
        own = pdf[pdf.g.isna() if r.g is None else pdf.g == r.g].v.dropna().to_numpy()
        assert r.n == len(own) and float(r.total) == pytest.approx(own.sum()) and (r.lowest, r.highest) == (own.min(), own.max())
        for p, at in POINTS.items():
            assert r[p] in own and abs(np.mean(own <= r[p]) - at) < 0.03


def test_span_reads_its_days_only(spark, rows, tmp_path):
    root = str(tmp_path / "s")
    sketches.write_sketches(sketches.daily_sketches(rows, ["g"], "v", "ts"), root)
    span = sketches.merged(spark, root, ["g"], F.lit("2024-01-02").cast("date"), F.lit("2024-01-03").cast("date"))
    assert "PartitionFilters: [isnotnull(date" in span._jdf.queryExecution().executedPlan().toString()
    want = rows.filter("day(ts) in (2, 3) and v is not null and not isnan(v)").count()
    assert span.agg(F.sum("n")).first()[0] == want
    # A day that runs again replaces itself.
    sketches.write_sketches(sketches.daily_sketches(rows.filter("day(ts) = 2").limit(10), ["g"], "v", "ts"), root)
    again = sketches.merged(spark, root, ["g"], F.lit("2024-01-02").cast("date"), F.lit("2024-01-03").cast("date"))
    assert again.agg(F.sum("n")).first()[0] < want and spark.read.parquet(root).select("date").distinct().count() == 5


def test_report_equals_the_one_over_rows_for_few_values(spark, tmp_path):
    """Sketches of fewer values than their size hold all of them."""
    df = spark.range(300).select(F.concat(F.lit("e"), (F.col("id") % 2).cast("string")).alias("experiment_name"),
                                 (F.col("id") * 37 % 101).cast("double").alias("processing_latency_ms"),
                                 F.timestamp_seconds(F.col("id") * 3600).alias("ts"))
    root = str(tmp_path / "s")
    sketches.write_sketches(sketches.daily_sketches(df, ["experiment_name"], "processing_latency_ms", "ts"), root)
    got = sketches.latency_report(spark, root, reports.POINTS, ["experiment_name"])
    want = reports.latency_percentiles(df)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
