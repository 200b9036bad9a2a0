"""Files, marts, the keyed table and the daily job."""

import os

import pytest
from pyspark.sql import functions as F

from checks import projections as p
from fareflow.operators import marts
from fareflow.plans import daily_marts
from fareflow.sources import files, keyed
from tests.conftest import SF


@pytest.fixture(scope="module")
def trips_root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("trips") / "raw")
    files.write_trips_csv(p.trips(spark, SF), root)
    return root


def test_trips_prune_days_and_keep_columns(spark, trips_root):
    day = files.read_trips(spark, trips_root, "2024-01-03")
    plan = day.select("trip_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "ReadSchema: struct<trip_id:string>" in plan
    want = p.trips(spark, SF).filter("date = '2024-01-03'")
    assert day.columns == want.columns
    assert day.exceptAll(want).isEmpty() and want.exceptAll(day).isEmpty()


def test_gates(spark, trips_root, tmp_path):
    size = files.input_bytes(spark, trips_root, "2024-01-03").first().input_bytes
    on_disk = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(trips_root)
                  for f in names if "date=2024-01-03" in d and f.endswith(".csv"))
    assert size == on_disk > 0
    assert files.input_size_gate(spark, trips_root, "2024-01-03", 100)
    assert not files.input_size_gate(spark, trips_root, "2024-01-03")
    assert not files.input_size_gate(spark, trips_root, "1999-01-01", 1)
    assert not files.input_size_gate(spark, str(tmp_path / "nowhere"), "2024-01-03", 1)
    assert files.empty_input_gate(spark.range(1)) and not files.empty_input_gate(spark.range(0))


def test_daily_job(spark, trips_root, tmp_path):
    out = str(tmp_path / "marts")
    skipped = daily_marts.run(spark, trips_root, out, "2024-01-03")
    assert not skipped.ran and skipped.reason == "input below minimum size"
    reports = [daily_marts.run(spark, trips_root, out, d, min_bytes=100) for d in ("2024-01-03", "2024-01-04")]
    again = daily_marts.run(spark, trips_root, out, "2024-01-03", min_bytes=100)
    assert [r.ran for r in reports] == [True, True] and again.trips == reports[0].trips
    both = p.trips(spark, SF).filter("date in ('2024-01-03', '2024-01-04')")
    assert sum(r.trips for r in reports) == both.count()
    direct = {"driver_earnings": marts.driver_earnings, "zone_heatmap": marts.zone_heatmap,
              "city_stats": marts.city_stats, "surge_analysis": marts.surge_effectiveness}
    for name, build in direct.items():
        want = build(both)
        got = files.read_mart(spark, out, name).select(*want.columns)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty(), name
    demand = keyed.read_current(spark, f"{out}/zone_demand", daily_marts.ZONE_DEMAND_KEYS)
    assert demand.count() == marts.zone_heatmap(both).count()


def test_register(spark, tmp_path):
    out = str(tmp_path / "m")
    files.write_marts(daily_marts.build_marts(p.trips(spark, SF).filter("date = '2024-01-03'")), out)
    files.register_marts(spark, out, database="rides")
    one = spark.table("rides.city_stats").count()
    files.write_marts(daily_marts.build_marts(p.trips(spark, SF).filter("date = '2024-01-05'")), out)
    files.register_marts(spark, out, database="rides")
    assert spark.table("rides.city_stats").count() > one
    plan = spark.sql("SELECT sum(trip_count) FROM rides.zone_heatmap WHERE date = '2024-01-05'")
    assert "PartitionFilters: [isnotnull(date" in plan._jdf.queryExecution().executedPlan().toString()
    files.register_marts(spark, out)
    assert spark.sql("SELECT count(*) n FROM city_stats").first().n == spark.table("rides.city_stats").count()


def test_sync_adds_only_what_is_new(spark, tmp_path):
    """New days by the log alone, a new column, a day whose files are gone, a day run again."""
    import shutil
    out, trips, db = str(tmp_path / "m"), p.trips(spark, SF), "synced"
    day = lambda n: daily_marts.build_marts(trips.filter(f"date = '2024-01-{n:02d}'"))
    count = lambda where="true": spark.sql(f"SELECT count(*) n FROM {db}.city_stats WHERE {where}").first().n
    files.write_marts(day(3), out, "2024-01-03")
    first = files.sync_marts(spark, out, db)
    assert first["city_stats"] == 1 and first["zone_heatmap"] == first["surge_analysis"] > 1 and count() > 0
    assert set(files.sync_marts(spark, out, db).values()) == {0}
    # Another day brings another column; a folder the log does not know stays out.
    wider = day(5)
    wider["city_stats"] = wider["city_stats"].withColumn("note", F.lit("new"))
    files.write_marts(wider, out, "2024-01-05")
    day(6)["city_stats"].drop("date").write.parquet(f"{out}/city_stats/date=2024-01-06")
    assert files.sync_marts(spark, out, db)["city_stats"] == 1
    assert count("date = '2024-01-06'") == 0 and count("note = 'new'") == count("date = '2024-01-05'") > 0
    assert count("note IS NULL") == count("date = '2024-01-03'") > 0
    # A run without the column again, and a removed day: column and partition stay, queries work.
    files.write_marts(day(7), out, "2024-01-07")
    shutil.rmtree(f"{out}/city_stats/date=2024-01-03")
    assert files.sync_marts(spark, out, db)["city_stats"] == 1
    days = {r.partition for r in spark.sql(f"SHOW PARTITIONS {db}.city_stats").collect()}
    assert days == {"date=2024-01-03", "date=2024-01-05", "date=2024-01-07"} and "note" in spark.table(f"{db}.city_stats").columns
    assert count("date = '2024-01-05'") > 0 and count("date = '2024-01-07'") > 0
    before = count("date = '2024-01-05'")
    files.write_marts(day(5), out, "2024-01-05")
    assert files.sync_marts(spark, out, db)["city_stats"] == 0 and count("date = '2024-01-05'") == before


def test_keyed_table(spark, tmp_path):
    root = str(tmp_path / "table")
    put = lambda rows, n: keyed.upsert(spark.createDataFrame(rows, "k string, v int"), root, n)
    state = lambda **kw: {r.k: r.v for r in keyed.read_current(spark, root, ["k"], **kw).collect()}
    put([("a", 1), ("b", 1)], 0)
    put([("b", 2), ("c", 2)], 1)
    assert state() == {"a": 1, "b": 2, "c": 2} and state(as_of=0) == {"a": 1, "b": 1}
    put([("b", 2), ("c", 2)], 1)
    keyed.compact(spark, root, ["k"], upto=1, keep=F.col("k") != "a")
    assert state() == {"b": 2, "c": 2}
    put([("c", 9)], 10)
    assert state() == {"b": 2, "c": 9}
    os.makedirs(f"{root}/snapshots/upto=10")  # a compaction that died
    assert state() == {"b": 2, "c": 9}
    keyed.compact(spark, root, ["k"], upto=10)
    assert state() == {"b": 2, "c": 9}
    assert keyed.prune(spark, root, keep_batches=5) == 2 and keyed.prune(spark, root, keep_batches=0) == 1
    assert state() == {"b": 2, "c": 9}
    put([("d", 1)], 11)
    assert state() == {"b": 2, "c": 9, "d": 1}


def test_small_batches_rewrite_little(spark, tmp_path):
    """100 keys on a table of a million: under 5 % is written, and every state is right."""
    root, n = str(tmp_path / "big"), 1_000_000
    keyed.upsert(spark.range(n).select("id", F.lit(0).alias("v")), root, 0)
    assert keyed.compact(spark, root, ["id"], upto=0).rows_written == n
    for batch in range(1, 4):
        keys = spark.range(100).select((F.col("id") * 7919 * batch % n).alias("id"), F.lit(batch).alias("v"))
        keyed.upsert(keys, root, batch)
        done = keyed.compact(spark, root, ["id"], upto=batch)
        assert done.rows >= n and done.rows_written < 0.05 * n
    state = keyed.read_current(spark, root, ["id"])
    assert state.count() == n
    want = {}
    for batch in range(1, 4):
        want |= {i * 7919 * batch % n: batch for i in range(100)}
    assert {r.id: r.v for r in state.filter("v > 0").collect()} == want
    some = keyed.read_current(spark, root, ["id"], only=spark.createDataFrame([(7919,), (5,)], "id bigint"))
    assert {r.id: r.v for r in some.collect()} == {7919: want[7919], 5: 0}
    keyed.prune(spark, root, keep_batches=0)
    assert keyed.read_current(spark, root, ["id"]).agg(F.sum("v")).first()[0] == sum(want.values())


def test_levels_fill_up_and_expire(spark, tmp_path):
    root, keep = str(tmp_path / "t"), F.col("at") >= 100
    put = lambda rows, n: keyed.upsert(spark.createDataFrame(rows, "k int, at int"), root, n)
    model = {}
    for batch in range(12):
        rows = [(k, 90 + batch if k % 3 else 200 + batch) for k in range(batch * 5, batch * 5 + 60)]
        put(rows, batch)
        model |= dict(rows)
        keyed.compact(spark, root, ["k"], upto=batch, keep=keep, buckets=4)
        now = {r.k: r.at for r in keyed.read_current(spark, root, ["k"]).collect()}
        assert {k: at for k, at in now.items() if at >= 100} == {k: at for k, at in model.items() if at >= 100}
        assert all(model[k] == at for k, at in now.items())
    assert sum(at < 100 for at in now.values()) <= 0.5 * len(now)


def test_order_column_beats_batch(spark, tmp_path):
    root = str(tmp_path / "t")
    put = lambda rows, n: keyed.upsert(spark.createDataFrame(rows, "k string, at int, v int"), root, n)
    state = lambda: {r.k: r.v for r in keyed.read_current(spark, root, ["k"], order=("at",)).collect()}
    put([("a", 5, 1), ("b", None, 1)], 0)
    put([("a", 4, 2), ("b", 1, 2)], 1)
    put([("a", 5, 3)], 2)
    assert state() == {"a": 3, "b": 2}
    keyed.compact(spark, root, ["k"], upto=1, order=("at",))
    assert state() == {"a": 3, "b": 2}
    put([("b", 0, 4)], 3)
    keyed.compact(spark, root, ["k"], upto=3, order=("at",))
    assert state() == {"a": 3, "b": 2}


def test_table_without_keys_keeps_all_rows(spark, tmp_path):
    root = str(tmp_path / "log")
    put = lambda rows, n: keyed.upsert(spark.createDataFrame(rows, "v int"), root, n)
    state = lambda: sorted(r.v for r in keyed.read_current(spark, root, []).collect())
    put([(1,), (1,)], 0)
    put([(2,)], 1)
    keyed.compact(spark, root, [], upto=1)
    assert state() == [1, 1, 2]
    put([(3,)], 0)  # batch 0 again, with other rows
    assert state() == [2, 3]
    keyed.compact(spark, root, [], upto=1)
    assert state() == [2, 3]


def test_backfill_after_compaction(spark, tmp_path):
    root = str(tmp_path / "days")
    put = lambda rows, n: keyed.upsert(spark.createDataFrame(rows, "k string, v int"), root, n)
    state = lambda: {r.k: r.v for r in keyed.read_current(spark, root, ["k"]).collect()}
    put([("a", 3)], 20240103)
    keyed.compact(spark, root, ["k"], upto=20240103)
    put([("a", 2), ("b", 2)], 20240102)
    put([("c", 1)], 20240101)
    assert state() == {"a": 3, "b": 2, "c": 1}
    assert keyed.prune(spark, root, keep_batches=0) == 1  # the two days are not in the snapshot yet
    assert state() == {"a": 3, "b": 2, "c": 1}
    put([("a", 4)], 20240103)
    assert state()["a"] == 4


def test_rerun_replaces_the_whole_day(spark, tmp_path):
    out, trips = str(tmp_path / "m"), p.trips(spark, SF).filter("date in ('2024-01-03', '2024-01-05')")
    cities = lambda day: {r.city_id for r in files.read_mart(spark, out, "driver_earnings").filter(f"date = '{day}'").select("city_id").distinct().collect()}
    files.write_marts(daily_marts.build_marts(trips), out)
    other, gone = cities("2024-01-05"), sorted(cities("2024-01-03"))[0]
    rerun = trips.filter(f"date = '2024-01-03' AND city_id <> '{gone}'")
    before = cities("2024-01-03")
    files.write_marts(daily_marts.build_marts(rerun), out, "2024-01-03")
    assert cities("2024-01-03") == before - {gone} and cities("2024-01-05") == other


def test_metrics_files(spark, tmp_path):
    good, bad = tmp_path / "exp" / "metrics_a.csv", tmp_path / "exp" / "metrics_b.csv"
    good.parent.mkdir()
    head = "timestamp,experiment_name,source,metric_name,value,labels\n"
    good.write_text(head + "2026-04-16T04:20:41.123Z,e,spark,spark_batch_latency_ms,5.5,\n")
    bad.write_text(head + "yesterday,e,spark,spark_batch_latency_ms,oops,\n")
    (tmp_path / "exp" / "fault_events.csv").write_text("FAULT_INJECT,100,kill\nRECOVERY_START,110,\n")  # not metrics
    rows = files.read_metrics(spark, str(tmp_path / "exp")).orderBy("value").collect()
    assert [(r.value, r.timestamp is None) for r in rows] == [(None, True), (5.5, False)]
    one, two = rows and files.read_metrics(spark, str(good)), spark.range(1).select(F.lit("x").alias("metric_name"))
    assert files.union_experiments([one, two]).count() == 2


def test_metric_file_verdicts(spark, tmp_path):
    """Every file is listed with its reason; only accepted ones are read."""
    head, row = "timestamp,experiment_name,source,metric_name,value,labels", "2026-04-16T04:20:41Z,e,spark,m,5.5,"
    content = {
        "good": f"{head}\n{row}\n", "quoted": '\ufeff"timestamp","experiment_name","source","metric_name","value","labels"\n' + row + "\n",
        "swapped": "timestamp,experiment_name,source,value,metric_name,labels\n2026-04-16T04:20:41Z,e,spark,5.5,m,\n",
        "short": "timestamp,experiment_name,metric_name,value\n2026-04-16T04:20:41Z,e,m,5.5\n", "more": f"{head},extra\n{row},1\n",
        "bare": f"{row}\n", "only head": f"{head}\n"}
    for name, text in content.items():
        (tmp_path / f"metrics_{name}.csv").write_text(text)
    got = {r.file.split("metrics_")[1].removesuffix(".csv").replace("%20", " "): r.reason for r in files.metric_files(spark, str(tmp_path)).collect()}
    assert got == {"good": None, "quoted": None, "only head": None, "swapped": "columns in another order: timestamp, experiment_name, source, value, metric_name, labels",
                   "short": "missing columns: source, labels", "more": "unknown columns: extra", "bare": "no header"}
    assert [r.value for r in files.read_metrics(spark, str(tmp_path)).collect()] == [5.5, 5.5]


def test_fault_log(spark, tmp_path):
    path = tmp_path / "fault_local" / "fault_events.csv"
    path.parent.mkdir()
    path.write_text("FAULT_INJECT,100,kill\nRECOVERY_START,110,\nRECOVERY_COMPLETE,135,ok\n")
    from fareflow.operators.experiments import pair_fault_events
    row = pair_fault_events(files.read_fault_events(spark, str(path))).first()
    assert (row.experiment_name, row.recovery_s) == ("fault_local", 25)


def test_summary_is_one_file(spark, tmp_path):
    files.write_summary(spark.range(20).repartition(5), str(tmp_path / "s"))
    assert sum(f.endswith(".csv") for f in os.listdir(tmp_path / "s")) == 1
