"""The alarm stream against the batch form, across restarts and silence."""

import math
import os
import random
import threading
import time

import pandas as pd
import psutil
import pytest
from pyspark.sql import functions as F

from fareflow.operators import observability as ob
from fareflow.streaming import alarms, flows

SCHEMA = "scale string, metric_name string, t long, value double"
LOW, HIGH = "KafkaEventsPerSecond", "AvgLatencyMs"


def drop(spark, folder, rows, n):
    df = spark.createDataFrame(rows, SCHEMA).select("scale", "metric_name", F.timestamp_seconds("t").alias("timestamp"), "value")
    df.coalesce(1).write.parquet(f"{folder}/f{n}")
    for name in os.listdir(f"{folder}/f{n}"):
        os.utime(f"{folder}/f{n}/{name}", (time.time() - 1000 + n,) * 2)
    return df


def run(spark, folder, out, schema, **kw):
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
    query = flows.to_parquet(alarms.alarm_stream(source, **kw), f"{out}/states", f"{out}/cp")
    query.awaitTermination()
    return sorted((r.scale, r.metric_name, int(r.window_start.timestamp()) // 60, r.avg_value, r.state)
                  for r in spark.read.parquet(f"{out}/states").collect())


def batch(df, spec, until):
    """The batch form over minutes that are over at ``until``."""
    rolled = ob.metric_rollup(df.filter(F.unix_seconds("timestamp") < until // 60 * 60))
    low = ob.alarm_state(rolled, spec["metric"], spec["periods"], spec["missing_breaches"], spec.get("above"), spec.get("below"),
                         until=F.timestamp_seconds(F.lit(until // 60 * 60 - 60)))
    return [(r.scale, r.metric_name, int(r.window_start.timestamp()) // 60, r.avg_value, r.state) for r in low.collect()]


def test_stream_equals_batch_after_restarts(spark, tmp_path):
    """Series with gaps, one that stops for good; three runs on one checkpoint."""
    folder, out, parts = str(tmp_path / "in"), str(tmp_path / "out"), []
    base = 1_700_000_040 // 60 * 60
    for n, (lo, hi) in enumerate([(0, 12), (12, 20), (20, 31)]):
        rows = []
        for m in range(lo, hi):
            if m % 7 not in (3, 4, 5):
                rows += [("a", LOW, base + 60 * m + s, 4.0 if m % 5 else 40.0) for s in (0, 30)]
            if m < 9:
                rows.append(("b", LOW, base + 60 * m + 5, 50.0))
            rows.append(("a", HIGH, base + 60 * m + 10, 20_000.0 if m % 6 < 3 else 1.0))
        parts.append(drop(spark, folder, rows, n))
        got = run(spark, folder, out, parts[0].schema)
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    last = every.agg(F.max(F.unix_seconds("timestamp"))).first()[0]
    want = batch(every, ob.LOW_THROUGHPUT, last - 60) + batch(every, ob.HIGH_LATENCY, last - 60)
    assert got == sorted(want)
    # The series that stopped is in alarm after three silent minutes, without a row of its own.
    state = {(s, m): x for s, metric, m, _, x in got if metric == LOW}
    first = base // 60
    assert state["b", first + 10] == "OK" and state["b", first + 11] == "ALARM" and state["b", first + 20] == "ALARM"


def test_forgotten_series(spark, tmp_path):
    folder, out, base = str(tmp_path / "in"), str(tmp_path / "out"), 1_700_000_040 // 60 * 60
    drop(spark, folder, [("a", LOW, base, 50.0), ("b", HIGH, base, 1.0)], 0)
    df = drop(spark, folder, [("b", HIGH, base + 60 * m, 1.0) for m in range(1, 30)], 1)
    got = run(spark, folder, out, df.schema, forget_minutes=5)
    assert [m - base // 60 for s, _, m, _, _ in got if s == "a"] == [0, 1, 2, 3, 4, 5]


def test_heartbeat_moves_time(spark):
    source = spark.readStream.format("rate").load().select(
        F.lit("s").alias("scale"), F.lit(LOW).alias("metric_name"), "timestamp", F.lit(1.0).alias("value"))
    beating = alarms.with_heartbeat(source)
    assert beating.isStreaming and beating.columns == ["scale", "metric_name", "timestamp", "value"]
    assert alarms.alarm_stream(beating).isStreaming


class Handle:
    """One series' state and timers."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def registerTimer(self, at):
        self.timers.append(at)


def chunks(rows, size):
    for i in range(0, len(rows), size):
        part = rows[i:i + size]
        yield pd.DataFrame({"minute": [m for m, _ in part], "avg_value": [math.nan if v is None else v for _, v in part],
                            "known": [v is not None for _, v in part]})


@pytest.mark.parametrize("held,part,stretch", [(7, 5, 3), (10, 1000, 64), (10_000, 10_000, 10_000)])
def test_unordered_minutes_judged_one_by_one(monkeypatch, held, part, stretch):
    """Batches of minutes in any order, far more than are held, against a loop over every minute."""
    for name, value in (("HELD", held), ("PART", part), ("STRETCH", stretch)):
        monkeypatch.setattr(alarms, name, value)
    rnd = random.Random(held)
    values = [None, math.nan, math.inf, -math.inf, 4.0, 10.0, 50.0, 10_000.0, 20_000.0]
    for spec in (ob.HIGH_LATENCY, ob.LOW_THROUGHPUT):
        handle = Handle()
        alarm = alarms.Alarm({spec["metric"]: spec}, None)
        alarm.init(handle)
        got, every = [], {}
        for batch in range(4):
            # Minutes around zero: parts of the file start below it, too. The first of a batch were judged before.
            new = {m: rnd.choice(values) for m in range(batch * 150 - 105, batch * 150 + 40) if rnd.random() < 0.5}
            every |= {m: v for m, v in new.items() if not got or m > got[-1][0]}
            rows = list(new.items())
            rnd.shuffle(rows)
            for out in alarm.handleInputRows(("a", spec["metric"]), chunks(rows, 4), None):
                assert len(out) <= stretch
                got += zip(out.minute, out.avg_value, out.known, out.alarm)
        want, run = [], 0
        for m in range(min(every), max(every) + 1):
            v = every.get(m)
            if v is None:
                bad = spec["missing_breaches"]
            else:
                bad = (v > spec["above"] or v != v) if "above" in spec else v < spec["below"]
            run = run + 1 if bad else 0
            want.append((m, str(v), run >= spec["periods"]))
        assert [(m, str(float(v)) if k else "None", a) for m, v, k, a in got] == want
        assert handle.value[0] == max(every) and handle.timers == [(max(every) + 2) * 60_000]


def test_special_averages_on_the_stream(spark, tmp_path):
    """NaN stays NaN, and a minute of nulls has no average."""
    folder, out, base = str(tmp_path / "in"), str(tmp_path / "out"), 1_700_000_040 // 60 * 60
    rows = [(None, HIGH, base + 60 * m, v) for m, v in enumerate([math.nan, math.nan, None, 1.0, math.inf, 20_000.0])]
    drop(spark, folder, rows, 0)
    df = drop(spark, folder, [("end", HIGH, base + 60 * 8, 0.0)], 1)
    run(spark, folder, out, df.schema)
    got = sorted((int(r.window_start.timestamp()) - base, str(r.avg_value), r.state)
                 for r in spark.read.parquet(f"{out}/states").filter("scale IS NULL").collect())
    assert [(v, s) for _, v, s in got] == [("nan", "OK"), ("nan", "ALARM"), ("None", "OK"), ("1.0", "OK"), ("inf", "OK"),
                                           ("20000.0", "ALARM"), ("None", "OK")]


def test_many_minutes_do_not_fill_the_worker(spark, tmp_path):
    """A year and more of one series closed in one batch: a worker holds no list of its rows."""
    folder, out, minutes = str(tmp_path / "in"), str(tmp_path / "out"), 600_000
    (spark.range(minutes).select(F.lit("a").alias("scale"), F.lit(LOW).alias("metric_name"),
                                 F.timestamp_seconds(F.lit(1_700_000_040 // 60 * 60) + F.col("id") * 60).alias("timestamp"),
                                 (F.col("id") % 7).cast("double").alias("value")).coalesce(1).write.parquet(f"{folder}/f0"))
    most, done = [0], threading.Event()

    def watch():
        while not done.wait(0.1):
            for p in psutil.Process().children(recursive=True):
                try:
                    if p.name().startswith("python"):
                        most.append(p.memory_info().rss / 1e6)
                except psutil.Error:
                    pass

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        source = spark.readStream.schema(spark.read.parquet(f"{folder}/f0").schema).parquet(f"{folder}/*")
        flows.to_parquet(alarms.alarm_stream(source), f"{out}/states", f"{out}/cp").awaitTermination()
    finally:
        done.set()
        watcher.join()
    states = spark.read.parquet(f"{out}/states")
    assert states.count() == minutes - 2 and states.select("window_start").distinct().count() == minutes - 2
    assert 0 < max(most) < 400


def test_state_stores_share_one_bound(spark):
    """Memory outside the heap does not grow with the partitions of an executor."""
    prefix = "spark.sql.streaming.stateStore.rocksdb."
    assert spark.conf.get(f"{prefix}boundedMemoryUsage") == "true" and int(spark.conf.get(f"{prefix}maxMemoryUsageMB")) <= 200
