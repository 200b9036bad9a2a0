"""Alarms while the data arrive.

Samples become minute averages as soon as the watermark closes a minute; a state per
scale and metric then judges every minute in turn. A minute without data is judged too, when
a timer finds it closed, so an alarm on missing data needs no row of its own series. What
moves the watermark is any row of the stream; ``with_heartbeat`` adds one a second, for the
case that everything falls silent.

The state is one small row per series, so a series' minutes run in one task at a time,
in Python, after the averages have been made in Catalyst. The minutes that a batch closes
come in any order and may be many (years, when a stream starts on old data); a task holds
``HELD`` of them, sorts the others through a file of its own and returns ``STRETCH`` at a time.
"""

from __future__ import annotations

import os
import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fareflow.functions.numeric import exact_mean
from fareflow.operators.observability import HIGH_LATENCY, LOW_THROUGHPUT

#: What a series' state returns. pandas has no null beside NaN, so ``known`` says whether there is an average.
JUDGED = "scale string, metric_name string, minute bigint, avg_value double, known boolean, alarm boolean"
MINUTE_MS = 60_000
#: What a heartbeat row carries as its metric.
HEARTBEAT = "__heartbeat"
#: Minutes of a series with data that a task holds in memory, minutes to a part of its file, and minutes returned at once.
HELD, PART, STRETCH = 500_000, 100_000, 10_000
CLOSED = np.dtype([("minute", "i8"), ("value", "f8"), ("known", "?")])


class ClosedMinutes:
    """Minutes added in any order and given back in order. Beyond ``HELD`` they go to a file, in parts by time;
    a part has ``PART`` minutes at most, as a minute comes once in a batch."""

    def __init__(self) -> None:
        self.held: list[np.ndarray] = []
        self.count = 0
        self.file = None
        self.parts: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def __enter__(self) -> ClosedMinutes:
        return self

    def __exit__(self, *error) -> None:
        if self.file is not None:
            self.file.close()

    def add(self, rows: pd.DataFrame) -> None:
        chunk = np.empty(len(rows), CLOSED)
        for name, column in zip(CLOSED.names, ("minute", "avg_value", "known")):
            chunk[name] = rows[column].to_numpy()
        self.held.append(chunk)
        self.count += len(chunk)
        if self.count >= HELD:
            self._spill()

    def in_order(self) -> Iterator[np.ndarray]:
        if self.file is None:
            if self.held:
                yield self._sorted(self.held)
            return
        self._spill()
        for part in sorted(self.parts):
            yield self._sorted([self._read(*piece) for piece in self.parts[part]])

    def _spill(self) -> None:
        if not self.held:
            return
        if self.file is None:
            # Where Spark spills too; the file has no name and goes with the task.
            self.file = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
        rows = self._sorted(self.held)
        part = rows["minute"] // PART
        for piece in np.split(rows, np.flatnonzero(np.diff(part)) + 1):
            self.parts[int(piece["minute"][0]) // PART].append((self.file.tell(), len(piece)))
            self.file.write(piece.tobytes())
        self.held, self.count = [], 0

    def _read(self, at: int, rows: int) -> np.ndarray:
        self.file.seek(at)
        return np.frombuffer(self.file.read(rows * CLOSED.itemsize), CLOSED)

    @staticmethod
    def _sorted(pieces: list[np.ndarray]) -> np.ndarray:
        rows = np.concatenate(pieces)
        return rows[np.argsort(rows["minute"], kind="stable")]


class Alarm(StatefulProcessor):
    """State per series: the last judged minute and how many minutes up to it breach in a row."""

    def __init__(self, alarms: dict[str, dict], forget_minutes: int | None) -> None:
        self.alarms, self.forget = alarms, forget_minutes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "minute bigint, run int, silent bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.seen.get()
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        last, run, silent = known if known else (None, 0, 0)
        with ClosedMinutes() as minutes:
            for chunk in rows:
                minutes.add(chunk)
            for closed in minutes.in_order():
                if last is not None:  # what was judged as missing before; the watermark drops such rows already
                    closed = closed[closed["minute"] > last]
                if len(closed):
                    first = int(closed["minute"][0]) if last is None else last + 1
                    last, silent = int(closed["minute"][-1]), 0
                    run = yield from self._judge(key, first, last, closed, run)
        if last is not None:
            self._keep(last, run, silent)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, run, silent = self.seen.get()
        closed = timerValues.getCurrentWatermarkInMs() // MINUTE_MS - 1
        until = closed if self.forget is None else min(closed, last + max(self.forget - silent, 0))
        if until > last:
            run = yield from self._judge(key, last + 1, until, np.empty(0, CLOSED), run)
            last, silent = until, silent + until - last
        if last < closed:
            self.seen.clear()
        else:
            self._keep(last, run, silent)

    def close(self) -> None:
        pass

    def _keep(self, last: int, run: int, silent: int) -> None:
        self.seen.update((last, run, silent))
        self.handle.registerTimer((last + 2) * MINUTE_MS)  # when the minute after the last one is over

    def _judge(self, key, first: int, last: int, closed: np.ndarray, run: int) -> Iterator[pd.DataFrame]:
        """Every minute from ``first`` to ``last``, with the ordered minutes of ``closed`` among them; gives back the run."""
        scale, metric = key
        alarm = self.alarms[metric]
        for start in range(first, last + 1, STRETCH):
            size = min(STRETCH, last + 1 - start)
            here = closed[slice(*np.searchsorted(closed["minute"], (start, start + size)))]
            value, known = np.full(size, np.nan), np.zeros(size, bool)
            value[here["minute"] - start], known[here["minute"] - start] = here["value"], here["known"]
            if "above" in alarm:
                outside = (value > alarm["above"]) | np.isnan(value)  # NaN is above all, as in SQL
            else:
                outside = value < alarm["below"]
            breach = np.where(known, outside, alarm["missing_breaches"])
            at = np.arange(size)
            fine = np.maximum.accumulate(np.where(breach, -1, at))  # the last minute so far that did not breach
            runs = np.minimum(np.where(fine < 0, run + at + 1, at - fine), alarm["periods"])
            run = int(runs[-1])
            yield pd.DataFrame({"scale": scale, "metric_name": metric, "minute": start + at, "avg_value": value,
                                "known": known, "alarm": runs == alarm["periods"]})
        return run


def alarm_stream(samples: DataFrame, alarms: tuple[dict, ...] = (HIGH_LATENCY, LOW_THROUGHPUT), delay: str = "1 minute",
                 forget_minutes: int | None = None) -> DataFrame:
    """State per minute of every series that an alarm watches, once the minute is over.

    ``samples`` has scale, metric_name, timestamp and value. The rows are those of
    ``observability.alarm_state`` up to the watermark. A series that stays silent for
    ``forget_minutes`` is forgotten; without it, it is judged for ever.
    """
    by_metric = {a["metric"]: a for a in alarms}
    # Naming the event time keeps the filter above the watermark: all rows move it.
    watched = F.col("metric_name").isin(*by_metric) & F.col("timestamp").isNotNull()
    minute = F.floor(F.unix_seconds("w.start") / F.lit(60)).cast("bigint")
    minutes = (samples.withWatermark("timestamp", delay).filter(watched)
               .groupBy("scale", "metric_name", F.window("timestamp", "60 seconds").alias("w"))
               .agg(exact_mean(F.col("value")).cast("double").alias("avg_value"))
               .select("scale", "metric_name", minute.alias("minute"), F.window_time("w").alias("closed"),
                       "avg_value", F.col("avg_value").isNotNull().alias("known")))
    judged = minutes.groupBy("scale", "metric_name").transformWithStateInPandas(
        Alarm(by_metric, forget_minutes), JUDGED, "Append", "EventTime")
    return judged.select("scale", "metric_name", F.timestamp_seconds(F.col("minute") * 60).alias("window_start"),
                         F.when(F.col("known"), F.coalesce("avg_value", F.lit(float("nan")))).alias("avg_value"),
                         F.when(F.col("alarm"), "ALARM").otherwise("OK").alias("state"))


def with_heartbeat(samples: DataFrame) -> DataFrame:
    """The samples and a row a second that only moves time on."""
    beat = samples.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    return samples.select("scale", "metric_name", "timestamp", "value").unionByName(beat.select(
        F.lit(None).cast("string").alias("scale"), F.lit(HEARTBEAT).alias("metric_name"), "timestamp",
        F.lit(None).cast("double").alias("value")))
