"""Pipeline metrics: parsing, rollups, rates, alarms, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.functions.numeric import exact_mean, rounded
from fareflow.operators.keys import join_on_keys
from fareflow.operators.ordered import (BLOCK, SERIES, before, carry, in_block, over_neighbours, up_to_row,
                                        with_block, with_index)

# Metrics kept, and the two alarms.
METRICS_KEPT = ("spark_batch_latency_ms", "spark_kafka_events_per_second", "spark_active_surge_zones",
                "spark_events_processed_total", "gps_events_sent_total", "active_drivers_count",
                "events_per_minute")
HIGH_LATENCY = {"metric": "AvgLatencyMs", "above": 10000.0, "periods": 2, "missing_breaches": False}
LOW_THROUGHPUT = {"metric": "KafkaEventsPerSecond", "below": 10.0, "periods": 3, "missing_breaches": True}

DAY_MINUTES = 1440


def parse_metrics_text(lines: DataFrame, text: str = "value", kept: tuple[str, ...] | None = METRICS_KEPT
                       ) -> DataFrame:
    """Exposition-format lines to (metric_name, value, labels).

    Blank lines, comments and lines without a number are dropped. A name with no
    value counts as 0. Other columns of the input are kept.
    """
    line = F.trim(F.col(text))
    labelled = line.contains("{")
    name = F.when(labelled, F.substring_index(line, "{", 1)).otherwise(F.regexp_extract(line, r"^(\S+)", 1))
    labels = F.when(labelled, F.regexp_extract(line, r"^[^{]*\{([^}]*)\}", 1)).otherwise(F.lit(""))
    value = (F.when(labelled, F.regexp_extract(line, r"^[^{]*\{[^}]*\}\s*(\S+)", 1))
             .when(line.rlike(r"^\S+$"), F.lit("0"))
             .otherwise(F.regexp_extract(line, r"^\S+\s+(\S+)", 1)))
    parsed = lines.filter((line != "") & ~line.startswith("#")).select(
        *[F.col(c) for c in lines.columns if c != text],
        F.trim(name).alias("metric_name"), value.try_cast("double").alias("value"),
        F.trim(labels).alias("labels")).filter(F.col("value").isNotNull())
    return parsed if kept is None else parsed.filter(F.col("metric_name").isin(*kept))


def metric_rollup(samples: DataFrame, seconds: int = 60, keys: tuple[str, ...] = ("scale", "metric_name"),
                  ts: str = "timestamp", value: str = "value") -> DataFrame:
    """Average per metric and scale in tumbling windows."""
    return (samples.groupBy(*keys, F.window(ts, f"{seconds} seconds").alias("w"))
            .agg(exact_mean(F.col(value)).cast("double").alias("avg_value"), F.count(value).alias("samples"))
            .select(*keys, F.col("w.start").alias("window_start"), "avg_value", "samples"))


def alarm_state(rollup: DataFrame, metric: str, periods: int, missing_breaches: bool,
                above: float | None = None, below: float | None = None, until: Column | None = None) -> DataFrame:
    """ALARM where the last ``periods`` minutes all breach, for every minute from
    a scale's first to its last one, or to ``until`` if that is later: a scale that
    stopped reporting is then judged too. Minutes without data breach or not as told.

    The minute spine grows with time only; it is built day by day, and the
    look-back crosses at most ``periods - 1`` minutes between parts.
    """
    minute = F.floor(F.unix_seconds("window_start") / F.lit(60)).cast("bigint")
    seen = rollup.filter(F.col("metric_name") == metric).select(
        "scale", minute.alias("minute"), "avg_value")
    last = F.max("minute")
    if until is not None:
        last = F.greatest(last, F.floor(F.unix_seconds(until) / F.lit(60)).cast("bigint"))
    days = seen.groupBy("scale").agg(F.min("minute").alias("lo"), last.alias("hi")).select(
        "scale", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / DAY_MINUTES),
                                                  F.floor(F.col("hi") / DAY_MINUTES))).alias("day"))
    spine = days.repartition("scale", "day").select("scale", F.explode(F.sequence(
        F.greatest("lo", F.col("day") * DAY_MINUTES),
        F.least("hi", F.col("day") * DAY_MINUTES + DAY_MINUTES - 1))).alias("minute"))
    filled = join_on_keys(spine, seen, ["scale", "minute"], "left")
    value = F.col("avg_value")
    outside = value > above if above is not None else value < below
    breach = F.coalesce(outside, F.lit(missing_breaches)).cast("int")
    marked = over_neighbours(
        filled.withColumn("__breach", breach), ["scale"], "minute", periods - 1,
        {"__all": lambda w: F.min("__breach").over(w.rowsBetween(-(periods - 1), 0)),
         "__rows": lambda w: F.count("*").over(w.rowsBetween(-(periods - 1), 0))}, size=DAY_MINUTES)
    alarm = (F.col("__all") == 1) & (F.col("__rows") == periods)
    return marked.select("scale", F.lit(metric).alias("metric_name"),
                         F.timestamp_seconds(F.col("minute") * 60).alias("window_start"), "avg_value",
                         F.when(alarm, "ALARM").otherwise("OK").alias("state"))


def high_latency_alarm(rollup: DataFrame, until: Column | None = None) -> DataFrame:
    return alarm_state(rollup, HIGH_LATENCY["metric"], HIGH_LATENCY["periods"],
                       HIGH_LATENCY["missing_breaches"], above=HIGH_LATENCY["above"], until=until)


def low_throughput_alarm(rollup: DataFrame, until: Column | None = None) -> DataFrame:
    return alarm_state(rollup, LOW_THROUGHPUT["metric"], LOW_THROUGHPUT["periods"],
                       LOW_THROUGHPUT["missing_breaches"], below=LOW_THROUGHPUT["below"], until=until)


def counter_rate(samples: DataFrame, keys: list[str], ts: str = "timestamp", value: str = "value",
                 ties: list | None = None) -> DataFrame:
    """Increase per second since the previous sample; a drop is a restart from 0."""
    indexed = with_index(samples, keys, ts, ties)
    prev = over_neighbours(indexed, keys, "idx", 1, {
        "__prev": lambda w: F.lag(value).over(w), "__prev_ts": lambda w: F.lag(ts).over(w)})
    gain = F.when(F.col(value) >= F.col("__prev"), F.col(value) - F.col("__prev")).otherwise(F.col(value))
    seconds = (F.unix_micros(ts) - F.unix_micros("__prev_ts")) / F.lit(1e6)
    return prev.withColumn("rate", F.when(F.col("__prev").isNotNull(), F.try_divide(gain, seconds))).drop(
        "__prev", "__prev_ts")


def counter_rate_windowed(samples: DataFrame, keys: list[str], seconds: int = 60, ts: str = "timestamp",
                          value: str = "value", ties: list | None = None) -> DataFrame:
    """Per-second increase of a counter in each window of ``seconds``."""
    indexed = with_index(samples, keys, ts, ties)
    prev = over_neighbours(indexed, keys, "idx", 1, {"__prev": lambda w: F.lag(value).over(w)})
    gain = F.when(F.col("__prev").isNull(), F.lit(0.0)).when(
        F.col(value) >= F.col("__prev"), F.col(value) - F.col("__prev")).otherwise(F.col(value))
    return (prev.groupBy(*keys, F.window(ts, f"{seconds} seconds").alias("w"))
            .agg((F.sum(gain) / F.lit(float(seconds))).alias("rate"))
            .select(*keys, F.col("w.start").alias("window_start"), "rate"))


def no_data_streak(samples: DataFrame, keys: list[str], interval_seconds: int = 10, streak: int = 3,
                   ts: str = "timestamp", since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Runs of at least ``streak`` scrapes without data between two with data; with
    ``since`` also before a series' first, with ``until`` also after its last, where
    ``resumed_at`` is null.

    Works on the slots that do have data and looks at the gap to the one before,
    so the empty scrapes are never spelled out.
    """
    slot_of = lambda t: F.floor(F.unix_micros(t) / F.lit(interval_seconds * 1_000_000)).cast("bigint")
    slot = slot_of(F.col(ts))
    slots = samples.groupBy(*keys, slot.alias("slot")).agg(F.min(ts).alias("__at"))
    rows = carry(with_block(slots, keys, "__at"), {"__hi": F.max("slot")},
                 {"__earlier": F.max("__hi").over(before())})
    gaps = rows.withColumn("__prev", F.coalesce(F.lag("slot").over(in_block(["slot"])), F.col("__earlier"),
                                                 F.lit(None) if since is None else slot_of(since) - 1))
    empty = F.col("slot") - F.col("__prev") - 1
    at = lambda s: F.timestamp_seconds(s * interval_seconds)
    closed = gaps.filter(empty >= streak).select(
        *keys, at(F.col("__prev") + streak).alias("warned_at"), empty.alias("empty_scrapes"),
        at(F.col("slot")).alias("resumed_at"))
    if until is None:
        return closed
    rest = slot_of(until) - F.col("last")
    still = slots.groupBy(*keys).agg(F.max("slot").alias("last")).filter(rest >= streak).select(
        *keys, at(F.col("last") + streak).alias("warned_at"), rest.alias("empty_scrapes"),
        F.lit(None).cast("timestamp").alias("resumed_at"))
    return closed.unionByName(still)


def outage_intervals(samples: DataFrame, keys: list[str], ts: str = "timestamp", value: str = "value",
                     ties: list | None = None) -> DataFrame:
    """Runs of zero throughput: first zero, first non-zero after it, seconds down.

    A run and the sample that ends it share the position of the last live sample
    before them. Recovery is null while an outage lasts. The value ends the order,
    so rows that stay tied are alike and their positions do not matter.
    """
    order = [F.col(ts), *(ties or []), F.col(value)]
    live = F.col(value) != 0
    blocked = with_block(samples.filter(F.col(value).isNotNull()), keys, ts)
    start = F.coalesce(F.sum("__n").over(before()), F.lit(0))
    rows = carry(blocked, {"__n": F.count("*")}, {"__start": start})
    rows = rows.withColumn("__idx", F.col("__start") + F.row_number().over(in_block(order)))
    rows = carry(rows, {"__hi": F.max(F.when(live, F.col("__idx")))},
                 {"__earlier": F.max("__hi").over(before())})
    strictly = in_block(order).rowsBetween(Window.unboundedPreceding, -1)
    last_live = F.coalesce(F.max(F.when(live, F.col("__idx"))).over(strictly), F.col("__earlier"), F.lit(0))
    runs = rows.withColumn("__run", last_live).groupBy(*keys, "__run").agg(
        F.min(F.when(~live, F.col(ts))).alias("detected_at"),
        F.min(F.when(live, F.col(ts))).alias("recovered_at"),
        F.count(F.when(~live, 1)).alias("zero_samples"))
    down = (F.unix_micros("recovered_at") - F.unix_micros("detected_at")) / F.lit(1e6)
    return runs.filter(F.col("zero_samples") > 0).drop("__run").withColumn("downtime_s", down)


def backlog_growth(samples: DataFrame, keys: list[str], ts: str = "timestamp", incoming: str = "input_rate",
                   processed: str = "processed_rate", ties: list | None = None) -> DataFrame:
    """Running surplus of input over processing, never below an empty queue.

    With S the running sum, the backlog is S minus the lowest S so far (at most
    0). Both carry over block borders, so no series is sorted whole.
    """
    order = [F.col(ts), *(ties or [])]
    change = F.coalesce(F.col(incoming), F.lit(0)) - F.coalesce(F.col(processed), F.lit(0))
    w = up_to_row(order)
    rows = carry(with_block(samples.withColumn("__d", change), keys, ts), {"__sum": F.sum("__d")},
                 {"__base": F.coalesce(F.sum("__sum").over(before()), F.lit(0))})
    rows = rows.withColumn("__s", F.col("__base") + F.sum("__d").over(w))
    rows = carry(rows, {"__min": F.min("__s")}, {"__low": F.min("__min").over(before())})
    floor = F.least(F.lit(0), F.coalesce(F.col("__low"), F.lit(0)), F.min("__s").over(w))
    return rows.withColumn("backlog", F.col("__s") - floor).drop("__d", "__base", "__s", "__low", SERIES, BLOCK)


def sla_check(samples: DataFrame, keys: list[str], latency: str, limit_ms: float = 5000) -> DataFrame:
    """Samples within and beyond the limit per key."""
    ok = F.col(latency) < limit_ms
    return samples.groupBy(*keys).agg(F.count(F.when(ok, 1)).alias("passed"),
                                      F.count(F.when(~ok | F.col(latency).isNull(), 1)).alias("failed"),
                                      rounded(F.max(latency), 2).alias("worst_ms"))
