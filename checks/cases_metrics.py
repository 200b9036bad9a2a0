"""Lineage, pipeline metrics, alarms, reports and experiment analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import projections as p
from checks.cases_surge import hourly
from checks.registry import case, text
from fareflow.functions.places import infra_of, sla_flag
from fareflow.operators import experiments as ex
from fareflow.operators import lineage as ln
from fareflow.operators import observability as ob
from fareflow.operators import quantiles, reports, sketches, surge
from fareflow.session import shared_dir
from fareflow.sources import files
from fareflow.streaming import alarms, flows

STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
SERIES = ["experiment_name", "metric_name"]


def series(spark, sf, metric=None):
    rows = p.samples(spark, sf)
    return rows if metric is None else rows.filter(F.col("metric_name") == metric)


def experiment_summary_of(spark, sf):
    return ex.with_experiment_meta(ex.experiment_summary(p.samples(spark, sf)), p.meta(spark, sf))


# -- lineage -----------------------------------------------------------------

@case(""", s AS (SELECT * FROM lin WHERE kind = 'start'), e AS (SELECT * FROM lin WHERE kind = 'end')
SELECT s.batch_id, s.stage, s.input_source, e.output_sink, CAST(s.record_count AS BIGINT) AS record_count,
  strftime(s.at, '%Y-%m-%d %H:%M:%S.%f') AS started_at, strftime(e.at, '%Y-%m-%d %H:%M:%S.%f') AS completed_at,
  (epoch_us(e.at) - epoch_us(s.at)) // 1000 AS duration_ms, 2 AS schema_version, e.status, substr(e.error, 1, 500) AS error
FROM s JOIN e USING (batch_id)""")
def lineage_records(spark, sf):
    done = ln.lineage(p.lineage_events(spark, sf))
    return done.withColumn("started_at", text("started_at")).withColumn("completed_at", text("completed_at"))


@case("""SELECT stage, count(*) AS open_batches FROM lin s WHERE kind = 'start'
  AND NOT EXISTS (SELECT 1 FROM lin e WHERE e.kind = 'end' AND e.batch_id = s.batch_id) GROUP BY stage""")
def open_batches(spark, sf):
    return ln.open_batches(p.lineage_events(spark, sf))


# -- metrics -----------------------------------------------------------------

@case("""SELECT event_id, metric_name, CASE WHEN event_id % 6 = 4 THEN 0.0::DOUBLE ELSE value END AS value,
  CASE WHEN event_id % 6 = 0 THEN 'topic="a",city="' || city_id || '"' ELSE '' END AS labels
  FROM samples WHERE event_id % 6 IN (0, 1, 4) AND NOT (event_id % 6 = 1 AND k % 10 = 0)""")
def metrics_text_parse(spark, sf):
    """Lines with labels, plain, comment, blank, name only, unknown name; some
    numbers are not numbers."""
    n, name, value = F.col("event_id") % 6, F.col("metric_name"), F.col("value").cast("string")
    line = (F.when(n == 0, F.concat(name, F.lit('{topic="a",city="'), "city_id", F.lit('"} '), value, F.lit(" 17")))
            .when(n == 1, F.concat(F.lit("  "), name, F.lit(" "),
                                   F.when(F.col("k") % 10 == 0, "n/a").otherwise(value)))
            .when(n == 2, "# HELP something").when(n == 3, "   ").when(n == 4, name)
            .otherwise(F.concat(F.lit("other_metric "), value)))
    return ob.parse_metrics_text(p.samples(spark, sf).select("event_id", line.alias("value")))


@case("""SELECT 'S' || CAST(user_id % 3 AS VARCHAR) AS scale, metric_name,
  strftime(date_trunc('minute', timestamp), '%Y-%m-%d %H:%M:%S.%f') AS window_start,
  round(avg(value::DECIMAL(22,6)) + 1e-9, 4) AS avg_value, count(*) AS samples FROM samples GROUP BY ALL""")
def metric_rollup(spark, sf):
    rows = p.samples(spark, sf).withColumn("scale", F.concat(F.lit("S"), (F.col("user_id") % 3).cast("string")))
    return ob.metric_rollup(rows).withColumn("window_start", text("window_start")).withColumn(
        "avg_value", F.round("avg_value", 4))


def dense_rollup(spark, sf):
    return ob.metric_rollup(dense_samples(p.samples(spark, sf)))


def dense_samples(samples):
    """The samples put eight seconds apart, so minutes follow each other, with a
    throughput outage in every twelfth half hour."""
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("event_id") * 8)
    latency = F.col("metric_name").isin("spark_batch_latency_ms", "gps_events_sent_total")
    gap = F.floor(F.col("event_id") / 225) % 12 == 5
    return samples.filter(latency | ~gap).select(
        F.concat(F.lit("S"), (F.col("user_id") % 3).cast("string")).alias("scale"),
        F.when(latency, "AvgLatencyMs").otherwise("KafkaEventsPerSecond").alias("metric_name"),
        at.alias("timestamp"), F.when(latency, F.col("value") * 250).otherwise(F.col("value") / 3).alias("value"))


ALARM_SQL = """, r AS (SELECT 'S' || CAST(user_id % 3 AS VARCHAR) AS scale,
    CASE WHEN metric_name IN ('spark_batch_latency_ms', 'gps_events_sent_total') THEN 'AvgLatencyMs' ELSE 'KafkaEventsPerSecond' END AS m,
    (1704067200 + event_id * 8) // 60 AS minute, avg(CASE WHEN metric_name IN ('spark_batch_latency_ms', 'gps_events_sent_total')
      THEN value * 250 ELSE value / 3 END) AS v FROM samples
  WHERE metric_name IN ('spark_batch_latency_ms', 'gps_events_sent_total') OR (event_id // 225) % 12 <> 5 GROUP BY ALL),
 one AS (SELECT * FROM r WHERE m = '{m}'),
 spine AS (SELECT scale, unnest(range(min(minute), max(minute) + 1)) AS minute FROM one GROUP BY scale),
 f AS (SELECT spine.scale, spine.minute, coalesce({breach}, {missing}) AS breach FROM spine LEFT JOIN one
   ON spine.scale = one.scale AND spine.minute = one.minute)
SELECT scale, '{m}' AS metric_name, strftime(make_timestamp(minute * 60000000), '%Y-%m-%d %H:%M:%S.%f') AS window_start,
  CASE WHEN sum(CASE WHEN breach THEN 1 ELSE 0 END) OVER (PARTITION BY scale ORDER BY minute ROWS {back} PRECEDING) = {back} + 1
  THEN 'ALARM' ELSE 'OK' END AS state FROM f"""


def alarm_out(df):
    return df.select("scale", "metric_name", text("window_start"), "state")


@case(""", v AS (SELECT k % 4 AS g, CASE WHEN k % 4 = 1 AND k < 10 THEN 'nan'::DOUBLE WHEN k % 4 = 2 AND k < 10 THEN 'inf'::DOUBLE
    WHEN k % 4 = 3 THEN value * 1e-7 ELSE value END AS x FROM samples),
 a AS (SELECT g, count(*) AS samples, bool_or(isnan(x)) AS n, bool_or(isinf(x)) AS i, avg(x) FILTER (isfinite(x)) AS m FROM v GROUP BY g)
SELECT 'm' || g AS metric_name, samples, CASE WHEN n THEN 'nan' WHEN i THEN 'inf' ELSE 'finite' END AS kind,
  CASE WHEN NOT n AND NOT i THEN round(m * CASE WHEN g = 3 THEN 1e7 ELSE 1 END, 3) END AS mean FROM a""")
def rollup_special_values(spark, sf):
    """Means keep NaN, infinity and very small values."""
    g, value = F.col("k") % 4, F.col("value")
    x = (F.when((g == 1) & (F.col("k") < 10), F.lit(float("nan"))).when((g == 2) & (F.col("k") < 10), F.lit(float("inf")))
         .when(g == 3, value * 1e-7).otherwise(value))
    rows = p.samples(spark, sf).select("timestamp", F.lit("S").alias("scale"), F.concat(F.lit("m"), g.cast("string")).alias("metric_name"), x.alias("value"))
    mean = F.col("avg_value")
    kind = F.when(F.isnan(mean), "nan").when(mean == float("inf"), "inf").otherwise("finite")
    scaled = F.round(mean * F.when(F.col("metric_name") == "m3", 1e7).otherwise(1.0), 3)
    return ob.metric_rollup(rows, seconds=864_000_000).select("metric_name", "samples", kind.alias("kind"), F.when(kind == "finite", scaled).alias("mean"))


@case(ALARM_SQL.format(m="AvgLatencyMs", breach="v > 10000", missing="false", back=1))
def alarm_high_latency(spark, sf):
    return alarm_out(ob.high_latency_alarm(dense_rollup(spark, sf)))


@case(ALARM_SQL.format(m="KafkaEventsPerSecond", breach="v < 10", missing="true", back=2))
def alarm_low_throughput(spark, sf):
    return alarm_out(ob.low_throughput_alarm(dense_rollup(spark, sf)))


@case(ALARM_SQL.split(" one AS")[0] + """ e AS (SELECT ((1704067200 + max(event_id) * 8) - 60) // 60 - 1 AS hi FROM samples
    WHERE metric_name IN ('spark_batch_latency_ms', 'gps_events_sent_total') OR (event_id // 225) % 12 <> 5),
 spine AS (SELECT scale, m, unnest(range(min(minute), any_value(hi) + 1)) AS minute FROM r, e GROUP BY scale, m),
 f AS (SELECT spine.scale, spine.m, spine.minute, CASE WHEN spine.m = 'AvgLatencyMs' THEN coalesce(v > 10000, false) ELSE coalesce(v < 10, true) END AS breach,
   CASE WHEN spine.m = 'AvgLatencyMs' THEN 2 ELSE 3 END AS periods FROM spine LEFT JOIN r USING (scale, m, minute))
SELECT scale, m AS metric_name, strftime(make_timestamp(minute * 60000000), '%Y-%m-%d %H:%M:%S.%f') AS window_start,
  CASE WHEN sum(breach::INT) OVER (PARTITION BY scale, m ORDER BY minute ROWS 1 PRECEDING) = 2 AND (periods = 2
    OR sum(breach::INT) OVER (PARTITION BY scale, m ORDER BY minute ROWS 2 PRECEDING) = 3) THEN 'ALARM' ELSE 'OK' END AS state FROM f""")
def alarm_states_stream(spark, sf):
    """Both alarms judged as the minutes close, up to a minute before the newest sample."""
    out = shared_dir(spark, "alarm-stream")
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    states = alarms.alarm_stream(dense_samples(p.samples_of(p.events_view(raw))))
    flows.to_parquet(states, f"{out}/states", f"{out}/checkpoint").awaitTermination()
    return alarm_out(spark.read.parquet(f"{out}/states"))


PREV = """, q AS (SELECT *, lag(value) OVER w AS pv, lag(timestamp) OVER w AS pt FROM samples
  WINDOW w AS (PARTITION BY experiment_name, metric_name ORDER BY timestamp, event_id))"""


@case(PREV + """ SELECT event_id, round(CASE WHEN pv IS NOT NULL THEN (CASE WHEN value >= pv THEN value - pv ELSE value END)
  / ((epoch_us(timestamp) - epoch_us(pt)) / 1e6::DOUBLE) END + 1e-9, 6) AS rate FROM q""")
def counter_rate(spark, sf):
    rates = ob.counter_rate(series(spark, sf), SERIES, ties=["event_id"])
    return rates.select("event_id", F.round(F.col("rate") + 1e-9, 6).alias("rate"))


@case(PREV + """ SELECT experiment_name, metric_name, strftime(date_trunc('minute', timestamp), '%Y-%m-%d %H:%M:%S.%f') AS window_start,
  round(sum(CASE WHEN pv IS NULL THEN 0 WHEN value >= pv THEN value - pv ELSE value END) / 60.0::DOUBLE + 1e-9, 6) AS rate
  FROM q GROUP BY ALL""")
def counter_rate_per_minute(spark, sf):
    rates = ob.counter_rate_windowed(series(spark, sf), SERIES, ties=["event_id"])
    return rates.withColumn("window_start", text("window_start")).withColumn(
        "rate", F.round(F.col("rate") + 1e-9, 6))


@case("""SELECT event_id, round(avg(value) OVER (PARTITION BY experiment_name, metric_name ORDER BY timestamp, event_id
  ROWS 2 PRECEDING) + 1e-9, 4) AS rolling FROM samples""")
def rolling_latency(spark, sf):
    rows = ex.rolling_latency(series(spark, sf), SERIES, ties=["event_id"])
    return rows.select("event_id", F.round(F.col("rolling") + 1e-9, 4).alias("rolling"))


@case("""SELECT event_id, 10 * (row_number() OVER w - 1) AS elapsed_s,
  round((epoch_us(timestamp) - epoch_us(min(timestamp) OVER (PARTITION BY experiment_name, metric_name))) / 1e6::DOUBLE, 6) AS true_elapsed_s
  FROM samples WINDOW w AS (PARTITION BY experiment_name, metric_name ORDER BY timestamp, event_id)""")
def elapsed_axis(spark, sf):
    rows = ex.elapsed_axis(series(spark, sf), SERIES, ties=["event_id"])
    return rows.select("event_id", "elapsed_s", F.round("true_elapsed_s", 6).alias("true_elapsed_s"))


@case(""", s AS (SELECT DISTINCT city_id, epoch_us(timestamp) // 10000000 AS slot FROM samples),
 g AS (SELECT *, lag(slot) OVER (PARTITION BY city_id ORDER BY slot) AS prev FROM s)
SELECT city_id, strftime(make_timestamp((prev + 3) * 10000000), '%Y-%m-%d %H:%M:%S.%f') AS warned_at, slot - prev - 1 AS empty_scrapes,
  strftime(make_timestamp(slot * 10000000), '%Y-%m-%d %H:%M:%S.%f') AS resumed_at FROM g WHERE slot - prev - 1 >= 3""")
def no_data_streak(spark, sf):
    gaps = ob.no_data_streak(series(spark, sf), ["city_id"])
    return gaps.withColumn("warned_at", text("warned_at")).withColumn("resumed_at", text("resumed_at"))


@case(""", s AS (SELECT city_id, timestamp, event_id, CASE WHEN k < 55 THEN 0 ELSE value END AS eps FROM samples),
 i AS (SELECT *, coalesce(sum(CASE WHEN eps <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY city_id ORDER BY timestamp, event_id
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM s),
 o AS (SELECT city_id, run, min(timestamp) FILTER (eps = 0) AS d, min(timestamp) FILTER (eps <> 0) AS r, count(*) FILTER (eps = 0) AS z
   FROM i GROUP BY ALL)
SELECT city_id, strftime(d, '%Y-%m-%d %H:%M:%S.%f') AS detected_at, strftime(r, '%Y-%m-%d %H:%M:%S.%f') AS recovered_at,
  z AS zero_samples, round((epoch_us(r) - epoch_us(d)) / 1e6::DOUBLE, 6) AS downtime_s FROM o WHERE z > 0""")
def outage_intervals(spark, sf):
    rows = series(spark, sf).withColumn("eps", F.when(F.col("k") < 55, 0.0).otherwise(F.col("value")))
    runs = ob.outage_intervals(rows, ["city_id"], value="eps", ties=["event_id"])
    return (runs.withColumn("detected_at", text("detected_at")).withColumn("recovered_at", text("recovered_at"))
            .withColumn("downtime_s", F.round("downtime_s", 6)))


@case(""", s AS (SELECT *, sum(CAST(value AS DECIMAL(12,2)) - k) OVER w AS t FROM samples
    WINDOW w AS (PARTITION BY city_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING))
SELECT event_id, CAST(t - least(0, min(t) OVER (PARTITION BY city_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING)) AS DOUBLE)
  AS backlog FROM s""")
def backlog_growth(spark, sf):
    rows = series(spark, sf).withColumn("input_rate", F.col("value").cast("decimal(12,2)")).withColumn(
        "processed_rate", F.col("k").cast("decimal(12,2)"))
    out = ob.backlog_growth(rows, ["city_id"], ties=["event_id"])
    return out.select("event_id", F.col("backlog").cast("double").alias("backlog"))


@case("""SELECT city_id AS experiment_name, metric_name, count(*) AS n, sum(CAST(value AS DECIMAL(12,2)))::DOUBLE AS total,
  strftime(max(timestamp), '%Y-%m-%d %H:%M:%S.%f') AS last_at FROM samples GROUP BY ALL""")
def metrics_csv_roundtrip(spark, sf):
    """Written as metric CSV by experiment, read back, and joined as one set."""
    rows = p.samples(spark, sf).withColumn("timestamp", p.iso_text("timestamp")).withColumn(
        "experiment_name", F.col("city_id"))
    one, two = shared_dir(spark, "metrics-a"), shared_dir(spark, "metrics-b")
    hot = F.col("k") < 30
    files.write_metrics(rows.filter(hot), one)
    files.write_metrics(rows.filter(~hot), two)
    both = files.union_experiments([files.read_metrics(spark, one), files.read_metrics(spark, two)])
    return both.groupBy(*SERIES).agg(F.count("*").alias("n"),
                                     F.sum(F.col("value").cast("decimal(12,2)")).cast("double").alias("total"),
                                     F.max("timestamp").alias("last_at")).withColumn("last_at", text("last_at"))


@case("""SELECT city_id AS experiment, city_id NOT IN ('MUM', 'DEL') AS accepted, CASE city_id WHEN 'DEL' THEN 'missing columns: labels'
    WHEN 'MUM' THEN 'columns in another order: timestamp, experiment_name, source, value, metric_name, labels' END AS reason,
  CASE WHEN city_id NOT IN ('MUM', 'DEL') THEN count(*) ELSE 0 END AS rows_read FROM samples GROUP BY city_id""")
def metric_file_verdicts(spark, sf):
    """Two experiments whose files have wrong columns are listed with the reason, and not read."""
    root = shared_dir(spark, "metric-files")
    rows = p.samples(spark, sf).withColumn("timestamp", p.iso_text("timestamp")).withColumn("experiment_name", F.col("city_id"))
    columns = ["timestamp", "experiment_name", "source", "metric_name", "value", "labels"]
    shapes = [(~F.col("city_id").isin("MUM", "DEL"), columns), (F.col("city_id") == "DEL", columns[:-1]),
              (F.col("city_id") == "MUM", [*columns[:3], "value", "metric_name", "labels"])]
    for which, names in shapes:
        (rows.filter(which).select(F.col("city_id").alias("experiment"), *names).write.mode("append").partitionBy("experiment")
         .option("header", True).csv(root))
    found = files.metric_files(spark, root).select(F.regexp_extract("file", "experiment=([A-Z]+)", 1).alias("experiment"), "accepted", "reason").distinct()
    read = files.read_metrics(spark, root).groupBy("experiment_name").agg(F.count("*").alias("n"))
    return found.join(read, F.col("experiment") == F.col("experiment_name"), "left").select(
        "experiment", "accepted", "reason", F.coalesce("n", F.lit(0)).alias("rows_read"))


@case("""SELECT event_id, CASE WHEN value * 100 < 5000 THEN 'PASS' ELSE 'FAIL' END AS sla_5s,
  CASE WHEN value * 1000 < 60000 THEN 'PASS' ELSE 'FAIL' END AS sla_60s,
  CASE user_id % 3 WHEN 0 THEN 'local' WHEN 1 THEN 'ec2' ELSE 'emr' END AS infra FROM samples""")
def sla_flags(spark, sf):
    return p.samples(spark, sf).select("event_id", sla_flag(F.col("value") * 100).alias("sla_5s"),
                                       sla_flag(F.col("value") * 1000, 60000).alias("sla_60s"),
                                       infra_of(F.col("experiment_name")).alias("infra"))


@case("""SELECT experiment_name, count(*) FILTER (value * 100 < 5000) AS passed, count(*) FILTER (value * 100 >= 5000) AS failed,
  round(max(value * 100) + 1e-9, 2) AS worst_ms FROM samples GROUP BY ALL""")
def sla_check(spark, sf):
    return ob.sla_check(p.samples(spark, sf).withColumn("latency", F.col("value") * 100), ["experiment_name"],
                        "latency")


# -- percentiles and reports -------------------------------------------------

def latencies(spark, sf):
    return p.samples(spark, sf).select("experiment_name", F.col("value").alias("processing_latency_ms"))


def interpolated(point: str) -> str:
    """SQL for the value at a point of the sorted list ``v``."""
    at = f"((len(v) - 1) * {point}::DOUBLE)"
    low, high = f"v[1 + CAST(floor{at} AS INT)]", f"v[1 + CAST(ceil{at} AS INT)]"
    return f"round({low} + ({high} - {low}) * ({at} - floor{at}), 0)"


@case(f""", g AS (SELECT experiment_name, list_sort(list(value)) AS v, avg(value::DECIMAL(22,6)) AS m FROM samples GROUP BY experiment_name)
SELECT experiment_name, round(m + 1e-9, 0) AS avg_ms, {interpolated('0.5')} AS p50_ms, {interpolated('0.95')} AS p95_ms,
  {interpolated('0.99')} AS p99_ms, len(v) AS sample_count FROM g""")
def latency_percentiles_exact(spark, sf):
    return reports.latency_percentiles(latencies(spark, sf), exact=True)


@case()
def latency_percentiles_approx(spark, sf):
    """Sketches differ between engines, so no SQL."""
    return reports.latency_percentiles(latencies(spark, sf))


@case("""SELECT city_id, count(*) AS n, true AS p50_ms_within, true AS p95_ms_within, true AS p99_ms_within
FROM samples GROUP BY city_id""")
def latency_sketches(spark, sf):
    """Percentiles per city from stored daily sketches, against the true ranks of all rows."""
    root, rows = shared_dir(spark, "sketches"), p.samples(spark, sf)
    sketches.write_sketches(sketches.daily_sketches(rows, ["city_id"], "value", "timestamp"), root)
    found = sketches.percentiles(sketches.merged(spark, root, ["city_id"]), reports.POINTS)
    return sketches.within_rank_error(rows, found, ["city_id"], "value", reports.POINTS, sketches.rank_error(sure=2))


@case(""", g AS (SELECT city_id, list_sort(list(value)) AS v FROM samples GROUP BY city_id)
SELECT city_id, v[1 + least(CAST(floor(len(v) * 0.5::DOUBLE) AS INT), len(v) - 1)] AS p50,
  v[1 + least(CAST(floor(len(v) * 0.95::DOUBLE) AS INT), len(v) - 1)] AS p95,
  v[1 + least(CAST(floor(len(v) * 0.99::DOUBLE) AS INT), len(v) - 1)] AS p99 FROM g""")
def latency_nearest_rank(spark, sf):
    return quantiles.exact_quantiles(p.samples(spark, sf), ["city_id"], "value",
                                     {"p50": 0.5, "p95": 0.95, "p99": 0.99}, method="nearest")


def zone_summary(spark, sf):
    zones = surge.with_surge(hourly(spark, sf))
    return zones.withColumn("demand_ratio", F.col("demand_ratio").cast("decimal(18,4)")).withColumn(
        "total_count", F.col("total_events"))


@case("""SELECT city_id, zone_id, count(*) AS surge_events, round(avg(demand_ratio::DECIMAL(18,4)) + 1e-9, 2) AS avg_demand,
  round(max(demand_ratio) + 1e-9, 2) AS peak_demand FROM zw WHERE surge_multiplier >= 2 GROUP BY ALL
  ORDER BY surge_events DESC, city_id, zone_id LIMIT 20""")
def top_surge_zones(spark, sf):
    return reports.top_surge_zones(zone_summary(spark, sf))


@case("""SELECT city_id, count(*) AS total_trips, round(avg(on_trip_count * 1.0::DOUBLE / nullif(total_events, 0)) + 1e-9, 3) AS avg_utilization,
  count(*) FILTER (surge_multiplier >= 2) AS surge_periods, round(avg(demand_ratio::DECIMAL(18,4)) + 1e-9, 3) AS avg_demand
  FROM zw GROUP BY city_id""")
def city_utilisation(spark, sf):
    return reports.city_utilisation(zone_summary(spark, sf))


@case("""SELECT city_id, count(*) AS zone_periods, round(avg(demand_ratio::DECIMAL(18,4)) + 1e-9, 4) AS avg_demand
  FROM zw GROUP BY city_id""")
def city_demand(spark, sf):
    return reports.city_demand_summary(zone_summary(spark, sf))


@case(""", c AS (SELECT experiment_name, min(user_id) AS u, 0.25::DOUBLE * min(user_id) AS cost,
    CASE WHEN min(user_id) % 4 = 0 THEN 0 ELSE sum(CAST(floor(value) AS BIGINT)) * 1000003 END AS bytes FROM samples GROUP BY experiment_name)
SELECT experiment_name, CASE u % 3 WHEN 0 THEN 'local' WHEN 1 THEN 'ec2' ELSE 'emr' END AS infrastructure,
  round(cost + 1e-9, 4) AS total_cost, round(bytes / 1073741824.0::DOUBLE + 1e-9, 3) AS gb_processed,
  round(cost / nullif(bytes / 1073741824.0::DOUBLE, 0) + 1e-9, 4) AS cost_per_gb FROM c""")
def cost_per_gb(spark, sf):
    user = F.min("user_id")
    costs = p.samples(spark, sf).groupBy("experiment_name").agg(
        (F.lit(0.25) * user).alias("total_cost_usd"),
        F.when(user % 4 == 0, 0).otherwise(F.sum(F.floor("value").cast("bigint")) * 1000003)
        .alias("total_bytes_processed")).withColumn("infrastructure", infra_of(F.col("experiment_name")))
    return reports.cost_per_gb_report(costs)


# -- experiments -------------------------------------------------------------

@case("""SELECT experiment_name, avg_eps, p50_lat, p95_lat, p99_lat, max_surge, infra, CAST(drivers AS BIGINT) AS drivers,
  window_s, cost_hr FROM summary""")
def experiment_summary(spark, sf):
    return experiment_summary_of(spark, sf)


@case("""SELECT experiment_name, CASE WHEN cost_hr > 0 THEN round(avg_eps / cost_hr + 1e-9, 1) END AS eps_per_dollar FROM summary""")
def eps_per_dollar(spark, sf):
    return ex.with_cost_efficiency(experiment_summary_of(spark, sf)).select("experiment_name", "eps_per_dollar")


@case(""", c AS (SELECT event_type, corr(value, k) AS r, count(*) AS n FROM ev GROUP BY event_type),
 i AS (SELECT c.*, x.i, abs(r) + (1 - abs(r)) * x.i / 20000.0::DOUBLE AS s1, x.i / 20000.0::DOUBLE AS s0,
   CASE WHEN x.i IN (0, 20000) THEN 1 WHEN x.i % 2 = 1 THEN 4 ELSE 2 END AS wt FROM c, range(20001) AS x(i)),
 a AS (SELECT event_type, any_value(r) AS r, any_value(n) AS n, any_value(1 - abs(r)) * sum(wt * pow(greatest(1 - s1 * s1, 0), (n - 4) / 2.0::DOUBLE)) AS tail,
   sum(wt * pow(greatest(1 - s0 * s0, 0), (n - 4) / 2.0::DOUBLE)) AS whole FROM i GROUP BY event_type)
SELECT event_type, round(r + 1e-9, 6) AS r, n, round(tail / whole + 1e-9, 5) AS p_value, tail / whole < 0.05 AS significant FROM a""")
def pearson(spark, sf):
    out = ex.pearson(p.ev(spark, sf), "value", "k", ["event_type"])
    return out.withColumn("r", F.round(F.col("r") + 1e-9, 6)).withColumn(
        "p_value", F.round(F.col("p_value") + 1e-9, 5))


@case("""SELECT max(p50_lat) FILTER (experiment_name = 'ec2_1') AS base_ms, max(p50_lat) FILTER (experiment_name = 'local_3') AS optimised_ms,
  round((1 - max(p50_lat) FILTER (experiment_name = 'local_3') / max(p50_lat) FILTER (experiment_name = 'ec2_1')) * 100 + 1e-9, 1) AS reduction_pct
  FROM summary""")
def latency_reduction(spark, sf):
    return ex.latency_reduction(experiment_summary_of(spark, sf), "ec2_1", "local_3")


@case(""", s AS (SELECT *, lag(avg_eps) OVER w AS pe, lag(drivers) OVER w AS pd FROM summary
    WINDOW w AS (PARTITION BY infra ORDER BY drivers, avg_eps))
SELECT infra, CAST(drivers AS BIGINT) AS drivers, avg_eps, CAST(pd AS BIGINT) AS from_drivers,
  round((avg_eps / nullif(pe, 0)) / nullif(drivers / nullif(pd, 0)::DOUBLE, 0) * 100 + 1e-9, 0) AS efficiency_pct
  FROM s WHERE pd IS NOT NULL""")
def scaling_efficiency(spark, sf):
    return ex.scaling_efficiency(experiment_summary_of(spark, sf))


@case(""", w AS (SELECT city_id, 1 + k % 7 AS window_s, round(avg(value::DECIMAL(22,6)) + 1e-9, 2) AS ms FROM samples GROUP BY ALL)
SELECT city_id, arg_min(ms, window_s) AS smallest_window_ms, arg_max(ms, window_s) AS largest_window_ms, count(*) AS points,
  round((1 - arg_min(ms, window_s) / arg_max(ms, window_s)) * 100 + 1e-9, 0) AS reduction_pct FROM w GROUP BY city_id""")
def reduction_vs_baseline(spark, sf):
    from fareflow.functions.numeric import exact_mean, rounded
    points = p.samples(spark, sf).groupBy("city_id", (1 + F.col("k") % 7).alias("window_s")).agg(
        rounded(exact_mean(F.col("value")), 2).alias("latency_ms"))
    return ex.reduction_vs_baseline(points, "city_id")


@case(""", pts AS (SELECT event_id, k, value, 100 - k + value / 7 AS y FROM ev),
 best AS (SELECT value, min(y) AS y FROM pts GROUP BY value),
 run AS (SELECT *, min(y) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM best)
SELECT event_id, k, pts.value FROM pts JOIN run ON pts.value = run.value AND pts.y = run.y AND (before IS NULL OR run.y < before)""")
def pareto_frontier(spark, sf):
    points = p.ev(spark, sf).withColumn("y", F.lit(100) - F.col("k") + F.col("value") / 7)
    return ex.pareto_frontier(points, "value", "y").select("event_id", "k", "value")


@case("""SELECT experiment_name,
  coalesce(round((avg_eps - min(avg_eps) OVER ()) / nullif(max(avg_eps) OVER () - min(avg_eps) OVER (), 0) + 1e-9, 6), 0.5) AS avg_eps_score,
  coalesce(round(1 - (p95_lat - min(p95_lat) OVER ()) / nullif(max(p95_lat) OVER () - min(p95_lat) OVER (), 0) + 1e-9, 6), 0.5) AS p95_lat_score,
  coalesce(round(1 - (cost_hr - min(cost_hr) OVER ()) / nullif(max(cost_hr) OVER () - min(cost_hr) OVER (), 0) + 1e-9, 6), 0.5) AS cost_hr_score,
  coalesce(round((drivers - min(drivers) OVER ()) / nullif(max(drivers) OVER () - min(drivers) OVER (), 0)::DOUBLE + 1e-9, 6), 0.5) AS drivers_score
  FROM summary""")
def minmax_scores(spark, sf):
    scored = ex.minmax_scores(experiment_summary_of(spark, sf))
    return scored.select("experiment_name", *[F.round(F.col(c) + 1e-9, 6).alias(c) for c in (
        "avg_eps_score", "p95_lat_score", "cost_hr_score", "drivers_score")])


@case(""", f AS (SELECT user_id, arg_min(CAST(floor(epoch(ts)) AS BIGINT), event_id) FILTER (event_type = 'click') AS inject_ts,
    arg_min(CAST(floor(epoch(ts)) AS BIGINT), event_id) FILTER (event_type = 'view') AS recovery_start,
    arg_min(CAST(floor(epoch(ts)) AS BIGINT), event_id) FILTER (event_type = 'purchase') AS recovery_end FROM ev GROUP BY user_id)
SELECT *, recovery_end - recovery_start AS recovery_s FROM f""")
def fault_recovery(spark, sf):
    name = (F.when(F.col("event_type") == "click", "FAULT_INJECT")
            .when(F.col("event_type") == "view", "RECOVERY_START")
            .when(F.col("event_type") == "purchase", "RECOVERY_COMPLETE_OK").otherwise("NOTE"))
    log = p.ev(spark, sf).select("user_id", "event_id", name.alias("event"), F.unix_seconds("ts").alias("ts"))
    return ex.pair_fault_events(log, "user_id", "event_id")


@case(""", c AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) * 731 AS drivers, 2.0::DOUBLE + user_id % 16 AS ram_gb FROM ev GROUP BY ALL),
 w AS (SELECT *, greatest(2, CAST(ceil(drivers / 1000.0) AS BIGINT)) AS w0, ram_gb * 50000 * 0.6::DOUBLE AS lim FROM c)
SELECT user_id, CAST(day AS VARCHAR) AS day, drivers,
  CAST(CASE WHEN drivers * 10 * w0 > lim THEN greatest(2, CAST(floor(lim / (drivers * 10)) AS BIGINT)) ELSE w0 END AS INTEGER) AS window_seconds,
  CAST(greatest(4, least(drivers // 500, 200)) AS INTEGER) AS parallelism,
  CAST(greatest(500, least(drivers * 2, 5000)) AS INTEGER) AS max_rate_per_partition FROM w""")
def adaptive_config(spark, sf):
    """One configuration per user and day, sized by the day's events."""
    configs = p.ev(spark, sf).groupBy("user_id", F.to_date("ts").cast("string").alias("day")).agg(
        (F.count("*") * 731).alias("drivers"))
    configs = configs.withColumn("ram_gb", F.lit(2.0) + F.col("user_id") % 16)
    return ex.adaptive_config(configs).drop("ram_gb")
