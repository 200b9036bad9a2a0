"""The given ``events`` table read as trips, positions, metrics and so on.

Every projection keeps all rows and exists twice: as a DataFrame and as the SQL
of the oracle. ``ev`` is the common base with the number in ``props`` as ``k``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.functions.pricing import final_fare
from fareflow.session import prepare

# The cities, in order.
CITIES = ("MUM", "DEL", "BLR", "HYD", "CHN", "PUN", "KOL", "AMD", "JAI", "SRT")


def ev(spark: SparkSession, sf: str) -> DataFrame:
    raw = prepare(spark).read.parquet(f"{sf}/events.parquet")
    return events_view(raw)


def events_view(raw: DataFrame) -> DataFrame:
    return raw.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value",
                      F.get_json_object("props", "$.k").cast("int").alias("k"),
                      F.element_at(F.array(*map(F.lit, CITIES)), (F.col("user_id") % 10 + 1).cast("int")).alias("city_id"))


def zone() -> Column:
    return F.concat("city_id", F.lit("_Z"), F.lpad((1 + F.col("k") % 20).cast("string"), 2, "0"))


def driver() -> Column:
    return F.concat(F.lit("DRV_"), F.lpad(F.col("user_id").cast("string"), 6, "0"))


def one_of(number, *texts) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in texts]), (number % len(texts) + 1).cast("int"))


def trips(spark: SparkSession, sf: str) -> DataFrame:
    base = F.col("value").cast("decimal(12,2)")
    surge = (F.lit(1.0) + F.lit(0.5) * (F.col("event_id") % 4)).cast("decimal(4,2)")
    cancelled = F.col("event_type") == "error"
    return ev(spark, sf).select(
        F.col("event_id").cast("string").alias("trip_id"), driver().alias("driver_id"),
        F.concat(F.lit("RDR_"), (F.col("event_id") % 9000).cast("string")).alias("rider_id"), "city_id",
        zone().alias("pickup_zone"),
        F.concat("city_id", F.lit("_Z"), F.lpad((1 + F.col("k") % 7).cast("string"), 2, "0"))
        .alias("dropoff_zone"),
        one_of(F.col("event_id"), "auto", "cab", "bike").alias("ride_type"),
        F.col("ts").alias("start_time"),
        F.timestamp_add("MINUTE", 10 + F.col("k") % 36, F.col("ts")).alias("end_time"),
        (10 + F.col("k") % 36).cast("int").alias("duration_min"),
        F.round(base * F.lit("0.1").cast("decimal(2,1)"), 2).cast("decimal(10,2)").alias("distance_km"),
        base.alias("base_fare_inr"), surge.alias("surge_multiplier"),
        final_fare(base, surge).cast("decimal(12,2)").alias("final_fare_inr"),
        ((35 + F.col("k") % 16) * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(3,1)").alias("driver_rating"),
        ((35 + F.col("k") % 11) * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(3,1)").alias("rider_rating"),
        one_of(F.col("event_id"), "UPI", "Card", "Cash", "Wallet").alias("payment_method"),
        F.when(cancelled, "cancelled").otherwise("completed").alias("status"),
        F.when(cancelled & (F.col("k") % 2 == 0), "wait_long").alias("cancellation_reason"),
        F.to_date("ts").alias("date"))


def iso_text(ts: str) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def pings_of(base: DataFrame, few_zones: bool = False) -> DataFrame:
    status = (F.when(F.col("event_type").isin("click", "purchase"), "on_trip")
              .when(F.col("event_type").isin("view", "signup"), "available").otherwise("offline"))
    where = F.concat(F.lit("Z"), (F.col("user_id") % 10).cast("string")) if few_zones else zone()
    return base.select(
        F.concat(F.lit("EVT_"), F.col("event_id").cast("string")).alias("event_id"),
        driver().alias("driver_id"), "city_id", where.alias("zone_id"), iso_text("ts").alias("timestamp"),
        (F.col("k") / F.lit(4.0) - F.lit(12.0)).alias("lat"),
        (F.col("value") / F.lit(2.0) - F.lit(20.0)).alias("lng"),
        F.floor("value").cast("int").alias("speed_kmh"), status.alias("status"),
        F.col("k").alias("battery_pct"), (F.col("k") / F.lit(25.0)).alias("zone_demand_ratio"),
        F.lit(None).cast("string").alias("event_timestamp"), F.col("ts").alias("kafka_ts"))


def pings(spark: SparkSession, sf: str, few_zones: bool = False) -> DataFrame:
    return pings_of(ev(spark, sf), few_zones)


def envelope_of(positions: DataFrame) -> DataFrame:
    """Broker records. By event number some are damaged: not JSON, a number as
    text, a fraction for a whole number, or without zone and status."""
    n = F.substring("event_id", 5, 20).cast("bigint") % 50
    fields = [c for c in positions.columns if c != "kafka_ts"]
    good = F.to_json(F.struct(*fields))
    no_key = F.to_json(F.struct(*[c for c in fields if c not in ("zone_id", "status")]))
    value = (F.when(n == 0, "not json").when(n == 1, F.regexp_replace(good, r'"speed_kmh":\d+', '"speed_kmh":"7"'))
             .when(n == 2, F.regexp_replace(good, r'"speed_kmh":\d+', '"speed_kmh":3.5'))
             .when(n == 3, no_key).otherwise(good))
    return positions.select(F.col("city_id").alias("key"), value.alias("value"),
                            F.lit("gps-normal").alias("topic"), F.lit(0).alias("partition"),
                            F.substring("event_id", 5, 20).cast("bigint").alias("offset"),
                            F.col("kafka_ts").alias("timestamp"))


METRIC_OF = {"click": "spark_batch_latency_ms", "view": "spark_kafka_events_per_second",
             "signup": "spark_active_surge_zones", "purchase": "gps_events_sent_total",
             "error": "active_drivers_count"}


def experiment() -> Column:
    return F.concat(one_of(F.col("user_id"), "local", "ec2", "emr"), F.lit("_"),
                    F.col("user_id").cast("string"))


def samples(spark: SparkSession, sf: str) -> DataFrame:
    return samples_of(ev(spark, sf))


def samples_of(base: DataFrame) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in METRIC_OF.items() for x in pair])
    return base.select("event_id", F.col("ts").alias("timestamp"),
                                experiment().alias("experiment_name"),
                                F.lit("spark").alias("source"),
                                F.element_at(names, F.col("event_type")).alias("metric_name"), "value",
                                F.lit("").alias("labels"), "k", "city_id", "user_id")


def meta(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of an experiment; every seventh is unknown."""
    u = F.col("user_id")
    return ev(spark, sf).filter(u % 7 != 0).select(
        experiment().alias("experiment_name"), (500 * (1 + u)).alias("drivers"),
        F.element_at(F.array(F.lit(2), F.lit(5), F.lit(10)), (u % 3 + 1).cast("int")).alias("window_s"),
        (F.lit(0.25) * (u % 5)).alias("cost_hr")).distinct()


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """REST bodies: fields left out, null, and times as number or text, by event number."""
    n, k = F.col("event_id"), F.col("k")
    part = lambda cond, text: F.when(cond, text).otherwise(F.lit(""))
    number = lambda c: c.cast("string")
    quoted = lambda name, c: F.concat(F.lit(f',"{name}":"'), c, F.lit('"'))
    seconds = F.unix_seconds("ts")
    body = F.concat(
        F.lit('{"n":'), number(n),
        part(n % 11 != 0, quoted("driver_id", driver())),
        part(n % 13 != 0, F.concat(F.lit(',"lat":'), number(k / F.lit(4.0) - F.lit(12.0)))),
        F.concat(F.lit(',"lon":'), number(F.floor("value") / F.lit(2.0) - F.lit(20.0))),
        part(n % 17 != 0, F.when(n % 19 == 0, ',"status":null').otherwise(',"status":"on_trip"')),
        F.when(n % 3 == 0, F.concat(F.lit(',"timestamp":'), number(seconds)))
        .when(n % 3 == 1, quoted("timestamp", iso_text("ts"))).otherwise(F.lit("")),
        part(n % 5 == 0, F.lit(',"vehicle_type":"cab"')),
        F.when(n % 10 == 4, F.lit(',"schema_version":2,"event_time":"t2"'))
        .when(n % 10 == 5, F.lit(',"schema_version":1'))
        .when(n % 10 == 6, F.lit(',"schema_version":3'))
        .when(n % 10 == 7, F.lit(',"schema_version":0')).otherwise(F.lit("")),
        F.lit("}"))
    return ev(spark, sf).select(F.col("event_id"), (F.col("user_id") % 40).alias("request_id"),
                                F.to_date("ts").alias("day"), body.alias("value"))


def lineage_events(spark: SparkSession, sf: str) -> DataFrame:
    """Even events start a batch and odd ones end it; some of either are missing."""
    n, even = F.col("event_id"), F.col("event_id") % 2 == 0
    kind = F.when(F.col("k") % 7 == 0, "note").when(even, "start").otherwise("end")
    return ev(spark, sf).select(
        F.concat(F.lit("b"), F.floor(n / 2).cast("string")).alias("batch_id"), kind.alias("kind"),
        one_of(F.col("user_id"), "ingestion", "streaming", "batch_glue").alias("stage"),
        F.concat(F.lit("topic-"), F.col("event_type")).alias("input_source"),
        F.concat(F.lit("sink-"), F.col("city_id")).alias("output_sink"),
        F.col("k").cast("bigint").alias("record_count"), F.lit(2).alias("schema_version"),
        F.when(F.col("k") % 3 == 0, "failed").otherwise("success").alias("status"),
        F.when(F.col("k") % 3 == 0, F.repeat(F.lit("error "), 100)).alias("error"), F.col("ts").alias("at"))


# The same projections for the oracle. Later ones build on earlier ones.
SQL = """
WITH ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         ['MUM', 'DEL', 'BLR', 'HYD', 'CHN', 'PUN', 'KOL', 'AMD', 'JAI', 'SRT'][CAST(1 + user_id % 10 AS INT)] AS city_id
  FROM events),
trips0 AS (
  SELECT CAST(event_id AS VARCHAR) AS trip_id, 'DRV_' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS driver_id,
         city_id, city_id || '_Z' || lpad(CAST(1 + k % 20 AS VARCHAR), 2, '0') AS pickup_zone,
         CASE event_id % 3 WHEN 0 THEN 'auto' WHEN 1 THEN 'cab' ELSE 'bike' END AS ride_type,
         ts AS start_time, ts + to_minutes(CAST(10 + k % 36 AS BIGINT)) AS end_time,
         CAST(round(CAST(value AS DECIMAL(12,2)) * CAST(0.1 AS DECIMAL(2,1)), 2) AS DECIMAL(10,2)) AS distance_km,
         CAST(value AS DECIMAL(12,2)) AS base_fare_inr,
         CAST(1.0 + 0.5 * (event_id % 4) AS DECIMAL(4,2)) AS surge_multiplier,
         CAST((35 + k % 16) / 10.0 AS DECIMAL(3,1)) AS driver_rating,
         CASE WHEN event_type = 'error' THEN 'cancelled' ELSE 'completed' END AS status,
         CAST(ts AS DATE) AS date, hour(ts) AS pickup_hour
  FROM ev),
trips AS (
  SELECT *, CAST(round(base_fare_inr * surge_multiplier, 2) AS DECIMAL(12,2)) AS final_fare_inr FROM trips0),
driver_earnings AS (
  SELECT driver_id, city_id, date, count(*) AS total_trips,
         round(CAST(sum(final_fare_inr) AS DOUBLE) + 1e-9, 2) AS total_earnings_inr,
         round(sum(final_fare_inr) / count(*) + 1e-9, 2) AS avg_fare_inr,
         round(sum(surge_multiplier) / count(*) + 1e-9, 2) AS avg_surge,
         round(CAST(sum(distance_km) AS DOUBLE) + 1e-9, 2) AS total_distance_km,
         round(sum(driver_rating) / count(*) + 1e-9, 2) AS avg_rating
  FROM trips WHERE status = 'completed' GROUP BY ALL),
zone_heatmap AS (
  SELECT pickup_zone, city_id, pickup_hour, date, count(*) AS trip_count,
         round(sum(surge_multiplier) / count(*) + 1e-9, 2) AS avg_surge,
         round(sum(final_fare_inr) / count(*) + 1e-9, 2) AS avg_fare_inr,
         round(CAST(sum(final_fare_inr) AS DOUBLE) + 1e-9, 2) AS total_revenue_inr,
         count(*) FILTER (status = 'cancelled') AS cancellation_count
  FROM trips GROUP BY ALL),
city_stats AS (
  SELECT city_id, date, count(*) AS total_trips,
         count(*) FILTER (status = 'completed') AS completed_trips,
         count(*) FILTER (status = 'cancelled') AS cancelled_trips,
         round(CAST(sum(final_fare_inr) AS DOUBLE) + 1e-9, 2) AS total_revenue_inr,
         round(sum(final_fare_inr) / count(*) + 1e-9, 2) AS avg_fare_inr,
         round(sum(surge_multiplier) / count(*) + 1e-9, 2) AS avg_surge,
         round(sum(distance_km) / count(*) + 1e-9, 2) AS avg_distance_km,
         round(sum(driver_rating) / count(*) + 1e-9, 2) AS avg_driver_rating,
         round(count(*) FILTER (status = 'completed') * 100.0 / count(*) + 1e-9, 2) AS completion_rate_pct
  FROM trips GROUP BY ALL),
surge_analysis AS (
  SELECT city_id, date, CAST(round(surge_multiplier, 1) AS DOUBLE) AS surge_bucket, count(*) AS trip_count,
         round(sum(final_fare_inr) / count(*) + 1e-9, 2) AS avg_fare,
         round(count(*) FILTER (status = 'cancelled') * 100.0 / count(*) + 1e-9, 2) AS cancellation_rate_pct
  FROM trips GROUP BY ALL),
pings AS (
  SELECT event_id AS n, 'EVT_' || CAST(event_id AS VARCHAR) AS event_id,
         'DRV_' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS driver_id, city_id,
         city_id || '_Z' || lpad(CAST(1 + k % 20 AS VARCHAR), 2, '0') AS zone_id,
         'Z' || CAST(user_id % 10 AS VARCHAR) AS zone10, ts,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS timestamp, k / 4.0::DOUBLE - 12.0::DOUBLE AS lat,
         value / 2.0::DOUBLE - 20.0::DOUBLE AS lng, CAST(floor(value) AS INTEGER) AS speed_kmh,
         CASE WHEN event_type IN ('click', 'purchase') THEN 'on_trip'
              WHEN event_type IN ('view', 'signup') THEN 'available' ELSE 'offline' END AS status,
         k AS battery_pct, k / 25.0::DOUBLE AS zone_demand_ratio
  FROM ev),
zw0 AS (
  SELECT zone10 AS zone_id, city_id, date_trunc('hour', ts) AS window_start,
         count(*) FILTER (status = 'on_trip') AS on_trip_count,
         count(*) FILTER (status = 'available') AS available_count,
         count(*) AS total_events, min(ts) AS min_event_ts
  FROM pings GROUP BY ALL),
zw AS (
  SELECT *, round(on_trip_count / greatest(available_count, 1)::DOUBLE + 1e-9, 4) AS demand_ratio,
         CASE WHEN on_trip_count >= 4.0 * greatest(available_count, 1) THEN 3.0::DOUBLE
              WHEN on_trip_count >= 3.0 * greatest(available_count, 1) THEN 2.5
              WHEN on_trip_count >= 2.0 * greatest(available_count, 1) THEN 2.0
              WHEN on_trip_count >= 1.5 * greatest(available_count, 1) THEN 1.5 ELSE 1.0 END AS surge_multiplier
  FROM zw0),
samples AS (
  SELECT event_id, ts AS timestamp,
         CASE user_id % 3 WHEN 0 THEN 'local' WHEN 1 THEN 'ec2' ELSE 'emr' END || '_' ||
           CAST(user_id AS VARCHAR) AS experiment_name,
         CASE event_type WHEN 'click' THEN 'spark_batch_latency_ms' WHEN 'view' THEN 'spark_kafka_events_per_second'
              WHEN 'signup' THEN 'spark_active_surge_zones' WHEN 'purchase' THEN 'gps_events_sent_total'
              ELSE 'active_drivers_count' END AS metric_name,
         value, k, city_id, user_id
  FROM ev),
summary0 AS (
  SELECT experiment_name,
         round(avg(value::DECIMAL(22,6)) FILTER (metric_name = 'spark_kafka_events_per_second') + 1e-9, 1) AS avg_eps,
         list_sort(list(value) FILTER (metric_name = 'spark_batch_latency_ms')) AS v,
         CAST(trunc(max(value) FILTER (metric_name = 'spark_active_surge_zones')) AS INTEGER) AS max_surge,
         min(user_id) AS user_id
  FROM samples GROUP BY experiment_name),
summary1 AS (
  SELECT *, (len(v) - 1) * 0.5::DOUBLE AS e50, (len(v) - 1) * 0.95::DOUBLE AS e95, (len(v) - 1) * 0.99::DOUBLE AS e99
  FROM summary0),
summary AS (
  SELECT experiment_name, avg_eps,
         round_even(v[1 + CAST(floor(e50) AS INT)] + (v[1 + CAST(ceil(e50) AS INT)] - v[1 + CAST(floor(e50) AS INT)]) * (e50 - floor(e50)), 0) AS p50_lat,
         round_even(v[1 + CAST(floor(e95) AS INT)] + (v[1 + CAST(ceil(e95) AS INT)] - v[1 + CAST(floor(e95) AS INT)]) * (e95 - floor(e95)), 0) AS p95_lat,
         round_even(v[1 + CAST(floor(e99) AS INT)] + (v[1 + CAST(ceil(e99) AS INT)] - v[1 + CAST(floor(e99) AS INT)]) * (e99 - floor(e99)), 0) AS p99_lat,
         max_surge,
         CASE user_id % 3 WHEN 0 THEN 'local' WHEN 1 THEN 'ec2' ELSE 'emr' END AS infra,
         CASE WHEN user_id % 7 = 0 THEN 0 ELSE 500 * (1 + user_id) END AS drivers,
         CASE WHEN user_id % 7 = 0 THEN 5 WHEN user_id % 3 = 0 THEN 2 WHEN user_id % 3 = 1 THEN 5 ELSE 10 END AS window_s,
         CASE WHEN user_id % 7 = 0 THEN 0.0::DOUBLE ELSE 0.25::DOUBLE * (user_id % 5) END AS cost_hr
  FROM summary1),
req AS (
  SELECT event_id AS n, user_id % 40 AS request_id, CAST(ts AS DATE) AS day, ts, k, value, user_id,
         event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0 AS accepted,
         CASE event_id % 10 WHEN 4 THEN 2 WHEN 6 THEN 3 WHEN 7 THEN 0 ELSE 1 END AS version
  FROM ev),
lin AS (
  SELECT 'b' || CAST(event_id // 2 AS VARCHAR) AS batch_id,
         CASE WHEN k % 7 = 0 THEN 'note' WHEN event_id % 2 = 0 THEN 'start' ELSE 'end' END AS kind,
         CASE user_id % 3 WHEN 0 THEN 'ingestion' WHEN 1 THEN 'streaming' ELSE 'batch_glue' END AS stage,
         'topic-' || event_type AS input_source, 'sink-' || city_id AS output_sink, k AS record_count,
         CASE WHEN k % 3 = 0 THEN 'failed' ELSE 'success' END AS status,
         CASE WHEN k % 3 = 0 THEN repeat('error ', 100) END AS error, ts AS at
  FROM ev)
"""
