"""Zone surge in batch and streaming, the hot table, joins and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import projections as p
from checks.registry import case, text
from fareflow.functions.timeparts import normalize_event_time
from fareflow.functions.places import derive_zone
from fareflow.operators import alerts, events, joins, surge, versions
from fareflow.plans import serving
from fareflow.session import shared_dir
from fareflow.sources import keyed, streams
from fareflow.streaming import adaptive, flows, late
from fareflow.streaming import surge as surge_stream

HOUR = 3600
LATE = "timestamp'2024-02-01 00:00:00'"


def hourly(spark, sf):
    """Hourly windows over ten zones: every surge tier occurs."""
    return surge.zone_surge(p.pings(spark, sf, few_zones=True), HOUR)


def raw_stream(spark, sf):
    """The events table as a file stream."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf))


WINDOW_SQL = """SELECT zone_id, city_id, strftime(window_start, '%Y-%m-%d %H:%M:%S.%f') AS window_start,
  on_trip_count, available_count, total_events, strftime(min_event_ts, '%Y-%m-%d %H:%M:%S.%f') AS min_event_ts"""


def windows_out(df, *more):
    return df.select("zone_id", "city_id", text("window_start"), "on_trip_count", "available_count",
                     "total_events", text("min_event_ts"), *more)


@case(WINDOW_SQL + " FROM zw")
def zone_surge_batch(spark, sf):
    return windows_out(hourly(spark, sf))


@case(WINDOW_SQL + ", demand_ratio, surge_multiplier FROM zw")
def zone_surge_stream(spark, sf):
    """The stream over the whole table, update mode, read back from the keyed table."""
    root = shared_dir(spark, "surge-stream")
    job = surge_stream.SurgeJob(root, f"{root}/checkpoint", HOUR)
    positions = p.pings_of(p.events_view(raw_stream(spark, sf)), few_zones=True)
    surge_stream.start(positions, job, availableNow=True).awaitTermination()
    return windows_out(surge_stream.windows_table(spark, job), "demand_ratio", "surge_multiplier")


@case("""SELECT zone_id, city_id, strftime(window_start, '%Y-%m-%d %H:%M:%S.%f') AS window_start,
  demand_ratio, surge_multiplier FROM zw""")
def surge_tiers(spark, sf):
    return surge.with_surge(hourly(spark, sf)).select("zone_id", "city_id", text("window_start"),
                                                      "demand_ratio", "surge_multiplier")


@case(WINDOW_SQL + """ FROM zw QUALIFY row_number() OVER (PARTITION BY zone_id
  ORDER BY on_trip_count DESC, window_start, city_id) = 1""")
def zone_dedupe(spark, sf):
    return windows_out(surge.dedupe_zone(hourly(spark, sf)))


@case(""", best AS (
  SELECT *, date_diff('day', DATE '1970-01-01', CAST(window_start AS DATE)) AS batch_id,
    (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(min_event_ts)) / 1000.0::DOUBLE AS lat
  FROM zw QUALIFY row_number() OVER (PARTITION BY CAST(window_start AS DATE), zone_id
    ORDER BY on_trip_count DESC, window_start, city_id) = 1),
 g AS (SELECT batch_id, sum(total_events) AS e, count(*) AS zones, count(*) FILTER (surge_multiplier > 1) AS sz,
    sum(on_trip_count) AS w, sum(available_count) AS a, avg(lat) AS m, list_sort(list(lat)) AS v FROM best GROUP BY batch_id)
SELECT batch_id, CAST(e AS BIGINT) AS events, round(e / 3600.0 + 1e-9, 2)::DOUBLE AS events_per_second, zones,
  sz AS surge_zones, CAST(w AS BIGINT) AS waiting_riders, CAST(a AS BIGINT) AS available_drivers,
  round(w / greatest(a, 1)::DOUBLE + 1e-9, 4) AS avg_demand_ratio, round(m + 1e-6, 2) AS avg_latency_ms,
  round(v[1 + least(CAST(floor(len(v) * 0.95::DOUBLE) AS INT), len(v) - 1)] + 1e-6, 2) AS p95_latency_ms,
  round(v[1 + least(CAST(floor(len(v) * 0.99::DOUBLE) AS INT), len(v) - 1)] + 1e-6, 2) AS p99_latency_ms,
  3600 AS window_size_sec FROM g""")
def batch_kpis(spark, sf):
    """Each day taken as one micro-batch."""
    zones = hourly(spark, sf).withColumn("batch_id", F.unix_date(F.to_date("window_start")).cast("bigint"))
    best = surge.dedupe_zone(surge.with_surge(zones), ["batch_id", "zone_id"])
    return surge.batch_kpis(surge.with_latency(best, F.expr(LATE)), HOUR)


@case("""SELECT zone_id, strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') || '_' || zone_id AS timestamp, city_id,
  surge_multiplier, on_trip_count AS waiting_riders, available_count AS available_drivers, demand_ratio,
  2 AS batches FROM zw""")
def hot_store_upsert(spark, sf):
    """Half the events first, then all; the second batch is written twice, as a
    replay would, with a compaction in between."""
    root = shared_dir(spark, "hot-store")
    positions = p.pings(spark, sf, few_zones=True)
    half = positions.filter(F.substring("event_id", 5, 20).cast("bigint") % 2 == 0)
    keys = ["zone_id", "timestamp", "city_id"]

    def put(df, batch_id):
        zones = surge.with_latency(surge.with_surge(surge.zone_surge(df, HOUR)), F.expr(LATE))
        records = surge.surge_records(zones, HOUR, "5K", F.lit(batch_id), F.expr(LATE))
        keyed.upsert(records, root, batch_id)

    put(half, 1)
    put(positions, 2)
    keyed.compact(spark, root, keys, upto=1)
    put(positions, 2)
    return keyed.read_current(spark, root, keys).select(
        "zone_id", "timestamp", "city_id", F.col("surge_multiplier").cast("double").alias("surge_multiplier"),
        "waiting_riders", "available_drivers", F.col("demand_ratio").cast("double").alias("demand_ratio"),
        F.col("batch_id").cast("int").alias("batches"))


@case(WINDOW_SQL + " FROM zw WHERE window_start + INTERVAL 25 HOURS > TIMESTAMP '2024-01-20 00:00:00'")
def ttl_expiry(spark, sf):
    """Windows live 24 hours from their end."""
    alive = events.unexpired(hourly(spark, sf), "window_end", 24 * HOUR, F.expr("timestamp'2024-01-20'"))
    return windows_out(alive)


# -- joins -------------------------------------------------------------------

JOIN_SQL = """SELECT g.event_id AS gps_event, s.event_id AS status_event, g.user_id FROM ev g JOIN ev s
  ON g.user_id = s.user_id AND g.event_type = 'click' AND s.event_type = 'view'
  AND abs(epoch_us(g.ts) - epoch_us(s.ts)) <= 3600000000"""


def sides(base):
    gps = base.filter(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("gps_event"), F.col("ts").alias("gps_ts"))
    status = base.filter(F.col("event_type") == "view").select(
        "user_id", F.col("event_id").alias("status_event"), F.col("ts").alias("status_ts"))
    return gps, status


@case(JOIN_SQL)
def gps_status_join_batch(spark, sf):
    pairs = joins.join_status(*sides(p.ev(spark, sf)), seconds=HOUR, key="user_id")
    return pairs.select("gps_event", "status_event", "user_id")


@case(JOIN_SQL)
def gps_status_join_stream(spark, sf):
    out = shared_dir(spark, "status-join")
    gps, _ = sides(p.events_view(raw_stream(spark, sf)))
    _, status = sides(p.events_view(raw_stream(spark, sf)))
    pairs = flows.status_join(gps, status, HOUR, "1 hour", key="user_id")
    flows.to_parquet(pairs.select("gps_event", "status_event", "user_id"), f"{out}/pairs",
                     f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/pairs")


def demand_history(rides):
    """The demand of hours before 18, as the daily job keeps it."""
    return rides.filter(F.hour("ts") < 18).groupBy(
        F.concat(F.lit("Z"), (F.col("user_id") % 10).cast("string")).alias("zone_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH").alias("hour_bucket")).agg(
        F.count("*").alias("trip_count"), F.lit(1.0).alias("avg_surge"),
        F.round(F.avg(F.col("value").cast("decimal(18,2)")), 2).cast("double").alias("avg_fare_inr"))


HISTORY_SQL = """, hist AS (SELECT zone10 AS zone_id, strftime(pings.ts, '%Y-%m-%dT%H') AS hour_bucket, count(*) AS history_trips,
    round(avg(value::DECIMAL(18,2)) + 1e-9, 2) AS history_fare_inr FROM pings JOIN ev ON pings.n = ev.event_id
  WHERE hour(pings.ts) < 18 GROUP BY ALL)
SELECT zw.zone_id, zw.city_id, strftime(window_start, '%Y-%m-%dT%H') AS hour_bucket, surge_multiplier,
  history_trips, history_fare_inr FROM zw LEFT JOIN hist ON zw.zone_id = hist.zone_id
  AND strftime(window_start, '%Y-%m-%dT%H') = hist.hour_bucket"""


@case(HISTORY_SQL)
def surge_with_history(spark, sf):
    """Hours from 18 on have no history and keep nulls."""
    history = demand_history(p.ev(spark, sf))
    joined = joins.enrich_with_history(surge.with_surge(hourly(spark, sf)), history)
    return joined.select("zone_id", "city_id", "hour_bucket", "surge_multiplier", "history_trips",
                         "history_fare_inr")


@case(HISTORY_SQL.replace("surge_multiplier,", "surge_multiplier, 1 + day(window_start) % 2 AS history_version,"))
def surge_with_history_stream(spark, sf):
    """Even days first, with the demand of even days; then odd days, after the daily job has added theirs."""
    root = shared_dir(spark, "history-stream")
    job = surge_stream.SurgeJob(f"{root}/hot", f"{root}/checkpoint", HOUR, watermark_seconds=60 * 24 * HOUR, with_kpis=False,
                                history_root=f"{root}/demand")
    base = p.ev(spark, sf)
    for version in (1, 2):
        share = base.filter(F.dayofmonth("ts") % 2 == version - 1)
        keyed.upsert(demand_history(share).withColumn("city_id", F.lit("any")), job.history_root, version)
        share.coalesce(1).write.mode("append").parquet(f"{root}/in")
        pings = p.pings_of(spark.readStream.schema(base.schema).parquet(f"{root}/in"), few_zones=True)
        surge_stream.start(pings, job, availableNow=True).awaitTermination()
    return surge_stream.history_table(spark, job).select(
        "zone_id", "city_id", "hour_bucket", "surge_multiplier", "history_version",
        "history_trips", "history_fare_inr")


@case("""SELECT zone_id, strftime(window_start, '%Y-%m-%d %H:%M:%S.%f') AS window_start, city_id,
  CASE WHEN hour(window_start) >= 12 THEN on_trip_count ELSE 0 END AS on_trip_count FROM zw""")
def serving_union(spark, sf):
    """Fresh rows for afternoons over older rows of all hours."""
    zones = hourly(spark, sf).select("zone_id", "window_start", "city_id", "on_trip_count")
    fresh = zones.filter(F.hour("window_start") >= 12).withColumn("seen_at", F.expr(LATE))
    old = zones.withColumn("on_trip_count", F.lit(0).cast("bigint")).withColumn(
        "seen_at", F.expr("timestamp'2024-01-31'"))
    view = serving.serving_view(fresh, old, ["zone_id", "window_start", "city_id"], "seen_at")
    return view.select("zone_id", text("window_start"), "city_id", "on_trip_count")


# -- single events -----------------------------------------------------------

@case("""SELECT event_id, CASE WHEN speed_kmh > 100 OR battery_pct < 10 THEN 'gps-critical'
  WHEN zone_demand_ratio > 1.5 THEN 'gps-surge' ELSE 'gps-normal' END AS topic FROM pings""")
def priority_routing(spark, sf):
    topic = events.classify_priority(F.col("speed_kmh"), F.col("battery_pct"), F.col("zone_demand_ratio"))
    return p.pings(spark, sf).select("event_id", topic.alias("topic"))


TOPIC_SQL = """SELECT CASE WHEN speed_kmh > 100 OR battery_pct < 10 THEN 'gps-critical'
  WHEN zone_demand_ratio > 1.5 THEN 'gps-surge' ELSE 'gps-normal' END AS topic, city_id, count(*) AS events
  FROM pings GROUP BY ALL"""


@case(TOPIC_SQL)
def events_by_topic_city(spark, sf):
    return events.events_by_topic_city(events.route_events(p.pings(spark, sf).drop("kafka_ts")))


@case(TOPIC_SQL)
def topic_sink_stream(spark, sf):
    """Routed records streamed to a folder per topic and read back."""
    out = shared_dir(spark, "topics")
    routed = events.route_events(p.pings_of(p.events_view(raw_stream(spark, sf))).drop("kafka_ts"))
    streams.write_routed(routed, f"{out}/checkpoint", path=f"{out}/topics").awaitTermination()
    return events.events_by_topic_city(spark.read.parquet(f"{out}/topics"))


@case("""SELECT event_id, driver_id, zone_id, CASE WHEN n % 50 IN (1, 2) THEN NULL ELSE speed_kmh END AS speed_kmh,
  lat, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS kafka_ts FROM pings WHERE n % 50 NOT IN (0, 3)""")
def decode_events(spark, sf):
    decoded = events.drop_keyless(events.decode_events(p.envelope_of(p.pings(spark, sf))))
    return decoded.select("event_id", "driver_id", "zone_id", "speed_kmh", "lat", text("kafka_ts"))


DEAD_SQL = """SELECT 'gps-dead-letters' AS topic, CASE WHEN n % 50 = 3 THEN 'missing_key' ELSE 'malformed' END AS fault,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS kafka_ts FROM pings WHERE n % 50 < 4"""


@case(DEAD_SQL)
def dead_letters(spark, sf):
    decoded = events.decode_with_faults(p.envelope_of(p.pings(spark, sf)))
    return events.dead_letters(decoded).select("topic", "fault", text("kafka_ts"))


@case("""SELECT CASE WHEN n % 50 = 3 THEN 'missing_key' ELSE 'malformed' END AS fault, count(*) AS events FROM pings
  WHERE n % 50 < 4 GROUP BY ALL""")
def fault_counts(spark, sf):
    return events.fault_counts(events.decode_with_faults(p.envelope_of(p.pings(spark, sf))))


@case(DEAD_SQL)
def dead_letters_stream(spark, sf):
    """The split as a stream: good events and dead letters go to two tables."""
    out = shared_dir(spark, "dead-letters")
    envelope = p.envelope_of(p.pings_of(p.events_view(raw_stream(spark, sf))))
    flows.split_faults(envelope, f"{out}/good", f"{out}/dead", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/dead/changes").select("topic", "fault", text("kafka_ts"))


@case("""SELECT city_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS events, count(DISTINCT zone_id) AS zones
  FROM pings GROUP BY ALL""")
def raw_archive_roundtrip(spark, sf):
    out = shared_dir(spark, "archive")
    decoded = p.pings_of(p.events_view(raw_stream(spark, sf)))
    flows.archive_events(decoded, f"{out}/raw", f"{out}/checkpoint").awaitTermination()
    back = spark.read.parquet(f"{out}/raw")
    zones = back.groupBy("city_id", "date", "zone_id").agg(F.count("*").alias("n"))
    return zones.groupBy("city_id", F.col("date").cast("string").alias("date")).agg(
        F.sum("n").alias("events"), F.count("zone_id").alias("zones"))


STATUS_SQL = """SELECT driver_id, city_id, zone_id, status, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS kafka_ts FROM pings
  QUALIFY row_number() OVER (PARTITION BY driver_id ORDER BY ts DESC, event_id) = 1"""


@case(STATUS_SQL)
def driver_last_status(spark, sf):
    return events.last_driver_status(p.pings(spark, sf)).select("driver_id", "city_id", "zone_id", "status",
                                                                text("kafka_ts"))


@case("SELECT driver_id, status FROM (" + STATUS_SQL + """)
  WHERE kafka_ts > '2024-01-30 12:00:00.000000'""")
def driver_status_stream(spark, sf):
    """The driver table kept by a stream, then only drivers seen in the last half day."""
    out = shared_dir(spark, "driver-status")
    flows.driver_status_table(p.pings_of(p.events_view(raw_stream(spark, sf))), f"{out}/table",
                              f"{out}/checkpoint").awaitTermination()
    table = keyed.read_current(spark, f"{out}/table", ["driver_id"])
    return events.unexpired(table, "kafka_ts", 12 * HOUR, F.expr("timestamp'2024-01-31 00:00:00'")).select(
        "driver_id", "status")


def newest_first(spark, base, out, parts=3):
    """The rows written as ``parts`` files, the newest rows in the first one, to be streamed
    file by file: all batches after the first are late."""
    day = F.dayofmonth("ts")
    for i in reversed(range(parts)):
        share = base.filter(F.least(F.floor((day - 1) * parts / F.lit(30)), F.lit(parts - 1)) == i)
        share.coalesce(1).write.mode("append").parquet(out)
    return spark.readStream.schema(base.schema).option("maxFilesPerTrigger", 1).parquet(out)


@case(STATUS_SQL)
def driver_status_late(spark, sf):
    """The driver table fed newest days first, compacted on the way: the latest event still wins."""
    out = shared_dir(spark, "driver-late")
    source = newest_first(spark, p.ev(spark, sf), f"{out}/in")
    flows.driver_status_table(p.pings_of(source), f"{out}/table", f"{out}/checkpoint", compact_every=2).awaitTermination()
    return flows.driver_statuses(spark, f"{out}/table").select("driver_id", "city_id", "zone_id", "status", text("kafka_ts"))


@case("""SELECT zone_id, strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') || '_' || zone_id AS timestamp, city_id,
  on_trip_count AS waiting_riders FROM zw WHERE window_start >= TIMESTAMP '2024-01-11'""")
def hot_store_levels(spark, sf):
    """The hot table written in overlapping weeks and compacted after every other batch, with expiry of the first ten days."""
    root = shared_dir(spark, "hot-levels")
    zones = surge.with_latency(surge.with_surge(hourly(spark, sf)), F.expr(LATE))
    records = surge.surge_records(zones, HOUR, "5K", F.lit(0), F.expr(LATE))
    keys, keep = ["zone_id", "timestamp", "city_id"], F.col("window_start") >= F.expr("timestamp'2024-01-11'")
    for n, first in enumerate(range(1, 31, 6)):
        keyed.upsert(records.filter(F.dayofmonth("window_start").between(first, first + 6)), root, n)
        if n % 2:
            keyed.compact(spark, root, keys, upto=n, keep=keep)
    return keyed.read_current(spark, root, keys).filter(keep).select("zone_id", "timestamp", "city_id", "waiting_riders")


def routed_late(spark, sf):
    """Newest days first through the router, then the surge stream over what was on time."""
    root = shared_dir(spark, "late")
    job = surge_stream.SurgeJob(f"{root}/hot", f"{root}/checkpoint", HOUR, with_kpis=False)
    pings = p.pings_of(newest_first(spark, p.ev(spark, sf), f"{root}/in"), few_zones=True)
    late.route(pings, job).awaitTermination()
    surge_stream.start(late.on_time_events(spark, job, pings.schema), job, availableNow=True).awaitTermination()
    return job


@case(WINDOW_SQL + ", demand_ratio, surge_multiplier, CAST(window_start AS DATE) < DATE '2024-01-21' AS changed FROM zw")
def late_rows_folded(spark, sf):
    """Two thirds of the rows come late, and the windows are still those of all rows."""
    return windows_out(late.with_late(spark, routed_late(spark, sf)), "demand_ratio", "surge_multiplier", "changed")


@case("""SELECT CAST(ts AS DATE) < DATE '2024-01-21' AS late, count(*) AS events, count(DISTINCT driver_id) AS drivers FROM pings GROUP BY ALL""")
def late_rows_kept(spark, sf):
    """Rows on time and late rows together are all rows."""
    job = routed_late(spark, sf)
    on_time = keyed.read_current(spark, f"{job.root}/on_time", []).select("driver_id", F.lit(False).alias("late"))
    both = on_time.unionByName(late.late_rows(spark, job).select("driver_id", F.lit(True).alias("late")))
    return both.groupBy("late").agg(F.count("*").alias("events"), F.count_distinct("driver_id").alias("drivers"))


@case(WINDOW_SQL + ", demand_ratio, surge_multiplier FROM zw")
def zone_surge_adaptive(spark, sf):
    """Half the days with windows of half an hour, then a restart with hours: hours are whole for all days."""
    root = shared_dir(spark, "adaptive")
    job = adaptive.AdaptiveJob(f"{root}/hot", f"{root}/checkpoint", slot_seconds=HOUR // 4, watermark_seconds=60 * 24 * HOUR,
                               keep_hours=10**6)
    base, day = p.ev(spark, sf), F.dayofmonth("ts")
    for n, (share, seconds) in enumerate([(day % 2 == 0, HOUR // 2), (day % 2 == 1, HOUR)]):
        base.filter(share).coalesce(1).write.mode("append").parquet(f"{root}/in")
        adaptive.record(spark, job, adaptive.Decision(n + 1, 1000, seconds, 4, 2000, 5))
        pings = p.pings_of(spark.readStream.schema(base.schema).parquet(f"{root}/in"), few_zones=True)
        adaptive.start(pings, job, availableNow=True).awaitTermination()
    return windows_out(adaptive.windows_of(spark, job, HOUR), "demand_ratio", "surge_multiplier")


@case("SELECT event_id, 'Z_' || upper(substr(md5(format('{:.1f}_{:.1f}', CAST(floor(lat / 0.5) AS BIGINT) * 0.5, "
      "CAST(floor(lng / 0.5) AS BIGINT) * 0.5)), 1, 6)) AS zone FROM pings")
def derive_zones(spark, sf):
    return p.pings(spark, sf).select("event_id", derive_zone(F.col("lat"), F.col("lng")).alias("zone"))


# -- requests and versions ---------------------------------------------------

@case("""SELECT n AS event_id, accepted, CASE WHEN NOT accepted THEN 'Missing fields: ' || concat_ws(', ',
  CASE WHEN n % 11 = 0 THEN 'driver_id' END, CASE WHEN n % 13 = 0 THEN 'lat' END, CASE WHEN n % 17 = 0 THEN 'status' END)
  END AS reason, CASE WHEN accepted THEN version WHEN n % 10 IN (4, 5, 6, 7) THEN version END AS schema_version,
  accepted AS has_id FROM req""")
def validate_events(spark, sf):
    checked = events.check_requests(events.parse_requests(p.requests(spark, sf)))
    return checked.select("event_id", "accepted", "reason", "schema_version",
                          F.col("ingestion_id").isNotNull().alias("has_id"))


@case("""SELECT r.request_id, count(q.n) AS events, CASE WHEN count(q.n) = 0 THEN 422 WHEN count(q.n) > 250 THEN 413
  ELSE 202 END AS code FROM (SELECT DISTINCT user_id % 50 AS request_id FROM ev) r
  LEFT JOIN req q ON q.request_id = r.request_id GROUP BY r.request_id""")
def batch_guard(spark, sf):
    """Ten of the fifty requests are empty."""
    asked = p.ev(spark, sf).select((F.col("user_id") % 50).alias("request_id")).distinct()
    return events.request_verdicts(asked, p.requests(spark, sf), limit=250)


@case("""SELECT n AS event_id FROM req WHERE request_id IN
  (SELECT request_id FROM req GROUP BY request_id HAVING count(*) <= 300)""")
def batch_admit(spark, sf):
    bodies = p.requests(spark, sf)
    verdicts = events.request_verdicts(bodies.select("request_id").distinct(), bodies, limit=300)
    return events.admit(bodies, verdicts).select("event_id")


@case("""SELECT count(*) FILTER (accepted) AS events_accepted_total, count(*) FILTER (NOT accepted) AS events_rejected_total,
  count(DISTINCT request_id) AS batch_requests_total FROM req""")
def ingest_counters(spark, sf):
    return events.ingest_counters(events.check_requests(events.parse_requests(p.requests(spark, sf))))


UPGRADED = """CASE WHEN version >= 2 THEN 'same' WHEN version = 1 THEN 'upgraded' ELSE 'unsupported' END"""
NOW = "timestamp'2024-03-01 10:20:30'"


@case(f""", u AS (SELECT *, {UPGRADED} AS upgrade,
    CASE WHEN n % 13 <> 0 THEN k / 4.0::DOUBLE - 12.0::DOUBLE END AS lat, floor(value) / 2.0::DOUBLE - 20.0::DOUBLE AS lon FROM req)
SELECT n AS event_id, upgrade,
  CASE WHEN upgrade <> 'upgraded' THEN CASE WHEN n % 10 = 4 THEN 't2' END
       WHEN n % 3 = 0 THEN strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S+00:00')
       WHEN n % 3 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') ELSE '2024-03-01T10:20:30+00:00' END AS event_time,
  CASE WHEN n % 5 = 0 THEN 'cab' WHEN upgrade = 'upgraded' THEN 'unknown' END AS vehicle_type,
  CASE WHEN upgrade = 'upgraded' THEN -1 END AS battery_level,
  CASE WHEN upgrade = 'upgraded' AND lat IS NOT NULL THEN 'Z_' || upper(substr(md5(format('{{:.1f}}_{{:.1f}}',
    CAST(floor(lat / 0.5) AS BIGINT) * 0.5, CAST(floor(lon / 0.5) AS BIGINT) * 0.5)), 1, 6)) END AS zone_id,
  CASE WHEN upgrade = 'upgraded' THEN 2 WHEN n % 10 IN (4, 5, 6, 7) THEN version END AS schema_version,
  upgrade = 'upgraded' AND accepted OR (n % 10 = 4 AND accepted) AS valid_v2 FROM u""")
def upgrade_events(spark, sf):
    up = events.upgrade_events(events.parse_requests(p.requests(spark, sf)), now=F.expr(NOW))
    return up.select("event_id", "upgrade", "event_time", "vehicle_type", "battery_level", "zone_id",
                     "schema_version", events.satisfies_version(2).alias("valid_v2"))


@case(f"""SELECT n AS event_id, CASE WHEN version = 1 THEN
    CASE WHEN n % 3 = 0 THEN strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S+00:00')
         WHEN n % 3 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') ELSE '2024-03-01T10:20:30+00:00' END
    WHEN n % 10 = 4 THEN 't2' WHEN n % 3 = 0 THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)
    WHEN n % 3 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS timestamp,
  1 AS schema_version, accepted AS valid_v1 FROM req""")
def downgrade_events(spark, sf):
    """Upgrade, then go back; version 1 is valid again wherever it was before."""
    up = events.upgrade_events(events.parse_requests(p.requests(spark, sf)), now=F.expr(NOW))
    down = events.downgrade_events(up)
    return down.select("event_id", "timestamp", "schema_version", events.satisfies_version(1).alias("valid_v1"))


WHOLE = """, w AS (SELECT *, list_filter(['n', 'extra', 'big', CASE WHEN n % 11 <> 0 THEN 'driver_id' END, CASE WHEN n % 13 <> 0 THEN 'lat' END, 'lon',
    CASE WHEN n % 17 <> 0 THEN 'status' END, CASE WHEN n % 3 < 2 THEN 'timestamp' END, CASE WHEN n % 5 = 0 THEN 'vehicle_type' END,
    CASE WHEN n % 10 = 4 THEN 'event_time' END, CASE WHEN n % 10 IN (4, 5, 6, 7) THEN 'schema_version' END], lambda x: x IS NOT NULL) AS f FROM req),
 u AS (SELECT *, CASE WHEN version = 1 THEN list_distinct(list_concat(list_filter(f, lambda x: x <> 'timestamp'),
    ['event_time', 'vehicle_type', 'battery_level', 'zone_id', 'schema_version'])) ELSE f END AS g FROM w),
 d AS (SELECT *, list_distinct(list_concat(list_filter(g, lambda x: x NOT IN ('vehicle_type', 'battery_level', 'zone_id', 'event_time', 'schema_version')),
    ['schema_version'], CASE WHEN list_contains(g, 'event_time') THEN ['timestamp'] ELSE [] END)) AS h FROM u)
SELECT n AS event_id, '{"a":[1,null,2.5],"b":{"c":"x"}}' AS extra, '12345678901234567890' AS big, """


def whole_events(spark, sf):
    """The request bodies with fields that no version knows."""
    more = F.lit(',"extra":{"a":[1,null,2.5],"b":{"c":"x"}},"big":12345678901234567890}')
    return p.requests(spark, sf).withColumn("value", F.concat(F.expr("left(value, length(value) - 1)"), more))


def fields_out(df, *more):
    """Some fields of ``value`` and the names of all, from one parse."""
    read = df.select("*", events.once(F.struct(F.from_json("value", "map<string, string>").alias("got"))))
    names = F.array_join(F.array_sort(F.map_keys("got")), ",")
    return read.select("event_id", F.col("got.extra").alias("extra"), F.col("got.big").alias("big"), names.alias("fields"), *more)


@case(WHOLE + """array_to_string(list_sort(g), ',') AS fields,
  CASE WHEN version >= 2 THEN 'same' WHEN version = 1 THEN 'upgraded' ELSE 'unsupported' END AS upgrade FROM d""")
def upgrade_whole_events(spark, sf):
    """No field of an event is lost, whatever its name."""
    return fields_out(versions.upgrade_json(whole_events(spark, sf), now=F.expr(NOW)), "upgrade")


@case(WHOLE + """array_to_string(list_sort(h), ',') AS fields, CASE WHEN version = 1 THEN
    CASE WHEN n % 3 = 0 THEN strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S+00:00')
         WHEN n % 3 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') ELSE '2024-03-01T10:20:30+00:00' END
    WHEN n % 10 = 4 THEN 't2' WHEN n % 3 = 0 THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)
    WHEN n % 3 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS timestamp FROM d""")
def downgrade_whole_events(spark, sf):
    up = versions.upgrade_json(whole_events(spark, sf), now=F.expr(NOW))
    return fields_out(versions.downgrade_json(up), F.col("got.timestamp").alias("timestamp"))


@case(f"""SELECT CAST(day AS VARCHAR) AS day, 1 AS from_version, 2 AS to_version, count(*) AS upgraded_count
  FROM req WHERE version = 1 GROUP BY day""")
def schema_upgrade_counts(spark, sf):
    up = events.upgrade_events(events.parse_requests(p.requests(spark, sf)))
    return events.schema_upgrade_counts(up, "day").withColumn("day", F.col("day").cast("string"))


@case("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
    CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE '.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0') END || '+00:00'
  WHEN 1 THEN 'as text' ELSE '2024-03-01T10:20:30+00:00' END AS event_time FROM ev""")
def normalize_event_times(spark, sf):
    n = F.col("event_id") % 3
    epoch = F.when(n == 0, F.unix_micros("ts").cast("decimal(20,0)") / F.lit(1000000))
    return p.ev(spark, sf).select("event_id", normalize_event_time(
        epoch, F.when(n == 1, "as text"), F.expr(NOW)).alias("event_time"))


# -- alerts ------------------------------------------------------------------

def change_records(zones):
    """Windows as change records: some removals, some images without a latency."""
    n = F.hour("window_start") % 5
    records = surge.surge_records(surge.with_latency(surge.with_surge(zones), F.expr(LATE)), HOUR, "5K",
                                  F.lit(1), F.expr(LATE))
    name = F.when(n == 0, "REMOVE").when(n == 1, "MODIFY").otherwise("INSERT")
    changes = alerts.to_changes(records, name)
    bare = F.map_filter("NewImage", lambda key, _: ~key.isin("e2e_latency_ms", "city_id"))
    return changes.withColumn("NewImage", F.when(F.col("eventName") == "MODIFY", bare)
                              .otherwise(F.col("NewImage")))


CHANGE_SQL = """, ch AS (SELECT zone_id, CASE WHEN hour(window_start) % 5 = 1 THEN 'UNKNOWN' ELSE city_id END AS city_id,
    CASE WHEN hour(window_start) % 5 = 1 THEN 'MODIFY' ELSE 'INSERT' END AS eventName, surge_multiplier AS surge,
    on_trip_count AS waiting, available_count AS available, CASE WHEN hour(window_start) % 5 = 1 THEN 0.0::DOUBLE ELSE
      round((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(min_event_ts)) / 1000.0::DOUBLE + 1e-6, 2) END AS latency_ms, '5K' AS scale
  FROM zw WHERE hour(window_start) % 5 <> 0)"""


@case(CHANGE_SQL + " SELECT * FROM ch")
def change_records_read(spark, sf):
    return alerts.read_changes(change_records(hourly(spark, sf)))


@case(CHANGE_SQL + " SELECT * FROM ch WHERE surge >= 2.5")
def change_alerts(spark, sf):
    return alerts.surge_alerts(alerts.read_changes(alerts.feed(change_records(hourly(spark, sf)))))


MESSAGE_SQL = CHANGE_SQL + """ SELECT zone_id, city_id, surge, 'SURGE ' || CAST(surge AS VARCHAR) || 'x — ' || zone_id AS subject,
  'SURGE PRICING ALERT' || chr(10) || chr(10) || 'Zone:       ' || zone_id || chr(10) || 'City:       ' || city_id || chr(10)
  || 'Surge:      ' || CAST(surge AS VARCHAR) || 'x' || chr(10) || 'Waiting:    ' || waiting || ' riders' || chr(10)
  || 'Available:  ' || available || ' drivers' || chr(10) || 'Latency:    ' || CAST(CAST(round_even(latency_ms, 0) AS BIGINT) AS VARCHAR)
  || 'ms' || chr(10) || 'Scale:      5K' || chr(10) || chr(10) || 'Action: Consider repositioning drivers to ' || zone_id AS body
  FROM ch WHERE surge >= 2.5"""


@case(MESSAGE_SQL)
def alert_messages(spark, sf):
    return flows.alert_stream(change_records(hourly(spark, sf)))


@case(MESSAGE_SQL)
def alert_stream(spark, sf):
    """The change records written out and read back as a stream."""
    out = shared_dir(spark, "alerts")
    change_records(hourly(spark, sf)).write.parquet(f"{out}/changes")
    schema = spark.read.parquet(f"{out}/changes").schema
    changes = spark.readStream.schema(schema).parquet(f"{out}/changes")
    flows.to_parquet(flows.alert_stream(changes), f"{out}/alerts", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/alerts")
