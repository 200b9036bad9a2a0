"""Trip marts, the SQL on them, pricing and file round trips."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import projections as p
from checks.registry import case, day, text
from fareflow.functions import pricing, timeparts
from fareflow.operators import marts
from fareflow.plans import daily_marts, serving
from fareflow.session import shared_dir
from fareflow.sources import files


def dated(df):
    return df.withColumn("date", day())


@case("SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM driver_earnings")
def driver_earnings(spark, sf):
    return dated(marts.driver_earnings(p.trips(spark, sf)))


@case("SELECT * REPLACE (CAST(date AS VARCHAR) AS date, CAST(pickup_hour AS INTEGER) AS pickup_hour) FROM zone_heatmap")
def zone_heatmap(spark, sf):
    return dated(marts.zone_heatmap(p.trips(spark, sf)))


@case("SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM city_stats")
def city_stats(spark, sf):
    return dated(marts.city_stats(p.trips(spark, sf)))


@case("SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM surge_analysis")
def surge_effectiveness(spark, sf):
    return dated(marts.surge_effectiveness(p.trips(spark, sf)))


def saved(spark, sf, name, mart, build):
    return serving.query(spark, name, **{mart: build(p.trips(spark, sf))})


@case("""SELECT city_id, round(sum(CAST(total_revenue_inr AS DECIMAL(18,2))) + 1e-9, 2)::DOUBLE AS total_revenue,
  round(avg(CAST(avg_fare_inr AS DECIMAL(18,2))) + 1e-9, 2) AS avg_fare FROM city_stats GROUP BY city_id""")
def top_cities_revenue(spark, sf):
    return saved(spark, sf, "top_cities_revenue", "city_stats", marts.city_stats)


@case("""SELECT driver_id, city_id, total_earnings_inr, total_trips FROM driver_earnings
  ORDER BY total_earnings_inr DESC, driver_id, city_id, total_trips DESC LIMIT 10""")
def top_driver_earnings(spark, sf):
    return saved(spark, sf, "top_driver_earnings", "driver_earnings", marts.driver_earnings)


@case("""SELECT city_id, surge_bucket, trip_count, round(cancellation_rate_pct + 1e-9, 1) AS cancel_rate
  FROM surge_analysis""")
def surge_by_city(spark, sf):
    return saved(spark, sf, "surge_by_city", "surge_analysis", marts.surge_effectiveness)


@case("""SELECT city_id, pickup_zone, CAST(pickup_hour AS INTEGER) AS pickup_hour, trip_count, avg_surge
  FROM zone_heatmap WHERE pickup_hour BETWEEN 7 AND 22
  ORDER BY trip_count DESC, city_id, pickup_zone, pickup_hour, date LIMIT 20""")
def zone_peak_hours(spark, sf):
    return saved(spark, sf, "zone_peak_hours", "zone_heatmap", marts.zone_heatmap)


@case("SELECT city_id, round(completion_rate_pct + 1e-9, 1) AS completion_pct, avg_surge FROM city_stats")
def city_completion(spark, sf):
    return saved(spark, sf, "city_completion", "city_stats", marts.city_stats)


@case("""SELECT surge_bucket, CAST(sum(trip_count) AS BIGINT) AS trips,
  round(avg(CAST(cancellation_rate_pct AS DECIMAL(18,2))) + 1e-9, 1) AS avg_cancel_rate
  FROM surge_analysis GROUP BY surge_bucket""")
def surge_cancellation(spark, sf):
    return saved(spark, sf, "surge_cancellation", "surge_analysis", marts.surge_effectiveness)


@case("""SELECT CAST(date AS VARCHAR) AS date, CAST(sum(total_trips) AS BIGINT) AS trips,
  round(sum(CAST(total_revenue_inr AS DECIMAL(18,2))) + 1e-9, 2)::DOUBLE AS revenue FROM city_stats GROUP BY date""")
def revenue_by_date(spark, sf):
    return dated(saved(spark, sf, "revenue_by_date", "city_stats", marts.city_stats))


@case("""SELECT trip_id, round(distance_km * CASE ride_type WHEN 'auto' THEN 18 WHEN 'cab' THEN 14 ELSE 10 END, 2)::DOUBLE AS base,
  round(round(distance_km * CASE ride_type WHEN 'auto' THEN 18 WHEN 'cab' THEN 14 ELSE 10 END, 2) * surge_multiplier, 2)::DOUBLE AS final
  FROM trips""")
def price_trips(spark, sf):
    base = pricing.base_fare(F.col("distance_km"), F.col("ride_type"))
    return p.trips(spark, sf).select("trip_id", base.cast("double").alias("base"), pricing.final_fare(
        base, F.col("surge_multiplier")).cast("double").alias("final"))


@case("""SELECT trip_id, date_diff('minute', date_trunc('second', start_time), date_trunc('second', end_time)) AS minutes,
  pickup_hour BETWEEN 7 AND 10 OR pickup_hour BETWEEN 17 AND 20 AS peak,
  strftime(start_time, '%Y-%m-%dT%H') AS bucket FROM trips""")
def trip_duration(spark, sf):
    t = marts.with_pickup_hour(p.trips(spark, sf))
    return t.select("trip_id", timeparts.duration_min(F.col("start_time"), F.col("end_time")).alias("minutes"),
                    timeparts.is_peak_hour(F.col("pickup_hour")).alias("peak"),
                    timeparts.hour_bucket(F.col("date"), F.col("pickup_hour")).alias("bucket"))


@case("""SELECT event_id, round(([0.2,0.1,0.1,0.1,0.2,0.4,0.7,1.2,2.0,2.5,1.5,1.0,1.2,1.0,0.8,0.9,1.3,2.0,2.8,2.5,1.8,1.5,1.0,0.5])
  [1 + hour(ts)]::DOUBLE * CASE WHEN 1 + k % 20 IN (5, 7, 12) THEN 1.5 ELSE 1.0 END, 4)::DOUBLE AS demand FROM ev""")
def expected_demand(spark, sf):
    demand = pricing.expected_demand(F.hour("ts"), 1 + F.col("k") % 20)
    return p.ev(spark, sf).select("event_id", F.round(demand, 4).alias("demand"))


@case("""SELECT city_id, CAST(date AS VARCHAR) AS date, ride_type, count(*) AS trips,
  sum(final_fare_inr)::DOUBLE AS fares, strftime(max(end_time), '%Y-%m-%d %H:%M:%S.%f') AS last_end
  FROM trips GROUP BY ALL""")
def trips_csv_roundtrip(spark, sf):
    root = shared_dir(spark, "trips-csv")
    files.write_trips_csv(p.trips(spark, sf), root)
    back = files.read_trips(spark, root)
    return (back.groupBy("city_id", "date", "ride_type").agg(
        F.count("trip_id").alias("trips"), F.sum("final_fare_inr").cast("double").alias("fares"),
        F.max("end_time").alias("last_end"))
        .withColumn("last_end", text("last_end")).withColumn("date", day()))


@case("""SELECT * REPLACE (CAST(date AS VARCHAR) AS date, CAST(pickup_hour AS INTEGER) AS pickup_hour) FROM zone_heatmap""")
def marts_roundtrip(spark, sf):
    """All four marts through the shared rollup and partitioned Parquet."""
    out = shared_dir(spark, "marts")
    files.write_marts(daily_marts.build_marts(p.trips(spark, sf)), out)
    return dated(files.read_mart(spark, out, "zone_heatmap"))


@case("""SELECT city_id, CAST(date AS VARCHAR) AS date, total_trips, total_revenue_inr,
  CASE WHEN date > DATE '2024-01-15' THEN total_trips * 2 END AS doubled FROM city_stats""")
def marts_catalogue(spark, sf):
    """City statistics through the catalogue, which learns of two runs from their log; the second has one more column."""
    out, database = shared_dir(spark, "catalogue"), f"catalogue_{uuid.uuid4().hex}"
    stats, early = marts.city_stats(p.trips(spark, sf)), F.col("date") <= F.lit("2024-01-15").cast("date")
    for mart in (stats.filter(early), stats.filter(~early).withColumn("doubled", F.col("total_trips") * 2)):
        files.write_marts({"city_stats": mart}, out)
        files.sync_marts(spark, out, database, ("city_stats",))
    return spark.table(f"{database}.city_stats").select("city_id", day(), "total_trips", "total_revenue_inr", "doubled")


@case("""SELECT pickup_zone AS zone_id, CAST(date AS VARCHAR) || 'T' || lpad(CAST(pickup_hour AS VARCHAR), 2, '0') AS hour_bucket,
  city_id, trip_count, avg_surge, avg_fare_inr FROM zone_heatmap""")
def zone_demand_upsert(spark, sf):
    """Hourly zone demand written twice into the keyed table; the key wins once."""
    from fareflow.sources import keyed
    root = shared_dir(spark, "zone-demand")
    heatmap = marts.zone_heatmap(p.trips(spark, sf))
    daily_marts.upsert_zone_demand(heatmap.filter(F.col("pickup_hour") < 12), root, "2024-01-01")
    daily_marts.upsert_zone_demand(heatmap, root, "2024-01-02")
    back = keyed.read_current(spark, root, daily_marts.ZONE_DEMAND_KEYS)
    return back.select("zone_id", "hour_bucket", "city_id", "trip_count",
                       F.col("avg_surge").cast("double").alias("avg_surge"),
                       F.col("avg_fare_inr").cast("double").alias("avg_fare_inr"))


@case("""SELECT pickup_zone AS zone_id, CAST(date AS VARCHAR) || 'T' || lpad(CAST(pickup_hour AS VARCHAR), 2, '0') AS hour_bucket,
  city_id, trip_count, avg_surge, avg_fare_inr FROM zone_heatmap""")
def zone_demand_backfill(spark, sf):
    """A late day is compacted, then earlier days arrive under smaller batch numbers."""
    from fareflow.sources import keyed
    root = shared_dir(spark, "zone-demand")
    heatmap = marts.zone_heatmap(p.trips(spark, sf))
    late = F.dayofmonth("date") % 2 == 1
    daily_marts.upsert_zone_demand(heatmap.filter(late), root, "2024-01-03")
    keyed.compact(spark, root, daily_marts.ZONE_DEMAND_KEYS, upto=20240103)
    daily_marts.upsert_zone_demand(heatmap.filter(~late), root, "2024-01-02")
    back = keyed.read_current(spark, root, daily_marts.ZONE_DEMAND_KEYS)
    return back.select("zone_id", "hour_bucket", "city_id", "trip_count",
                       F.col("avg_surge").cast("double").alias("avg_surge"),
                       F.col("avg_fare_inr").cast("double").alias("avg_fare_inr"))


@case()
def input_size_gate(spark, sf):
    """Bytes of one day's trip files; the size depends on the writer, so no SQL."""
    root = shared_dir(spark, "gate")
    files.write_trips_csv(p.trips(spark, sf), root)
    return files.input_bytes(spark, root, "2024-01-03")
