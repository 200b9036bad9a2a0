"""Edge values of the column functions."""

import pytest
from pyspark.sql import functions as F

from fareflow.functions import numeric, places, pricing, timeparts
from fareflow.operators import events, experiments


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("ratio,expected", [(None, 1.0), (0.0, 1.0), (1.4999, 1.0), (1.5, 1.5), (2.0, 2.0),
                                            (3.0, 2.5), (3.99, 2.5), (4.0, 3.0), (99.0, 3.0)])
def test_surge_tiers(spark, ratio, expected):
    assert one(spark, pricing.surge_multiplier(F.lit(ratio).cast("double"))) == expected


def test_demand_ratio_counts_no_driver_as_one(spark):
    assert one(spark, pricing.demand_ratio(F.lit(5), F.lit(0))) == 5.0
    assert one(spark, pricing.demand_ratio(F.lit(None).cast("int"), F.lit(2))) == 0.0


@pytest.mark.parametrize("lat,lon,zone", [(28.61, 77.23, "Z_D8310B"), (-0.3, 0.2, "Z_67FFA7"),
                                          (0.0, -0.0, "Z_355895"), (-33.86, 151.2, "Z_E47B0F"),
                                          (None, 1.0, None)])
def test_derive_zone(spark, lat, lon, zone):
    assert one(spark, places.derive_zone(F.lit(lat).cast("double"), F.lit(lon).cast("double"))) == zone


@pytest.mark.parametrize("speed,battery,demand,topic", [
    (101, 50, 0.0, events.TOPIC_CRITICAL), (100, 50, 0.0, events.TOPIC_NORMAL), (0, 9, 0.0, events.TOPIC_CRITICAL),
    (0, 10, 1.5, events.TOPIC_NORMAL), (0, 10, 1.51, events.TOPIC_SURGE), (101, 5, 9.0, events.TOPIC_CRITICAL)])
def test_priority(spark, speed, battery, demand, topic):
    assert one(spark, events.classify_priority(F.lit(speed), F.lit(battery), F.lit(demand))) == topic


@pytest.mark.parametrize("text,micros", [
    ("2024-01-05T03:04:05.123456Z", 1704423845123456), ("2024-01-05T03:04:05Z", 1704423845000000),
    ("2024-01-05T03:04:05", 1704423845000000), ("2024-01-05T03:04:05.5", 1704423845500000),
    ("", None), (None, None), ("garbage", None), ("2024-01-05", None), ("2024-13-05T03:04:05Z", None),
    ("2024-01-05T03:04:05+05:30", None)])
def test_parse_event_ts(spark, text, micros):
    parsed = timeparts.parse_event_ts(F.lit(text).cast("string"))
    assert one(spark, F.unix_micros(parsed)) == micros


def test_parse_event_ts_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        assert one(spark, F.unix_micros(timeparts.parse_event_ts(F.lit("2024-01-05T03:04:05Z")))) == 1704423845000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_normalize_event_time(spark):
    now = F.expr("timestamp'2024-03-01 00:00:00'")
    none, text = F.lit(None), F.lit("kept")
    n = timeparts.normalize_event_time
    assert one(spark, n(F.lit(1744800000.0), none.cast("string"), now)) == "2025-04-16T10:40:00+00:00"
    assert one(spark, n(F.lit(1744800000.25), none.cast("string"), now)) == "2025-04-16T10:40:00.250000+00:00"
    assert one(spark, n(none.cast("double"), text, now)) == "kept"
    assert one(spark, n(none.cast("double"), none.cast("string"), now)) == "2024-03-01T00:00:00+00:00"


def test_adaptive_config(spark):
    rows = spark.createDataFrame([(d, 8.0) for d in (500, 1000, 5000, 50000)], "drivers int, ram_gb double")
    got = {r.drivers: (r.window_seconds, r.parallelism, r.max_rate_per_partition)
           for r in experiments.adaptive_config(rows).collect()}
    assert got == {500: (2, 4, 1000), 1000: (2, 4, 2000), 5000: (4, 10, 5000), 50000: (2, 100, 5000)}


def test_ratios_survive_zero(spark):
    zero = F.lit(0)
    assert one(spark, numeric.percent(F.lit(1), zero)) is None
    assert one(spark, numeric.cost_per_gb(F.lit(1.0), zero)) is None
    assert one(spark, numeric.utilisation(F.lit(1), zero)) is None
    assert one(spark, numeric.eps_per_dollar(F.lit(10.0), F.lit(0.0))) is None


def test_fares(spark):
    base = pricing.base_fare(F.lit("3.33").cast("decimal(10,2)"), F.lit("auto"))
    assert str(one(spark, base)) == "59.94"
    assert str(one(spark, F.round(pricing.final_fare(base, F.lit("1.5").cast("decimal(4,2)")), 2))) == "89.91"
    assert one(spark, pricing.base_fare(F.lit("1").cast("decimal(10,2)"), F.lit("boat"))) is None


def test_labels(spark):
    names = ["local_1k", "fault_local", "ec2_5k", "fault_ec2", "emr_50k"]
    assert [one(spark, places.infra_of(F.lit(n))) for n in names] == ["local", "local", "ec2", "ec2", "emr"]
    assert one(spark, places.sla_flag(F.lit(4999.9))) == "PASS"
    assert one(spark, places.sla_flag(F.lit(5000.0))) == "FAIL"
    assert one(spark, F.length(places.truncate_error(F.repeat(F.lit("x"), 900)))) == 500


def test_trigger_and_hours(spark):
    assert [one(spark, timeparts.trigger_seconds(F.lit(w))) for w in (2, 5, 10)] == [2, 5, 5]
    assert one(spark, timeparts.hour_bucket(F.to_date(F.lit("2024-01-05")), F.lit(7))) == "2024-01-05T07"
    assert [one(spark, timeparts.in_service_hours(F.lit(h))) for h in (6, 7, 22, 23)] == [False, True, True, False]
