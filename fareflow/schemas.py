"""Explicit schemas. Inference is never used: it reads the input twice and
mistypes ids such as ``T1``."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(),
          "TIMESTAMP": T.TimestampType(), "DATE": T.DateType()}


def _record(text: str) -> T.StructType:
    """Nullable columns from ``name TYPE`` pairs; works before a session exists."""
    pairs = [part.split() for part in text.split(", ")]
    return T.StructType([T.StructField(name, _type(kind)) for name, kind in pairs])


def _type(kind: str) -> T.DataType:
    if kind.startswith("DECIMAL("):
        precision, scale = kind[8:-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return _TYPES[kind]


# Field names of the domain records.
GPS_EVENT = _record(
    "event_id STRING, driver_id STRING, city_id STRING, zone_id STRING, timestamp STRING, "
    "lat DOUBLE, lng DOUBLE, speed_kmh INT, status STRING, battery_pct INT, "
    "zone_demand_ratio DOUBLE, event_timestamp STRING")

TRIP = _record(
    "trip_id STRING, driver_id STRING, rider_id STRING, city_id STRING, pickup_zone STRING, "
    "dropoff_zone STRING, ride_type STRING, start_time TIMESTAMP, end_time TIMESTAMP, "
    "duration_min INT, distance_km DECIMAL(10,2), base_fare_inr DECIMAL(12,2), "
    "surge_multiplier DECIMAL(4,2), final_fare_inr DECIMAL(12,2), driver_rating DECIMAL(3,1), "
    "rider_rating DECIMAL(3,1), payment_method STRING, status STRING, "
    "cancellation_reason STRING, date DATE")

METRIC = _record(
    "timestamp STRING, experiment_name STRING, source STRING, metric_name STRING, "
    "value DOUBLE, labels STRING")

FAULT_EVENT = _record("event STRING, ts BIGINT, detail STRING")

ENVELOPE = _record(
    "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP")

LINEAGE_EVENT = _record(
    "batch_id STRING, kind STRING, stage STRING, input_source STRING, output_sink STRING, "
    "record_count BIGINT, schema_version INT, status STRING, error STRING, at TIMESTAMP")

DRIVER_STATUSES = ("available", "on_trip", "offline")
TRIP_STATUSES = ("completed", "cancelled")
