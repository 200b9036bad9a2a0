"""Decode, check, upgrade and route single events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow import schemas
from fareflow.functions.places import derive_zone
from fareflow.functions.timeparts import normalize_event_time
from fareflow.operators.keys import best_row, join_on_keys

# Topics, required fields and limits.
TOPIC_CRITICAL, TOPIC_SURGE, TOPIC_NORMAL = "gps-critical", "gps-surge", "gps-normal"
TOPIC_DEAD_LETTERS = "gps-dead-letters"
TOPICS = (TOPIC_CRITICAL, TOPIC_SURGE, TOPIC_NORMAL)
REQUIRED_V1 = ("driver_id", "lat", "lon", "status")
REQUIRED_V2 = ("driver_id", "lat", "lon", "status", "event_time", "schema_version")
V2_ONLY = ("vehicle_type", "battery_level", "zone_id", "schema_version", "event_time")
MAX_BATCH = 10_000
DEFAULT_VEHICLE, DEFAULT_BATTERY = "unknown", -1


# -- GPS stream --------------------------------------------------------------

def decode_events(envelope: DataFrame) -> DataFrame:
    """JSON ``value`` to GPS columns; the broker time becomes ``kafka_ts``."""
    parsed = F.from_json(F.col("value").cast("string"), schemas.GPS_EVENT)
    return envelope.select(once(parsed), F.col("timestamp").alias("kafka_ts"))


def once(struct: Column) -> Column:
    """The fields of a struct, computed once per row.

    A filter on a plain projection is pushed below it and repeats the parsing
    for every field it tests; it is not pushed below a generator.
    """
    return F.inline(F.array(struct))


def drop_keyless(events: DataFrame) -> DataFrame:
    return events.filter(F.col("zone_id").isNotNull() & F.col("status").isNotNull())


def decode_with_faults(envelope: DataFrame) -> DataFrame:
    """Decode and name what is wrong: null, ``malformed`` or ``missing_key``."""
    schema = T.StructType(schemas.GPS_EVENT.fields + [T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(F.col("value").cast("string"), schema,
                         {"columnNameOfCorruptRecord": "_corrupt_record"})
    fault = (F.when(F.col("_corrupt_record").isNotNull() | F.col("value").isNull(), "malformed")
             .when(F.col("zone_id").isNull() | F.col("status").isNull(), "missing_key"))
    return (envelope.select(once(parsed), F.col("timestamp").alias("kafka_ts"), "value")
            .withColumn("fault", fault).drop("_corrupt_record"))


def accepted_events(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("fault").isNull()).drop("value", "fault")


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Everything ``accepted_events`` leaves out, with the original text."""
    return decoded.filter(F.col("fault").isNotNull()).select(
        F.lit(TOPIC_DEAD_LETTERS).alias("topic"), "fault", "value", "kafka_ts")


def fault_counts(decoded: DataFrame) -> DataFrame:
    """Failed records per reason."""
    return decoded.filter(F.col("fault").isNotNull()).groupBy("fault").agg(F.count("*").alias("events"))


def classify_priority(speed: Column, battery: Column, demand: Column, speed_limit: float = 100,
                      battery_floor: float = 10, demand_limit: float = 1.5) -> Column:
    """Topic of an event. Unsafe speed or a dying battery goes first."""
    return (F.when((speed > speed_limit) | (battery < battery_floor), TOPIC_CRITICAL)
            .when(demand > demand_limit, TOPIC_SURGE)
            .otherwise(TOPIC_NORMAL))


def route_events(events: DataFrame) -> DataFrame:
    """(topic, key, value) records, keyed by city."""
    topic = classify_priority(F.col("speed_kmh"), F.col("battery_pct"), F.col("zone_demand_ratio"))
    return events.select(topic.alias("topic"), F.col("city_id").alias("key"),
                         F.to_json(F.struct("*")).alias("value"))


def events_by_topic_city(routed: DataFrame) -> DataFrame:
    return routed.groupBy("topic", F.col("key").alias("city_id")).agg(F.count("*").alias("events"))


def last_driver_status(events: DataFrame, now: Column | None = None, ttl_seconds: int = 300) -> DataFrame:
    """The newest status of each driver; with ``now``, only those still alive."""
    cols = events.select("driver_id", "city_id", "zone_id", "status", "kafka_ts", "event_id")
    latest = best_row(cols, ["driver_id"], [-F.unix_micros("kafka_ts"), F.col("event_id")])
    return latest if now is None else unexpired(latest, "kafka_ts", ttl_seconds, now)


def unexpired(df: DataFrame, ts: str, ttl_seconds: int, now: Column) -> DataFrame:
    """Rows whose time plus life span has not passed yet."""
    return df.filter(F.unix_micros(F.col(ts)) + F.lit(ttl_seconds * 1_000_000) > F.unix_micros(now))


# -- request events ----------------------------------------------------------

def parse_requests(df: DataFrame, value: str = "value") -> DataFrame:
    """Free-form JSON events to nullable columns.

    ``keys`` lists the top-level keys, since an absent key and a JSON null mean
    different things. ``epoch`` is set only if ``timestamp`` is a JSON number.
    Other columns of the input are kept.
    """
    v = F.col("__v")
    text = lambda name, kind: F.try_variant_get(v, f"$.{name}", kind).alias(name)
    stamp = F.try_variant_get(v, "$.timestamp", "variant")
    numeric = F.schema_of_variant(stamp).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return df.withColumn("__v", F.try_parse_json(F.col(value))).select(
        *[F.col(c) for c in df.columns],
        F.json_object_keys(F.col(value)).alias("keys"),
        text("driver_id", "string"), text("lat", "double"), text("lon", "double"),
        text("status", "string"), text("speed", "double"), text("timestamp", "string"),
        F.when(numeric, F.try_variant_get(v, "$.timestamp", "double")).alias("epoch"),
        text("event_time", "string"), text("vehicle_type", "string"), text("battery_level", "int"),
        text("zone_id", "string"), text("ingestion_id", "string"), text("schema_version", "int"))


def has_key(name: str) -> Column:
    return F.coalesce(F.array_contains("keys", name), F.lit(False))


def missing_fields(required: tuple[str, ...] = REQUIRED_V1) -> Column:
    """Required keys that are absent, in the order listed."""
    return F.array_compact(F.array(*[F.when(~has_key(k), F.lit(k)) for k in required]))


def satisfies_version(version: int = 2) -> Column:
    return F.size(missing_fields(REQUIRED_V1 if version == 1 else REQUIRED_V2)) == 0


def check_requests(parsed: DataFrame, now: Column | None = None) -> DataFrame:
    """Accept or reject each event in one pass.

    Accepted events get an id, an arrival time in epoch seconds and version 1
    unless they name one. Split with ``accepted`` afterwards.
    """
    ok = F.size("__missing") == 0
    arrived = F.unix_micros(F.current_timestamp() if now is None else now) / F.lit(1e6)
    version = F.when(has_key("schema_version"), F.col("schema_version")).otherwise(F.lit(1))
    return (parsed.withColumn("__missing", missing_fields())
            .withColumn("accepted", ok)
            .withColumn("reason", F.when(~ok, F.concat(F.lit("Missing fields: "),
                                                       F.array_join("__missing", ", "))))
            .withColumn("ingestion_id", F.when(ok, F.uuid()).otherwise(F.col("ingestion_id")))
            .withColumn("ingestion_ts", F.when(ok, arrived))
            .withColumn("schema_version", F.when(ok, version).otherwise(F.col("schema_version")))
            .drop("__missing"))


def request_verdicts(requests: DataFrame, events: DataFrame, key: str = "request_id",
                     limit: int = MAX_BATCH) -> DataFrame:
    """HTTP-style verdict per request: 422 empty, 413 too large, else 202.

    Sizes are counted with map-side combining, so the oversized request that
    this guard exists for never travels as one group.
    """
    sizes = events.groupBy(key).agg(F.count("*").alias("events"))
    return join_on_keys(requests.select(key), sizes, [key], "left").select(
        key, F.coalesce("events", F.lit(0)).alias("events")).withColumn(
        "code", F.when(F.col("events") == 0, 422).when(F.col("events") > limit, 413).otherwise(202))


def admit(events: DataFrame, verdicts: DataFrame, key: str = "request_id") -> DataFrame:
    """Events of the requests that passed."""
    refused = verdicts.filter(F.col("code") != 202).select(key)
    return events.join(refused, key, "left_anti")


def ingest_counters(checked: DataFrame, key: str = "request_id") -> DataFrame:
    return checked.agg(F.count(F.when(F.col("accepted"), 1)).alias("events_accepted_total"),
                       F.count(F.when(~F.col("accepted"), 1)).alias("events_rejected_total"),
                       F.count_distinct(key).alias("batch_requests_total"))


# -- schema versions ---------------------------------------------------------

def version_of() -> Column:
    return F.when(has_key("schema_version"), F.col("schema_version")).otherwise(F.lit(1))


def upgrade_outcome(target: int = 2) -> Column:
    """``same``, ``upgraded`` or ``unsupported``; the only known step is 1 to 2."""
    version = version_of()
    return (F.when(version >= target, "same")
            .when((version == 1) & F.lit(target == 2), "upgraded")
            .otherwise("unsupported"))


def upgrade_events(parsed: DataFrame, target: int = 2, now: Column | None = None) -> DataFrame:
    """Bring version 1 events to version 2.

    Events at or above the target stay as they are. Events without a known step
    keep their columns and are marked ``unsupported``, so the caller can divert
    them; nothing is dropped here.
    """
    up = F.col("upgrade") == "upgraded"

    def filled(name: str, default: Column) -> Column:
        return F.when(up & ~has_key(name), default).otherwise(F.col(name)).alias(name)

    stamp_text = F.when(has_key("timestamp"), F.col("timestamp"))
    new_time = normalize_event_time(F.col("epoch"), stamp_text, now)
    added = F.array(*[F.lit(k) for k in V2_ONLY])
    new_keys = F.array_union(F.array_remove(F.coalesce("keys", F.array().cast("array<string>")),
                                            "timestamp"), added)
    replaced = {
        "event_time": F.when(up, new_time).otherwise(F.col("event_time")).alias("event_time"),
        "vehicle_type": filled("vehicle_type", F.lit(DEFAULT_VEHICLE)),
        "battery_level": filled("battery_level", F.lit(DEFAULT_BATTERY)),
        "zone_id": filled("zone_id", derive_zone(F.col("lat"), F.col("lon"))),
        "timestamp": F.when(~up, F.col("timestamp")).alias("timestamp"),
        "epoch": F.when(~up, F.col("epoch")).alias("epoch"),
        "schema_version": F.when(up, F.lit(2)).otherwise(F.col("schema_version")).alias("schema_version"),
        "keys": F.when(up, new_keys).otherwise(F.col("keys")).alias("keys"),
    }
    marked = parsed.withColumn("from_version", version_of()).withColumn("upgrade", upgrade_outcome(target))
    return marked.select(*[replaced.get(c, F.col(c)) for c in marked.columns])


def downgrade_events(events: DataFrame) -> DataFrame:
    """Back to version 1: drop the newer columns, ``event_time`` becomes ``timestamp``."""
    stamp = F.when(has_key("event_time"), F.col("event_time")).otherwise(F.col("timestamp"))
    gone = F.array(*[F.lit(k) for k in V2_ONLY])
    kept = F.array_union(F.array_except("keys", gone), F.array(F.lit("schema_version")))
    keys = F.when(has_key("event_time"), F.array_union(kept, F.array(F.lit("timestamp")))).otherwise(kept)
    epoch = F.when(~has_key("event_time"), F.col("epoch"))
    changed = (events.withColumn("__stamp", stamp).withColumn("__keys", keys).withColumn("__epoch", epoch)
               .drop(*V2_ONLY, "timestamp", "keys", "epoch", "from_version", "upgrade"))
    return (changed.withColumnsRenamed({"__stamp": "timestamp", "__keys": "keys", "__epoch": "epoch"})
            .withColumn("schema_version", F.lit(1)))


def schema_upgrade_counts(upgraded: DataFrame, batch: str = "batch_id", target: int = 2) -> DataFrame:
    """Upgraded rows per batch and source version."""
    return (upgraded.filter(F.col("upgrade") == "upgraded")
            .groupBy(batch, "from_version", F.lit(target).alias("to_version"))
            .agg(F.count("*").alias("upgraded_count")))
