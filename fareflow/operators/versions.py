"""Schema versions of whole JSON events: every field survives, known or not.

``events.upgrade_events`` works on the columns the pipeline knows. Here the event stays
one JSON object: it is parsed once to a VARIANT, taken apart into its top-level fields,
and put together again from the old and the new ones. Fields nobody knows keep their
name, value and type, nested ones too. Top-level fields come out in order of name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.functions.places import derive_zone
from fareflow.functions.timeparts import normalize_event_time
from fareflow.operators.events import DEFAULT_BATTERY, DEFAULT_VEHICLE, V2_ONLY, once

FIELDS = "__fields"


def _opened(df: DataFrame, value: str) -> DataFrame:
    """Add the fields of the JSON object as a map; null where the text is no JSON object."""
    parsed = df.select("*", once(F.struct(F.try_parse_json(F.col(value)).alias("__v"))))
    fields = F.try_variant_get("__v", "$", "map<string, variant>")
    return parsed.select(*df.columns, once(F.struct(fields.alias(FIELDS))))


def _get(name: str, kind: str) -> Column:
    return F.try_variant_get(F.try_element_at(FIELDS, F.lit(name)), "$", kind)


def _has(name: str) -> Column:
    return F.coalesce(F.map_contains_key(FIELDS, name), F.lit(False))


def _as_map(fields: dict[str, Column]) -> Column:
    return F.create_map(*[c for name, x in fields.items() for c in (F.lit(name), F.coalesce(x.cast("variant"), F.parse_json(F.lit("null"))))])


def _if(needed: Column, fields: Column) -> Column:
    """The fields where they are needed, else none; they are not computed elsewhere."""
    return F.when(needed, fields).otherwise(F.create_map().cast("map<string, variant>"))


def _without(*names: str) -> Column:
    return F.map_filter(FIELDS, lambda k, _: ~k.isin(*names))


def _closed(fields: Column) -> Column:
    return F.to_json(F.to_variant_object(fields))


def event_version() -> Column:
    """The version an event names, 1 where it names none; null for one that is no whole number."""
    return F.when(_has("schema_version"), _get("schema_version", "int")).otherwise(F.when(F.col(FIELDS).isNotNull(), 1))


def upgrade_json(df: DataFrame, value: str = "value", target: int = 2, now: Column | None = None) -> DataFrame:
    """Replace ``value`` by its version 2, and add ``from_version`` and ``upgrade``.

    ``upgrade`` is ``same`` for events at or above the target, ``upgraded``, ``unsupported`` where no
    step is known, and ``malformed`` for text that is no JSON object; all but upgraded ones
    keep their text, byte for byte.
    """
    opened = _opened(df, value).withColumn("from_version", event_version())
    version = F.col("from_version")
    outcome = (F.when(F.col(FIELDS).isNull(), "malformed").when(version >= target, "same")
               .when((version == 1) & F.lit(target == 2), "upgraded").otherwise("unsupported"))
    stamp = F.try_element_at(FIELDS, F.lit("timestamp"))
    numeric = F.schema_of_variant(stamp).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    epoch = F.when(numeric, F.try_variant_get(stamp, "$", "double"))
    lat, lon = _get("lat", "double"), _get("lon", "double")
    kept = _without("timestamp", "event_time", "schema_version")
    missing = {"vehicle_type": F.lit(DEFAULT_VEHICLE), "battery_level": F.lit(DEFAULT_BATTERY), "zone_id": derive_zone(lat, lon)}
    added = [_if(~_has(name), _as_map({name: x})) for name, x in missing.items()]
    always = _as_map({"event_time": normalize_event_time(epoch, _get("timestamp", "string"), now), "schema_version": F.lit(target)})
    upgraded = _closed(F.map_concat(kept, *added, always))
    return (opened.withColumn("upgrade", outcome)
            .withColumn(value, F.when(F.col("upgrade") == "upgraded", upgraded).otherwise(F.col(value))).drop(FIELDS))


def downgrade_json(df: DataFrame, value: str = "value") -> DataFrame:
    """Replace ``value`` by its version 1: the fields that version 2 brought go, ``event_time``
    becomes ``timestamp``. Text that is no JSON object stays as it is."""
    opened = _opened(df, value)
    stamp = _if(_has("event_time"), F.create_map(F.lit("timestamp"), F.try_element_at(FIELDS, F.lit("event_time"))))
    kept = F.when(_has("event_time"), _without(*V2_ONLY, "timestamp")).otherwise(_without(*V2_ONLY))
    down = _closed(F.map_concat(kept, stamp, _as_map({"schema_version": F.lit(1)})))
    return opened.withColumn(value, F.when(F.col(FIELDS).isNotNull(), down).otherwise(F.col(value))).drop(FIELDS)
