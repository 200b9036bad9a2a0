"""Change records of the hot table and the alerts they raise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds of the feed and of the alert, and the message text.
FEED_MIN_SURGE = 2.0
ALERT_MIN_SURGE = 2.5
SUBJECT = "SURGE %sx — %s"
BODY = ("SURGE PRICING ALERT\n\nZone:       %s\nCity:       %s\nSurge:      %sx\n"
        "Waiting:    %d riders\nAvailable:  %d drivers\nLatency:    %sms\nScale:      %s\n\n"
        "Action: Consider repositioning drivers to %s")


def to_changes(records: DataFrame, event_name: Column) -> DataFrame:
    """Hot-table rows as change records with an attribute map."""
    text = lambda c: F.struct(F.col(c).cast("string").alias("S"), F.lit(None).cast("string").alias("N"))
    number = lambda c: F.struct(F.lit(None).cast("string").alias("S"), F.col(c).cast("string").alias("N"))
    pairs = [x for c in ("zone_id", "city_id", "scale_level") for x in (F.lit(c), text(c))]
    pairs += [x for c in ("surge_multiplier", "waiting_riders", "available_drivers", "e2e_latency_ms")
              for x in (F.lit(c), number(c))]
    return records.select(event_name.alias("eventName"), F.create_map(*pairs).alias("NewImage"))


def read_changes(changes: DataFrame) -> DataFrame:
    """Inserts and updates as typed columns; missing attributes get defaults."""
    image = F.col("NewImage")

    def text(name: str, default: str) -> Column:
        return F.coalesce(F.try_element_at(image, F.lit(name))["S"], F.lit(default))

    def number(name: str, default, kind: str) -> Column:
        return F.coalesce(F.try_element_at(image, F.lit(name))["N"].try_cast(kind), F.lit(default).cast(kind))

    return (changes.filter(F.col("eventName").isin("INSERT", "MODIFY") & (F.size(image) > 0))
            .select("eventName", text("zone_id", "UNKNOWN").alias("zone_id"),
                    text("city_id", "UNKNOWN").alias("city_id"),
                    number("surge_multiplier", 1.0, "double").alias("surge"),
                    number("waiting_riders", 0, "bigint").alias("waiting"),
                    number("available_drivers", 0, "bigint").alias("available"),
                    number("e2e_latency_ms", 0, "double").alias("latency_ms"),
                    text("scale_level", "unknown").alias("scale")))


def feed(changes: DataFrame, min_surge: float = FEED_MIN_SURGE) -> DataFrame:
    """The subscription filter: only rows that carry at least this surge."""
    surge = F.try_element_at(F.col("NewImage"), F.lit("surge_multiplier"))["N"].try_cast("double")
    return changes.filter(surge >= min_surge)


def surge_alerts(changed: DataFrame, min_surge: float = ALERT_MIN_SURGE) -> DataFrame:
    return changed.filter(F.col("surge") >= min_surge)


def alert_message(alerts: DataFrame) -> DataFrame:
    """Subject and body per surging zone."""
    surge = F.col("surge").cast("string")
    whole_ms = F.format_string("%.0f", F.bround("latency_ms", 0))
    return alerts.select(
        "zone_id", "city_id", "surge",
        F.format_string(SUBJECT, surge, F.col("zone_id")).alias("subject"),
        F.format_string(BODY, F.col("zone_id"), F.col("city_id"), surge, F.col("waiting"),
                        F.col("available"), whole_ms, F.col("scale"), F.col("zone_id")).alias("body"))
