"""Surge tiers, demand and fares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Demand ratio at or above -> multiplier, highest first.
SURGE_TIERS = ((4.0, 3.0), (3.0, 2.5), (2.0, 2.0), (1.5, 1.5))
NO_SURGE = 1.0

# Fare per km by ride type.
FARE_PER_KM = {"auto": 18, "cab": 14, "bike": 10}

# Usual demand by hour of day 0..23, and the busy zone numbers.
HOURLY_DEMAND = (0.2, 0.1, 0.1, 0.1, 0.2, 0.4, 0.7, 1.2, 2.0, 2.5, 1.5, 1.0,
                 1.2, 1.0, 0.8, 0.9, 1.3, 2.0, 2.8, 2.5, 1.8, 1.5, 1.0, 0.5)
BUSY_ZONES = (5, 7, 12)
BUSY_ZONE_FACTOR = 1.5


def demand_ratio(on_trip: Column, available: Column) -> Column:
    """Riders per free driver; no free driver counts as one."""
    return F.coalesce(on_trip, F.lit(0)) / F.greatest(F.coalesce(available, F.lit(0)), F.lit(1))


def surge_multiplier(ratio: Column) -> Column:
    tier = F
    for floor, multiplier in SURGE_TIERS:
        tier = tier.when(ratio >= floor, F.lit(multiplier))
    return tier.otherwise(F.lit(NO_SURGE))


def base_fare(distance_km: Column, ride_type: Column) -> Column:
    """Distance times the rate of the ride type; null for an unknown type."""
    rates = F.create_map(*[F.lit(x) for pair in FARE_PER_KM.items() for x in pair])
    rate = F.try_element_at(rates, ride_type).cast("decimal(4,0)")
    return F.round(distance_km * rate, 2)


def final_fare(base: Column, surge: Column) -> Column:
    return F.round(base * surge, 2)


def surge_bucket(multiplier: Column) -> Column:
    return F.round(multiplier, 1).cast("double")


def expected_demand(hour: Column, zone_number: Column) -> Column:
    """Usual demand of an hour, raised in busy zones. The table has 24 fixed
    entries, so it is an array literal and needs no join."""
    usual = F.array(*[F.lit(v) for v in HOURLY_DEMAND])
    base = F.coalesce(F.get(usual, hour), F.lit(1.0))
    return base * F.when(zone_number.isin(*BUSY_ZONES), BUSY_ZONE_FACTOR).otherwise(1.0)
