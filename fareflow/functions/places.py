"""Grid zones and deployment labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRID_DEGREES = 0.5


def derive_zone(lat: Column, lon: Column) -> Column:
    """Zone id of the half-degree cell: ``Z_`` and six hex digits of its MD5."""
    corner = [F.floor(c / GRID_DEGREES).cast("bigint") * F.lit(GRID_DEGREES) for c in (lat, lon)]
    digits = F.upper(F.substring(F.md5(F.format_string("%.1f_%.1f", *corner)), 1, 6))
    return F.when(lat.isNotNull() & lon.isNotNull(), F.concat(F.lit("Z_"), digits))


def infra_of(experiment: Column) -> Column:
    """Where an experiment ran, from its name."""
    return (F.when(experiment.startswith("local") | (experiment == "fault_local"), "local")
            .when(experiment.startswith("ec2") | (experiment == "fault_ec2"), "ec2")
            .otherwise("emr"))


def sla_flag(latency: Column, limit_ms: float = 5000) -> Column:
    """PASS below the limit; a missing latency fails."""
    return F.when(latency < limit_ms, "PASS").otherwise("FAIL")


def truncate_error(text: Column, limit: int = 500) -> Column:
    return F.substring(text, 1, limit)
