"""Registry of checked queries: a Spark callable and, where SQL can say it, the
DuckDB text over the same tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.projections import SQL
from fareflow.session import prepare


@dataclass(frozen=True)
class Case:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CASES: dict[str, Case] = {}


def case(body: str | None = None):
    """Register the function under its own name. ``body`` follows the shared
    WITH list; it starts with SELECT, or with a comma and more definitions."""

    def add(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(prepare(spark), sf)

        CASES[fn.__name__] = Case(run, None if body is None else SQL.rstrip() + "\n" + body)
        return fn

    return add


def text(ts: str, alias: str | None = None) -> Column:
    """A timestamp as text, so both engines write it alike."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(alias or ts)


def day(name: str = "date") -> Column:
    return F.col(name).cast("string").alias(name)
