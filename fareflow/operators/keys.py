"""Small helpers for keyed work."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other, so no row is lost.

    No side is hinted: Catalyst broadcasts a side only when its measured size is
    under ``spark.sql.autoBroadcastJoinThreshold``, and otherwise sort-merges
    with AQE splitting hot keys.
    """
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                           *[F.col(c) for c in right.columns if c not in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"__r_{k}" for k in keys])


def best_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in the given order.

    An aggregate rather than a ranking window: it combines before the shuffle,
    so a hot key costs one partial row per task, not one huge sorted partition.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(first).select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c)
                                                 for c in df.columns])
