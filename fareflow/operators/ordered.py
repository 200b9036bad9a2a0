"""Ordered work on long series without sorting a whole series in one task.

A series is cut into time blocks. Rows are ordered inside a block; what crosses
a block border (counts, sums, latest values) is carried by a table with one row
per series and block, which is ordered per series. That table grows with the
length of the history, not with the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SERIES, BLOCK = "__series", "__block"
BLOCK_SECONDS = 3600


def with_block(df: DataFrame, keys: list[str], ts: str, seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Add the series (its keys as one struct) and the time block of each row.

    Structs with null fields are equal to each other, so a plain equi-join keeps
    null keys, and its shuffle also serves the window that follows.
    """
    block = F.floor(F.unix_micros(F.col(ts)) / F.lit(seconds * 1_000_000)).cast("bigint")
    return df.withColumns({SERIES: F.struct(*keys), BLOCK: block})


def before() -> Window:
    """Earlier blocks of the same series."""
    return Window.partitionBy(SERIES).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)


def whole() -> Window:
    """All blocks of the same series."""
    return Window.partitionBy(SERIES)


def in_block(order: list) -> Window:
    return Window.partitionBy(SERIES, BLOCK).orderBy(*order)


def up_to_row(order: list) -> Window:
    """Rows of this block up to and including the current one."""
    return in_block(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def carry(blocked: DataFrame, per_block: dict[str, Column], carried: dict[str, Column]) -> DataFrame:
    """Join to every row what the other blocks of its series add up to.

    ``per_block`` are aggregates of one block; ``carried`` are window
    expressions over them, such as sums over ``before()``.
    """
    blocks = blocked.groupBy(SERIES, BLOCK).agg(*[c.alias(n) for n, c in per_block.items()])
    blocks = blocks.select(SERIES, BLOCK, *[c.alias(n) for n, c in carried.items()])
    return blocked.join(blocks, [SERIES, BLOCK])


def with_index(df: DataFrame, keys: list[str], ts: str, ties: list | None = None,
               seconds: int = BLOCK_SECONDS, name: str = "idx") -> DataFrame:
    """Zero-based position of each row in its series."""
    rows = carry(with_block(df, keys, ts, seconds), {"__n": F.count("*")},
                 {"__start": F.coalesce(F.sum("__n").over(before()), F.lit(0))})
    place = F.row_number().over(in_block([ts, *(ties or [])]))
    return rows.withColumn(name, (F.col("__start") + place - 1).cast("bigint")).drop("__start", SERIES, BLOCK)


def over_neighbours(indexed: DataFrame, keys: list[str], idx: str, back: int,
                    columns: dict, size: int = 100_000) -> DataFrame:
    """Add window columns that look at most ``back`` rows behind.

    Rows are grouped by ``idx // size``; the last ``back`` rows of a group are
    also copied to the next one, where they are seen but not returned. Every
    window partition thus holds at most ``size + back`` rows. ``columns`` maps a
    name to a function from the window to a column.
    """
    own = F.floor(F.col(idx) / size).cast("bigint")
    near_end = F.pmod(F.col(idx), F.lit(size)) >= size - back
    copies = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    spread = indexed.withColumn("__own", own).withColumn("__part", F.explode(copies))
    w = Window.partitionBy(*keys, "__part").orderBy(idx)
    for name, build in columns.items():
        spread = spread.withColumn(name, build(w))
    return spread.filter(F.col("__part") == F.col("__own")).drop("__part", "__own")
