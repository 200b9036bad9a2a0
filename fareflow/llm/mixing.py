"""Mixing sources to target weights by entropy balancing.

Each document starts with rate 1. Among all rates between 0 and ``most`` that
give every source its target number of words, entropy balancing takes those of
least relative entropy to the start: rate = min(most, exp(lambda * size / scale)),
one multiplier lambda per source, scale the source's mean size. The convex dual
of each source is solved by safeguarded Newton steps. A step is one distributed
aggregate over (source, size, number of documents), the only thing the dual
depends on, so neither a hot source nor copies make a large group.

Rates are then rounded into whole copies: per (source, size) the copies of its
documents are counted by carrying the rounding rest from size to size, so the
words of a source miss its target by about one document. Which documents of a
size get the extra copy is decided by a hash of the id.

* null text: size 0, taken 0. Null source: a source of its own, the last.
* null ids: hashed as null; ties and repeated rows of one size are exchangeable,
  so the result is the same set of rows in each run.
* empty table: no rows. A source without words: target 0.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import WORD, stored

MOST = 3
STEPS = 60
#: Newton stops for a source when its words are this near to the target.
NEAR = 1e-6
#: At most so many single copies correct what rounding left of a source's target.
CORRECTIONS = 20
#: Documents of one size are ranked in this many hash buckets.
RANK_BUCKETS = 4096


def sizes(documents: DataFrame) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("source").cast("string").alias("source"), size.alias("size"))


def targets(totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """``source, source_size, target``: shares of all words by weight, none above
    ``most`` times its source's size, the excess shared again by weight.

    Sources fill up in order of size per weight. With sources in that order, the
    first k that are full leave rest / (weights left) for each unit of weight, and
    k is right when no later source would overflow: a running sum, no iteration.
    One row per source is sorted in one task.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    shares = F.array(*[F.lit(float(w)) for w in weights])
    cells = (totals.withColumn("weight", F.element_at(shares, ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int")))
             .withColumn("room", F.col("source_size") * float(most)))
    by_fill = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("room").over(before), F.lit(0.0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    cells = cells.withColumn("level", level).withColumn("full", F.col("room") <= F.col("level") * F.col("weight"))
    # The level that counts is that of the first source which is not full.
    final = F.min(F.when(~F.col("full"), F.struct(F.col("room") / F.col("weight"), F.col("source").isNull(), "source", "level"))).over(every)["level"]
    return cells.select("source", "source_size",
                        F.when(F.col("full"), F.col("room")).otherwise(final * F.col("weight")).alias("target"))


def rate(most: int) -> Column:
    """The rate that a source's multiplier gives a size; ``most`` where it has none."""
    tilted = F.exp(F.least(F.col("lambda") * F.col("size") / F.col("scale"), F.lit(50.0)))
    return F.when(F.col("lambda").isNull(), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), tilted))


def balance(cells: DataFrame, goals: DataFrame, most: int = MOST) -> DataFrame:
    """``source, lambda`` (null: every rate is ``most``) from ``source, size, n`` and the targets.

    The words of a source grow with lambda, so each step keeps a bracket and
    halves it whenever Newton's step leaves it; while one end is open, a step
    at most doubles lambda.
    """
    docs = cells.groupBy(F.col("source").alias("s")).agg(F.sum("n").alias("docs"))
    null = F.lit(None).cast("double")
    state = stored(goals.join(docs, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "source_size", "target", F.greatest(F.col("source_size") / F.col("docs"), F.lit(1.0)).alias("scale"),
        F.when(F.col("target") < most * F.col("source_size"), F.lit(0.0)).alias("lambda"),
        null.alias("low"), null.alias("high"), (F.col("target") >= most * F.col("source_size")).alias("done")), "dual")
    for _ in range(STEPS):
        open_ = state.filter(~F.col("done"))
        if open_.isEmpty():
            break
        at = cells.withColumnRenamed("source", "s").join(open_, F.col("source").eqNullSafe(F.col("s")))
        words = F.col("n") * F.col("size") * rate(most)
        slope = F.when(rate(most) < most, words * F.col("size") / F.col("scale")).otherwise(0.0)
        # Summed as DECIMAL: the same in any order, so reruns agree to the last digit.
        exact = lambda c: F.sum(c.cast("decimal(28,6)")).cast("double")
        sums = at.groupBy("s").agg(exact(words).alias("words"), exact(slope).alias("slope"))
        gap = F.col("words") - F.col("target")
        step = (state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumn("gap", gap)
                .withColumn("low", F.when(F.col("gap") < 0, F.col("lambda")).otherwise(F.col("low")))
                .withColumn("high", F.when(F.col("gap") > 0, F.col("lambda")).otherwise(F.col("high"))))
        reach = F.abs(F.col("lambda")) + 1
        low = F.coalesce("low", F.col("lambda") - reach)
        high = F.coalesce("high", F.col("lambda") + reach)
        newton = F.when(F.col("slope") > 0, F.col("lambda") - F.col("gap") / F.col("slope")).otherwise(F.when(F.col("gap") > 0, low).otherwise(high))
        inside = (newton > low) & (newton < high)
        halved = F.when(F.col("low").isNull(), low).when(F.col("high").isNull(), high).otherwise((low + high) / 2)
        near = F.abs(F.col("gap")) <= F.greatest(F.lit(0.5), NEAR * F.col("target"))
        state = stored(step.select(
            "source", "source_size", "target", "scale",
            F.when(F.col("done") | near, F.col("lambda")).when(inside, newton).otherwise(halved).alias("lambda"), "low", "high",
            (F.col("done") | F.coalesce(near, F.lit(True))).alias("done")), "dual")
    return state.select("source", "source_size", "target", "scale", "lambda")


def copies_per_size(cells: DataFrame, solved: DataFrame, most: int = MOST) -> DataFrame:
    """``source, source_size, target, size, n, total``: whole copies that the ``n``
    documents of a size take together.

    From the largest size on, what rounding leaves over is carried, in words, to
    the next size. A group is a source's sizes, at most as many as the words of
    its longest document, whatever the number of documents.
    """
    at = cells.withColumnRenamed("source", "s").join(solved, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("rate", rate(most))

    def carry(group):
        group = group.sort_values("size", ascending=False)
        total, owed = [], 0.0
        for size, n, each in zip(group["size"].tolist(), group["n"].tolist(), group["rate"].tolist()):
            want = n * each * size + owed
            taken = min(max(round(want / size), 0), most * n) if size else 0
            owed = want - taken * size
            total.append(taken)
        # The smallest sizes may be too few to take the last rest: one copy more of a size, one
        # less of another, or both, as long as that comes nearer.
        sizes, room = group["size"].to_numpy(), most * group["n"].to_numpy()
        total = np.array(total, np.int64)
        for _ in range(CORRECTIONS):
            up = np.append(np.flatnonzero((sizes > 0) & (total < room)), -1)
            down = np.append(np.flatnonzero((sizes > 0) & (total > 0)), -1)  # from large to small; -1: none
            more = np.where(up >= 0, sizes[up], 0)
            less = np.where(down >= 0, sizes[down], 0)[::-1]
            near = np.searchsorted(less, more - owed)
            either = np.stack([np.minimum(near, len(less) - 1), np.maximum(near - 1, 0)])
            left = np.abs(owed - more + less[either])
            side, at = np.unravel_index(left.argmin(), left.shape)
            if left[side, at] >= abs(owed):
                break
            pick = either[side, at]
            for place, step in ((up[at], 1), (down[::-1][pick], -1)):
                if place >= 0:
                    total[place] += step
            owed += less[pick] - more[at]
        return group.assign(total=total)[["source", "source_size", "target", "size", "n", "total"]]

    return (at.select("source", "source_size", "target", "size", "n", "rate").groupBy("source")
            .applyInPandas(carry, "source string, source_size long, target double, size long, n long, total long"))


def hand_out(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Each document's copies: total // n, and one more for the first total % n by hash of the id.

    The hash bucket in which that count ends is found from bucket counts; only
    the documents of that bucket are ranked.
    """
    # Null sources join as an empty name with a flag: plain keys, which Spark can split when one is hot.
    key = [F.coalesce("source", F.lit("")).alias("key"), F.col("source").isNull().alias("none")]
    docs = docs.select("*", *key, F.pmod(F.xxhash64("doc_id"), F.lit(RANK_BUCKETS)).alias("bucket"))
    plan = plan.select(*key, "size", "source_size", "target", (F.col("total") % F.col("n")).alias("extra"),
                       F.floor(F.col("total") / F.col("n")).alias("base"))
    cell = ["key", "none", "size"]
    before = F.sum("c").over(Window.partitionBy(*cell).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    ends = (docs.groupBy(*cell, "bucket").agg(F.count(F.lit(1)).alias("c")).withColumn("before", F.coalesce(before, F.lit(0)))
            .join(plan.filter("extra > 0"), cell)
            .filter((F.col("before") < F.col("extra")) & (F.col("before") + F.col("c") >= F.col("extra")))
            .select(*cell, F.col("bucket").alias("last"), (F.col("extra") - F.col("before")).alias("left")))
    placed = docs.join(plan.join(ends, cell, "left"), cell)
    edge = F.col("bucket").eqNullSafe(F.col("last"))
    # Dealt by bucket, so the join above can be split where one size is hot.
    ranked = placed.filter(edge).repartition(*cell, "bucket").withColumn("rank", F.row_number().over(
        Window.partitionBy(*cell, "bucket").orderBy(F.xxhash64("doc_id", F.lit(1)), F.col("doc_id").asc_nulls_last())))
    sure = placed.filter(~edge).withColumn("rank", F.lit(None).cast("int"))
    more = F.coalesce((F.col("bucket") < F.col("last")) | (F.col("rank") <= F.col("left")), F.lit(False))
    times = (F.col("base") + F.when(more, 1).otherwise(0)).cast("long")
    return sure.unionByName(ranked).select("doc_id", "source", "size", "source_size", "target",
                                           times.alias("copies"), (times * F.col("size")).alias("taken"))


def mix(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken``."""
    docs = stored(sizes(documents), "sizes")
    cells = stored(docs.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "cells")
    totals = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    solved = balance(cells, targets(totals, weights, most), most)
    return hand_out(docs, stored(copies_per_size(cells, solved, most), "plan"))
