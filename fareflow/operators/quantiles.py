"""Three kinds of percentile, kept apart because they give different numbers.

``nearest``      the value at sorted position ``min(floor(n * p), n - 1)``
``linear``       interpolation between the two nearest positions
``approximate``  Spark's mergeable sketch

The exact kinds never bring a whole group into one task. Every double has a 64-bit
image in the same order. Rows are counted per group and leading bits of the image,
straight from the input, so a task gives out one row per bin; only the bins that hold
a wanted position are followed, their rows counted by the next bits, and so on, until
no such bin has more than ``leaf`` rows or all 64 bits are used up, where a bin is one
value. What is left is sorted bin by bin. Rows outside the bins in question leave
before any shuffle as long as these bins are few enough to broadcast, which is
counted. Nothing depends on the order in which rows or shuffle blocks arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.session import written

BINS = 1024
#: Bins per level of the radix search, and rows of a bin that one task may sort.
RADIX = 1 << 16
LEAF = 200_000
#: Bins in question that may be broadcast.
FEW = 50_000


def cut_points(value: str, bins: int) -> Column:
    """Distinct values that split a column into about ``bins`` even parts, in order."""
    shares = [i / bins for i in range(1, bins)]
    return F.array_distinct(F.percentile_approx(value, shares, 2 * bins))


def bin_of(value: str, cuts: str, bins: int) -> Column:
    """How many cuts lie below the value, by halving: a jump of 2^k is taken
    when the cut it reaches is still below."""
    jumps = F.array(*[F.lit(1 << k) for k in reversed(range(bins.bit_length()))])
    return F.aggregate(jumps, F.lit(0), lambda at, jump: F.when(
        F.get(F.col(cuts), at + jump - 1) < F.col(value), at + jump).otherwise(at))


def ordered_image(value: Column) -> Column:
    """A bigint that is larger exactly where the double is larger; NaN comes last, as in
    Spark's order, and both zeros are 0. It is the double's exponent and mantissa,
    negated for negative values, worked out with exact steps only."""
    size = F.abs(value)
    guess = F.floor(F.log2(size)).cast("int")
    exponent = F.when(size < F.pow(F.lit(2.0), guess), guess - 1).when(
        size >= F.pow(F.lit(2.0), guess + 1), guess + 1).otherwise(guess)
    mantissa = (size / F.pow(F.lit(2.0), exponent) - 1) * float(1 << 52)
    normal = (exponent + 1023).cast("bigint") * (1 << 52) + mantissa.cast("bigint")
    tiny = (size * 2.0**537 * 2.0**537).cast("bigint")
    image = (F.when(F.isnan(value), 0x7FF8 << 48).when(size == float("inf"), 0x7FF0 << 48)
             .when(size < 2.0**-1022, tiny).otherwise(normal))
    return F.when(value < 0, -image).otherwise(image)


def exact_quantiles(df: DataFrame, keys: list[str], value: str, points: dict[str, float],
                    method: str = "linear", bins: int = RADIX, leaf: int = LEAF, refine: bool = True) -> DataFrame:
    """One row per key with a column for every entry of ``points`` (name -> 0..1).

    Null values are ignored; a group without values yields no row. The search runs when
    the function is called. With ``refine=False`` everything is one plan of a single
    level: for inputs that are small in themselves, such as one row per zone.
    """
    if method not in ("linear", "nearest"):
        raise ValueError(f"unknown method {method!r}")
    # The keys as one struct: null keys then compare as equal in plain joins.
    group, total = "__group", F.col("__total")
    rows = (df.select(F.struct(*keys).alias(group), (F.col(value).cast("double") + 0.0).alias("__v"))
            .filter(F.col("__v").isNotNull()).withColumn("__i", ordered_image(F.col("__v"))))
    asked = F.array_distinct(F.concat(*[F.array(*_positions(total, p, method)) for p in points.values()]))
    width, shift = max(1, (bins - 1).bit_length()), 64
    live, parent = rows, [group]
    while True:
        step = min(width, shift)
        shift -= step
        carried = [] if parent == [group] else [F.max("__start").alias("__from"), F.max("__total").alias("__total")]
        counts = live.groupBy(*parent, F.shiftright("__i", shift).alias("__digit")).agg(
            F.count("*").alias("__size"), F.max("__v").alias("__top"), *carried)
        beside = Window.partitionBy(*parent)
        below = beside.orderBy("__digit").rowsBetween(Window.unboundedPreceding, -1)
        if not carried:
            counts = counts.withColumns({"__from": F.lit(0), "__total": F.sum("__size").over(beside)})
        start = F.col("__from") + F.coalesce(F.sum("__size").over(below), F.lit(0))
        hits = counts.withColumn("__start", start).withColumn("__wanted", F.filter(asked, lambda pos: (
            pos >= F.col("__start")) & (pos < F.col("__start") + F.col("__size")))).filter(F.size("__wanted") > 0).select(
            group, F.col("__digit").alias("__bin"), "__start", "__size", "__top", "__wanted", "__total")
        if refine:
            hits = written(hits, "quantile-bins")
            largest, n = hits.agg(F.max("__size"), F.count("*")).first()
            if n <= FEW:
                hits = F.broadcast(hits)
        in_bins = rows.withColumn("__bin", F.shiftright("__i", shift)).join(hits, [group, "__bin"])
        if not refine or shift == 0 or (largest or 0) <= leaf:
            break
        live, parent = in_bins, [group, "__bin"]

    if shift == 0:
        ranked = hits.select("*", F.col("__top").alias("__v"), F.col("__start").alias("__first"),
                             (F.col("__start") + F.col("__size") - 1).alias("__last"))
    else:
        in_bin = Window.partitionBy(group, "__bin").orderBy("__v")
        ranked = (in_bins.groupBy(group, "__bin", "__v").agg(
            F.count("*").alias("__n"), *[F.any_value(c).alias(c) for c in ("__start", "__wanted", "__total")])
            .withColumn("__last", F.col("__start") + F.sum("__n").over(in_bin) - 1)
            .withColumn("__first", F.col("__last") - F.col("__n") + 1)
            .filter(F.exists("__wanted", lambda pos: pos.between(F.col("__first"), F.col("__last")))))

    picks = []
    for i, p in enumerate(points.values()):
        for j, pos in enumerate(_positions(total, p, method)):
            here = pos.between(F.col("__first"), F.col("__last"))
            picks.append(F.max(F.when(here, F.col("__v"))).alias(f"__p{i}_{j}"))
    found = ranked.groupBy(group).agg(F.max("__total").alias("__total"), *picks)
    return found.select(*[F.col(f"{group}.{k}").alias(k) for k in keys],
                        *[_value(total, i, p, method).alias(name)
                          for i, (name, p) in enumerate(points.items())])


def _positions(total: Column, p: float, method: str) -> list[Column]:
    """Zero-based sorted positions that the point ``p`` needs."""
    if method == "nearest":
        return [F.least(F.floor(total * F.lit(float(p))).cast("bigint"), total - 1)]
    exact = (total - 1) * F.lit(float(p))
    return [F.floor(exact).cast("bigint"), F.ceil(exact).cast("bigint")]


def _value(total: Column, i: int, p: float, method: str) -> Column:
    low = F.col(f"__p{i}_0")
    if method == "nearest":
        return low
    exact = (total - 1) * F.lit(float(p))
    return low + (F.col(f"__p{i}_1") - low) * (exact - F.floor(exact))


def approx_quantiles(df: DataFrame, keys: list[str], value: str, points: dict[str, float],
                     accuracy: int = 10000) -> DataFrame:
    """Sketch percentiles: one shuffle, error below 1/accuracy of the rank."""
    return df.groupBy(*keys).agg(*[F.percentile_approx(value, p, accuracy).alias(name)
                                   for name, p in points.items()])
