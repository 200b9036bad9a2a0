"""Fuzzy line deduplication by MinHash, in DataFrame operations only.

A line is the set of its runs of ``SHINGLE`` bytes of UTF-8. Equal lines are one
line first. A signature hashes each shingle once: the hash says which of the
``BANDS`` x 4 bins it falls in, and the least hash of each bin is one minimum
(MinHash by one permutation). Four bins make a band; lines with an equal band
become candidates, which at a Jaccard similarity of 0.8 happens with a chance of
0.998. Candidates are verified on their exact shingle sets, and components of
verified lines keep one line: the one in the document with the smallest doc_id,
and in it the first.

Two rounds find the links between lines:

1. In a bucket of equal bands every line meets one hub, the bucket's most central line.
   That is linear in the entries and joins a group of near copies through its origin.
2. Where a bucket still holds lines of different components, all pairs across
   components are compared, whoever the hub was. Links inside a component cannot
   change it, so no candidate is lost for the components.

In the second round a pair is verified only if its sketches allow the threshold. A
sketch has one parity bit per hash cell; two sets that differ in d shingles differ in
no more than d bits, so a pair that the sketches rule out is below the threshold.
Buckets with very many lines are split over tasks.

* blank lines, of white space alone, stay as they are. A line shorter than a shingle is near
  only to lines equal to it.
* null or empty text: no lines, nothing removed.
* null doc_id: the largest id, so its lines go before those of others. Equal
  doc_ids are ordered by a hash of the text.
* rows equal in doc_id and text are the same occurrence: each keeps the same lines.
* an empty table: no rows. Columns besides doc_id and text are ignored, or kept in ``without_repeats``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import stored
from fareflow.llm.components import components

SHINGLE = 8
PERCENT = 80
BANDS = 12
#: 64-bit words of a line's sketch, a power of two; twice as many tell 0.77 from 0.8 for lines of some 500 bytes.
CELLS = 16
#: Lines of a bucket that one task compares with the others of it.
SPLIT = 1000
NO_ID = 2**63 - 1
#: What a blank line consists of.
WHITE = " \t\n\x0b\f\r"
#: A signature's few groups per line fit the compiled map before the general one; a group per
#: shingle does not, and looking there first costs as much again.
FEW_GROUPS = {"spark.sql.codegen.aggregate.fastHashMap.capacityBit": "20"}
MANY_GROUPS = {"spark.sql.codegen.aggregate.map.twolevel.enabled": "false"}


def occurrences(documents: DataFrame) -> DataFrame:
    """``k, tie, line_no, line, lid``: every line that is not blank; ``k, tie`` name the document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("k"), F.xxhash64(text).alias("tie"),
                             F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
            .filter(F.octet_length(F.ltrim("line", F.lit(WHITE))) > 0)
            .withColumn("lid", F.xxhash64("line")))


def shingle(at: str = "p"):
    return F.xxhash64(F.col("raw").substr(F.col(at), F.lit(SHINGLE)))


def bands(lines: DataFrame) -> DataFrame:
    """``lid, key``: one row per band of a line. Rows partitioned by lid are not shuffled."""
    raw = lines.select("lid", F.col("line").cast("binary").alias("raw"))
    each = raw.select("lid", "raw", F.explode(F.sequence(F.lit(1), F.length("raw") - (SHINGLE - 1))).alias("p"))
    hashed = each.select("lid", shingle().alias("h"))
    # pmod without its branch, which goes either way for each shingle.
    rest = F.col("h") % BANDS
    band = (rest + F.shiftright(rest, 63).bitwiseAND(F.lit(BANDS))).cast("int")
    placed = hashed.select("lid", "h", band.alias("band"), F.shiftright("h", 58).bitwiseAND(F.lit(3)).alias("bin"))
    least = placed.groupBy("lid", "band").agg(*[F.min(F.when(F.col("bin") == i, F.col("h"))).alias(f"m{i}") for i in range(4)])
    return least.select("lid", F.xxhash64("band", *[F.coalesce(f"m{i}", F.lit(0)) for i in range(4)]).alias("key"))


def candidates(documents: DataFrame) -> DataFrame:
    """``lid, line, keys, central``: the different lines that share a band, with their buckets and the lines these hold together."""
    found = occurrences(documents).filter(F.octet_length("line") >= SHINGLE)
    # One line per task first, so that a line that fills a third of the input is a row per task.
    lines = found.groupBy("lid").agg(F.first("line").alias("line"))
    # A count over the bucket needs no order of its lines and gives what makes a line central.
    shared = bands(lines).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("n > 1")
    return lines.join(shared.groupBy("lid").agg(F.collect_list("key").alias("keys"), F.sum("n").alias("central")), "lid")


def with_hubs(buckets: DataFrame) -> DataFrame:
    """``key, lid, hub`` of ``key, lid, central``: each bucket's most central line, the one whose buckets hold the most lines.

    A line from which many others were copied shares a band with each of them and
    becomes their hub, though they may be too far from one another.
    """
    best = buckets.groupBy("key").agg(F.max(F.struct("central", "lid")).alias("best"))
    return buckets.select("key", "lid").join(best.select("key", F.col("best.lid").alias("hub")), "key")


def shingles_of(line: str):
    """All shingles of a line, repeated ones too."""
    # The bytes are a variable of the outer function: as a column they would be copied out of the row for each shingle.
    each = lambda raw: F.transform(F.sequence(F.lit(1), F.length(raw) - (SHINGLE - 1)), lambda p: F.xxhash64(raw.substr(p, F.lit(SHINGLE))))
    return F.transform(F.array(F.col(line).cast("binary")), each)[0]


def verified(pairs: DataFrame, percent: int) -> DataFrame:
    """``a, b`` of the pairs with lines ``line_a, line_b`` whose sets reach the threshold."""
    lists = pairs.select("a", "b", shingles_of("line_a").alias("x"), shingles_of("line_b").alias("y"))
    # Both functions look at different values only.
    both, either = F.size(F.array_intersect("x", "y")), F.size(F.array_union("x", "y"))
    return lists.filter(100 * both >= percent * either).select("a", "b")


def sketches(lines: DataFrame) -> DataFrame:
    """``lid, size, bits``: how many different shingles a line has, and their parity in ``CELLS`` x 64 cells."""
    each = lines.select("lid", F.array_distinct(shingles_of("line")).alias("all"))
    hashed = each.select("lid", F.explode_outer("all").alias("h"))
    bit = F.expr("shiftleft(1L, cast(shiftright(h, 32) & 63 AS int))")
    # One word per group; with more of them side by side each shingle would go through all.
    parts = (hashed.select("lid", F.col("h").bitwiseAND(F.lit(CELLS - 1)).cast("int").alias("i"), bit.alias("bit"))
             .groupBy("lid", "i").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("bit").alias("w")))
    return parts.groupBy("lid").agg(F.sum("n").alias("size"), *[F.coalesce(F.max(F.when(F.col("i") == i, F.col("w"))), F.lit(0)).alias(f"bits{i}") for i in range(CELLS)])


def across(buckets: DataFrame, roots: DataFrame, lines: DataFrame, percent: int) -> DataFrame:
    """``a, b``: pairs of one bucket but of different components whose sketches allow the threshold."""
    placed = stored(buckets.join(roots.withColumnRenamed("node", "lid"), "lid", "left").withColumn("root", F.coalesce("root", "lid")), "placed")
    mixed = (placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("n")).filter("x < y")
             .select("key", F.floor(1 + F.col("n") / SPLIT).cast("int").alias("salts")))
    # A bucket's hub has met all its lines.
    held = stored(placed.filter("lid <> hub").join(mixed, "key").select("key", "salts", "lid", "root"), "mixed")
    sketch = sketches(lines.join(held.select("lid").distinct(), "lid", "left_semi"))
    held = stored(held.join(sketch, "lid"), "held", FEW_GROUPS)
    mine = ["lid", "root", "size", *[f"bits{i}" for i in range(CELLS)]]
    left = held.select("key", F.pmod(F.xxhash64("lid"), F.col("salts")).cast("int").alias("salt"), *[F.col(c).alias(f"l_{c}") for c in mine])
    right = held.select("key", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), *mine)
    both, differ = F.col("l_size") + F.col("size"), F.lit(0)
    for i in range(CELLS):
        differ = differ + F.bit_count(F.col(f"l_bits{i}").bitwiseXOR(F.col(f"bits{i}")))
    # Of sets at the threshold, at most (100 - percent) / (100 + percent) of the shingles are in one of them only.
    allowed = lambda d: (100 + percent) * d <= (100 - percent) * both
    return (left.join(right, (left["key"] == right["key"]) & (left["salt"] == right["salt"]) & (F.col("l_root") < F.col("root"))
                      & allowed(F.abs(F.col("l_size") - F.col("size"))) & allowed(differ))
            .select(F.greatest("l_lid", "lid").alias("a"), F.least("l_lid", "lid").alias("b")).distinct())


def same_lines(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``node, root`` for lines that are near another one."""
    active = stored(candidates(documents), "lines", FEW_GROUPS)
    line_a = active.select(F.col("lid").alias("a"), F.col("line").alias("line_a"))
    line_b = active.select(F.col("lid").alias("b"), F.col("line").alias("line_b"))
    buckets = stored(with_hubs(active.select("lid", "central", F.explode("keys").alias("key"))), "buckets")
    near = lambda pairs: stored(verified(pairs.join(line_a, "a").join(line_b, "b"), percent), "links")
    first = near(buckets.filter("lid <> hub").select(F.col("lid").alias("a"), F.col("hub").alias("b")).distinct())
    second = near(across(buckets, stored(components(first), "roots"), active, percent))
    return stored(components(first.unionByName(second)), "roots")


def repeats(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``k, tie, n_lines, removed``: per document with lines, how many, and the numbers of those removed."""
    roots = same_lines(documents, percent)
    spots = stored(occurrences(documents).select("k", "tie", "line_no", "lid").distinct(), "spots", MANY_GROUPS)
    grouped = stored(spots.join(roots.withColumnRenamed("node", "lid").hint("shuffle_hash"), "lid", "left").withColumn("root", F.coalesce("root", "lid")), "grouped")
    # Only lines that occur again, or near which another does, are looked up; the least document of each comes by its number alone.
    least = grouped.groupBy("root").agg(F.min("k").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    met = stored(grouped.join(least, "root"), "met")
    place = F.struct("tie", "line_no")
    first = met.filter("k = least").groupBy("root").agg(F.min(place).alias("first"))
    again = met.join(first, "root").filter((F.col("k") > F.col("least")) | (place != F.col("first")))
    removed = again.groupBy("k", "tie").agg(F.array_sort(F.collect_list("line_no")).alias("removed"))
    counts = grouped.groupBy("k", "tie").agg(F.count(F.lit(1)).alias("n_lines"))
    return counts.join(removed, ["k", "tie"], "left").withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))


def line_report(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed`` per document: lines that are not blank, and the numbers
    of the removed ones from 0 on, joined by commas."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie")).withColumn("k", F.coalesce("doc_id", F.lit(NO_ID)))
    found = docs.join(repeats(documents, percent), ["k", "tie"], "left")
    return found.select("doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
                        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
                        F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit("")).alias("removed"))


def without_repeats(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents with their repeated lines taken out of ``text``; all columns kept. A document that
    loses all its lines goes; ``n_chars``, where there is one, follows the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    gone = repeats(documents, percent).filter("size(removed) > 0").select(F.col("k").alias("__gone_k"), F.col("tie").alias("__gone_tie"), F.col("removed").alias("__gone_lines"))
    joined = documents.join(gone, (F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) == F.col("__gone_k")) & (F.xxhash64(text) == F.col("__gone_tie")), "left")
    left = F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains(F.col("__gone_lines"), i))
    cleaned = F.when(F.col("__gone_k").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    kept = joined.filter(F.col("__gone_k").isNull() | cleaned.rlike(r"\S")).withColumn("text", cleaned)
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.when(F.col("__gone_k").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind)))
    return kept.select(*documents.columns)
