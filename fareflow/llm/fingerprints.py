"""Document fingerprints by consistent weighted sampling, in DataFrame operations only.

A text is a set of words weighted by how often each occurs. A consistent weighted sample is a word
and a place below its weight, (word, y), uniform over all such pairs and the same in every
text that holds the chosen pair. Weights are whole numbers, so y is one of 0 to weight - 1. Every pair throws a dart per
round: a hash of (word, y, round) says which of the samples it may become, and its rank. A
sample is the dart of the first round that hits it, there the one of least rank. All pairs
are equally likely, so two texts agree in a sample with the probability of their
generalised Jaccard similarity: the sum of the smaller weights over the sum of the larger.

A sample depends only on rounds up to the one that decides it, so how many a text plays
changes no result. A text of W words plays enough for ``DARTS`` darts a sample; texts with a sample that none
hit, a few in a hundred, play four times as many, until none is left. So the work is a hash per word and
some per sample, not one per word and sample.

A dart is kept as one number, round before rank, so a sample is a plain minimum that tasks combine early.

The query compares a document with an edited text and with the next document, in
descending order of doc_id; the last one's next is the first. Texts are shuffled once, in runs of
consecutive documents, so a document's next one stands beside it.

* null or empty text: no words; all such texts have one fingerprint, likeness 1
  among themselves and 0 to others.
* null doc_id: the smallest id (as is the smallest BIGINT, returned as null). Equal doc_ids are ordered by a hash of the text.
* rows equal in doc_id and text are one document; each row is returned.
* one document alone is its own next. An empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import WORD, stored

SAMPLES = 128
#: Samples side by side in one aggregate; small enough for compiled code.
SIDE_BY_SIDE = 4
#: Darts a sample that a text throws at first; all miss one with a chance of e^-8.
DARTS = 8
#: Bits of a dart's rank within its round.
RANK_BITS = 40
#: A task gets about this much text.
TASK_BYTES = 4 << 20
NOT_A_WORD = r"[\x20\x09-\x0D]+"
LOWEST = -(2**63)


def throws(texts: DataFrame, keys: list[str], samples: int = SAMPLES, darts: int = DARTS) -> DataFrame:
    """``keys, round, h``: the darts of all words of a text, no more than its words and ``samples * darts``."""
    split = texts.select(*keys, F.split("text", NOT_A_WORD).alias("words"))
    words = split.select(*keys, F.ceil(F.lit(samples * darts) / F.size("words")).cast("int").alias("rounds"), F.explode("words").alias("word")).filter("word <> ''")
    weights = words.select(*keys, "rounds", F.xxhash64("word").alias("term")).groupBy(*keys, "rounds", "term").agg(F.count(F.lit(1)).alias("n"))
    # One short array per word: place and round are read off its numbers.
    thrown = weights.select(*keys, "rounds", "term", F.explode(F.sequence(F.lit(0), F.expr("CAST(n * rounds - 1 AS INT)"))).alias("x"))
    thrown = thrown.select(*keys, "term", F.expr("CAST(x DIV rounds AS INT)").alias("y"), F.expr("x % rounds").alias("round"))
    return thrown.select(*keys, "round", F.xxhash64("term", "y", "round").alias("h"))


def fingerprints(texts: DataFrame, keys: list[str], samples: int = SAMPLES, darts: int = DARTS) -> DataFrame:
    """``keys, samples``: an array of numbers per text with words, null where no dart hit; ``keys`` name a text.

    Rows partitioned by (some of) the keys are not shuffled again.
    """
    thrown = throws(texts, keys, samples, darts)
    hits = thrown.select(*keys, F.pmod("h", F.lit(samples)).cast("int").alias("j"),
                         F.shiftleft(F.col("round").cast("long"), RANK_BITS).bitwiseOR(F.shiftrightunsigned(F.xxhash64("h"), 64 - RANK_BITS)).alias("dart"))
    groups, each = -(-samples // SIDE_BY_SIDE), range(SIDE_BY_SIDE)
    least = (hits.select(*keys, F.floor(F.col("j") / SIDE_BY_SIDE).cast("int").alias("g"), F.pmod("j", F.lit(SIDE_BY_SIDE)).alias("i"), "dart")
             .groupBy(*keys, "g").agg(*[F.min(F.when(F.col("i") == i, F.col("dart"))).alias(f"s{i}") for i in each]))
    number = lambda c: F.when(F.col(c).isNotNull(), F.shiftright(F.xxhash64(c), 32).cast("int"))
    drawn = least.select(*keys, "g", F.array(*[number(f"s{i}") for i in each]).alias("s"))
    # The few rows of a text become one array, in the order of their groups.
    one = drawn.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("g", "s"))).alias("parts"))
    none = F.array_repeat(F.lit(None).cast("int"), SIDE_BY_SIDE)
    parts = F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: F.coalesce(F.try_element_at("parts", g), none))
    return one.select(*keys, F.slice(F.flatten(parts), 1, samples).alias("samples"))


def likeness(a: str, b: str):
    """The share of equal samples."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x) / F.size(a).cast("double")


def as_text(samples: str):
    return F.array_join(F.transform(samples, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(2**32 - 1)))), 8, "0")), "")


def dealt(docs: DataFrame, tasks: int) -> DataFrame:
    """``chunk, ghost, place, tie, text`` from ``place, tie, text``: about ``tasks`` runs of consecutive documents.

    The first document of a chunk also ends the chunk before as its ghost, the first of
    all that of the last one; so each document's next is in its own chunk.
    """
    ranges = docs.select("place", "tie").repartitionByRange(tasks, "place", "tie").groupBy(F.spark_partition_id().alias("part"))
    # One pair of numbers per task comes to the driver.
    firsts = sorted(map(tuple, ranges.agg(F.min(F.struct("place", "tie")).alias("f")).select("f.*").collect())) or [(0, 0)]
    places, ties = (F.split(F.lit(",".join(str(f[i]) for f in firsts)), ",").cast("array<long>") for i in range(2))
    same = lambda i: F.get(places, i) == F.col("place")
    begun = lambda i: (F.get(places, i) < F.col("place")) | (same(i) & (F.get(ties, i) <= F.col("tie")))
    halving = F.array(*[F.lit(1 << i) for i in reversed(range(len(firsts).bit_length()))])
    found = docs.withColumn("own", F.coalesce(F.aggregate(halving, F.lit(0), lambda at, step: F.when(begun(at + step), at + step).otherwise(at)), F.lit(0)))
    own = F.struct(F.col("own").alias("chunk"), F.lit(0).alias("ghost"))
    ghost = F.struct(F.when(F.col("own") > 0, F.col("own") - 1).otherwise(len(firsts) - 1).alias("chunk"), F.lit(1).alias("ghost"))
    first = same(F.col("own")) & (F.get(ties, F.col("own")) == F.col("tie"))
    return (found.withColumn("in", F.explode(F.when(first, F.array(own, ghost)).otherwise(F.array(own))))
            .select("in.chunk", "in.ghost", "place", "tie", "text"))


def compare_neighbours(documents: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Places ascend where ids descend.
    place = F.bitwise_not(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)))
    docs = documents.select(place.alias("place"), F.xxhash64(text).alias("tie"), text.alias("text"))
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    tasks = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * total // TASK_BYTES))
    keys = ["chunk", "ghost", "place", "tie"]
    in_order = Window.partitionBy("chunk").orderBy("ghost", "place", "tie")
    # One exchange of the texts serves both uses below, as neither needs more columns than the other.
    own = dealt(docs, tasks).repartition(tasks, "chunk").groupBy(*keys).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("rows"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left(F.coalesce(F.lead("text").over(in_order), F.lit("")), half))
    both = own.select(*keys, "rows", "text", edited.alias("edited"))
    facts = both.select(*keys, "rows", F.char_length("text").cast("long").alias("n_chars"),
                        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "text", "edited")
    drawn = _stored_by_chunk(_open_texts(facts.join(_both(both, keys, samples, DARTS), keys, "left"), samples), "prints")
    darts, rounds = DARTS, [drawn.drop("text", "edited")]
    rest = drawn.filter("text IS NOT NULL")
    while not rest.isEmpty():
        darts *= 4
        again = rest.drop("own", "changed").repartition(tasks, *keys)
        drawn = stored(_open_texts(again.join(_both(again, keys, samples, darts), keys, "left"), samples), "prints")
        rounds.append(drawn.drop("text", "edited"))
        rest = drawn.filter("text IS NOT NULL")
    known = reduce(DataFrame.unionByName, rounds).filter(~_lacks())
    beside = known.withColumn("next_own", F.lead("own").over(in_order)).filter("ghost = 0").withColumn("doc_id", F.bitwise_not("place"))
    return (beside.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
            .select(F.when(F.col("doc_id") != LOWEST, F.col("doc_id")).alias("doc_id"), "n_chars", "edited_sha256", as_text("own").alias("fingerprint"), as_text("changed").alias("edited_fingerprint"),
                    likeness("own", "changed").alias("near_edited"), likeness("own", "next_own").alias("near_next")))


def _stored_by_chunk(df: DataFrame, label: str) -> DataFrame:
    """Stored; a join of rows that lie by chunk, on more keys than that, moves none of them."""
    conf, name = df.sparkSession.conf, "spark.sql.requireAllClusterKeysForCoPartition"
    before = conf.get(name, "true")
    conf.set(name, "false")
    try:
        return stored(df, label)
    finally:
        conf.set(name, before)


def _both(texts: DataFrame, keys: list[str], samples: int, darts: int) -> DataFrame:
    """``keys, own, changed``: the samples of a document's text and of its edited text, in one row and still one partitioning."""
    versions = texts.select(*keys, F.explode(F.array(F.struct(F.lit(0).alias("v"), F.col("text")), F.struct(F.lit(1).alias("v"), F.col("edited").alias("text")))).alias("x"))
    prints = fingerprints(versions.select(*keys, "x.v", "x.text"), [*keys, "v"], samples, darts)
    return prints.groupBy(*keys).agg(F.max(F.when(F.col("v") == 0, F.col("samples"))).alias("own"), F.max(F.when(F.col("v") == 1, F.col("samples"))).alias("changed"))


def _open_texts(joined: DataFrame, samples: int) -> DataFrame:
    """Texts without words get their fingerprint; ``text`` and ``edited`` stay only where a sample is null."""
    of = lambda c, text: F.coalesce(c, F.array_repeat(F.when(F.col(text).rlike(WORD), F.lit(None)).otherwise(F.lit(0)).cast("int"), samples))
    done = joined.withColumns({"own": of("own", "text"), "changed": of("changed", "edited")})
    return done.withColumns({c: F.when(_lacks(), F.col(c)) for c in ("text", "edited")})


def _lacks():
    return F.exists(F.concat("own", "changed"), lambda x: x.isNull())
