"""Benchmark items inside documents, by size-partitioned MinHash containment search.

An item is a set of 5-word shingles, A-Z lower-cased; one with fewer words is a
single shingle of all its words. Items are partitioned by size into classes
(S/2, S], S a power of two. For each class a document is cut into windows of 2S
shingles, one starting every S, so an item's passage lies whole in one window and
fills at least a fifth of it: that bounds the Jaccard similarity of item and
window from below however long the document is. ``HASHES`` minima of each window
are compared with the items' minima of its class; two equal ones make the
document a candidate, which misses a passage at the bound with a chance of about
5e-4. Candidates are verified on exact shingle containment over the whole
document. Items of fewer than ``SMALL`` shingles skip the minima: every document
with one of their shingles is a candidate.

Tasks get bit filters of the items' numbers. Their size depends on the number of
items alone and ends at 2^``MAX_FILTER_BITS`` bits; a full filter lets more
rows through to the joins and changes no result.

* null or empty item: matches nothing. Null or empty document: contains nothing.
* repeated items and items with equal ids: each text searched on its own, reported per item_id.
* documents with equal ids (or null ids): reported once, with the largest containment.
* empty tables: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import stored
from fareflow.llm.tokens import distinct, mix, shingles, within, words

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 48
SMALL = 8
MIN_FILTER_BITS, MAX_FILTER_BITS = 16, 24
#: Text is searched in slices of this many bytes, or one document if that is longer.
SLICE_BYTES = 1 << 20

MASKS = np.random.Generator(np.random.PCG64(11)).integers(0, 2**64, HASHES, dtype=np.uint64)


def size_class(n: int) -> int:
    """The power of two that bounds a set of ``n`` shingles; 0 for small sets."""
    return 0 if n < SMALL else 1 << (n - 1).bit_length()


def keyed(minima: np.ndarray, size: int) -> np.ndarray:
    """Numbers of (class, hash function, minimum)."""
    return mix(minima ^ mix(np.arange(HASHES, dtype=np.uint64) + np.uint64(size * HASHES)))


def item_table(benchmark: DataFrame) -> DataFrame:
    """Per item text: ``item_key, item_id, words (of a shingle), size, class, shingles, minima``."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = words(batch.column("text"), lower=True)
            out = []
            for i in range(batch.num_rows):
                number = found.number[found.first[i]:found.first[i + 1]]
                if not len(number):
                    continue
                length = min(SHINGLE, len(number))
                parts = np.unique(shingles(number, length))
                size = size_class(len(parts)) if length == SHINGLE else 0
                minima = keyed((parts[:, None] ^ MASKS).min(axis=0), size) if size else parts[:0]
                out.append((batch.column("item_key")[i].as_py(), batch.column("item_id")[i].as_py(), length, len(parts),
                            size, parts.view(np.int64), minima.view(np.int64)))
            columns = list(zip(*out)) or [[]] * 7
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["item_key", "item_id", "words", "size", "class", "shingles", "minima"])

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    return stored(items.withColumn("item_key", F.xxhash64("item_id", "text")).mapInArrow(
        rows, "item_key long, item_id long, words int, size int, class int, shingles array<bigint>, minima array<bigint>"), "items")


def bit_filter(numbers: DataFrame) -> np.ndarray:
    """A bit set of the low bits of ``number``, about 64 bits for each up to the maximum size."""
    n = numbers.count()
    bits = min(max(MIN_FILTER_BITS, (64 * n).bit_length()), MAX_FILTER_BITS)
    at = F.col("number").bitwiseAND(F.lit((1 << bits) - 1))
    cells = (numbers.select(F.shiftright(at, 3).cast("int").alias("cell"), F.expr("shiftleft(1, CAST(number & 7 AS INT))").alias("bit"))
             .groupBy("cell").agg(F.bit_or("bit").alias("bits")).toPandas())
    out = np.zeros(1 << (bits - 3), np.uint8)
    out[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return out


def in_filter(numbers: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = numbers & np.uint64(8 * len(bits) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` bytes of text."""
    import pyarrow.compute as pc
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def window_minima(number: np.ndarray, first: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per class: (S, document of each window, minima of each window), over shingles
    whose documents start at ``first``. Chunks of the smallest S are reduced once;
    each larger class takes the minima of whole chunks."""
    starts, doc, minima, step = None, None, None, 0
    for size in sizes:
        if minima is None:
            lengths = np.diff(first)
            chunks = -(-lengths // size)
            doc = np.repeat(np.arange(len(lengths)), chunks)
            starts = first[doc] + size * (np.arange(len(doc)) - np.repeat(np.cumsum(chunks) - chunks, chunks))
            if not len(starts):
                return
            minima = np.stack([np.minimum.reduceat(number ^ m, starts) for m in MASKS], axis=1)
        else:
            new = np.ones(len(doc), bool)
            new[1:] = doc[1:] != doc[:-1]
            group_start = np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))
            heads = np.flatnonzero((np.arange(len(doc)) - group_start) % (size // step) == 0)
            minima, doc = np.minimum.reduceat(minima, heads, axis=0), doc[heads]
        step = size
        window = minima.copy()
        same = doc[1:] == doc[:-1]
        window[:-1][same] = np.minimum(minima[:-1][same], minima[1:][same])
        yield size, doc, window


def search(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Rows ``doc_id, text_key, kind, number``: equal minima of candidate windows (kind 0), and the
    shingles that candidates (1) or any documents (2, for small items) may share with items."""
    spark = documents.sparkSession
    sizes = sorted(r[0] for r in items.filter("class > 0").select("class").distinct().collect())
    short = sorted(r[0] for r in items.filter("class = 0").select("words").distinct().collect())
    explode = lambda name, only: items.filter(only).select(F.explode(name).alias("number")).distinct()
    filters = spark.sparkContext.broadcast((bit_filter(explode("minima", "class > 0")), bit_filter(explode("shingles", "class > 0")),
                                            bit_filter(explode("shingles", "class = 0"))))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima_bits, shingle_bits, small_bits = filters.value
        for batch in batches:
            for part in slices(batch):
                found = words(part.column("text"), lower=True)
                docs, kinds, numbers = [], [], []

                def add(doc, number, kind):
                    doc, number = distinct(doc, number)
                    docs.append(doc), numbers.append(number), kinds.append(np.full(len(doc), kind, np.int32))

                whole = within(found.doc, SHINGLE)
                number, doc = shingles(found.number, SHINGLE)[whole], found.doc[:len(whole)][whole]
                first = np.searchsorted(doc, np.arange(part.num_rows + 1))
                candidate = np.zeros(part.num_rows, bool)
                for size, window_doc, minima in window_minima(number, first, sizes) if len(number) else ():
                    key = keyed(minima, size)
                    hit = in_filter(key, minima_bits)
                    hit &= (hit.sum(axis=1) >= 2)[:, None]
                    if hit.any():
                        at = np.nonzero(hit)
                        candidate[window_doc[at[0]]] = True
                        add(window_doc[at[0]].astype(np.int32), key[at], 0)
                shared = np.flatnonzero(candidate[doc])
                shared = shared[in_filter(number[shared], shingle_bits)]
                add(doc[shared], number[shared], 1)
                for length in short:
                    whole = within(found.doc, length)
                    small = shingles(found.number, length)
                    at = np.flatnonzero(whole & in_filter(small, small_bits))
                    add(found.doc[at], small[at], 2)
                where = np.concatenate(docs).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(where)), part.column("text_key").take(pa.array(where)),
                     pa.array(np.concatenate(kinds)), pa.array(np.concatenate(numbers).view(np.int64))],
                    ["doc_id", "text_key", "kind", "number"])

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                            F.xxhash64("text").alias("text_key"))
    return docs.mapInArrow(rows, "doc_id long, text_key long, kind int, number long")


def contained(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared, containment`` for each item whose shingles are in
    a document to at least ``threshold``."""
    items = item_table(benchmark)
    hits = stored(search(documents, items).distinct(), "hits")  # rows equal in id and text count once
    pair = ["doc_id", "text_key", "item_key"]
    minima = items.select("item_key", F.explode("minima").alias("number"))
    # Two equal minima, as in the search, but now of one item.
    candidates = hits.filter("kind = 0").join(minima, "number").groupBy(*pair).agg(F.count(F.lit(1)).alias("equal")).filter("equal >= 2")
    sets = items.select("item_key", "class", F.explode("shingles").alias("number"))
    counted = (hits.filter("kind > 0").withColumn("small", F.col("kind") == 2)
               .join(sets.withColumn("small", F.col("class") == 0), ["number", "small"])
               .groupBy(*pair, "small").agg(F.count(F.lit(1)).alias("n_shared")))
    same = [counted["doc_id"].eqNullSafe(candidates["doc_id"]), counted["text_key"] == candidates["text_key"],
            counted["item_key"] == candidates["item_key"]]
    kept = counted.filter("small").unionByName(counted.filter("NOT small").join(candidates, same, "left_semi"))
    share = F.col("n_shared") / F.col("size")
    return (kept.join(items.select("item_key", "item_id", "size"), "item_key").filter(share >= threshold)
            .groupBy("doc_id", "item_id").agg(F.max(F.struct(share.alias("containment"), F.col("size").cast("long").alias("n_shingles"), "n_shared")).alias("best"))
            .select("doc_id", "item_id", "best.n_shingles", "best.n_shared", "best.containment"))


def without_leaks(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that contain no item."""
    bad = contained(documents, benchmark, threshold).select(F.col("doc_id").alias("__leak_id")).distinct()
    return documents.join(bad, documents["doc_id"].cast("long").eqNullSafe(F.col("__leak_id")), "left_anti")
