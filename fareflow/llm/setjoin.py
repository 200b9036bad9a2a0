"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is the set of its different 5-word shingles. Sets are ordered by one
global order, rare shingles first. Two sets that reach the threshold share at
least l shingles within their first ``size - ceil(t * size) + l`` ones, for every
l. Each document picks its own l by estimated cost: a longer prefix means more
entries to scan, but only partners that share l of them need verification. A pair
is verified when it shares as many prefix shingles as the smaller l of the two.

Documents with equal sets are one node, so copies never meet. Two rounds find the
links between nodes:

1. Each prefix shingle links its nodes to one hub, the node whose shingles are
   the most frequent on average. That is linear in the entries and joins a group of
   near copies through its common origin.
2. Where a prefix shingle still holds nodes of different components, pairs across
   components are compared, whoever the hub was, unless the shingle's places in both
   sets or the sets' parities rule the pair out. Links inside a component cannot
   change it, so no pair is lost for the components.

A set's parities are one bit per hash cell. Two sets that differ in d shingles differ in no
more than d bits, so a pair that they rule out is below the threshold.

Shingle frequencies come from counts over all documents in 2^``SKETCH_BITS``
hashed cells. They order shingles and estimate cost; any order gives the same
result. Shingles and sets are compared as 64-bit numbers.

* null or empty text, or only white space: no shingles, linked with nothing.
* one to four words: the whole sequence is the one shingle.
* null doc_id: takes part; a component's smallest id ignores nulls, and is null if all are.
* equal doc_ids and repeated rows: each row is returned with its component.
* an empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import stored
from fareflow.llm.components import components
from fareflow.llm.decontam import bit_filter, in_filter, slices
from fareflow.llm.tokens import distinct, mix, shingles, within, words

SHINGLE = 5
PERCENT = 80
#: Cells of the sketch: 16 MB to broadcast at every input size.
SKETCH_BITS = 21
#: Cells that travel as one row.
CELLS = 1 << 13
LONGEST = 4
#: 64-bit words of a set's parities.
PARITY_WORDS = 8
PARITIES = [f"bits{i}" for i in range(PARITY_WORDS)]
#: Cost of verifying a pair against that of scanning one prefix entry.
VERIFY = 8.0
#: A shingle expected in more entries than this is split.
SPLIT = 100_000

META_SCHEMA = "doc_id long, tie long, n_shingles long, node long, part int, seen binary, " + ", ".join(f"{c} long" for c in PARITIES)
ENTRY_SCHEMA = "shingle long, salt int, salts int, place int, node long, size int, need int, early boolean, at int"


def shingle_sets(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (document, shingle) pairs of a text column, sorted, and the size of each set."""
    found = words(column, lower=True)
    whole = within(found.doc, SHINGLE)
    doc, number = found.doc[:len(whole)][whole], shingles(found.number, SHINGLE)[whole]
    lengths = np.diff(found.first)
    for n in range(1, SHINGLE):
        short = np.flatnonzero(lengths == n)
        if len(short):
            starts = found.first[short]
            doc = np.concatenate([doc, short.astype(np.int32)])
            number = np.concatenate([number, shingles(found.number, n)[starts]])
    doc, number = distinct(doc, number)
    return doc, number, np.bincount(doc, minlength=len(lengths))


def node_of(doc: np.ndarray, number: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A number of each set."""
    total = np.zeros(len(sizes), np.uint64)
    if len(doc):
        new = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        total[doc[new]] = np.add.reduceat(mix(number), new)
    return mix(total + sizes.astype(np.uint64)).view(np.int64)


def parities(doc: np.ndarray, number: np.ndarray, n: int) -> list[np.ndarray]:
    """For each of ``n`` sets the parities of its shingles, a word per array."""
    wide = 64 * PARITY_WORDS
    cell = (mix(number) % np.uint64(wide)).astype(np.int64)
    odd = np.zeros((n, PARITY_WORDS), np.int64)
    for start in range(0, n, 4096):  # a cell is a number of 8 bytes while it is counted
        a, b = np.searchsorted(doc, [start, start + 4096])
        rows = min(4096, n - start)
        counts = np.bincount((doc[a:b].astype(np.int64) - start) * wide + cell[a:b], minlength=rows * wide)
        odd[start:start + rows] = np.packbits((counts & 1).astype(bool)).reshape(rows, -1).view(np.int64)
    return list(odd.T)


def measure(documents: DataFrame) -> DataFrame:
    """Per document its set's size, number and parities; per task the sketch of its shingles (rows with ``part``)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)

        names = ["doc_id", "tie", "n_shingles", "node", "part", "seen", *PARITIES]

        for batch in batches:
            for part in slices(batch):
                doc, number, sizes = shingle_sets(part.column("text"))
                sketch += np.bincount((number & np.uint64(len(sketch) - 1)).astype(np.int64), minlength=len(sketch))
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("tie"), pa.array(sizes, pa.int64()), pa.array(node_of(doc, number, sizes)),
                                                  pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                                                  *[pa.array(np.ascontiguousarray(w)) for w in parities(doc, number, n)]], names)
        parts = sketch.reshape(-1, CELLS)
        used = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([*[pa.nulls(len(used), pa.int64())] * 4, pa.array(used, pa.int32()),
                                          pa.array([zlib.compress(parts[i].tobytes(), 1) for i in used], pa.binary()),
                                          *[pa.nulls(len(used), pa.int64())] * PARITY_WORDS], names)

    return documents.mapInArrow(rows, META_SCHEMA)


def sketch_of(measured: DataFrame) -> np.ndarray:
    """The sum of all tasks' sketches. A task adds up its parts as they come, one array per part."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, seen in zip(batch.column("part").to_pylist(), batch.column("seen")):
                counts = np.frombuffer(zlib.decompress(seen.as_py()), np.int64)
                sums[part] = sums[part] + counts if part in sums else counts
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([c.tobytes() for c in sums.values()], pa.binary())], ["part", "seen"])

    parts = measured.filter("part IS NOT NULL").select("part", "seen").repartition("part").mapInArrow(add, "part int, seen binary").collect()
    sketch = np.zeros((1 << SKETCH_BITS) // CELLS * CELLS, np.int64)
    for r in parts:
        sketch[r.part * CELLS:(r.part + 1) * CELLS] = np.frombuffer(r.seen, np.int64)
    return sketch


def prefix_entries(documents: DataFrame, sketch: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """The prefix of every set, one row per shingle."""
    shared = documents.sparkSession.sparkContext.broadcast(sketch)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        excess = np.maximum(counts - counts.mean(), 0) + 1.0
        for batch in batches:
            for part in slices(batch):
                doc, number, sizes = shingle_sets(part.column("text"))
                if not len(doc):
                    continue
                node = node_of(doc, number, sizes)
                cell = (number & np.uint64(len(counts) - 1)).astype(np.int64)
                order = np.lexsort((number, counts[cell], doc))
                number, cell = number[order], cell[order]
                first = np.concatenate([[0], np.cumsum(sizes)])
                alpha = -(-sizes * percent // 100)
                one = sizes - alpha + 1
                weight = np.concatenate([[0.0], np.cumsum(excess[cell])])
                # Cost of each l: entries scanned, and pairs that may share l of them.
                cost = np.full((LONGEST, len(sizes)), np.inf)
                for l in range(1, LONGEST + 1):
                    fits = (l <= alpha) & (sizes > 0)
                    stop = first[:-1] + np.minimum(one + l - 1, sizes)
                    cost[l - 1] = np.where(fits, (weight[stop] - weight[first[:-1]]) * (1 + VERIFY / l), np.inf)
                need = cost.argmin(axis=0) + 1
                length = np.where(sizes > 0, np.minimum(one + need - 1, sizes), 0)
                usual = np.log(excess[cell])
                centre = np.bincount(doc, usual, len(sizes)) / np.maximum(sizes, 1)
                place = (-1_000_000 * centre).astype(np.int32)
                position = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                at = np.repeat(first[:-1], length) + position
                owner = np.repeat(np.arange(len(sizes)), length)
                # Against a partner of its size or larger, a set needs still fewer of its first shingles.
                overlap = -(-sizes * 2 * percent // (100 + percent))
                early = position < (sizes - overlap + need)[owner]
                # Copies inside the slice send their prefix once.
                _, once = np.unique(node, return_index=True)
                keep = np.isin(owner, once)
                at, owner, early, position = at[keep], owner[keep], early[keep], position[keep]
                salts = (1 + excess[cell[at]] // SPLIT).astype(np.int32)
                salt = (mix(node[owner].view(np.uint64)) % salts.astype(np.uint64)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(number[at].view(np.int64)), pa.array(salt), pa.array(salts), pa.array(place[owner]),
                                                  pa.array(node[owner]), pa.array(sizes[owner].astype(np.int32)), pa.array(need[owner].astype(np.int32)), pa.array(early),
                                                  pa.array(position.astype(np.int32))],
                                                 [f.strip().split(" ")[0] for f in ENTRY_SCHEMA.split(",")])

    return documents.mapInArrow(rows, ENTRY_SCHEMA)


SHARED_SCHEMA = ENTRY_SCHEMA + ", hub long, hub_size int, hub_need int"


def shared_entries(entries: DataFrame) -> DataFrame:
    """Entries whose shingle another node has too, each with the hub of its (shingle, salt).

    Rows arrive sorted; a run of one shingle may span batches and is never held
    whole. Of a split shingle the hubs are kept even when alone.
    """
    names = [f.strip().split(" ")[0] for f in ENTRY_SCHEMA.split(",")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # last run: its hub's row, and whether that row is still to be given out
        for batch in batches:
            columns = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
            waiting = False
            if held is not None:
                row, waiting = held
                columns = {n: np.concatenate([row[n], columns[n]]) for n in names}
            n = len(columns["node"])
            if not n:
                continue
            key, salt, node = columns["shingle"], columns["salt"], columns["node"]
            new_run = np.ones(n, bool)
            new_run[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
            new_node = new_run.copy()
            new_node[1:] |= node[1:] != node[:-1]  # copies from other slices
            starts = np.flatnonzero(new_run)
            run = np.cumsum(new_run) - 1
            hub = starts[run]
            several = np.bincount(run, new_node)[run] >= 2
            give = new_node & (several | (columns["salts"] > 1))
            last = starts[-1]
            if held is not None and not waiting:
                give[0] = False
            # A last run of one node may go on in the next batch.
            wait = bool(not give[last] and not (last == 0 and held is not None and not waiting))
            held = {c: columns[c][last:last + 1] for c in names}, wait
            at, of = np.flatnonzero(give), hub[give]
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[c][at]) for c in names] + [pa.array(columns[c][of]) for c in ("node", "size", "need")],
                    names + ["hub", "hub_size", "hub_need"])

    spread = entries.repartition("shingle", "salt").sortWithinPartitions("shingle", "salt", "place", "node")
    return spread.mapInArrow(rows, SHARED_SCHEMA)


def sets_of(documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, members``: the set of each wanted node, once."""
    wanted = documents.sparkSession.sparkContext.broadcast(bit_filter(nodes.select(F.col("node").alias("number"))))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                doc, number, sizes = shingle_sets(part.column("text"))
                node = node_of(doc, number, sizes)
                first = np.concatenate([[0], np.cumsum(sizes)])
                _, once = np.unique(node, return_index=True)
                once = once[in_filter(node[once].view(np.uint64), wanted.value) & (sizes[once] > 0)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[once]), pa.array([number[first[i]:first[i + 1]].view(np.int64) for i in once], pa.list_(pa.int64()))], ["node", "members"])

    found = documents.mapInArrow(rows, "node long, members array<bigint>")
    return found.groupBy("node").agg(F.first("members").alias("members")).join(nodes, "node", "left_semi")


def nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``a, b`` whose sets reach the threshold."""
    one = sets.select(F.col("node").alias("a"), F.col("members").alias("of_a"))
    two = sets.select(F.col("node").alias("b"), F.col("members").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    return (pairs.join(one, "a").join(two, "b")
            .filter(100 * both >= percent * (F.size("of_a") + F.size("of_b") - both)).select("a", "b"))


def links(documents: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """``doc_id, tie, n_shingles, node`` of each document, and links ``a, b`` between nodes."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), _tie(F.col("text")).alias("tie"))
    measured = stored(measure(docs), "measured")
    meta = measured.filter("part IS NULL").select("doc_id", "tie", "n_shingles", "node")
    shared = stored(shared_entries(prefix_entries(docs, sketch_of(measured), percent)), "shared")
    fits = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent

    # Round 1: every node against its hubs; hubs of a split shingle against one of them.
    to_hub = shared.filter("node <> hub").select("node", "size", "need", "hub", "hub_size", "hub_need")
    tops = shared.filter("salts > 1 AND node = hub")
    best = tops.groupBy("shingle").agg(F.min(F.struct("place", F.col("node").alias("hub"), F.col("size").alias("hub_size"), F.col("need").alias("hub_need"))).alias("best"))
    across = tops.select("shingle", "node", "size", "need").join(best, "shingle").select("node", "size", "need", "best.hub", "best.hub_size", "best.hub_need").filter("node <> hub")
    pairs = stored(to_hub.unionByName(across).filter(fits(F.col("size"), F.col("hub_size")))
                   .groupBy(F.col("node").alias("a"), F.col("hub").alias("b"))
                   .agg(F.count(F.lit(1)).alias("shared"), F.max(F.least("need", "hub_need")).alias("least"))
                   .filter(F.col("shared") >= F.col("least")).select("a", "b"), "pairs")
    first = stored(verified(pairs, stored(sets_of(docs, nodes_of(pairs)), "sets"), percent), "links")
    roots = stored(components(first), "roots")

    # Round 2: pairs across components.
    placed = (shared.select("shingle", "node", "size", "need", "early", "at").join(roots, "node", "left")
              .withColumn("root", F.coalesce("root", "node")))
    mixed = placed.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x < y").select("shingle")
    of_node = measured.filter("part IS NULL").groupBy("node").agg(*[F.max(c).alias(c) for c in PARITIES])
    placed = stored(placed.join(mixed, "shingle", "left_semi").join(of_node, "node"), "placed")
    # Of two sets the smaller one's shingle has to be early; sets far below the threshold then never meet.
    left = placed.filter("early").select("shingle", *[F.col(c).alias(f"l_{c}") for c in ("node", "size", "need", "root", "at", *PARITIES)])
    smaller = (F.col("l_size") < F.col("size")) | ((F.col("l_size") == F.col("size")) & (F.col("l_node") < F.col("node")))
    # Both sets hold their shingles in one order, so where a shared one stands bounds how many they can share in all.
    most = F.least("l_at", "at") + F.least(F.col("l_size") - F.col("l_at"), F.col("size") - F.col("at"))
    enough = most * (100 + percent) >= (F.col("l_size") + F.col("size")) * percent
    # Of sets at the threshold, at most (100 - percent) / (100 + percent) of the shingles are in one of them only.
    differ = reduce(add, [F.bit_count(F.col(f"l_{c}").bitwiseXOR(F.col(c))) for c in PARITIES])
    alike = differ * (100 + percent) <= (F.col("l_size") + F.col("size")) * (100 - percent)
    met = (left.join(placed, "shingle").filter((F.col("l_root") != F.col("root")) & smaller & fits(F.col("size"), F.col("l_size")) & enough & alike)
           .groupBy(F.greatest("l_node", "node").alias("a"), F.least("l_node", "node").alias("b"))
           .agg(F.count(F.lit(1)).alias("shared"), F.max(F.least("need", "l_need")).alias("least"))
           .filter(F.col("shared") >= F.col("least")).select("a", "b"))
    done = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    met = stored(met.join(done, ["a", "b"], "left_anti"), "pairs")
    second = stored(verified(met, stored(sets_of(docs, nodes_of(met)), "sets"), percent), "links")
    return meta, first.unionByName(second)


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, node`` per document."""
    placed, empty = _placed(documents, percent)
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    alone = empty.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "node")
    return placed.join(least, "root").select("doc_id", "n_shingles", "component_id", "node").unionByName(alone)


def _placed(documents: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Documents with shingles and the root of their component; documents without."""
    meta, found = links(documents, percent)
    roots = stored(components(found), "roots")
    full = meta.filter("n_shingles > 0").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return stored(full, "placed"), meta.filter("n_shingles = 0")


def _rank(doc_id):
    return F.coalesce(doc_id, F.lit(2**63 - 1))


def _tie(text):
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def one_of_each(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One document of every component, all columns kept: the one with the smallest doc_id, nulls
    last, then by a hash of its text. Documents without shingles stay; of rows equal in doc_id and
    text any one stays."""
    placed, empty = _placed(documents, percent)
    name = F.struct(_rank(F.col("doc_id")).alias("k"), "tie")
    kept = placed.groupBy("root").agg(F.min(name).alias("first")).select("first.k", "first.tie")
    kept = kept.unionByName(empty.select(_rank(F.col("doc_id")).alias("k"), "tie").distinct())
    keyed = documents.withColumns({"__k": _rank(F.col("doc_id").cast("long")), "__tie": _tie(F.col("text"))})
    kept = kept.withColumnsRenamed({"k": "__keep_k", "tie": "__keep_tie"})
    same = (F.col("__k") == F.col("__keep_k")) & (F.col("__tie") == F.col("__keep_tie"))
    return keyed.join(kept, same, "left_semi").dropDuplicates(["__k", "__tie"]).select(*documents.columns)
