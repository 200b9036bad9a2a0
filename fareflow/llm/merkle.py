"""A Merkle manifest of the documents, checked with one octopus multiproof per leaf partition.

Every document is a leaf, ``sha256`` over its fields. The leaves of a language, in
order of doc_id, form a binary tree; the roots of the languages, in order, form the
tree above. A node is the hash of its one or two children, all as lower-case hex.

Leaves are sorted over the cluster into partitions of about ``LEAVES`` consecutive
ones. Each partition folds what lies wholly inside it and gives out only the tops of
that; ``_stitched`` joins these across partitions, ``STEP`` levels per round, in
groups of at most 2^STEP nodes. All other nodes live in their partition alone, so the
node table has some dozens of rows per partition, not two per document.

For the proofs each partition names the least set of nodes that it needs and cannot
compute (the siblings along the edges of its range, level by level), fetches them in
one join, derives every inner node above its leaves once, and expands from these
the proof of each leaf. The tree above is handled alike; of it all nodes are kept.

Defined results: a null field counts as ``-``; an empty text as ``0:``. Rows with
equal or null doc_id are leaves of their own, nulls first, equal ids in order of the
leaf's hash; rows equal in every field have equal leaves and take each other's places
in any order. A lone leaf is its language's root, a lone language's root the root. A
leaf without siblings has the hash of nothing as proof. An empty table yields no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import stored

#: Leaves that one partition holds in memory.
LEAVES = 50_000
#: Levels that one round joins across partitions.
STEP = 12
#: Number of the tree above the languages.
ABOVE = -1
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree bigint, level int, at bigint, hash string"


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per document: its place in the trees, its proof, and whether the leaf as
    it is now, ``n_chars`` being one larger where ``tampered`` holds, still leads to the root."""
    if tampered is None:
        tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    leaves = stored(docs.select("doc_id", "lang", leaf_hash().alias("leaf"),
                                leaf_hash(n_chars=changed).alias("found")), "leaves")
    placed, spans = numbered(leaves, ["lang"], ["doc_id", "leaf"])
    trees, above = numbered(spans.select("lang").distinct(), [], ["lang"])
    # Languages get the number of their place; their spans carry it from here on.
    start = above.select(F.col("part").alias("__part"), F.col("start").alias("__start"), F.col("n").alias("trees"))
    trees = trees.join(start, F.col("part") == F.col("__part")).select(
        F.col("lang").alias("__lang"), (F.col("__start") + F.col("row")).alias("tree"), "trees")
    spans = stored(spans.join(trees, F.col("lang").eqNullSafe(F.col("__lang"))).drop("__lang"), "spans")

    of_spans = spans.select("part", "tree", "trees", "first", F.col("start"), F.col("size"), F.col("n"))
    mine = placed.select("part", "row", "doc_id", "leaf", "found")
    nodes = stored(_stitched(_tops(mine, of_spans), spans), "nodes")
    roots = nodes.join(spans.select(F.col("tree"), _height(F.col("n")).alias("level")).distinct(),
                       ["tree", "level"])
    upper = stored(_all_above(roots.select("tree", "hash")), "upper")

    wanted = of_spans.groupBy("part").applyInArrow(_lacking, "part bigint, tree bigint, level int, at bigint")
    fetched = wanted.join(nodes.unionByName(upper), ["tree", "level", "at"])
    empty = [F.lit(None).cast("bigint").alias(c) for c in ("trees", "first", "start", "size", "n")]
    known = fetched.select("part", "tree", "level", "at", "hash", *empty).unionByName(of_spans.select(
        "part", "tree", F.lit(None).cast("int").alias("level"), F.lit(None).cast("bigint").alias("at"),
        F.lit(None).cast("string").alias("hash"), "trees", "first", "start", "size", "n"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return mine.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(
        _proofs, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
                 "folded_root string, verified boolean")


def leaf_hash(n_chars: Column | None = None) -> Column:
    def field(name: str) -> Column:
        value = (n_chars if name == "n_chars" and n_chars is not None else F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(field, FIELDS)).cast("binary"), 256)


def numbered(df: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows in order over the cluster, and where each partition's run of a group begins.

    Rows gain ``part`` and ``row``, their place within it. Spans have one row per part
    and group: ``first``, the row at which it begins, ``start``, how many rows of the group
    come before, ``size`` and the group's total ``n``.
    """
    keys = [F.col(c).asc_nulls_first() for c in group + order]
    parts = max(1, -(-df.count() // LEAVES))
    at = F.monotonically_increasing_id()  # partition and row within it
    placed = (df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
              .withColumn("part", F.shiftright(at, 33)).withColumn("row", at.bitwiseAND((1 << 33) - 1)))
    placed = stored(placed, "numbered")
    sizes = placed.groupBy("part", *group).agg(F.min("row").alias("first"), F.count("*").alias("size"))
    # A row per part and group: few however large the group.
    run = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = run.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return placed, sizes.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0))).withColumn(
        "n", F.sum("size").over(run))


# -- nodes -------------------------------------------------------------------

def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def widths(n: int) -> list[int]:
    """Nodes per level, the leaves first."""
    out = [n]
    while out[-1] > 1:
        out.append((out[-1] + 1) // 2)
    return out


def fold(level: dict[int, str], width: int) -> dict[int, str]:
    """The parents whose children are all there."""
    up = {}
    for at, value in level.items():
        if at % 2 == 0:
            if at + 1 == width:
                up[at // 2] = digest(value)
            elif at + 1 in level:
                up[at // 2] = digest(value + level[at + 1])
    return up


def octopus(places: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """Per level, the nodes that proofs of all these leaves need and the leaves do not give."""
    lacking = []
    for width in sizes[:-1]:
        beside = places ^ 1
        lacking.append(np.setdiff1d(beside[beside < width], places))
        places = np.unique(places >> 1)
    return lacking


def _spans_of(table: pa.Table) -> list[dict]:
    return sorted(table.select(["tree", "trees", "first", "start", "size", "n"]).to_pylist(), key=lambda s: s["first"])


def _node_table(rows: list[tuple], schema: str = NODE) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(fields)})


def _height(n: Column) -> Column:
    """The number of levels above the leaves: the binary digits of n - 1."""
    return F.when(n == 1, 0).otherwise(F.length(F.bin(n - 1))).cast("int")


def _tops(leaves: DataFrame, spans: DataFrame) -> DataFrame:
    """Nodes wholly inside one partition whose parent is not."""

    def run(rows: pa.Table, known: pa.Table) -> pa.Table:
        hashes = rows.sort_by("row").column("leaf").to_pylist()
        out = []
        for s in _spans_of(known):
            level = {s["start"] + i: h for i, h in enumerate(hashes[s["first"]:s["first"] + s["size"]])}
            for depth, width in enumerate(widths(s["n"])):
                up = fold(level, width) if width > 1 else {}
                out += [(s["tree"], depth, at, h) for at, h in level.items() if at >> 1 not in up]
                level = up
        return _node_table(out)

    return leaves.groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(run, NODE)


def _join_up(end: int):
    """From tops of neighbouring partitions to the nodes above them, up to a level."""

    def run(table: pa.Table) -> pa.Table:
        tree, n = table.column("tree")[0].as_py(), table.column("n")[0].as_py()
        levels: dict[int, dict[int, str]] = {}
        for depth, at, value in zip(*[table.column(c).to_pylist() for c in ("level", "at", "hash")]):
            levels.setdefault(depth, {})[at] = value
        new = []
        for depth, width in list(enumerate(widths(n)))[min(levels):end]:
            if width > 1:
                up = fold(levels.get(depth, {}), width)
                levels.setdefault(depth + 1, {}).update(up)
                new += [(tree, depth + 1, at, h, n) for at, h in up.items()]
        return _node_table(new, NODE + ", n bigint")

    return run


def _stitched(tops: DataFrame, spans: DataFrame) -> DataFrame:
    """The partitions' tops and all nodes above them, up to the languages' roots."""
    size = spans.select("tree", "n").distinct()
    height = size.agg(F.max("n")).first()[0]
    rounds = -(-(len(widths(height or 1)) - 1) // STEP)
    done, open_nodes = None, tops.join(size, "tree")
    for r in range(rounds):
        end = (r + 1) * STEP

        below = open_nodes.filter(F.col("level") < end)
        group = F.expr(f"shiftright(at, {end} - level)").alias("above")
        new = stored(below.groupBy("tree", group).applyInArrow(_join_up(end), NODE + ", n bigint"), "joined")
        done = below if done is None else done.unionByName(below)
        done = done.unionByName(new.filter(F.col("level") < end))
        open_nodes = open_nodes.filter(F.col("level") >= end).unionByName(new.filter(F.col("level") >= end))
    done = open_nodes if done is None else done.unionByName(open_nodes)
    return done.select("tree", "level", "at", "hash")


def _fold_up(base: int, sizes: list[int]):
    """One subtree of the tree above, ``STEP`` levels high."""
    tops = min(base + STEP, len(sizes) - 1)

    def run(table: pa.Table) -> pa.Table:
        nodes, out = dict(zip(table.column("at").to_pylist(), table.column("hash").to_pylist())), []
        for depth in range(base, tops):
            nodes = fold(nodes, sizes[depth])
            out += [(ABOVE, depth + 1, at, h) for at, h in nodes.items()]
        return _node_table(out)

    return run


def _all_above(roots: DataFrame) -> DataFrame:
    """All nodes of the tree over the languages' roots, ``STEP`` levels per round."""
    n = roots.count()
    sizes = widths(n) if n else [0]
    level = roots.select(F.lit(ABOVE).cast("bigint").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("at"), "hash")
    done = level
    for base in range(0, len(sizes) - 1, STEP):
        new = stored(level.groupBy(F.shiftright("at", STEP).alias("above")).applyInArrow(
            _fold_up(base, sizes), NODE), "folded")
        done = done.unionByName(new)
        level = new.filter(F.col("level") == base + STEP)
    return done


# -- proofs ------------------------------------------------------------------

def _lacking(table: pa.Table) -> pa.Table:
    """The nodes that a partition has to fetch."""
    part, spans, out = table.column("part")[0].as_py(), _spans_of(table), []
    for s in spans:
        places = np.arange(s["start"], s["start"] + s["size"])
        for depth, nodes in enumerate(octopus(places, widths(s["n"]))):
            out += [(part, s["tree"], depth, at) for at in nodes.tolist()]
    trees = np.unique([s["tree"] for s in spans])
    for depth, nodes in enumerate(octopus(trees, widths(spans[0]["trees"]))):
        out += [(part, ABOVE, depth, at) for at in nodes.tolist()]
    return _node_table(out, "part bigint, tree bigint, level int, at bigint")


def _derived(leaves: dict[int, str], fetched: dict[int, dict[int, str]], sizes: list[int]) -> list[dict[int, str]]:
    """All nodes above these leaves, each computed once, with the fetched ones beside them."""
    levels, level = [], leaves
    for depth, width in enumerate(sizes):
        level = level | fetched.get(depth, {})
        levels.append(level)
        level = fold(level, width) if width > 1 else {}
    return levels


def _siblings(levels: list[dict[int, str]], at: int) -> list[tuple[int, str | None]]:
    """Per level, on which side the node itself stands and the other child's hash, if any."""
    out = []
    for level in levels[:-1]:
        out.append((at & 1, level.get(at ^ 1)))
        at >>= 1
    return out


def folded(value: str, path: list[tuple[int, str | None]]) -> str:
    for side, other in path:
        value = digest(value if other is None else other + value if side else value + other)
    return value


def _proofs(rows: pa.Table, known: pa.Table) -> pa.Table:
    level = known.column("level")
    spans = _spans_of(known.filter(level.is_null()))
    fetched: dict[int, dict[int, dict[int, str]]] = {}
    for tree, depth, at, value in zip(*[known.filter(level.is_valid()).column(c).to_pylist() for c in ("tree", "level", "at", "hash")]):
        fetched.setdefault(tree, {}).setdefault(depth, {})[at] = value
    rows = rows.sort_by("row")
    leaves, found = rows.column("leaf").to_pylist(), rows.column("found").to_pylist()
    nodes = {s["tree"]: _derived({s["start"] + i: h for i, h in enumerate(leaves[s["first"]:s["first"] + s["size"]])},
                                 fetched.get(s["tree"], {}), widths(s["n"])) for s in spans}
    above = _derived({tree: levels[-1][0] for tree, levels in nodes.items()}, fetched.get(ABOVE, {}), widths(spans[0]["trees"]))
    root = above[-1][0]
    subroots, proofs, ends = [], [], []
    for s in spans:
        levels, upper = nodes[s["tree"]], _siblings(above, s["tree"])
        for i in range(s["size"]):
            path = _siblings(levels, s["start"] + i) + upper
            subroots.append(levels[-1][0])
            proofs.append(digest("".join(other for _, other in path if other is not None)))
            ends.append(folded(found[s["first"] + i], path))
    return pa.table({"doc_id": rows.column("doc_id"), "leaf": rows.column("leaf"), "subroot": pa.array(subroots, pa.string()),
                     "root": pa.array([root] * len(leaves), pa.string()), "proof_sha256": pa.array(proofs, pa.string()),
                     "folded_root": pa.array(ends, pa.string()), "verified": pa.array([e == root for e in ends], pa.bool_())})
