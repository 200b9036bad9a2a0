"""Keyed tables on plain Parquet.

Each micro-batch appends its rows under ``changes/batch_id=N``; writing the same
batch again replaces that folder, so a replay changes nothing. A micro-batch thus
never rewrites, or even reads, the table it updates. Readers keep one row per key:
the one with the largest ``order`` columns where a table has them (an event time, say,
so that a late batch does not undo a newer state), of equal ones the newest batch's.

``compact`` folds finished batches into ``levels``. Rows are spread over ``buckets`` by
a hash of their key, and each bucket has ``LEVELS`` cells, each about ten times the size
of the one before. New rows of a bucket go to its first level that stays a tenth of the
next one; only that cell and the ones before it are rewritten, so a small batch never
costs a rewrite of the table. Cells are immutable: a compaction writes its cells under
a new generation and then a manifest that lists, for every cell, which generation holds
it, its rows, and the batches held with the time they were finished. A batch that is
new, or was written again, after that is read beside the levels whatever its number, so a
backfill of an older day counts. Folders count only once their write completed; a
compaction that died leaves the last manifest in force.

A table without keys keeps all rows; there, a batch written again replaces the rows
the levels hold of it.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.operators.keys import best_row

VERSION = "batch_id"
FRESH, BUCKET, LEVEL = "__fresh", "__bucket", "__level"
LEVELS = 3
#: A level may hold this share of the next one's rows.
SHARE = 0.1
#: A bucket with this share of expired rows is rewritten whole.
EXPIRED = 0.25
BUCKETS = 64
MANIFEST = "batch_id bigint, finished bigint, level int, bucket int, generation bigint, n bigint, buckets int, schema string"


@dataclass
class Manifest:
    """What the levels hold after a compaction."""
    upto: int
    generation: int
    batches: dict[int, int] = field(default_factory=dict)          # number -> finished
    cells: dict[tuple[int, int], tuple[int, int]] = field(default_factory=dict)  # level, bucket -> generation, rows
    buckets: int = BUCKETS
    schema: T.StructType | None = None


@dataclass(frozen=True)
class Compaction:
    """What a compaction did: rows and cells written, and rows of the whole table's levels."""
    rows_written: int
    cells_written: int
    rows: int


def upsert(batch: DataFrame, root: str, batch_id: int) -> None:
    (batch.drop(VERSION).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .parquet(f"{root}/changes/{VERSION}={batch_id}"))


def read_current(spark: SparkSession, root: str, keys: list[str], as_of: int | None = None,
                 order: tuple[str, ...] = (), only: DataFrame | None = None) -> DataFrame:
    """The current row per key, optionally as of an earlier batch. With ``only``, a table of
    keys, the rows of these keys; cells that can't hold one of them are not read."""
    base = _newest(spark, root, as_of)
    pending = _pending(spark, root, base, as_of)
    cells = set(base.cells) if base else set()
    if only is not None and base:
        here = {r[0] for r in only.select(_bucket(keys, base.buckets)).distinct().collect()}
        cells = {c for c in cells if c[1] in here}
    rows = _rows(spark, root, base, cells, pending, keys)
    if rows is None:
        raise ValueError(f"no finished batch under {root}")
    if only is not None:
        rows = rows.join(only.select(*[F.col(k).alias(f"__k_{k}") for k in keys]).distinct(),
                         [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys], "left_semi")
    return _merged(rows, keys, order).drop(FRESH)


def compact(spark: SparkSession, root: str, keys: list[str], upto: int, keep: Column | None = None,
            order: tuple[str, ...] = (), buckets: int = BUCKETS) -> Compaction:
    """Fold the batches up to ``upto`` into the levels.

    ``keep`` drops expired rows wherever a bucket is rewritten whole, which happens at
    the latest when a quarter of it has expired; smaller rewrites leave them, since an
    expired row may hide an older one of its key. The list of batches is taken before reading
    begins: a batch that lands meanwhile is read again, never missed. Older files stay, so
    readers that started before are not disturbed; ``prune`` removes them later.
    """
    covered = _complete(spark, f"{root}/changes", upto)
    base = _newest(spark, root, upto)
    known = Manifest(upto, 0, buckets=buckets) if base is None else base
    pending = sorted(n for n, at in covered.items() if known.batches.get(n) != at)
    size = lambda level, b: known.cells.get((level, b), (0, 0))[1]

    come: dict[int, int] = {}
    if pending:
        fresh = _changes(spark, root, pending)
        come = {r[0]: r[1] for r in fresh.groupBy(_bucket(keys, known.buckets)).count().collect()}
    target = {b: _target(n, [size(level, b) for level in range(1, LEVELS + 1)]) for b, n in come.items()}
    if keep is not None:
        for b, n in _expired(spark, root, known, keep).items():
            if n >= EXPIRED * sum(size(level, b) for level in range(1, LEVELS + 1)):
                target[b] = LEVELS
    if not keys and pending:  # rows of a batch written again are replaced wherever they lie
        held = [n for n in pending if n in known.batches]
        if held:
            target = {b: LEVELS for b in {c[1] for c in known.cells} | set(come)}

    generation = max(time.time_ns() // 1000, known.generation + 1)
    after = Manifest(upto, generation, covered, dict(known.cells), known.buckets, known.schema)
    written = 0
    if target:
        taken = {c for c in known.cells if c[1] in target and c[0] <= target[c[1]]}
        rows = _merged(_rows(spark, root, known, taken, pending, keys), keys, order).drop(FRESH)
        after.schema = rows.schema
        # What the buckets become, as a table of at most `buckets` rows.
        to = F.element_at(F.create_map(*[F.lit(x) for pair in target.items() for x in pair]), F.col(BUCKET))
        rows = rows.withColumn(BUCKET, _bucket(keys, known.buckets)).withColumn(LEVEL, to)
        if keep is not None:
            rows = rows.filter((F.col(LEVEL) < LEVELS) | keep)
        folder = f"{root}/levels/generation={generation}"
        (rows.hint("rebalance", LEVEL, BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(LEVEL, BUCKET).parquet(folder))
        for cell in taken:
            del after.cells[cell]
        shape = T.StructType([f for f in rows.schema if f.name in (LEVEL, BUCKET)])
        for level, b, n in spark.read.schema(shape).option("basePath", folder).parquet(folder).groupBy(LEVEL, BUCKET).count().collect():
            after.cells[level, b] = (generation, n)
            written += n
    _put(spark, root, after)
    return Compaction(written, sum(1 for g, _ in after.cells.values() if g == generation), sum(n for _, n in after.cells.values()))


def has_batches(spark: SparkSession, root: str) -> bool:
    """Has any batch of the table been written?"""
    return bool(_complete(spark, f"{root}/changes") or _manifests(spark, root))


def newest_batch(spark: SparkSession, root: str) -> int | None:
    """The largest batch number the table holds."""
    return max([*_complete(spark, f"{root}/changes"), *[upto for upto, _ in _manifests(spark, root)]], default=None)


def maintain(spark: SparkSession, root: str, keys: list[str], batch_id: int, every: int, keep: Column | None = None,
             order: tuple[str, ...] = (), stride: int = 1) -> None:
    """Every ``every`` batches, also empty ones: compact what is there, drop what expired, remove
    files no reader needs. ``stride`` is how many folder numbers one batch takes."""
    if batch_id and batch_id % every == 0 and _complete(spark, f"{root}/changes"):
        compact(spark, root, keys, (batch_id + 1) * stride - 1, keep, order)
        prune(spark, root, every * stride)


def prune(spark: SparkSession, root: str, keep_batches: int) -> int:
    """Delete change folders that the newest manifest holds, except the last ``keep_batches``
    before it, which slow readers may still use, older manifests, and cells that no
    remaining manifest names. Returns the number of change folders."""
    base = _newest(spark, root)
    if base is None:
        return 0
    fs = hadoop_path(spark, root)[0]
    drop = lambda path: fs.delete(hadoop_path(spark, path)[1], True)
    named = set()
    for upto, generation in _manifests(spark, root):
        if upto < base.upto - keep_batches or (upto == base.upto and generation < base.generation):
            drop(f"{root}/manifests/upto={upto}/generation={generation}")
        else:
            named |= {(g, *cell) for cell, (g, _) in _read_manifest(spark, root, upto, generation).cells.items()}
    cells = hadoop_path(spark, f"{root}/levels/*/*/*")[1]
    for status in fs.globStatus(cells) or []:
        parts = [int(p.split("=")[1]) for p in status.getPath().toString().split("/")[-3:] if "=" in p]
        if len(parts) == 3 and parts[0] <= base.generation and tuple(parts) not in named:
            fs.delete(status.getPath(), True)
    old = [n for n, at in _complete(spark, f"{root}/changes").items() if base.batches.get(n) == at and n <= base.upto - keep_batches]
    return sum(drop(f"{root}/changes/{VERSION}={n}") for n in old)


# -- rows --------------------------------------------------------------------

def _bucket(keys: list[str], buckets: int) -> Column:
    """A row's bucket; rows of a table without keys go by their batch."""
    return F.pmod(F.xxhash64(F.struct(*(keys or [VERSION]))), F.lit(buckets)).cast("int").alias(BUCKET)


def _target(new: int, sizes: list[int]) -> int:
    """The level that takes ``new`` rows of a bucket with these levels."""
    level, rows = 1, new + sizes[0]
    while level < LEVELS and rows > SHARE * sizes[level]:
        rows += sizes[level]
        level += 1
    return level


def _merged(rows: DataFrame, keys: list[str], order: tuple[str, ...]) -> DataFrame:
    if not keys:
        return rows
    largest = []
    for name in order:
        kind = rows.schema[name].dataType
        value = F.unix_micros(F.col(name).cast("timestamp")) if isinstance(kind, (T.TimestampType, T.TimestampNTZType)) else F.col(name)
        largest += [F.col(name).isNull(), -value]
    return best_row(rows, keys, [*largest, -F.col(VERSION), -F.col(FRESH)])


def _changes(spark: SparkSession, root: str, batches: list[int]) -> DataFrame:
    rows = spark.read.option("basePath", f"{root}/changes").parquet(*[f"{root}/changes/{VERSION}={n}" for n in batches])
    return rows.withColumn(VERSION, F.col(VERSION).cast("bigint"))


def _rows(spark: SparkSession, root: str, base: Manifest | None, cells: set, pending: list[int], keys: list[str]) -> DataFrame | None:
    """Rows of some cells and of the pending batches; later levels and then batches are fresher."""
    parts = []
    for level in range(1, LEVELS + 1):
        paths = [f"{root}/levels/generation={base.cells[level, b][0]}/{LEVEL}={level}/{BUCKET}={b}"
                 for at, b in sorted(cells) if at == level] if base else []
        if paths:
            held = spark.read.schema(base.schema).parquet(*paths)
            if not keys and pending:
                held = held.filter(~F.col(VERSION).isin(pending))
            parts.append(held.withColumn(FRESH, F.lit(LEVELS - level)))
    if pending:
        parts.append(_changes(spark, root, pending).withColumn(FRESH, F.lit(LEVELS)))
    if not parts:
        return None if base is None or base.schema is None else spark.createDataFrame([], base.schema).withColumn(FRESH, F.lit(0))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows


def _expired(spark: SparkSession, root: str, known: Manifest, keep: Column) -> dict[int, int]:
    """Expired rows per bucket; row groups without any are skipped by their statistics."""
    found: dict[int, int] = {}
    for generation in {g for g, _ in known.cells.values()}:
        folder = f"{root}/levels/generation={generation}"
        paths = [f"{folder}/{LEVEL}={level}/{BUCKET}={b}" for (level, b), (g, _) in known.cells.items() if g == generation]
        shape = T.StructType([*known.schema.fields, T.StructField(LEVEL, T.IntegerType()), T.StructField(BUCKET, T.IntegerType())])
        gone = spark.read.schema(shape).option("basePath", folder).parquet(*paths).filter(~F.coalesce(keep, F.lit(False)))
        for b, n in gone.groupBy(BUCKET).count().collect():
            found[b] = found.get(b, 0) + n
    return found


# -- manifests ---------------------------------------------------------------

def _manifests(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """``upto, generation`` of the complete manifests."""
    fs, marks = hadoop_path(spark, f"{root}/manifests/*/*/_SUCCESS")
    names = [s.getPath().toString().split("/")[-3:-1] for s in fs.globStatus(marks) or []]
    return sorted(tuple(int(n.split("=")[1]) for n in pair) for pair in names)


def _newest(spark: SparkSession, root: str, as_of: int | None = None) -> Manifest | None:
    found = [m for m in _manifests(spark, root) if as_of is None or m[0] <= as_of]
    return _read_manifest(spark, root, *found[-1]) if found else None


def _read_manifest(spark: SparkSession, root: str, upto: int, generation: int) -> Manifest:
    out = Manifest(upto, generation)
    for r in spark.read.schema(MANIFEST).parquet(f"{root}/manifests/upto={upto}/generation={generation}").collect():
        if r.batch_id is not None:
            out.batches[r.batch_id] = r.finished
        elif r.level is not None:
            out.cells[r.level, r.bucket] = (r.generation, r.n)
        else:
            out.buckets, out.schema = r.buckets, r.schema and T.StructType.fromJson(json.loads(r.schema))
    return out


def _put(spark: SparkSession, root: str, m: Manifest) -> None:
    rows = [(n, at, None, None, None, None, None, None) for n, at in m.batches.items()]
    rows += [(None, None, level, b, g, n, None, None) for (level, b), (g, n) in m.cells.items()]
    rows.append((None, None, None, None, None, None, m.buckets, m.schema and m.schema.json()))
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{root}/manifests/upto={m.upto}/generation={m.generation}")


def _pending(spark: SparkSession, root: str, base: Manifest | None, as_of: int | None) -> list[int]:
    held = base.batches if base else {}
    return sorted(n for n, at in _complete(spark, f"{root}/changes", as_of).items() if held.get(n) != at)


def _complete(spark: SparkSession, folder: str, as_of: int | None = None) -> dict[int, int]:
    """Numbers of the ``name=N`` folders whose write finished, and when: one listing."""
    fs, marks = hadoop_path(spark, f"{folder}/*/_SUCCESS")
    found = {int(s.getPath().getParent().getName().split("=")[1]): s.getModificationTime()
             for s in fs.globStatus(marks) or [] if "=" in s.getPath().getParent().getName()}
    return {n: at for n, at in sorted(found.items()) if as_of is None or n <= as_of}


def hadoop_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jpath
