"""Documents in blocks, and exact lookups of a block's numbers in tables partitioned by hash.

A block is a hashed group of about ``BLOCK_BYTES`` of text. It asks about its
*different* 64-bit numbers (words, shingles), packed into one row per bucket; a
bucket is a range of numbers. A bucket combines the values all blocks sent for a
number and answers each block in the order of its question. So a number that
fills a third of the input is one entry per block, never a group of rows, and a
number costs eight bytes each way instead of a row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20
#: Each bucket takes the numbers of about this much text.
BUCKET_BYTES = 32 << 20

ASK_SCHEMA = "bucket int, block long, keys binary, vals binary, extra long"
ANSWER_SCHEMA = "block long, bucket int, step int, vals binary, extra long"


def in_blocks(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` with a ``block`` column, and the number of buckets."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    n_blocks = -(-total // BLOCK_BYTES) or 1
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))
    return docs.withColumn("block", F.pmod(F.xxhash64(*docs.columns), F.lit(n_blocks))), int(buckets)


def borders(buckets: int) -> np.ndarray:
    return np.array([(2**64 * i) // buckets for i in range(buckets)], np.uint64)


def packed(values: np.ndarray) -> bytes:
    """Byte by byte, all first bytes first: the zero bytes of small numbers lie together and compress to nothing."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(wide, len(data) // wide).T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted numbers as their differences."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def question(block: int, buckets: int, keys: np.ndarray, vals: np.ndarray, extra: Callable[[slice], int] | None = None) -> pa.Table:
    """Sorted different ``keys`` and their ``vals``, one row per bucket."""
    cut = np.append(np.searchsorted(keys, borders(buckets)), len(keys))
    spans = [slice(cut[i], cut[i + 1]) for i in range(buckets)]
    return pa.table({"bucket": pa.array(range(buckets), pa.int32()), "block": pa.array([block] * buckets, pa.int64()),
                     "keys": pa.array([packed_keys(keys[s]) for s in spans], pa.binary()),
                     "vals": pa.array([packed(vals[s]) for s in spans], pa.binary()),
                     "extra": pa.array([extra(s) if extra else 0 for s in spans], pa.int64())})


def answers(questions: DataFrame, step: int, combine: np.ufunc, kind: type, total_kind: type) -> DataFrame:
    """Per block and bucket: the combined value of each asked number, in its order.

    ``combine`` is ``np.add`` or ``np.minimum``; values of ``kind`` are combined as ``total_kind``.
    """

    def reduce(table: pa.Table) -> pa.Table:
        blocks, bucket = table["block"].to_numpy(), table["bucket"][0].as_py()
        asked = [unpacked_keys(x) for x in table["keys"].to_pylist()]
        sent = [unpacked(x, kind) for x in table["vals"].to_pylist()]
        keys, place = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.full(len(keys), np.iinfo(total_kind).max if combine is np.minimum else 0, total_kind)
        combine.at(total, place, np.concatenate(sent))
        cut = np.cumsum([len(x) for x in asked])[:-1]
        back = [packed(total[p]) for p in np.split(place, cut)]
        extra = int(np.sum(table["extra"].to_numpy()))
        n = len(blocks)
        return pa.table({"block": pa.array(blocks, pa.int64()), "bucket": pa.array([bucket] * n, pa.int32()),
                         "step": pa.array([step] * n, pa.int32()), "vals": pa.array(back, pa.binary()),
                         "extra": pa.array([extra] * n, pa.int64())})

    return questions.groupBy("bucket").applyInArrow(reduce, ANSWER_SCHEMA)


def answered(table: pa.Table, step: int, kind: type) -> np.ndarray:
    """One step's answers in the order of the asked numbers."""
    rows = [(b, v) for b, s, v in zip(table["bucket"].to_pylist(), table["step"].to_pylist(), table["vals"].to_pylist()) if s == step]
    return np.concatenate([unpacked(v, kind) for _, v in sorted(rows)]) if rows else np.zeros(0, kind)


def extras(table: pa.Table, step: int) -> int:
    return sum(e for s, e in zip(table["step"].to_pylist(), table["extra"].to_pylist()) if s == step)


def per_block(blocks: DataFrame, fn: Callable[[int, pa.Table], pa.Table], schema: str = ASK_SCHEMA) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        return fn(table["block"][0].as_py(), table)

    return blocks.groupBy("block").applyInArrow(run, schema)


def with_answers(blocks: DataFrame, replies: DataFrame, fn: Callable[[int, pa.Table, pa.Table], pa.Table], schema: str = ASK_SCHEMA) -> DataFrame:
    def run(table: pa.Table, reply: pa.Table) -> pa.Table:
        return fn(table["block"][0].as_py(), table, reply)

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)
