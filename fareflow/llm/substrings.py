"""Passages that repeat across documents, found level by level.

A window is ``length`` words in a row. A window can repeat only if every shorter
window in it repeats, so the search starts with short windows and extends only
those that repeat. The first level does not even ask about all short windows:
each full window names the short window in it with the smallest hash, and equal
full windows name equal ones. Lengths then double until the wanted length is
reached or no window of a block survives, when the block asks nothing more.
Longer repeats need no further level: they consist of windows of the wanted length.

A word is removed when a full window over it also starts in a document with a
smaller doc_id.

* null or empty text: no words, the hash of the empty text; short texts keep all.
* null doc_id: larger than all others; such documents count as one another's equals.
* repeated rows and ties in doc_id: none is smaller, so they do not remove each other's words.
* an empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm import blocks as B
from fareflow.llm.tokens import shingles, within, words

LENGTH = 13
NO_ID = np.iinfo(np.int64).max

RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, spans string"


def lengths(length: int, first: int | None = None) -> list[int]:
    """The window lengths of the levels: doubled from the first on, the wanted one last."""
    size = first or max(length // 2, 1)
    out = [size]
    while size < length:
        size = min(size * 2, length) if size * 2 + 1 < length else length
        out.append(size)
    return out


def smallest(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours, by doubling."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:len(x) - size], x[size:]) if len(x) > size else x[:0]
        size *= 2
    rest = width - size
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest and len(x) > rest else x[:0] if rest else x


class Level:
    """What a block knows of its windows at each level."""

    def __init__(self, table: pa.Table, length: int, sizes: list[int]):
        self.words = words(table["text"])
        self.length, self.sizes = length, sizes
        ids = table["doc_id"].fill_null(NO_ID).to_numpy()
        self.ids = ids
        self.whole = within(self.words.doc, length)
        self.doc = self.words.doc[:len(self.whole)]
        self.n = len(self.whole)

    def first_keys(self) -> np.ndarray:
        """Per full window: the smallest hash of a first-level window in it."""
        return smallest(shingles(self.words.number, self.sizes[0]), self.length - self.sizes[0] + 1)[:self.n]

    def ask(self, step: int, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys, per key the smallest doc_id, and per asked window its place and its key's place."""
        at = np.flatnonzero(alive)
        number = (self.first_keys() if step == 0 else shingles(self.words.number, self.sizes[step]))[at]
        keys, place = np.unique(number, return_inverse=True)
        least = np.full(len(keys), NO_ID, np.int64)
        np.minimum.at(least, place, self.ids[self.doc[at]])
        return keys, least, at, place

    def several(self, keys: np.ndarray, least: np.ndarray, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        """1 for keys seen in one document of the block, 2 for more."""
        most = np.full(len(keys), np.iinfo(np.int64).min, np.int64)
        np.maximum.at(most, place, self.ids[self.doc[at]])
        return np.where(most > least, 2, 1).astype(np.uint8)

    def survivors(self, upto: int, reply: pa.Table) -> np.ndarray:
        """The full windows whose windows of all levels below ``upto`` repeat.

        A full window stands for the windows of a level that start where it starts.
        """
        alive = self.whole.copy()
        for step in range(upto):
            keys, least, at, place = self.ask(step, alive)
            seen = B.answered(reply, step, np.uint8)
            alive = alive.copy()
            alive[at] = seen[place] >= 2
        return alive


def find_repeats(documents: DataFrame, length: int = LENGTH, first: int | None = None) -> DataFrame:
    """Per document: ``doc_id, n_words, n_removed, kept_sha256, kept, spans``.

    ``spans`` are the removed runs as "start-stop" word positions, joined by commas.
    """
    sizes = lengths(length, first)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks, buckets = B.in_blocks(docs)
    replies = None
    last = len(sizes) - 1
    for step in range(last + 1):
        def ask(block, table, reply=None, step=step):
            level = Level(table, length, sizes)
            keys, least, at, place = level.ask(step, level.survivors(step, reply))
            vals = least if step == last else level.several(keys, least, at, place)
            return B.question(block, buckets, keys, vals)

        questions = B.per_block(blocks, ask) if replies is None else B.with_answers(blocks, replies, ask)
        fresh = B.answers(questions, step, np.minimum, np.int64, np.int64) if step == last else count_two(questions, step)
        replies = fresh if replies is None else replies.unionByName(fresh)

    def finish(block, table, reply):
        level = Level(table, length, sizes)
        keys, _, at, place = level.ask(last, level.survivors(last, reply))
        owner = B.answered(reply, last, np.int64)
        hit = np.zeros(len(level.words.number) + 1, np.int64)
        starts = at[owner[place] < level.ids[level.doc[at]]] if len(at) else at
        np.add.at(hit, starts, 1)
        np.add.at(hit, starts + length, -1)
        keep = np.cumsum(hit)[:-1] == 0
        return outcome(table, level.words.first, keep)

    return B.with_answers(blocks, replies, finish, RESULT_SCHEMA)


def count_two(questions: DataFrame, step: int) -> DataFrame:
    """How many documents hold a number, as 1, or 2 and more."""
    def reduce(table: pa.Table) -> pa.Table:
        asked = [B.unpacked_keys(x) for x in table["keys"].to_pylist()]
        sent = np.concatenate([B.unpacked(x, np.uint8) for x in table["vals"].to_pylist()])
        keys, place = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.minimum(np.bincount(place, sent, len(keys)), 2).astype(np.uint8)
        back = [B.packed(total[p]) for p in np.split(place, np.cumsum([len(x) for x in asked])[:-1])]
        n = len(asked)
        return pa.table({"block": table["block"], "bucket": table["bucket"], "step": pa.array([step] * n, pa.int32()),
                         "vals": pa.array(back, pa.binary()), "extra": pa.array([0] * n, pa.int64())})

    return questions.groupBy("bucket").applyInArrow(reduce, B.ANSWER_SCHEMA)


def outcome(table: pa.Table, first: np.ndarray, keep: np.ndarray) -> pa.Table:
    n_words, n_removed, digests, kept, spans = [], [], [], [], []
    for i, text in enumerate(table["text"].to_pylist()):
        mask = keep[first[i]:first[i + 1]]
        rest = b" ".join(compress((text or "").encode().split(), mask.tolist()))
        n_words.append(len(mask))
        n_removed.append(int(len(mask) - mask.sum()))
        digests.append(hashlib.sha256(rest).hexdigest())
        kept.append(rest.decode())
        change = np.flatnonzero(np.diff(np.concatenate([[True], mask, [True]]).astype(np.int8)))
        spans.append(",".join(f"{a}-{b}" for a, b in change.reshape(-1, 2)))
    return pa.table({"doc_id": table["doc_id"], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                     "kept_sha256": pa.array(digests, pa.string()), "kept": pa.array(kept, pa.string()), "spans": pa.array(spans, pa.string())})
