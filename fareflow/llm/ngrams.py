"""Stupid-backoff scores of every document, from n-gram counts of all documents.

Counts are tables keyed by n-gram number and partitioned by its hash. Documents
are exploded into n-grams per block; a block's different n-grams are joined to
the count tables and the logarithms are summed per document. A document is
scored with its own n-grams taken out of all counts, so the score says how well
the rest of the corpus predicts it.

The score of a word after a context c is count(c word) / count(c) if that n-gram
occurs elsewhere, and otherwise ``BACKOFF`` times the score with a context one
word shorter; a word that occurs nowhere else counts as one half of an occurrence.

* null or empty text: no words, sum 0, mean null.
* repeated rows and copies: each is predicted by the others.
* null doc_id: carried through. One single document: all its words are unseen.
* an empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm import blocks as B
from fareflow.llm.tokens import shingles, within, words

ORDER = 2
BACKOFF = 0.4
UNSEEN = 0.5

SCORE_SCHEMA = "doc_id long, n_words long, n_backoff long, log_score double, mean_log_score double"


class Grams:
    """The n-grams of a block: per order, the number and the document of each."""

    def __init__(self, table: pa.Table, order: int):
        self.words = words(table["text"])
        self.order = order
        self.number, self.doc = [], []
        for n in range(1, order + 1):
            whole = within(self.words.doc, n)
            # The order is part of the shingle's number, so all orders share one key space.
            self.number.append(np.where(whole, shingles(self.words.number, n), np.uint64(0)))
            self.doc.append(np.where(whole, self.words.doc[:len(whole)], -1))

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different n-grams, how often each occurs in the block, and which are single words."""
        found = [np.unique(x[d >= 0], return_counts=True) for x, d in zip(self.number, self.doc)]
        keys = np.concatenate([k for k, _ in found])
        single = np.concatenate([np.full(len(k), i == 0) for i, (k, _) in enumerate(found)])
        n = np.concatenate([c for _, c in found]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        return keys[order], n[order], single[order]


def score(documents: DataFrame, order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """``doc_id, n_words, n_backoff, log_score, mean_log_score`` per document; natural logarithms."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks, buckets = B.in_blocks(docs)

    def ask(block, table):
        keys, n, single = Grams(table, order).counts()
        words_here = np.where(single, n, 0)
        return B.question(block, buckets, keys, n.astype(np.int32), lambda s: int(words_here[s].sum()))

    def finish(block, table, reply):
        grams = Grams(table, order)
        keys, _, _ = grams.counts()
        total = B.answered(reply, 0, np.int64)
        return scored(table["doc_id"], grams, keys, total, B.extras(reply, 0), backoff)

    replies = B.answers(B.per_block(blocks, ask), 0, np.add, np.int32, np.int64)
    return B.with_answers(blocks, replies, finish, SCORE_SCHEMA)


def scored(ids, grams: Grams, keys: np.ndarray, total: np.ndarray, all_words: int, backoff: float) -> pa.Table:
    doc, n = grams.words.doc, len(grams.words.number)
    lengths = np.diff(grams.words.first)
    others = [elsewhere(x, d, keys, total) for x, d in zip(grams.number, grams.doc)]
    # The shortest context first: a longer n-gram seen elsewhere overrides it.
    rest = np.maximum(all_words - lengths[doc], 1)
    value = np.log(np.maximum(others[0], UNSEEN) / rest) + (grams.order - 1) * np.log(backoff)
    level = np.zeros(n, np.int64)
    for size in range(2, grams.order + 1):
        last = np.arange(len(others[size - 1])) + size - 1
        seen = others[size - 1] > 0
        context = others[size - 2][:len(seen)]
        better = np.log(others[size - 1][seen] / context[seen]) + (grams.order - size) * np.log(backoff)
        value[last[seen]], level[last[seen]] = better, size - 1
    sums = np.bincount(doc, value, len(lengths))
    backed = np.bincount(doc, level < grams.order - 1, len(lengths)).astype(np.int64)
    mean = pa.array(sums / np.maximum(lengths, 1), mask=lengths == 0)
    return pa.table({"doc_id": ids, "n_words": pa.array(lengths, pa.int64()), "n_backoff": pa.array(backed, pa.int64()),
                     "log_score": pa.array(sums, pa.float64()), "mean_log_score": mean})


def elsewhere(number: np.ndarray, doc: np.ndarray, keys: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Per n-gram: how often it occurs outside its own document; 0 across document borders."""
    out = np.zeros(len(number), np.int64)
    at = np.flatnonzero(doc >= 0)
    if len(at):
        order = np.lexsort((number[at], doc[at]))
        d, x = doc[at][order], number[at][order]
        new = np.ones(len(d), bool)
        new[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1])
        group = np.cumsum(new) - 1
        own = np.bincount(group)[group]
        out[at[order]] = total[np.searchsorted(keys, x)] - own
    return out
