"""Document quality by regularised quadratic discriminant analysis.

Each text becomes ``FEATURES``: counts of its bytes and words, transformed by
logarithms so that they are near to normal. Per class, mean and covariance come
from sums over all labelled training rows; covariances are shrunk towards a
multiple of the identity. A score is the logistic of the difference of the
classes' log densities, from Mahalanobis distances with Cholesky factors that are
computed once.

Only the text makes the features. Rows with crc32(doc_id as text) mod 4 = 2 are
held out from training.

* null or empty text: the features of a text without words; scored like any other.
* null doc_id: held out as crc32 of the empty text says; it has no label.
* repeated labels of a doc_id: the majority counts, a tie as 1; null labels are left out.
* no training row of one class or of both: every score is the share of class 1, or 0.5 without any.
* an empty table: no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import stored
from fareflow.llm.decontam import slices
from fareflow.llm.tokens import bytes_of, distinct, shingles, within, words

FEATURES = ("words", "word_length", "upper", "symbols", "exclamations", "bars", "digits", "foreign",
            "stops", "repeats", "variety", "phrases", "lines")
SHRINK = 0.15
CUT = 0.7
HELD_OUT = 2

#: A text's shares are averaged with the usual ones as if so much usual text stood beside it,
#: so that a few words are not judged by one capital letter.
MANY_BYTES, MANY_WORDS = 100, 16

# The byte classes that are counted, and their usual shares in prose.
CLASSES = {"upper": (range(ord("A"), ord("Z") + 1), 0.015), "symbols": (b"#*&%$~^<>{}[]\\`", 0.0), "exclamations": (b"!", 0.0),
           "bars": (b"|", 0.0), "digits": (range(ord("0"), ord("9") + 1), 0.0), "foreign": (range(0x80, 0x100), 0.02),
           "stops": (b".?", 0.015), "lines": (b"\n", 0.005)}
USUAL_WORD = 6.0


def features(column) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    data, offsets = bytes_of(column)
    found = words(column)
    n_bytes, n_words = np.diff(offsets), np.diff(found.first)
    share = {}
    for name, (members, usual) in CLASSES.items():
        flags = np.zeros(256, bool)
        flags[list(members)] = True
        total = np.concatenate([[0], np.cumsum(flags[data])])
        share[name] = (total[offsets[1:]] - total[offsets[:-1]] + usual * MANY_BYTES) / (n_bytes + MANY_BYTES)
    n = len(n_words)
    same = np.flatnonzero(within(found.doc, 2) & (found.number[1:] == found.number[:-1])) if len(found.number) > 1 else np.zeros(0, int)
    different = np.bincount(distinct(found.doc, found.number)[0], minlength=n)
    whole = within(found.doc, 3)
    tri_doc, tri = found.doc[:len(whole)][whole], shingles(found.number, 3)[whole]
    phrases = (np.bincount(distinct(tri_doc, tri)[0], minlength=n) + MANY_WORDS) / (np.maximum(n_words - 2, 0) + MANY_WORDS)
    few = n_words + MANY_WORDS
    rows = {"words": np.log1p(n_words), "word_length": np.log((n_bytes + USUAL_WORD * MANY_WORDS) / few),
            "repeats": np.log(0.01 + np.bincount(found.doc[same], minlength=n) / few),
            "variety": np.log(different + MANY_WORDS) / np.log(few), "phrases": phrases}
    rows |= {name: np.log(0.002 + s) for name, s in share.items()}
    return np.stack([rows[f] for f in FEATURES], axis=1)


@dataclass
class Model:
    """Per class: mean, inverse-ready Cholesky factor, log determinant; the log odds of class 1; the scale of the features."""
    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_dets: list[float]
    log_odds: float
    constant: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        z = (x - self.centre) / self.scale
        density = []
        for mean, factor, log_det in zip(self.means, self.factors, self.log_dets):
            # Rows of the factor's inverse applied to all rows: half the squared length is the distance.
            away = np.linalg.solve(factor, (z - mean).T)
            density.append(-0.5 * (np.square(away).sum(axis=0) + log_det))
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.log_odds, -500, 500)))


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == HELD_OUT


def feature_table(documents: DataFrame) -> DataFrame:
    """``doc_id, x`` per document."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                x = features(part.column("text"))
                flat = pa.array(x.ravel())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), flat)], ["doc_id", "x"])

    return (documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(rows, "doc_id long, x array<double>"))


def fit(table: DataFrame, labels: DataFrame, shrink: float = SHRINK) -> Model:
    """A model from all training rows of the feature table, without sampling."""
    truth = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg((F.avg(F.col("quality").cast("double")) >= 0.5).cast("int").alias("y")))
    rows = table.filter(~held_out()).join(truth, "doc_id").select("x", "y")
    d = len(FEATURES)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per task and class: count, sums and sums of products, flat."""
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(-1, d)
            y = batch.column("y").to_numpy()
            for k in (0, 1):
                own = x[y == k]
                total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        at = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(at[0].ravel().astype(np.int32)), pa.array(at[1].ravel().astype(np.int32)), pa.array(total.ravel())], ["k", "i", "v"])

    total = np.zeros((2, 1 + d + d * d))
    for r in rows.mapInArrow(moments, "k int, i int, v double").groupBy("k", "i").agg(F.sum("v").alias("v")).collect():
        total[r["k"], r["i"]] = r["v"]
    return solve(total, d, shrink)


def solve(total: np.ndarray, d: int, shrink: float) -> Model:
    counts = total[:, 0]
    if (counts == 0).any():
        share = float(counts[1] / counts.sum()) if counts.sum() else 0.5
        return Model(np.zeros(d), np.ones(d), [], [], [], 0.0, share)
    sums, products = total[:, 1:1 + d], total[:, 1 + d:].reshape(2, d, d)
    centre = sums.sum(axis=0) / counts.sum()
    scale = np.sqrt(np.maximum(np.diag(products.sum(axis=0)) / counts.sum() - centre ** 2, 1e-6))
    means, factors, log_dets = [], [], []
    for k in (0, 1):
        mean = sums[k] / counts[k]
        cov = (products[k] / counts[k] - np.outer(mean, mean)) / np.outer(scale, scale)
        cov = (1 - shrink) * cov + shrink * max(np.trace(cov) / d, 1e-3) * np.eye(d)
        factor = np.linalg.cholesky((cov + cov.T) / 2)
        means.append((mean - centre) / scale)
        factors.append(factor)
        log_dets.append(2 * float(np.log(np.diag(factor)).sum()))
    return Model(centre, scale, means, factors, log_dets, float(np.log(counts[1] / counts[0])))


def score_table(table: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` from a feature table."""
    d = len(FEATURES)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("x").flatten()).reshape(-1, d)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    return table.mapInArrow(rows, "doc_id long, score double")


def quality(documents: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document."""
    table = stored(feature_table(documents), "features")
    return (score_table(table, fit(table, labels))
            .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted")))


def good_documents(documents: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents that the classifier accepts, all columns kept; each row is judged by its own text."""
    model = fit(stored(feature_table(documents), "features"), labels)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(model.score(features(part.column("text"))) >= cut))

    return documents.mapInArrow(rows, documents.schema)
