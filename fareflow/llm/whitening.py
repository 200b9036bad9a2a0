"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers ``x = floor(64 * c) + 1000000``. The fit list holds
every different vector once; C is its matrix of rows minus their mean. From a
fixed start vector the recurrence alternates the products ``C v`` and ``C' u``::

    C v_k  = beta_(k-1) u_(k-1) + alpha_k u_k
    C' u_k = alpha_k v_k + beta_k v_(k+1)

and keeps every new u and v orthogonal to all earlier ones. The long vectors u are
never stored: each is C times a short vector g, so one pass over the rows yields the
norm of ``C h``, its products with all earlier u, and ``C' C h``; the driver holds
only vectors of the embedding's length. Where the recurrence ends early (equal
eigenvalues, low rank), it goes on from a new vector orthogonal to all earlier ones.
It stops once the wanted triplets have settled to double precision and the variance
not yet reached is smaller than the smallest wanted one, so that none is missed, at
the latest after as many steps as there are dimensions. The singular values and right
vectors of the small bidiagonal matrix give deviations and components.

Defined results: null vectors, vectors with a null or non-finite entry or one of
2^46 and more (its x has no exact double) are left out; so are vectors whose length
is not the commonest (of equally common ones the longest), and empty ones. Repeated
rows count once in the fit and each get their own rows. Directions without variance
have no component, so fewer than ``wanted`` may come back, none for a single
different vector. ``deviation`` is null where it does not fit a long. Of the two
directions of a component the one with a positive largest entry (the first of equal
ones) is taken. An empty table yields no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import stored

WANTED = 16
OFFSET = 1_000_000
#: A number is held in two parts below and above this bit, so that sums stay exact.
SPLIT = 26
LARGEST = float(2**46)
#: Rows that one product takes at a time.
ROWS = 4096
#: Tasks that add up the vectors of all tasks.
ADDERS = 8
SETTLED = 1e-15
#: Singular values below this share of the largest are no direction.
FLAT = 1e-9
SCHEMA = ("vec_id {id}, component int, n bigint, deviation bigint, whitened double, explained double, "
          "identity_error double")


@dataclass
class Basis:
    """What the fit leaves: components in columns, eigenvalues, exact sums."""
    n: int
    sums: list[int]          # of x - OFFSET per dimension
    mean: np.ndarray         # of x - OFFSET
    components: np.ndarray   # dimensions x components
    variances: np.ndarray
    trace: float
    steps: int


def whitened(embeddings: DataFrame, wanted: int = WANTED) -> DataFrame:
    """One row per usable embedding and component."""
    rows = lattice(embeddings)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    schema = SCHEMA.format(id=kind)
    length = commonest_length(rows)
    spark = embeddings.sparkSession
    if not length:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("x") == length)
    fit = stored(rows.select("x").distinct(), "lattice")
    basis = bidiagonal_basis(fit, length, wanted)
    error = identity_error(fit, basis)
    return rows.mapInArrow(_project(basis, error), schema)


def lattice(embeddings: DataFrame) -> DataFrame:
    """``vec_id, x``: usable vectors as whole numbers."""
    value = F.col("embedding")
    usable = F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    x = F.transform(value, lambda c: F.floor(c.cast("double") * 64).cast("bigint") + OFFSET)
    return embeddings.filter(value.isNotNull() & usable).select("vec_id", x.alias("x"))


def commonest_length(rows: DataFrame) -> int:
    best = (rows.groupBy(F.size("x").alias("length")).count()
            .orderBy(F.desc("count"), F.desc("length")).limit(1).collect())
    return best[0]["length"] if best else 0


def bidiagonal_basis(fit: DataFrame, length: int, wanted: int = WANTED) -> Basis:
    n, sums = _exact_sums(fit, length)
    mean = np.array([_quotient(s, n) for s in sums])
    total = float(_summed(fit, lambda y: np.array([np.sum(y * y)]), mean, 1)[0])
    chance = np.random.Generator(np.random.PCG64(11))
    basis = lambda columns: np.array(columns).T.reshape(length, len(columns))
    right, short, images, alphas, betas = [], [], [], [], []
    beta, v = 0.0, _unit_beside(chance.normal(size=length), right)
    left = total
    while v is not None:
        g_all, w_all = basis(short), basis(images)
        h = v - beta * short[-1] if beta else v
        k = len(right)

        def products(y):
            p = y @ h
            return np.concatenate([[p @ p], p @ y, (y @ g_all).T @ p])

        got = _summed(fit, products, mean, length + k + 1)
        size, image, along = got[0], got[1:length + 1], got[length + 1:length + 1 + k]
        right.append(v)
        alpha = float(np.sqrt(max(size - along @ along, 0.0)))
        scale = max([alpha, beta, *alphas, *betas])
        if alpha <= 1e-13 * scale or scale == 0:
            alpha, g, w = 0.0, np.zeros(length), np.zeros(length)
        else:
            g, w = (h - g_all @ along) / alpha, (image - w_all @ along) / alpha
        left -= alpha**2 + beta**2
        alphas.append(alpha)
        betas.append(beta)
        short.append(g)
        images.append(w)
        rest = _beside(w - alpha * v, right)
        beta = float(np.linalg.norm(rest))
        if beta > 1e-13 * scale:
            v = rest / beta
        else:
            beta, v = 0.0, _unit_beside(chance.normal(size=length), right)
        if len(right) >= min(wanted, length) and v is not None and _settled(alphas, betas, beta, left, wanted):
            break
    b = np.diag(alphas) + np.diag(betas[1:], 1)
    _, sigma, turned = np.linalg.svd(b)
    keep = min(wanted, int(np.sum(sigma > FLAT * sigma[0])) if sigma[0] > 0 else 0)
    found = basis(right) @ turned[:keep].T
    if keep:
        found *= np.sign(found[np.argmax(np.abs(found) > np.abs(found).max(0) - 1e-12, axis=0), np.arange(keep)])
    return Basis(n, sums, mean, found, sigma[:keep]**2 / n, total / n, len(right))


def _settled(alphas, betas, beta: float, left: float, wanted: int) -> bool:
    """Are the wanted triplets final, and can nothing larger be left outside?"""
    b = np.diag(alphas) + np.diag(betas[1:], 1)
    p, sigma, _ = np.linalg.svd(b)
    at = min(wanted, len(sigma))
    return bool(np.all(beta * np.abs(p[-1, :at]) <= SETTLED * sigma[0]) and left < sigma[at - 1]**2)


def _beside(vector: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    """The part of a vector orthogonal to all columns; twice, against rounding."""
    if columns:
        q = np.array(columns)
        for _ in range(2):
            vector = vector - q.T @ (q @ vector)
    return vector


def _unit_beside(vector: np.ndarray, columns: list[np.ndarray]) -> np.ndarray | None:
    """A unit vector orthogonal to all columns, or None where they fill the space."""
    if len(columns) >= len(vector):
        return None
    rest = _beside(vector, columns)
    return rest / np.linalg.norm(rest)


def _quotient(s: int, n: int) -> float:
    whole, rest = divmod(s, n)
    return whole + rest / n


# -- passes over the rows ----------------------------------------------------

def _blocks(batches, name: str = "x"):
    """Matrices of x - OFFSET, a bounded number of rows each."""
    for batch in batches:
        column = batch.column(name)
        for at in range(0, len(column), ROWS):
            part = column.slice(at, ROWS)
            yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1) - OFFSET


def _summed(fit: DataFrame, products, mean: np.ndarray, width: int) -> np.ndarray:
    """The sum over all rows of ``products(centred rows)``."""

    def add(batches):
        total = np.zeros(width)
        for y in _blocks(batches):
            total += products(y - mean)
        yield _row(total)

    return _added(fit.mapInArrow(add, "part array<double>"), np.zeros(width), "part array<double>")


def _added(parts: DataFrame, zero: np.ndarray, schema: str) -> np.ndarray:
    """One vector per task, added up by a few tasks and then here."""

    def add(batches):
        total = zero.copy()
        for batch in batches:
            total += batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(zero)).sum(0)
        yield _row(total)

    few = parts.repartition(ADDERS).mapInArrow(add, schema).collect()
    return np.sum([r[0] for r in few], axis=0, dtype=zero.dtype)


def _row(vector: np.ndarray) -> pa.RecordBatch:
    cells = pa.array(vector)
    return pa.record_batch([pa.ListArray.from_arrays(pa.array([0, len(cells)], pa.int32()), cells)], ["part"])


def _exact_sums(fit: DataFrame, length: int) -> tuple[int, list[int]]:
    def add(batches):
        n, high, low = 0, np.zeros(length, np.int64), np.zeros(length, np.int64)
        for y in _blocks(batches):
            n += len(y)
            high += (y >> SPLIT).sum(0)
            low += (y & ((1 << SPLIT) - 1)).sum(0)
        yield _row(np.concatenate([[n], high, low]))

    n, *cells = _added(fit.mapInArrow(add, "part array<bigint>"), np.zeros(2 * length + 1, np.int64), "part array<bigint>").tolist()
    return n, [(h << SPLIT) + low for h, low in zip(cells[:length], cells[length:])]


def identity_error(fit: DataFrame, basis: Basis) -> float | None:
    """The largest entry of the whitened fit list's covariance minus the identity."""
    k = len(basis.variances)
    if not k:
        return None
    scaled = basis.components / np.sqrt(basis.variances)

    def products(y):
        w = y @ scaled
        return (w.T @ w).ravel()

    covariance = _summed(fit, products, basis.mean, k * k).reshape(k, k) / basis.n
    return float(np.max(np.abs(covariance - np.eye(k))))


def _project(basis: Basis, error: float | None):
    n, k = basis.n, len(basis.variances)
    scaled = basis.components / np.sqrt(basis.variances)
    explained = basis.variances / basis.trace if k else basis.variances

    def deviations(y: np.ndarray) -> list[int | None]:
        rough = np.sum((n * y.astype(float) - np.array([float(s) for s in basis.sums]))**2, axis=1)
        if rough.max(initial=0) < 9e18 and max(map(abs, basis.sums)) < 2**62 and n * float(np.abs(y).max(initial=0)) < 2**62:
            return np.sum((n * y - np.array(basis.sums, np.int64))**2, axis=1).tolist()
        exact = [sum((n * int(v) - s)**2 for v, s in zip(row, basis.sums)) for row in y]
        return [e if e < 2**63 else None for e in exact]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                y = next(_blocks([part]))
                w, m = (y - basis.mean) @ scaled, len(y)
                index = np.repeat(np.arange(m), k)
                yield pa.record_batch([
                    part.column("vec_id").take(pa.array(index)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)), pa.array(deviations(y), pa.int64()).take(pa.array(index)),
                    pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array([error] * (m * k), pa.float64())],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run
