"""Words and word shingles of Arrow text columns as 64-bit numbers.

Words are read from the column's bytes with whole-array operations. A word's
number is a sum over its bytes of a fixed random value per byte value times a
power of an odd base, modulo 2^64, then mixed; equal words have equal numbers
everywhere. Two different words or shingles share a number with a chance of
about 2^-64 for each pair compared.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Text is turned into numbers in pieces of this many bytes, cut at white space.
PIECE = 1 << 16

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BYTE_VALUES = np.random.Generator(np.random.PCG64(20240607)).integers(0, 2**64, 256, dtype=U64)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[ord("A"):ord("Z") + 1] = BYTE_VALUES[ord("a"):ord("z") + 1]

def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2^64."""
    out = []
    for base in (BASE, pow(BASE, -1, 2**64)):
        steps = np.full(n, base, U64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


@dataclass
class Words:
    """All words of some documents, in order."""
    number: np.ndarray   # uint64
    doc: np.ndarray      # int32, position of the document in the column
    first: np.ndarray    # int64, per document: index of its first word; one more entry at the end


def bytes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and where each text starts; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.fill_null("").cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words(column, lower: bool = False) -> Words:
    data, offsets = bytes_of(column)
    values = LOWER_VALUES if lower else BYTE_VALUES
    edges = np.zeros(len(data) + 1, bool)
    edges[offsets] = True
    power, inverse = powers(min(PIECE, len(data)) + 1)
    numbers, starts, at = [np.zeros(0, U64)], [np.zeros(0, np.int64)], 0
    while at < len(data):
        stop = min(at + PIECE, len(data))
        while stop < len(data) and not (SPACE[data[stop]] or edges[stop]):
            ahead = np.flatnonzero(SPACE[data[stop:stop + 4096]] | edges[stop:stop + len(data[stop:stop + 4096])])
            stop = stop + int(ahead[0]) if len(ahead) else min(stop + 4096, len(data))
        part = data[at:stop]
        inside, edge = ~SPACE[part], edges[at:stop]
        start, last = inside.copy(), inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:]
        last[:-1] &= ~inside[1:] | edge[1:]
        s, e = np.flatnonzero(start), np.flatnonzero(last) + 1
        if len(part) >= len(power):  # a word went on beyond the piece
            power, inverse = powers(len(part) + 1)
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(values[part] * power[:len(part)], out=total[1:])
        numbers.append(mix((total[e] - total[s]) * inverse[s] + (e - s).astype(U64)))
        starts.append(s + at)
        at = stop
    number, start = np.concatenate(numbers), np.concatenate(starts)
    first = np.searchsorted(start, offsets)
    return Words(number, np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(first)), first)


def shingles(number: np.ndarray, size: int) -> np.ndarray:
    """The numbers of all runs of ``size`` words, across document borders too."""
    n = max(len(number) - size + 1, 0)
    out = np.full(n, size, U64)
    for i in range(size):
        out = out * U64(0xFF51AFD7ED558CCD) + number[i:i + n]
    return mix(out)


def within(doc: np.ndarray, size: int) -> np.ndarray:
    """Which runs of ``size`` words lie in one document."""
    n = max(len(doc) - size + 1, 0)
    return doc[:n] == doc[len(doc) - n:]


def distinct(doc: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different (doc, number) pairs, sorted."""
    order = np.lexsort((number, doc))
    doc, number = doc[order], number[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (number[1:] != number[:-1])
    return doc[new], number[new]
