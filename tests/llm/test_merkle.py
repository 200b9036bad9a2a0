"""The Merkle manifest against trees built by hand."""

import hashlib
import zlib

import pytest

from fareflow.llm import merkle
from tests.conftest import SF

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(level):
    out = [level]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def path(levels, at):
    out = []
    for level in levels[:-1]:
        out.append((at & 1, level[at ^ 1] if at ^ 1 < len(level) else None))
        at >>= 1
    return out


def by_hand(rows):
    def leaf(r, more=0):
        n = None if r.n_chars is None else r.n_chars + more
        return h("".join(map(field, (r.doc_id, r.source, r.lang, n, r.text))))

    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r), r))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: levels_of([g[2] for g in sorted(groups[lang], key=lambda g: g[:3])]) for lang in langs}
    top = levels_of([trees[lang][-1][0] for lang in langs])
    out = []
    for q, lang in enumerate(langs):
        for i, (_, _, value, r) in enumerate(sorted(groups[lang], key=lambda g: g[:3])):
            way = path(trees[lang], i) + path(top, q)
            end = leaf(r, int(r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0))
            for side, other in way:
                end = h(end if other is None else other + end if side else end + other)
            out.append((r.doc_id, value, trees[lang][-1][0], top[-1][0], h("".join(o for _, o in way if o)), end, end == top[-1][0]))
    return sorted(out, key=str)


def check(df):
    got = sorted(map(tuple, merkle.manifest(df).collect()), key=str)
    rows = df.select("doc_id", "text", "lang", "source", "n_chars").collect()
    assert got == (by_hand(rows) if rows else [])
    return got


@pytest.mark.parametrize("leaves, step", [(50_000, 12), (7, 2)])
def test_equals_trees_by_hand(spark, monkeypatch, leaves, step):
    """Once all in one partition, once in many whose ranges cut through the trees."""
    monkeypatch.setattr(merkle, "LEAVES", leaves)
    monkeypatch.setattr(merkle, "STEP", step)
    got = check(spark.read.parquet(f"{SF}/documents.parquet"))
    assert {r[-1] for r in got} == {True, False}


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEAVES", 5)
    monkeypatch.setattr(merkle, "STEP", 3)
    odd = [(None, None, None, None, None)] * 3 + [(5, "", "", "ü", 0)] * 2 + [(7, "x" * 3_000_000, "de", "s", 1)]
    many = [(i, "t", f"l{i}", None, None if i % 3 else i) for i in range(23)]
    check(spark.createDataFrame(odd + many, SCHEMA))


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", "s", 1)], [(14, "a", None, "s", 1), (14, "a", None, "s", 1)]])
def test_few_rows(spark, rows):
    check(spark.createDataFrame(rows, SCHEMA))


def test_clashing_names(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(9)
    check(df.selectExpr("*", "1 AS part", "2 AS row", "3 AS leaf", "4 AS found", "5 AS tree", "6 AS n"))


def test_octopus_names_no_node_twice_or_in_vain():
    import numpy as np
    got = [x.tolist() for x in merkle.octopus(np.array([5, 6, 7]), merkle.widths(11))]
    assert got == [[4], [], [0], [1]]
