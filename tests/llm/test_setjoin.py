"""Pairs that the set join compares, beside its results."""

from __future__ import annotations

import random

import pyarrow as pa

from fareflow.llm import setjoin


def test_pairs_below_the_threshold_are_ruled_out_before_they_are_rows(spark, monkeypatch):
    """Forty texts, any two at 0.66: the second round meets all pairs of them, and none may go on to be verified."""
    r = random.Random(6)
    base, rows = [f"w{i}" for i in range(400)], []
    for n in range(40):
        text = list(base)
        for at in r.sample(range(0, 400, 6), 8):
            text[at] = f"x{n}y{at}"
        rows.append((n, " ".join(text)))
    sizes = []

    def kept(df, label, plain=setjoin.stored):
        out = plain(df, label)
        if label == "pairs":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(setjoin, "stored", kept)
    found = setjoin.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.component_id) for x in found) == [(n, n) for n, _ in rows]
    assert len(sizes) == 2 and sizes[1] < 20


def test_parities_never_differ_in_more_than_the_sets_do():
    r = random.Random(7)
    texts = [" ".join(f"a{r.randrange(9000)}" for _ in range(n)) for n in (1, 4, 5, 60, 700, 4000) for _ in range(3)]
    texts += [t.replace("a1", "b1") for t in texts] + ["", None]
    doc, number, sizes = setjoin.shingle_sets(pa.array(texts))
    words = [[int(x) % 2**64 for x in w] for w in setjoin.parities(doc, number, len(texts))]
    sets = [set(number[doc == i].tolist()) for i in range(len(texts))]
    assert [len(s) for s in sets] == sizes.tolist()
    for i, s in enumerate(sets):
        for j in range(i):
            assert sum((w[i] ^ w[j]).bit_count() for w in words) <= len(s ^ sets[j])
