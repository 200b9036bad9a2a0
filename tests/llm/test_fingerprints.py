"""How far the registered fingerprints' likeness is from the true similarity."""

from __future__ import annotations

import hashlib

from fareflow.llm import fingerprints
from fareflow.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.test_text_queries import jaccard, rows_of


def test_likeness_of_single_documents(spark):
    docs = sorted(rows_of("documents"), key=lambda r: -r["doc_id"])
    found = {r.doc_id: r for r in QUERIES["op7_fingerprints"](spark, SF).collect()}
    errors = []
    for i, d in enumerate(docs):
        text, after, r = d["text"], docs[(i + 1) % len(docs)]["text"], found[d["doc_id"]]
        n = len(text)
        errors.append(r.near_edited - jaccard(text, text[:n - n // 2] + after[:n // 2]))
        assert len(r.fingerprint) == len(r.edited_fingerprint) == 8 * 128
    # At 0.5 a likeness of 128 samples has a deviation of 0.044, one of 32 samples 0.088.
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.055
    print("deviation", (sum(e * e for e in errors) / len(errors)) ** 0.5)


def test_work_is_a_hash_per_word_and_some_per_sample(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (1, 7, 400, 5000)] + ["same " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    thrown = {r.id: r["count"] for r in fingerprints.throws(df, ["id"]).groupBy("id").count().collect()}
    for i, text in enumerate(texts):
        assert thrown[i] <= len(text.split()) + fingerprints.SAMPLES * fingerprints.DARTS


def test_samples_do_not_depend_on_the_darts_thrown_at_first(spark, monkeypatch):
    """Texts left with an undecided sample play on: the result is that of a long game."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-1, "one"), (-2, ""), (-3, None), (-4, "a a a b")], "doc_id long, text string"))
    rows = lambda: sorted(map(tuple, fingerprints.compare_neighbours(docs).collect()))
    want = rows()
    assert len(want) == docs.count() and all(len(r[3]) == len(r[4]) == 8 * 128 for r in want)
    monkeypatch.setattr(fingerprints, "DARTS", 2)
    assert rows() == want


def test_neighbours_across_chunks(spark, monkeypatch):
    """Many small chunks: the next document may end the chunk or, of the last one, be the first; ids may be equal, null or extreme."""
    ids = [*range(0, 60, 3), 7, 7, None, None, -(2**63), 2**63 - 1, 5, 5]
    rows = [(k, f"{k} " + " ".join(f"w{i * j % 13}" for j in range(i % 9 + 1))) for i, k in enumerate(ids)]
    rows += [(5, rows[-1][1]), (8, ""), (10, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(str, fingerprints.compare_neighbours(docs).collect()))
    monkeypatch.setattr(fingerprints, "TASK_BYTES", 40)
    got = fingerprints.compare_neighbours(docs).collect()
    assert sorted(map(str, got)) == want and len(got) == len(rows)
    edited = lambda a, b: hashlib.sha256((a[:len(a) - len(a) // 2] + b[:len(a) // 2]).encode()).hexdigest()
    order = sorted(rows, key=lambda r: r[0] if r[0] is not None else -(2**63), reverse=True)
    texts, found = [t or "" for _, t in order], {r.doc_id: r for r in got}
    for i, (k, _) in enumerate(order[:-3]):
        if [x for x, _ in order].count(k) == 1 and [x for x, _ in order].count(order[i + 1][0]) == 1:
            assert found[k].edited_sha256 == edited(texts[i], texts[i + 1])
    # The three of the smallest id stand in any order; the last of them is followed by the largest id.
    assert {r.edited_sha256 for r in got if r.doc_id is None} & {edited(t, texts[0]) for t in texts[-3:]}


def test_texts_are_shuffled_once(spark, monkeypatch):
    """The plan names the exchange of the texts once for each of its two uses, and nothing else in it moves a text."""
    plans, real = {}, fingerprints.stored

    def watched(df, label):
        plans.setdefault(label, df._jdf.queryExecution().executedPlan().toString())
        return real(df, label)

    monkeypatch.setattr(fingerprints, "stored", watched)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with more rows than are broadcast
    try:
        fingerprints.compare_neighbours(spark.read.parquet(f"{SF}/documents.parquet"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plans["prints"].count("Exchange") == plans["prints"].count("REPARTITION_BY_NUM") == 2
