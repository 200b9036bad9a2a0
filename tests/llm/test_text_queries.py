"""The registered text queries against their SQL, and those without SQL against plain Python."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import pyarrow.parquet as pq
import pytest

from fareflow.llm import mixing
from fareflow.llm.queries import ORACLES, QUERIES
from tests.conftest import SF


def rows_of(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    expected = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    tidy = lambda v: round(v, 6) if isinstance(v, float) else v
    got = ordered([tuple(tidy(r[c]) for c in expected.columns) for r in df.collect()])
    assert got == ordered([tuple(map(tidy, r)) for r in expected.fetchall()])


def test_quality_on_held_out_rows(spark):
    truth = {r["doc_id"]: r["quality"] for r in rows_of("labels")}
    rows = QUERIES["op3_quality"](spark, SF).collect()
    assert len(rows) == len(rows_of("documents"))
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    known = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in known) >= 0.9 * len(known)


def test_fuzzy_lines_like_brute_force(spark):
    found = {r.doc_id: r for r in QUERIES["op4_lines"](spark, SF).collect()}
    spots = collections.defaultdict(list)
    for r in sorted(rows_of("documents"), key=lambda r: r["doc_id"]):
        for i, line in enumerate(r["text"].split("\n")):
            if line.strip():
                spots[line].append((r["doc_id"], i))
    lines = list(spots)
    # A line shorter than a shingle is one itself.
    sets = [{x.encode()[p:p + 8] for p in range(max(len(x.encode()) - 7, 1))} for x in lines]
    holders = collections.defaultdict(list)
    for n, s in enumerate(sets):
        for x in s:
            holders[x].append(n)
    parent = list(range(len(lines)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, s in enumerate(sets):
        for m, both in collections.Counter(m for x in s for m in holders[x] if m > n).items():
            if 100 * both >= 80 * (len(s) + len(sets[m]) - both):
                a, b = root(n), root(m)
                parent[max(a, b)] = min(a, b)
    groups, gone = collections.defaultdict(list), collections.defaultdict(list)
    for n, line in enumerate(lines):
        groups[root(n)] += spots[line]
    for group in groups.values():
        for doc_id, i in sorted(group)[1:]:
            gone[doc_id].append(i)
    for doc_id, r in found.items():
        assert r.removed == ",".join(map(str, sorted(gone[doc_id])))


def test_main_text_is_the_article(spark):
    pages = {r["page_id"]: r["html"] for r in rows_of("pages")}
    import html as references
    for r in QUERIES["op5_main_text"](spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(references.unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))).split())
                 for p in re.split(r"</?h1>|</?p>", article)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_mix_meets_targets(spark):
    words = {r["doc_id"]: len((r["text"] or "").encode().split()) for r in rows_of("documents")}
    source = {r["doc_id"]: r["source"] for r in rows_of("documents")}
    rows = QUERIES["op6_mix"](spark, SF).collect()
    taken, target, size = collections.Counter(), {}, collections.Counter()
    for r in rows:
        assert r["size"] == words[r.doc_id] and 0 <= r.taken <= 3 * r["size"]
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        size[source[r.doc_id]] = r.source_size
    # Targets by repeated sharing of what is above three times a source's size.
    names = sorted(size, key=lambda s: s.encode("utf-32-be"))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    goal, full = {}, set()
    while True:
        rest = sum(size.values()) - sum(3 * size[s] for s in full)
        share = rest / sum(weight[s] for s in names if s not in full)
        goal = {s: 3 * size[s] if s in full else share * weight[s] for s in names}
        over = {s for s in names if goal[s] > 3 * size[s]}
        if not over:
            break
        full |= over
    for s in names:
        assert target[s] == pytest.approx(goal[s])
        assert abs(taken[s] - goal[s]) <= max(30, 0.01 * goal[s])
    again = QUERIES["op6_mix"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def jaccard(a, b):
    a, b = collections.Counter(a.encode().split()), collections.Counter(b.encode().split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_fingerprints_estimate_weighted_jaccard(spark):
    docs = sorted(rows_of("documents"), key=lambda r: -r["doc_id"])
    found = {r.doc_id: r for r in QUERIES["op7_fingerprints"](spark, SF).collect()}
    errors, of_text = [], {}
    for i, d in enumerate(docs):
        text, after, r = d["text"], docs[(i + 1) % len(docs)]["text"], found[d["doc_id"]]
        n = len(text)
        edited = text[:n - n // 2] + after[:n // 2]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert of_text.setdefault(text, r.fingerprint) == r.fingerprint
        errors += [r.near_edited - jaccard(text, edited), r.near_next - jaccard(text, after)]
    assert abs(sum(errors) / len(errors)) < 0.02 and sum(abs(e) for e in errors) / len(errors) < 0.08


def test_archive_round_trip(spark):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in rows_of("pages")}
    last = {}
    for page_id, payload in pages.items():
        last[payload] = max(page_id, last.get(payload, page_id))
    for r in QUERIES["op2_warc"](spark, SF).collect():
        import base64
        payload = pages[r.page_id]
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first = last[payload] == r.page_id
        assert (r.record_type, r.refers_to) == (("response", None) if first else ("revisit", last[payload]))


def test_pipeline_stages(spark):
    import corpus_pipeline
    from fareflow.llm.common import stored
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, SF), "stage")
        sizes.append(docs.count())
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]
    words = {r["doc_id"]: r["text"] for r in rows_of("documents")}
    leaks = {r["text"] for r in rows_of("benchmark")}
    kept = [words[r.doc_id] for r in docs.select("doc_id").collect()]
    assert not any(leak in text for leak in leaks for text in kept)


def test_mix_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    runs = [sorted(map(tuple, mixing.mix(docs.repartition(n)).select("doc_id", "copies", "taken").collect())) for n in (1, 5)]
    assert runs[0] == runs[1]
