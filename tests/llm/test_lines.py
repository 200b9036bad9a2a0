"""Groups of near lines that meet in large buckets, against plain Python."""

from __future__ import annotations

import random
import string

import pytest

from fareflow.llm import lines


def removed_by_brute_force(rows):
    """Per document of one line: whether a line of its component stands in an earlier document."""
    sets = [{t.encode()[p:p + 8] for p in range(len(t.encode()) - 7)} for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {rows[i][0] for i in range(len(rows)) if root(i) != i}


def letters(r, n):
    return "".join(r.choice(string.ascii_letters) for _ in range(n))


def small_clusters(r):
    """One template line and 200 variants, each with one near copy; neither the template nor another variant is near."""
    template = letters(r, 120)
    variants = [template + letters(r, 40) for _ in range(200)]
    return [template, *variants, *[v[:-1] + "!" for v in variants]]


def chains(r):
    """Eight chains of five lines with a common middle: only neighbours in a chain are near."""
    out = []
    for _ in range(8):
        text = list(letters(r, 200))
        for step in range(5):
            out.append("".join(text))
            for at in (20 + 36 * step, 32 + 36 * step):
                text[at] = "?"
    return out


@pytest.mark.parametrize("make", [small_clusters, chains])
def test_large_buckets_like_brute_force(spark, make):
    texts = make(random.Random(5))
    rows = list(enumerate(texts))
    want = removed_by_brute_force(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id for x in lines.line_report(docs).collect() if x.n_removed} == want
    assert len(want) == {small_clusters: 200, chains: 32}[make]


def test_chain_through_a_line_that_left_the_bucket(spark):
    """B is near A but not near the hub H, which A is near: H, A and B are one group, also when many lines share their buckets."""
    r = random.Random(8)
    head = letters(r, 120)
    texts = [head]
    for _ in range(30):
        body = letters(r, 60)
        h = head + body
        a = h[:150] + "".join("%" if i % 7 == 0 else c for i, c in enumerate(h[150:]))
        b = "&" * 14 + a[14:]
        texts += [h, a, b]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id for x in lines.line_report(docs).collect() if x.n_removed} == removed_by_brute_force(rows)


def test_sketches_never_rule_out_a_near_pair(spark):
    r = random.Random(2)
    base = [letters(r, n) for n in (20, 60, 200, 900) for _ in range(6)]
    texts = base + [t[:-2] + "??" for t in base] + ["ab" * 40, "ab" * 60]
    sketched = {x.lid: x for x in lines.sketches(spark.createDataFrame(list(enumerate(texts)), "lid long, line string")).collect()}
    sets = [{t.encode()[p:p + 8] for p in range(len(t) - 7)} for t in texts]
    for i, s in enumerate(sets):
        assert sketched[i].size == len(s)
        for j in range(i):
            differ = sum((sketched[i][f"bits{k}"] ^ sketched[j][f"bits{k}"]).bit_count() if sketched[i][f"bits{k}"] ^ sketched[j][f"bits{k}"] >= 0
                         else (2**64 + (sketched[i][f"bits{k}"] ^ sketched[j][f"bits{k}"])).bit_count() for k in range(lines.CELLS))
            assert differ <= len(s ^ sets[j])


def test_short_and_blank_lines(spark):
    """Equal short lines go, however short; lines of white space alone stay."""
    docs = spark.createDataFrame([(1, "Reply\n\t\t\nx"), (2, "Reply\n\t\t\n \n\ny"), (3, "reply\nx"), (4, "\t\t\t\t\t\t\t\t\t\t")], "doc_id long, text string")
    assert {r.doc_id: (r.n_lines, r.removed) for r in lines.line_report(docs).collect()} == {
        1: (2, ""), 2: (2, "0"), 3: (2, "1"), 4: (0, "")}
    assert {r.doc_id: r.text for r in lines.without_repeats(docs).collect()}[2] == "\t\t\n \n\ny"


def test_pairs_well_below_the_threshold_never_become_rows(spark):
    """Lines of one bucket, most at 0.72 to one another, the few whose marks lie close nearer: sketches must rule the others out in the join."""
    r = random.Random(4)
    base, texts = letters(r, 700), []
    for n in range(40):
        text = list(base)
        for step in range(7):
            text[8 + 96 * step + 2 * n] = "?"
        texts.append("".join(text))
    found = spark.createDataFrame(list(enumerate(texts)), "lid long, line string")
    buckets = found.selectExpr("1L AS key", "lid", "-1L AS hub")
    roots = spark.createDataFrame([], "node long, root long")
    assert lines.across(buckets, roots, found, 80).count() < 0.2 * len(texts) * (len(texts) - 1) / 2


def test_settings_hold_only_while_a_table_is_written(spark):
    """Signatures and sketches are written under map settings of their own, which are gone afterwards."""
    names = [*lines.FEW_GROUPS, *lines.MANY_GROUPS]
    before = [spark.conf.get(n, None) for n in names]
    assert lines.stored(spark.range(3), "three", lines.FEW_GROUPS | lines.MANY_GROUPS).count() == 3
    assert [spark.conf.get(n, None) for n in names] == before


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_are_counted_without_an_order(spark):
    """Most band values belong to one line: a count finds them, neighbours in the order of lines are not needed."""
    docs = spark.createDataFrame([(1, "the same line here\nanother one, alone"), (2, "the same line here!")], "doc_id long, text string")
    found = lines.candidates(docs)
    assert "lag(" not in plan_of(found) and "lead(" not in plan_of(found)
    rows = {r.lid: r for r in lines.bands(lines.occurrences(docs).select("lid", "line")).groupBy("lid").agg({"key": "count"}).collect()}
    assert all(len(r["keys"]) <= rows[r.lid]["count(key)"] and r.central >= 2 * len(r["keys"]) for r in found.collect())


def test_sketches_do_not_shuffle_shingles(spark):
    """The different shingles of a line are told apart inside its row; no aggregate has a group per shingle."""
    few = spark.createDataFrame([(1, "abcdefgh" * 5), (2, "x" * 30)], "lid long, line string")
    assert "array_distinct" in plan_of(lines.sketches(few))
    assert {r.lid: r.size for r in lines.sketches(few).collect()} == {1: 8, 2: 1}
