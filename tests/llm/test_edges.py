"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import collections
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fareflow.llm import decontam, fingerprints, lines, mixing, ngrams, pages, quality, setjoin, substrings, tokens, warc
from fareflow.llm.components import components
from fareflow.session import shared_dir

CLASH = ("node", "k", "tie", "block", "size", "score", "bucket", "root", "copies")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)
rng = random.Random(3)
LONG = " ".join("w%d" % rng.randrange(5000) for _ in range(60_000))
PROSE = " ".join("p%d" % i for i in range(60))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, *[None] * len(CLASH)) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, [
        (1, PROSE, "a"), (1, PROSE, "a"), (2, PROSE, None), (2, "other text with a same id", "a"), (None, PROSE, "b"),
        (None, None, None), (3, None, "a"), (4, "", "a"), (5, " \n\t ", "b"), (6, "one", "b"), (7, LONG, "b"), (8, "Zoë — ünï \U0001F600 x", None)])


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


OPERATORS = {
    "lines": lines.line_report, "mix": mixing.mix, "fingerprints": fingerprints.compare_neighbours, "ngrams": ngrams.score,
    "setjoin": setjoin.near_duplicates, "substrings": substrings.find_repeats,
    "quality": lambda d: quality.quality(d, d.sparkSession.createDataFrame([(1, 1), (6, 0), (None, 1), (7, None)], "doc_id long, quality int")),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_per_document(odd, none, name):
    assert OPERATORS[name](odd).count() == odd.count()
    assert OPERATORS[name](none).count() == 0


def test_substrings_of_odd_rows(odd):
    got = collections.defaultdict(list)
    for r in substrings.find_repeats(odd).collect():
        got[r.doc_id].append((r.n_words, r.n_removed))
    assert got[1] == [(60, 0), (60, 0)]                      # equal ids do not remove each other
    assert sorted(got[2]) == [(6, 0), (60, 60)]
    assert sorted(got[None]) == [(0, 0), (60, 60)]           # a null id is the largest
    assert got[3] == got[4] == got[5] == [(0, 0)]


@pytest.mark.parametrize("length", [1, 2, 5, 13, 40])
def test_substrings_like_brute_force(spark, length):
    r = random.Random(length)
    texts = [" ".join(r.choice("abc") for _ in range(r.randrange(80))) for _ in range(25)]
    docs = documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    seen, want = {}, {}
    for i, t in enumerate(texts):
        w = t.split()
        gone = set()
        for p in range(len(w) - length + 1):
            key = tuple(w[p:p + length])
            if seen.setdefault(key, i) < i:
                gone |= set(range(p, p + length))
        want[i] = (len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone))
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept) for x in substrings.find_repeats(docs, length).collect()}
    assert got == want


def test_near_duplicates_like_brute_force(spark):
    r = random.Random(9)
    base = [[f"t{r.randrange(400)}" for _ in range(r.choice([3, 8, 30, 90]))] for _ in range(12)]
    texts = []
    for _ in range(150):
        w = list(r.choice(base))
        for _ in range(r.randrange(4)):
            w[r.randrange(len(w))] = f"T{r.randrange(400)}"
        texts.append(" ".join(w))
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[p:p + 5]) for p in range(len(w) - 4)} or {tuple(w)})
    parent = list(range(len(texts)))

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    docs = documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in setjoin.near_duplicates(docs).collect()}
    assert got == {i: (len(sets[i]), root(i)) for i in range(len(texts))}
    assert sorted(x.doc_id for x in setjoin.one_of_each(docs).collect()) == sorted({root(i) for i in range(len(texts))})


def test_filters_keep_columns(spark, odd, none):
    benchmark = spark.createDataFrame([(1, " ".join(f"p{i}" for i in range(20, 50))), (2, None), (3, ""), (4, "one"), (None, "same id")],
                                      "item_id long, text string")
    for docs in (odd, none):
        for kept in (decontam.without_leaks(docs, benchmark), lines.without_repeats(docs), setjoin.one_of_each(docs)):
            assert kept.columns == docs.columns
            kept.collect()
    found = {(x.doc_id, x.item_id): (x.n_shingles, x.n_shared) for x in decontam.contained(odd, benchmark).collect()}
    assert found == {(1, 1): (26, 26), (2, 1): (26, 26), (None, 1): (26, 26), (6, 4): (1, 1), (2, None): (1, 1)}
    assert decontam.contained(odd, benchmark.limit(0)).count() == 0
    left = collections.Counter(x.doc_id for x in setjoin.one_of_each(odd).collect())
    assert left == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1, None: 1}


@pytest.mark.parametrize("size", [5, 11, 12, 13, 16, 17, 33, 70])
def test_short_items_in_long_documents(spark, size):
    """A passage at the threshold is found at any offset of a long document."""
    r = random.Random(size)
    item = [f"i{r.randrange(10**6)}" for _ in range(size)]
    edit = list(item)
    if size > 30:  # one changed word spoils five shingles
        edit[0] = "other"
    rows = [(n, " ".join([f"x{r.randrange(10**6)}" for _ in range(r.randrange(3000))] + edit + [f"y{r.randrange(10**6)}" for _ in range(r.randrange(3000))]), None)
            for n in range(12)]
    benchmark = spark.createDataFrame([(7, " ".join(item).upper())], "item_id long, text string")
    got = decontam.contained(documents(spark, rows + [(99, LONG, None)]), benchmark).collect()
    assert sorted(x.doc_id for x in got) == list(range(12))


def test_archive_edges(spark):
    schema = "page_id long, url string, html string, payload string"
    rows = [(1, "http://a\r\nb", "x\r\n\r\ny", None), (2, None, "x\r\n\r\ny", None), (3, "u", None, None), (3, "v", "", None), (None, "w", "", None),
            (None, None, "alone", None), (5, "big", "é" * 3_000_000, None)]
    root = shared_dir(spark, "warc-test")
    pages_ = spark.createDataFrame(rows, schema)
    warc.write_archive(pages_, root)
    got = collections.Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_archive(spark, root).collect())
    assert got == {(1, 6, "revisit", 2): 1, (2, 6, "response", None): 1, (3, 0, "response", None): 2, (None, 0, "revisit", 3): 1,
                   (None, 5, "response", None): 1, (5, 6_000_000, "response", None): 1}
    ids = warc.read_index(spark, root).filter("page_id = 5").select("record_id")
    one = warc.fetch(spark, root, ids).collect()
    assert [bytes(r.payload) for r in one] == [("é" * 3_000_000).encode()]
    assert warc.archive_pages(spark, pages_.limit(0)).count() == 0
    big = {r.page_id: r.record_type for r in _roles(spark, pages_, 6)}
    assert big == {1: "revisit", 2: "response", 3: "response", None: "response", 5: "response"}


def _roles(spark, pages_, least):
    root = shared_dir(spark, "warc-test")
    warc.write_archive(pages_, root, least)
    return warc.read_archive(spark, root).collect()


PAGE = """<!doctype html><title>No &amp; title</title><body><header><a href=/>Home</a> Site name of it</header>
<nav class=menu><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav><div id="cookie-notice">We use cookies for all that we do here, accept them.</div>
<main><h1>A  head&shy;line</h1><p>First &lt;paragraph&gt; with <a href=x>a link</a>,&nbsp;and<br>a break.<script>if (a < b) { "</p>" }</script>
<div class="advert">Buy this now, it is cheap and it is good for you</div><p>Yes.<!-- <p>no</p> --><p>Second, unclosed
<form><input name=q><label>Search this</label></form><section class="comments"><h2>Comments</h2><p>I liked the article very much, said a reader.</p></section>
</main><aside>More stories</aside><footer>&copy; 2024 of the site</footer>"""


def test_page_parts(spark):
    tree = pages.trained()
    assert pages.main_text(PAGE, tree) == "A head\xadline\nFirst <paragraph> with a link, and a break.\nYes.\nSecond, unclosed"
    assert pages.main_text(None, tree) == pages.main_text("", tree) == ""
    plain = "<div>" + "".join(f"<p>{'word ' * 30}{i}</p>" for i in range(3)) + "</div><ul><li><a href=1>More</a></li><li><a href=2>Other</a></li></ul>"
    assert pages.main_text(plain, tree).count("\n") == 2
    rows = spark.createDataFrame([(None, None, None, "x"), (1, "u", PAGE, "y"), (1, "u", PAGE, "y")], "page_id long, url string, html string, text string")
    assert [r.n_chars for r in pages.extract(rows).orderBy(F.col("page_id").asc_nulls_first()).collect()][0] == 0
    assert pages.extract(rows.limit(0)).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7), (500, 499), (500, 499)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100, 499: 499, 500: 499}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_are_numbers_of_their_bytes(monkeypatch):
    texts = ["a b\x0bA", None, "", "  ", "b a b", "x" * 9000 + " y", "\x1fq \x85z"]
    for piece in (1, 7, 1 << 20):
        monkeypatch.setattr(tokens, "PIECE", piece)
        found = tokens.words(pa.array(texts))
        want = [w for t in texts for w in (t or "").encode().split()]
        assert len(found.number) == len(want)
        assert len(set(zip(want, found.number.tolist()))) == len(set(want)) == len(set(found.number.tolist()))
        assert np.diff(found.first).tolist() == [len((t or "").encode().split()) for t in texts]
    lowered = tokens.words(pa.array(["Ab É"]), lower=True).number
    assert lowered[0] == tokens.words(pa.array(["ab"])).number[0] and lowered[1] == tokens.words(pa.array(["É"])).number[0]
