"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.llm import (decontam, fingerprints, licenses, lines, merkle, mixing, ngrams, pages, quality, setjoin, substrings,
                          warc, whitening)
from fareflow.llm.common import table
from fareflow.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query("""
WITH t AS (SELECT doc_id AS id, 0 AS k, text FROM documents UNION ALL SELECT item_id, 1, text FROM benchmark),
w AS (SELECT id, k, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM t),
g AS (SELECT id, k, w, unnest(range(1, len(w) - 3)) AS p FROM w WHERE len(w) >= 5),
s AS (SELECT DISTINCT id, k, array_to_string(w[p:p + 4], ' ') AS s FROM g),
n AS (SELECT id, count(*) AS n FROM s WHERE k = 1 GROUP BY 1),
c AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared FROM s d JOIN s b ON d.s = b.s AND d.k = 0 AND b.k = 1 GROUP BY 1, 2)
SELECT doc_id, item_id, n AS n_shingles, n_shared, n_shared / n AS containment FROM c JOIN n ON n.id = item_id WHERE n_shared / n >= 0.8""")
def op1_decontaminate(spark, sf_dir):
    return decontam.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op2_warc(spark, sf_dir):
    return warc.archive_pages(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op3_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op4_lines(spark, sf_dir):
    return lines.line_report(table(spark, sf_dir, "documents"))


@query()
def op5_main_text(spark, sf_dir):
    return pages.extract(table(spark, sf_dir, "pages"))


@query()
def op6_mix(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("""
WITH RECURSIVE t AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM t WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s FROM g),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM k JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT t.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, least(t.doc_id, min(r.b)) AS component_id
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN r ON r.a = t.doc_id GROUP BY t.doc_id""")
def op9_jaccard_join(spark, sf_dir):
    return setjoin.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS p, w FROM t WHERE len(w) >= 13),
h AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS s FROM g),
bad AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS lo FROM h) WHERE lo < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i FROM bad),
word AS (SELECT doc_id, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS i FROM t),
kept AS (SELECT doc_id, string_agg(v, ' ' ORDER BY i) AS k FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS c FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(c, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM t LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def op10_substrings(spark, sf_dir):
    return substrings.find_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query()
def op7_fingerprints(spark, sf_dir):
    return fingerprints.compare_neighbours(table(spark, sf_dir, "documents"))


@query("""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS i FROM t),
pair AS (SELECT a.doc_id, a.i, b.v AS c, a.v FROM word a LEFT JOIN word b ON b.doc_id = a.doc_id AND b.i = a.i - 1),
own1 AS (SELECT doc_id, v, count(*) AS o FROM word GROUP BY 1, 2),
own2 AS (SELECT doc_id, c, v, count(*) AS o FROM pair WHERE c IS NOT NULL GROUP BY 1, 2, 3),
all1 AS (SELECT v, sum(o) AS n FROM own1 GROUP BY 1),
all2 AS (SELECT c, v, sum(o) AS n FROM own2 GROUP BY 1, 2),
rest1 AS (SELECT doc_id, v, n - o AS n FROM own1 JOIN all1 USING (v)),
rest2 AS (SELECT doc_id, c, v, n - o AS n FROM own2 JOIN all2 USING (c, v)),
total AS (SELECT count(*) AS n FROM word),
s AS (SELECT p.doc_id, coalesce(g.n, 0) = 0 AS backed,
        CASE WHEN g.n > 0 THEN ln(g.n / x.n)
             ELSE ln(greatest(u.n, 0.5) / greatest((SELECT n FROM total) - len(t.w), 1)) + ln(0.4) END AS l
      FROM pair p JOIN t USING (doc_id) JOIN rest1 u ON u.doc_id = p.doc_id AND u.v = p.v
      LEFT JOIN rest2 g ON g.doc_id = p.doc_id AND g.c = p.c AND g.v = p.v
      LEFT JOIN rest1 x ON x.doc_id = p.doc_id AND x.v = p.c),
d AS (SELECT doc_id, sum(backed::INT) AS b, sum(l) AS l FROM s GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(b, 0)::BIGINT AS n_backoff, round(coalesce(l, 0), 4)::DOUBLE AS log_score
FROM t LEFT JOIN d USING (doc_id)""")
def op8_backoff(spark, sf_dir):
    scores = ngrams.score(table(spark, sf_dir, "documents"))
    return scores.select("doc_id", "n_words", "n_backoff", F.round("log_score", 4).alias("log_score"))


@query()
def op11_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query(licenses.oracle())
def op12_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents")).drop("found")


@query("""
WITH RECURSIVE d AS (SELECT doc_id, lang, '' || coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
        || coalesce(strlen(lang) || ':' || lang, '-') AS a, n_chars AS n, coalesce(strlen(text) || ':' || text, '-') AS z,
      list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '0'), ''),
        lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END) AS crc FROM documents),
t AS (SELECT *, n + (doc_id IS NOT NULL AND xor(crc, 4294967295) % 7 = 0)::INT AS m FROM d),
h AS (SELECT doc_id, lang, sha256(a || coalesce(strlen(n::VARCHAR) || ':' || n, '-') || z) AS leaf,
        sha256(a || coalesce(strlen(m::VARCHAR) || ':' || m, '-') || z) AS found FROM t),
f AS (SELECT *, row_number() OVER () AS k, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM h),
up AS (SELECT lang, 0 AS v, list(leaf ORDER BY p) AS l FROM f GROUP BY lang UNION ALL
  SELECT lang, v + 1, list_transform(range(0, (len(l) + 1) // 2), lambda i: sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], ''))) FROM up WHERE len(l) > 1),
sub AS (SELECT lang, l[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS q FROM up WHERE len(l) = 1),
top AS (SELECT 0 AS v, list(subroot ORDER BY q) AS l FROM sub UNION ALL
  SELECT v + 1, list_transform(range(0, (len(l) + 1) // 2), lambda i: sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], ''))) FROM top WHERE len(l) > 1),
s AS (SELECT k, v, p >> v AS i, l FROM f JOIN up ON f.lang IS NOT DISTINCT FROM up.lang AND len(l) > 1 UNION ALL
  SELECT k, 100 + v, q >> v, l FROM f JOIN sub ON f.lang IS NOT DISTINCT FROM sub.lang JOIN top ON len(l) > 1),
w AS (SELECT k, v, i & 1 AS side, l[xor(i, 1) + 1] AS o FROM s),
c AS (SELECT k, list(CASE WHEN o IS NULL THEN '-' WHEN side = 1 THEN 'L' || o ELSE 'R' || o END ORDER BY v) AS way, coalesce(string_agg(o, '' ORDER BY v), '') AS o
  FROM w GROUP BY k),
e AS (SELECT doc_id, leaf, subroot, (SELECT l[1] FROM top WHERE len(l) = 1) AS root, sha256(coalesce(o, '')) AS proof_sha256,
    list_reduce(list_prepend(found, coalesce(way, [])), lambda x, y: CASE WHEN y = '-' THEN sha256(x) WHEN y[1] = 'L' THEN sha256(y[2:] || x)
      ELSE sha256(x || y[2:]) END) AS folded_root
  FROM f JOIN sub ON f.lang IS NOT DISTINCT FROM sub.lang LEFT JOIN c USING (k))
SELECT *, folded_root = root AS verified FROM e""")
def op13_merkle(spark, sf_dir):
    return merkle.manifest(table(spark, sf_dir, "documents"))
