"""License scan by ordered signature rules, in DataFrame functions only.

A text becomes its words. Every rule is a regular expression over words joined by
one space; it starts with a literal word, its anchor. The keyword prefilter keeps the
places of anchors; a rule is tried at a place of its anchor only, on the next
``WINDOW`` words, and only if these contain the rule's key word. At one place the
rule of the best tier counts, of these the longest match, of these the first in
order. A detection that lies within one of an equal or better tier is suppressed.
At most one detection starts at a word and none is longer than ``WINDOW``, so the
detections before it that can contain one are at most ``WINDOW``: every step is
linear in the text.

Beside the rules stand the three base phrases, whose places all count and whose
labels are never suppressed. ``score`` is the confidence of the best tier found, base
phrases included, and 0 where nothing is found.

A row is worked on alone: no shuffle, and repeated rows and null or repeated ids need
no care. Its words are held as an array, some 15 times the text's size while the row
lasts. Defined results: a null or empty text, or one without words, has no words,
no places, empty labels and score 0. Ties are settled as above. An empty table yields no
rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareflow.llm.common import text_or_empty

#: Words a rule can span.
WINDOW = 24
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases whose places are counted, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Tiers, best first: a machine-readable tag, a sentence of the license itself, a name
#: with its version, a name without, a general hint; and how sure each is.
TAG, SENTENCE, VERSION, NAME, HINT = range(5)
CONFIDENCE = (1.0, 0.95, 0.9, 0.7, 0.4)
#: Tier of the base phrases in the score.
BASE_TIER = HINT

_L = "licen[cs]e"

# One license a line: label, its tag as words, names. A name is a regular expression
# that starts with a literal word.
SINGLE = [
    ("mit", "mit", f"mit {_L}", f"mit x11 {_L}", f"expat {_L}", "mit licensed"),
    ("mit-0", "mit 0", f"mit no attribution(?: {_L})?", f"mit zero(?: {_L})?"),
    ("isc", "isc", f"isc {_L}", f"internet (?:software|systems) consortium {_L}"),
    ("0bsd", "0bsd", f"zero clause bsd(?: {_L})?", f"bsd (?:0|zero) clause(?: {_L})?"),
    ("bsd-1-clause", "bsd 1 clause", f"bsd (?:1|one) clause(?: {_L})?"),
    ("bsd-2-clause", "bsd 2 clause", f"bsd (?:2|two) clause(?: {_L})?", f"simplified bsd(?: {_L})?", f"freebsd {_L}"),
    ("bsd-3-clause", "bsd 3 clause", f"bsd (?:3|three) clause(?: {_L})?", f"new bsd(?: {_L})?", f"modified bsd(?: {_L})?",
     f"revised bsd(?: {_L})?"),
    ("bsd-4-clause", "bsd 4 clause", f"bsd (?:4|four) clause(?: {_L})?", f"original bsd(?: {_L})?"),
    ("bsd", "bsd", f"bsd(?: style)? {_L}", f"berkeley software distribution {_L}"),
    ("zlib", "zlib", f"zlib(?: libpng)? {_L}", f"libpng {_L}"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", f"want to public {_L}"),
    ("x11", "x11", f"x11 {_L}", f"x consortium {_L}"),
    ("curl", "curl", f"curl {_L}"),
    ("ncsa", "ncsa", f"university of illinois ncsa(?: open source)? {_L}", f"ncsa open source {_L}"),
    ("postgresql", "postgresql", f"postgresql {_L}"),
    ("openssl", "openssl", f"openssl {_L}", f"ssleay {_L}"),
    ("vim", "vim", f"vim {_L}"),
    ("beerware", "beerware", f"beerware(?: {_L})?", f"beer ware {_L}"),
    ("hpnd", "hpnd", "historical permission notice and disclaimer"),
    ("icu", "icu", f"icu {_L}"),
    ("unicode", "unicode dfs 2016", f"unicode(?: inc)? {_L}(?: agreement)?", "unicode terms of use"),
    ("json", "json", f"json {_L}"),
    ("sleepycat", "sleepycat", f"sleepycat {_L}"),
    ("ms-pl", "ms pl", f"microsoft public {_L}", "ms pl"),
    ("ms-rl", "ms rl", f"microsoft reciprocal {_L}", "ms rl"),
    ("ruby", "ruby", f"ruby {_L}"),
    ("tcl", "tcl", f"tcl tk {_L}", f"tcl {_L}"),
    ("w3c", "w3c", f"w3c(?: software)?(?: notice and)? {_L}"),
    ("intel", "intel", f"intel open source {_L}"),
    ("ntp", "ntp", f"ntp {_L}"),
    ("afmparse", "afmparse", f"afmparse {_L}"),
    ("blueoak", "blueoak 1 0 0", "blue oak model " + _L),
    ("upl", "upl 1 0", f"universal permissive {_L}"),
    ("mulan", "mulanpsl 2 0", f"mulan psl", f"mulan permissive software {_L}"),
    ("cc0", "cc0 1 0", "cc0", "creative commons zero", "creative commons 0"),
    ("cc-pdm", "cc pdm 1 0", "public domain mark"),
    ("odbl", "odbl 1 0", f"open (?:data|database) commons open database {_L}", f"open database {_L}", "odbl"),
    ("odc-by", "odc by 1 0", f"open data commons attribution {_L}", "odc by"),
    ("pddl", "pddl 1 0", f"open data commons public domain dedication(?: and {_L})?", "pddl"),
    ("elastic", "elastic 2 0", f"elastic {_L}"),
    ("sspl", "sspl 1 0", f"server side public {_L}", "sspl"),
    ("busl", "busl 1 1", f"business source {_L}", "busl"),
    ("commons-clause", "commons clause", "commons clause"),
    ("polyform", "polyform noncommercial 1 0 0", f"polyform (?:noncommercial|shield|small business|strict|internal use)(?: {_L})?"),
    ("openrail", "openrail", f"openrail(?: m)?(?: {_L})?", f"responsible ai {_L}"),
    ("llama", "llama", f"llama(?: \\d){{0,2}} community {_L}(?: agreement)?"),
]

# Families with versions: label, tag as words, versions, names.
FAMILIES = [
    ("gpl", "gpl", ["1", "2", "3"], f"gnu general public {_L}", "gnu gpl", "gpl", f"general public {_L}"),
    ("lgpl", "lgpl", ["2", "2.1", "3"], f"gnu (?:lesser|library) general public {_L}", "gnu lgpl", "lgpl", f"lesser general public {_L}"),
    ("agpl", "agpl", ["1", "3"], f"gnu affero general public {_L}", "gnu agpl", "agpl", f"affero general public {_L}"),
    ("gfdl", "gfdl", ["1.1", "1.2", "1.3"], f"gnu free documentation {_L}", "gfdl", f"free documentation {_L}"),
    ("apache", "apache", ["1.0", "1.1", "2.0"], f"apache(?: software)? {_L}", "apache", "asl"),
    ("mpl", "mpl", ["1.0", "1.1", "2.0"], f"mozilla public {_L}", "mpl"),
    ("epl", "epl", ["1.0", "2.0"], f"eclipse public {_L}", "epl"),
    ("edl", "edl", ["1.0"], f"eclipse distribution {_L}"),
    ("cpl", "cpl", ["1.0"], f"common public {_L}"),
    ("cddl", "cddl", ["1.0", "1.1"], f"common development and distribution {_L}", "cddl"),
    ("eupl", "eupl", ["1.0", "1.1", "1.2"], f"european union public {_L}", "eupl"),
    ("osl", "osl", ["1.0", "2.0", "2.1", "3.0"], f"open software {_L}"),
    ("afl", "afl", ["1.1", "1.2", "2.0", "2.1", "3.0"], f"academic free {_L}"),
    ("artistic", "artistic", ["1.0", "2.0"], f"artistic {_L}", f"perl artistic {_L}"),
    ("bsl", "bsl", ["1.0"], f"boost software {_L}"),
    ("ecl", "ecl", ["1.0", "2.0"], f"educational community {_L}"),
    ("ofl", "ofl", ["1.0", "1.1"], f"sil open font {_L}", f"open font {_L}"),
    ("lppl", "lppl", ["1.0", "1.1", "1.2", "1.3"], f"latex project public {_L}", "lppl"),
    ("php", "php", ["3.0", "3.01"], f"php {_L}"),
    ("psf", "psf", ["2.0"], f"python software foundation {_L}", f"psf {_L}", f"python {_L}"),
    ("zpl", "zpl", ["1.1", "2.0", "2.1"], f"zope public {_L}", "zpl"),
    ("cecill", "cecill", ["1.0", "1.1", "2.0", "2.1"], f"cecill(?: free software)? {_L}(?: agreement)?", "cecill"),
    ("apsl", "apsl", ["1.0", "1.1", "1.2", "2.0"], f"apple public source {_L}"),
    ("ipl", "ipl", ["1.0"], f"ibm public {_L}"),
    ("qpl", "qpl", ["1.0"], f"q public {_L}"),
    ("npl", "npl", ["1.0", "1.1"], f"netscape public {_L}"),
    ("cc-by", "cc by", ["1.0", "2.0", "2.5", "3.0", "4.0"], f"creative commons attribution(?: {_L})?", f"creative commons by(?: {_L})?", "cc by"),
    ("cc-by-sa", "cc by sa", ["1.0", "2.0", "2.5", "3.0", "4.0"], "creative commons attribution share ?alike", "creative commons by sa", "cc by sa"),
    ("cc-by-nd", "cc by nd", ["1.0", "2.0", "2.5", "3.0", "4.0"], "creative commons attribution no ?deriv(?:ative)?s?", "cc by nd"),
    ("cc-by-nc", "cc by nc", ["1.0", "2.0", "2.5", "3.0", "4.0"], "creative commons attribution non ?commercial", "cc by nc"),
    ("cc-by-nc-sa", "cc by nc sa", ["1.0", "2.0", "2.5", "3.0", "4.0"], "creative commons attribution non ?commercial share ?alike", "cc by nc sa"),
    ("cc-by-nc-nd", "cc by nc nd", ["1.0", "2.0", "2.5", "3.0", "4.0"], "creative commons attribution non ?commercial no ?deriv(?:ative)?s?", "cc by nc nd"),
]

# Sentences of the licenses themselves.
SENTENCES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "permission is hereby granted free of charge"),
    ("mit", "above copyright notice and this permission notice shall be included in all copies"),
    ("mit", "software is provided as is without warranty of any kind"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("hpnd", "permission to use copy modify and distribute this software and its documentation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "neither the name of(?: \\S+){1,12} nor the names of its contributors"),
    ("bsd-4-clause", "advertising materials mentioning features or use of this software must display"),
    ("gpl", "program is free software you can redistribute it and or modify it under the terms of the gnu general"),
    ("lgpl", "library is free software you can redistribute it and or modify it under the terms of the gnu lesser"),
    ("gpl", "distributed in the hope that it will be useful but without any warranty"),
    ("gpl", "received a copy of the gnu general public " + _L),
    ("lgpl", "received a copy of the gnu lesser general public " + _L),
    ("agpl", "received a copy of the gnu affero general public " + _L),
    ("apache-2.0", "obtain a copy of the license at (?:http|https)? ?(?:www )?apache org licenses license 2 0"),
    ("apache-2.0", "except in compliance with the " + _L),
    ("apache-2.0", "required by applicable law or agreed to in writing software distributed under the " + _L),
    ("mpl-2.0", "source code form is subject to the terms of the mozilla public"),
    ("mpl-1.1", "contents of this file are subject to the mozilla public"),
    ("epl", "accompanying materials are made available under the terms of the eclipse public"),
    ("cddl", "contents of this file are subject to the terms of the common development and distribution"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("zlib", "provided as is without any express or implied warranty in no event will the authors"),
    ("zlib", "origin of this software must not be misrepresented"),
    ("zlib", "altered source versions must be plainly marked as such"),
    ("unlicense", "unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this " + _L),
    ("beerware", "retain this notice you can do whatever you want with this stuff"),
    ("openssl", "product includes software developed by the openssl project"),
    ("apache-1.1", "product includes software developed by the apache software foundation"),
    ("json", "software shall be used for good not evil"),
    ("ofl", "font software is licensed under the sil open font"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation"),
    ("lppl", "distributed and or modified under the conditions of the latex project public"),
    ("cc0", "extent possible under law(?: \\S+){1,10} waived all copyright"),
    ("public-domain", "released (?:in|into|to) the public domain"),
    ("public-domain", "placed (?:in|into) the public domain"),
    ("public-domain", "work is in the public domain"),
    ("public-domain", "dedicated to the public domain"),
    ("proprietary", "software is proprietary and confidential"),
    ("proprietary", "unauthorized (?:copying|use|reproduction)(?: \\S+){0,6} is strictly prohibited"),
    ("proprietary", "confidential and proprietary"),
    ("noncommercial", "noncommercial (?:use|purposes) only"),
    ("noncommercial", "non commercial (?:use|purposes) only"),
    ("noncommercial", "academic(?: \\S+){0,3} (?:use|purposes) only"),
    ("noncommercial", "educational(?: \\S+){0,3} (?:use|purposes) only"),
]

HINTS = [
    ("copyright", "copyright(?: c| ©)?(?: by)? (?:19|20)\\d\\d"),
    ("copyright", "© (?:19|20)\\d\\d"),
    ("copyright", "copr (?:19|20)\\d\\d"),
    ("license-text", "license agreement"),
    ("license-text", "licence agreement"),
    ("license-text", "terms and conditions for use reproduction and distribution"),
    ("license-text", "license terms"),
    ("license-text", "licensed under the terms"),
    ("warranty", "warranty of any kind"),
    ("public-domain", "public domain"),
]


@dataclass(frozen=True)
class Rule:
    """``pattern`` starts with a literal word, the anchor; ``key`` is a further word it can't do without."""
    tier: int
    label: str
    pattern: str
    key: str = ""

    @property
    def anchor(self) -> str:
        word = self.pattern.split(" ")[0].split("(?:")[0]
        if not word.isalnum() and word != "©":
            raise ValueError(f"{self.pattern!r} does not start with a word")
        return word


def rules() -> list[Rule]:
    """All rules in order."""
    out = []
    for label, tag, *names in SINGLE:
        out.append(Rule(TAG, label, f"spdx {_L} identifier {tag}", tag.split(" ")[0]))
        out += [Rule(NAME, label, name) for name in names]
    for label, tag, numbers, *names in FAMILIES:
        for number in numbers:
            whole, _, part = number.partition(".")
            # "2", "2.0", "v2", "version 2.0"; a name without a point also takes ".0".
            digits = f"{whole} {part}" if part and part != "0" else f"{whole}(?: 0)?"
            full = f"{label}-{number if part else number + '.0'}"
            later = "(?: only| or later| or any later version| or at your option any later version)?"
            out.append(Rule(TAG, full, f"spdx {_L} identifier {tag} {digits}{later}", tag.split(" ")[0]))
            for name in names:
                numbered = f"{name}(?: version)? v?{digits}(?: international| unported| generic)?{later}"
                out.append(Rule(VERSION, full, numbered))
            if " " not in tag and tag.isalpha():
                out.append(Rule(VERSION, full, f"{tag}v{digits}{later}"))
        out += [Rule(NAME, label, name) for name in names if name not in ("apache", "asl")]
    out += [Rule(SENTENCE, label, pattern) for label, pattern in SENTENCES]
    out += [Rule(HINT, label, pattern) for label, pattern in HINTS]
    return out


RULES = rules()


def _once(**columns: Column) -> Column:
    """Computed once per row: an optimizer that merged the steps would repeat them per element."""
    return F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))


def _rules_by_anchor() -> Column:
    by: dict[str, list[Column]] = {}
    for order, r in enumerate(RULES):
        by.setdefault(r.anchor, []).append(F.struct(
            F.lit(r.tier).alias("tier"), F.lit(order).alias("order"), F.lit(r.label).alias("label"),
            F.lit(f"^({r.pattern})(?: |$)").alias("pattern"), F.lit(r.key).alias("key")))
    return F.create_map(*[c for anchor, found in by.items() for c in (F.lit(anchor), F.array(*found))])


def detections(docs: DataFrame, *keep: str) -> DataFrame:
    """``words``, ``base`` (place, label) and ``found`` (place, end, tier, label) per row, beside
    the columns to keep."""
    anchors = sorted({r.anchor for r in RULES} | {p.split(" ")[0] for p in BASE})
    split = F.split(F.translate(text_or_empty(), UPPER, LOWER), BREAK)
    step = docs.select(*keep, _once(words=F.array_remove(split, "")))
    hits = F.transform("words", lambda w, i: F.when(w.isin(anchors), i))
    step = step.select(*keep, "words", _once(hits=F.filter(hits, lambda i: i.isNotNull())))

    def phrase(i: Column) -> Column:
        label = None
        for text, name in BASE.items():
            same = [F.get("words", i + n) == w for n, w in enumerate(text.split(" "))]
            every = same[0]
            for more in same[1:]:
                every &= more
            label = F.when(every, name) if label is None else label.when(every, name)
        return F.struct(i.alias("place"), label.alias("label"))

    def tried(i: Column) -> Column:
        window = F.array_join(F.slice("words", i + 1, WINDOW), " ")
        return F.struct(i.alias("place"), window.alias("window"), F.element_at("rules", F.get("words", i)).alias("rules"))

    def best(place: Column) -> Column:
        def one(r: Column) -> Column:
            match = F.call_function("regexp_extract", place["window"], r["pattern"], F.lit(1))
            words = F.when(place["window"].contains(r["key"]) & (match != ""), F.size(F.split(match, " ")))
            return F.struct(r["tier"].alias("tier"), (-words).alias("less"), r["order"].alias("order"), r["label"].alias("label"))

        top = F.array_min(F.filter(F.transform(place["rules"], one), lambda m: m["less"].isNotNull()))
        return F.transform(F.array(top), lambda m: F.when(m.isNotNull(), F.struct(
            place["place"].alias("place"), (place["place"] - m["less"]).alias("end"), m["tier"].alias("tier"), m["label"].alias("label"))))[0]

    step = step.select(*keep, "words", _once(
        base=F.filter(F.transform("hits", phrase), lambda b: b["label"].isNotNull()), hits=F.col("hits"), rules=_rules_by_anchor()))
    step = step.select(*keep, "words", "base", _once(
        tried=F.filter(F.transform("hits", tried), lambda t: t["rules"].isNotNull())))
    step = step.select(*keep, "words", "base", _once(all=F.filter(F.transform("tried", best), lambda d: d.isNotNull())))

    def alone(d: Column, i: Column) -> Column:
        before = F.slice("all", F.greatest(i - WINDOW, F.lit(0)) + 1, F.least(i, F.lit(WINDOW)))
        return ~F.exists(before, lambda e: (e["end"] >= d["end"]) & (e["tier"] <= d["tier"]))

    return step.select(*keep, "words", "base", _once(found=F.filter("all", alone)))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` per document,
    and ``found``, the detections that stand."""
    base = F.col("base.label")
    labels = lambda names: F.array_join(F.array_sort(F.array_distinct(names)), ",")
    tiers = F.concat(F.col("found.tier"), F.when(F.size("base") > 0, F.array(F.lit(BASE_TIER))).otherwise(F.array().cast("array<int>")))
    sure = F.array(*map(F.lit, CONFIDENCE))
    return detections(docs, "doc_id").select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"), F.size("base").cast("bigint").alias("n_base"),
        F.array_min("base.place").cast("bigint").alias("first_word"), F.array_max("base.place").cast("bigint").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.concat(base, F.col("found.label"))).alias("labels"),
        F.when(F.size(tiers) > 0, F.get(sure, F.array_min(tiers))).otherwise(0.0).alias("score"), "found")


def oracle() -> str:
    """The same as SQL over rows: a word at a time, with the rules as a table."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    table = ", ".join(f"({n}, {r.tier}, {quoted(r.label)}, {quoted(r.anchor)}, {quoted(r.key)}, {quoted(f'^({r.pattern})(?: |$)')})"
                      for n, r in enumerate(RULES))
    phrases = ", ".join(f"({quoted(p)}, {quoted(label)}, {len(p.split(' '))})" for p, label in BASE.items())
    sure = f"[{', '.join(map(str, CONFIDENCE))}]"
    return rf"""
WITH rules(n, tier, label, anchor, key, pattern) AS (VALUES {table}),
phrases(phrase, label, size) AS (VALUES {phrases}),
t AS (SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
  '{BREAK}'), lambda x: x <> '') AS w FROM documents),
word AS (SELECT k, w, unnest(w) AS v, unnest(range(1, len(w) + 1)) AS i FROM t),
base AS (SELECT k, i - 1 AS place, label FROM word JOIN phrases ON phrase[:strpos(phrase, ' ') - 1] = v
  AND array_to_string(w[i:i + size - 1], ' ') = phrase),
tried AS (SELECT k, i - 1 AS place, n, tier, label, regexp_extract(array_to_string(w[i:i + {WINDOW - 1}], ' '), pattern, 1) AS m
  FROM word JOIN rules ON anchor = v),
best AS (SELECT k, place, place + len(string_split(m, ' ')) AS stop, tier, label FROM tried WHERE m <> ''
  QUALIFY row_number() OVER (PARTITION BY k, place ORDER BY tier, len(string_split(m, ' ')) DESC, n) = 1),
found AS (SELECT k, tier, label FROM best b WHERE NOT EXISTS (SELECT 1 FROM best e WHERE e.k = b.k AND e.place < b.place
  AND e.stop >= b.stop AND e.tier <= b.tier)),
b AS (SELECT k, count(*) AS n, min(place) AS lo, max(place) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM base GROUP BY k),
every AS (SELECT k, label, tier FROM found UNION ALL SELECT k, label, {BASE_TIER} FROM base),
a AS (SELECT k, string_agg(DISTINCT label, ',' ORDER BY label) AS l, min(tier) AS tier FROM every GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
  coalesce(b.l, '') AS base_labels, coalesce(a.l, '') AS labels, coalesce({sure}[1 + tier], 0.0)::DOUBLE AS score
FROM t LEFT JOIN b USING (k) LEFT JOIN a USING (k)"""
