"""License rules: which detections stand, places of base phrases, odd inputs."""

import re

import pytest

from fareflow.llm import licenses

SCHEMA = "doc_id bigint, text string"


def scan(spark, *texts):
    return licenses.scan(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], SCHEMA)).orderBy("doc_id").collect()


@pytest.mark.parametrize("text, labels, score", [
    ("Released under the MIT License.", "mit", 0.7),
    ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0", 1.0),
    ("licensed under the Apache License, Version 2.0", "apache-2.0", 0.9),
    ("the GNU Lesser General Public License v2.1", "gpl,lgpl-2.1", 0.9),   # base label beside the longer name
    ("GNU General Public License, version 3", "gpl,gpl-3.0", 0.9),
    ("CC BY-NC-SA 4.0", "cc-by,cc-by-nc-sa-4.0", 0.9),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit", 0.95),
    ("All rights reserved.", "reserved", 0.4),
    ("© 2021 Someone", "copyright", 0.4),
    ("a submit licensee", "", 0.0),
])
def test_labels(spark, text, labels, score):
    row = scan(spark, text)[0]
    assert (row.labels, row.score) == (labels, score)


def test_containment_and_tiers(spark):
    row = scan(spark, "see bsd 3 clause license and mit license")[0]
    assert [(d.place, d.end, d.label) for d in row.found] == [(1, 5, "bsd-3-clause"), (6, 8, "mit")]
    # A hint inside a sentence of the license goes, one beside it stays.
    row = scan(spark, "software is provided as is without warranty of any kind x warranty of any kind")[0]
    assert [(d.label, d.tier) for d in row.found] == [("mit", licenses.SENTENCE), ("warranty", licenses.HINT)]


def test_base_places(spark):
    row = scan(spark, "CC-BY cc by, cc  BY.all rights reserved ALL Rights\tReserved; general public licenses")[0]
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (15, 5, 0, 9)
    assert row.base_labels == "cc-by,reserved"


def test_odd_texts(spark):
    rows = scan(spark, None, "", " .,;\n\t", "Ünder MIT Lıcense", "mit license " * 100_000)
    for r in rows[:3]:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (0, 0, None, None, "", "", 0.0)
    assert rows[3].n_words == 3 and rows[3].labels == ""
    assert rows[4].n_words == 200_000 and len(rows[4].found) == 100_000


def test_empty_table_and_clashing_names(spark):
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(None, "MIT license", 1), (None, "MIT license", 1)], SCHEMA + ", words int").selectExpr(
        "*", "2 AS base", "3 AS found", "4 AS hits", "5 AS rules")
    assert [r.labels for r in licenses.scan(df).collect()] == ["mit", "mit"]


def test_rules_are_many_bounded_and_anchored():
    assert len(licenses.RULES) > 300
    for rule in licenses.RULES:
        assert re.match(rule.anchor, rule.pattern)
        # Words of the longest match: of alternatives the longest, and what repetitions add.
        longest = re.sub(r"\(\?:([^()]*)\)", lambda m: max(m[1].split("|"), key=lambda a: a.count(" ")), rule.pattern)
        most = sum(int(n) for n in re.findall(r"\{\d+,(\d+)\}", longest)) + longest.count(" ") + 1
        assert most <= licenses.WINDOW, rule.pattern
