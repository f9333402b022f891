"""The native operators against their SQL, brute force and odd rows."""

import re

import pytest
from compare import differences, duck

from orderlake.llm.license_scan import scan_licenses, scan_words
from orderlake.llm.oracles import LICENSE_SCAN, QUALITY_RULES
from orderlake.llm.packing import best_fit
from orderlake.llm.quality_rules import RULE_COLUMNS, apply_rules
from orderlake.llm.queries import LLM_ORACLES, LLM_QUERIES

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_same_rows_as_sql(spark, name):
    assert differences(LLM_QUERIES[name](spark, SMOKE), LLM_ORACLES[name], duck(SMOKE)) is None


def over(docs, sql):
    """Rows that the SQL gives for these documents."""
    connection = duck(SMOKE)
    table = docs.select("doc_id", "text").toPandas()
    table["doc_id"] = table["doc_id"].astype("Int64")
    connection.register("odd", table)
    connection.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM odd")
    return connection


def test_rules_on_odd_rows(odd_docs):
    got = apply_rules(odd_docs)
    assert got.columns[-len(RULE_COLUMNS) :] == RULE_COLUMNS
    assert "label" in got.columns and got.columns.count("kept") == 1
    digest = got.select("doc_id", *[c for c in RULE_COLUMNS if c != "clean_text"])
    assert differences(digest, QUALITY_RULES, over(odd_docs, QUALITY_RULES)) is None


def test_rules_take_lines_out(spark):
    prose = "\n".join(
        f"Line {i} tells of {i * 7} apples, {i * 5} pears and some plums." for i in range(9)
    )
    text = f"Home\n{prose}\nWe use cookies: see our cookie policy.\n# $ % & * | x"
    docs = spark.createDataFrame([(1, text), (2, "A | B | C | D\n" * 9)], "doc_id int, text string")
    clean, menu = apply_rules(docs).orderBy("doc_id").collect()
    assert clean.kept and clean.clean_text == prose and clean.n_lines_removed == 3
    assert not menu.kept and menu.n_lines_removed == 9


def test_rules_and_scan_on_no_rows(no_docs):
    assert apply_rules(no_docs).collect() == []
    assert scan_licenses(no_docs).collect() == []


def test_scan_on_odd_rows(odd_docs, spark):
    more = spark.createDataFrame(
        [
            (20, "cc by nc, CC-BY-NC! cc by; nc cc by"),
            (21, "under the MIT license"),
            (22, "UNDER\tTHE mit license"),
            (23, "This program: you can redistribute it and/or modify it under the terms of the "
                 "GNU General Public License as published by the Free Software Foundation"),
            (24, "general public license gnu"),
            (25, "K under the mİt license apache license version 2"),
        ],
        "doc_id bigint, text string",
    )
    docs = odd_docs.select("doc_id", "text").union(more)
    got = scan_licenses(docs).drop("text")
    assert differences(got, LICENSE_SCAN, over(docs, LICENSE_SCAN)) is None
    rows = {r.doc_id: r for r in got.collect()}
    assert (rows[20].n_base, rows[20].first_word, rows[20].last_word) == (3, 0, 6)
    assert rows[21].labels == "mit" and rows[22].labels == "" and rows[23].labels == "gpl"
    assert rows[24].labels == "" and rows[25].base_labels == "apache-2"


def test_scan_words_as_stated(spark):
    texts = ["", None, "A-b\x00C", "é!É", "\u212aelvin k \u0130x Ix", "--a--", "\x7f|9"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r.w for r in rows.select(scan_words(rows.text).alias("w")).collect()]
    lowered = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
    expected = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t) for t in lowered]
    # Words of ASCII are as stated; others are as many, and stay other than ASCII.
    plain = [[w if w.isascii() else None for w in words] for words in expected]
    assert [[w if w.isascii() else None for w in words] for words in got] == plain
    assert plain[4] == [None, "k", None, "ix"]


def test_best_fit_takes_the_tightest_compatible_bin():
    items = [(60, "a", 1), (50, "b", 2), (40, "a", 3), (40, "c", 4), (10, "d", 2), (10, None, None)]
    # 40 of a does not fit behind 60 of a; 40 of c does; 10 of cluster 2 not behind 50.
    assert best_fit(items, 100) == [(0, 0), (1, 0), (1, 50), (0, 60), (2, 0), (1, 90)]
    assert best_fit([(200, "a", 1), (1, "b", 2)], 100) == [(0, 0), (1, 0)]


def test_scan_finds_notices_whose_rare_words_are_shifted(spark):
    notice = (
        "Redistribution and use in source and binary forms, with or without any modification, "
        "are permitted provided that the following conditions are met"
    )
    common = notice.replace("conditions are met", "")
    late = f"conditions met {'x ' * 50} {notice} {'y ' * 50} met conditions"
    texts = [common, common, notice, late]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in scan_licenses(docs).collect()}
    assert rows[2].labels == rows[3].labels == "bsd"
    assert rows[2].score == rows[3].score == 11 / 21
