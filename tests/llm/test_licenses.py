"""Phrase places and the exact join against plain Python, and edge cases."""

import re
import textwrap

import duckdb
import pytest
from pyspark.sql import functions as F

import check
from __spark_entry__ import oracle_sql, queries
from dossierkit.llm import licenses


def words(text):
    lower = (text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def places(text):
    w, out = words(text), []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return sorted(out)


def blocks(rows, threshold):
    out = []
    for key, text in rows:
        for no, line in enumerate((text or "").split("\n") if text is not None else []):
            have = set(words(line))
            for name, template in licenses.TEMPLATES.items():
                need = set(words(template))
                if len(need & have) >= round(threshold * len(need), 9):
                    out.append((key, no, name, round(len(need & have) / len(need), 12)))
    return sorted(out, key=str)


FULL = list(licenses.TEMPLATES.values())
CASES = [
    (1, "MIT License mit-license (MIT  LICENSE) mitlicense"), (2, None), (3, ""), (4, "cc by cc by-nc CC/BY ccby"), (5, "x\n".join(FULL)),
    (6, "the gnu\ngeneral public license"), (7, "İ K apache license é apache license"), (8, "..."), (9, "\n\n"),
    (10, "a " * 50000 + FULL[2] + " b" * 10), (1, "mit license"), (None, FULL[5]), (11, " ".join(FULL[1].split()[:30])),
    (12, " ".join(FULL[7].split()[3:]).upper()), (13, FULL[0].replace("version", "v.") + " " + FULL[0]), (14, "license " * 300),
]


def test_places(spark):
    df = spark.createDataFrame([(*c, 1, "x") for c in CASES], "id bigint, body string, n_words int, _spaced string")
    rows = licenses.phrase_places(df, "body").collect()
    assert [(r["id"], r.n_words, [tuple(p) for p in r.places]) for r in rows] == [(k, len(words(t)), places(t)) for k, t in CASES]


@pytest.mark.parametrize("threshold", [0.3, 0.8, 1.0])
def test_the_filters_lose_no_block(spark, threshold):
    df = spark.createDataFrame([(*c, 1, "x") for c in CASES], "id bigint, body string, block int, template string")
    rows = licenses.license_blocks(df, "id", "body", threshold=threshold).collect()
    assert sorted([(r["id"], r.block, r.template, round(r.containment, 12)) for r in rows], key=str) == blocks(CASES, threshold)


def notices(rows, threshold):
    """Best window of each text and template, over all windows."""
    out = []
    for key, text in rows:
        w = words(text)
        for name, template in licenses.TEMPLATES.items():
            need, length = set(words(template)), licenses.SPREAD * len(words(template))
            own = set(words(name.split("/")[0])) & need
            held = [need & set(w[i : i + length]) for i in range(len(w)) if w[i] in need]
            best = max([len(h) for h in held if own <= h], default=0)
            if best and best >= round(threshold * len(need), 9):
                out.append((key, name, round(best / len(need), 12)))
    return sorted(out, key=str)


WRAPPED = [(i, "# intro\n# " + "\n# ".join(textwrap.wrap(t, 30)) + "\nimport x") for i, t in enumerate(FULL)]
NO_NOTICES = [
    (20, " filler".join(f" {w}" + " word" * 40 for w in FULL[6].split())),  # all words of a notice, but scattered
    (21, "Released under the BSD License. Licensed under the Apple License, Version 2.0."),
    (22, "This work is licensed under the GNU General Public License,\nversion 2."),
]


def test_wrapped_notices_are_found_and_scattered_words_are_none(spark):
    df = spark.createDataFrame([*WRAPPED, *NO_NOTICES], "id bigint, body string")
    rows = licenses.license_notices(df, "id", "body").collect()
    got = sorted([(r["id"], r.template, round(r.containment, 12)) for r in rows], key=str)
    assert got == notices([*WRAPPED, *NO_NOTICES], licenses.THRESHOLD)
    full = {(i, name, 1.0) for i, name in enumerate(licenses.TEMPLATES)}
    assert full <= set(got) and not {k for k, _, _ in got} & {20, 21, 22}


def test_the_query_finds_wrapped_notices(spark, tmp_path):
    df = spark.createDataFrame([*WRAPPED, *NO_NOTICES], "doc_id bigint, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries()["op9_license_scan"](spark, str(tmp_path)).collect()}
    for i, name in enumerate(licenses.TEMPLATES):
        assert name.split("/")[0] in rows[i].labels.split(",") and rows[i].score == 1.0
    assert rows[20].score == rows[21].score == 0.0


@pytest.mark.parametrize("threshold", [0.3, 1.0])
def test_the_filters_lose_no_window(spark, threshold):
    df = spark.createDataFrame([(*c, 1, "x") for c in CASES], "id bigint, body string, line string, template string")
    rows = licenses.license_notices(df, "id", "body", threshold=threshold).collect()
    assert sorted([(r["id"], r.template, round(r.containment, 12)) for r in rows], key=str) == notices(CASES, threshold)


def test_rows_of_one_id_have_their_own_results(spark, tmp_path):
    """The query's SQL agrees on wrapped notices, repeated ids and repeated rows."""
    texts = [(1, FULL[0]), (1, "nothing here at all"), (1, None), (None, "MIT License"), (None, FULL[1]), (2, FULL[5]), (2, FULL[5])]
    spark.createDataFrame([*texts, *WRAPPED, *NO_NOTICES], "doc_id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    ok, note = check.compare(spark, con, str(tmp_path), "op9_license_scan")
    assert ok, note
    rows = queries()["op9_license_scan"](spark, str(tmp_path)).filter("doc_id = 1 AND n_words < 10").collect()
    assert [(r.labels, r.score) for r in rows] == [("", 0.0)] * 2


def test_one_long_notice(spark):
    text = (FULL[6] + " ") * 20_000
    rows = licenses.license_notices(spark.createDataFrame([(1, text)], "id int, body string"), "id", "body").collect()
    assert [(r.template, r.containment) for r in rows] == [("mit/grant", 1.0)]


def test_no_rows_and_bad_parameters(spark):
    empty = spark.createDataFrame([], "id bigint, body string")
    assert licenses.license_blocks(empty, "id", "body").collect() == [] == licenses.phrase_places(empty, "body").collect()
    for bad in ({"threshold": 0}, {"threshold": 1.1}, {"templates": {"x": "..."}}):
        with pytest.raises(ValueError, match="threshold"):
            licenses.license_blocks(empty, "id", "body", **bad)


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    ok, note = check.compare(spark, con, "/root/testdata/sf0.001", "op9_license_scan")
    assert ok, note
    assert set(oracle_sql()) <= set(queries())
    labels = queries()["op9_license_scan"](spark, "/root/testdata/sf0.001").agg(F.collect_set("labels")).first()[0]
    assert any("mit" in x for x in labels)
