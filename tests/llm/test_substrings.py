"""Substring dedup against a brute-force version, and its edge cases."""

import hashlib

import pytest

from __spark_entry__ import queries
from dossierkit.llm import substrings

SF = "/root/testdata/sf0.001"


def brute(rows, window):
    """(n_words, kept words) per row, with all windows of all rows in one table."""
    cut = [(k, (t or "").encode().split()) for k, t in rows]
    first = {}
    for key, words in cut:
        if key is not None:
            for i in range(len(words) - window + 1):
                gram = tuple(words[i : i + window])
                first[gram] = min(first.get(gram, key), key)
    out = []
    for key, words in cut:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if key is not None and first[tuple(words[i : i + window])] < key:
                gone[i : i + window] = [True] * window
        out.append((key, len(words), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return sorted(out, key=str)


def test_query_over_whole_texts(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
        expected = {k: (n, hashlib.sha256(t.encode()).hexdigest()) for k, n, t in brute([tuple(d) for d in docs], 50)}
        rows = queries()["op2_substring_dedup"](spark, sf).collect()
        assert {r.doc_id: (r.n_words, r.kept_sha256) for r in rows} == expected
        assert len(rows) == len(expected) and sum(r.n_removed for r in rows) > 0


CASES = [
    (1, "a b c d e f g h"), (2, "x b c d e f y"), (3, None), (4, ""), (5, "c  d\te\nf"), (6, "a a a a a a a a a"),
    (7, "z a a a a a"), (None, "a b c d e f g h"), (8, "b c d e"), (8, "b c d e"), (9, "é b c d e f 　"),
    (10, " ".join(str(i % 7) for i in range(3000))), (11, " ".join(str(i % 7) for i in range(500, 2900)) + " end"),
    (12, "word " * 5000), (0, "d e f g"),
]


@pytest.mark.parametrize("window,first", [(4, 2), (4, 1), (3, 3), (5, 1)])
def test_edges(spark, window, first):
    df = spark.createDataFrame([(k, t, "other", 1) for k, t in CASES], "id bigint, body string, _text string, n_words int")
    rows = substrings.remove_repeats(df, "id", "body", window, first).collect()
    assert sorted([(r["id"], r.n_words, r.kept_text) for r in rows], key=str) == brute(CASES, window)
    for r in rows:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed


def test_words_between_repeated_windows_stay(spark):
    """Recurring short windows join repeated and other windows to one context."""
    rows = []
    for i in range(100):
        rows += [(4 * i, f"a{i} " * 200), (4 * i + 1, f"a{i} " * 60 + "b " + f"a{i} " * 60)]
        fixed = [f"f{i}x{j}" for j in range(25)]
        rows += [(4 * i + 2 + k, " ".join(" ".join([*fixed, f"v{i}x{(j * (k + 1)) % 12}"]) for j in range(12))) for k in (0, 1)]
    df = spark.createDataFrame(rows, "id bigint, body string")
    got = substrings.remove_repeats(df, "id", "body").collect()
    assert sorted([(r["id"], r.n_words, r.kept_text) for r in got], key=str) == brute(rows, 50)


def test_hot_windows_take_the_same_way(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT", 1)
    df = spark.createDataFrame(CASES, "id bigint, body string")
    rows = substrings.remove_repeats(df, "id", "body", 4, 2).collect()
    assert sorted([(r["id"], r.n_words, r.kept_text) for r in rows], key=str) == brute(CASES, 4)


def test_no_rows_and_no_repeats(spark):
    empty = spark.createDataFrame([], "id bigint, body string")
    assert substrings.remove_repeats(empty, "id", "body").collect() == []
    rows = substrings.remove_repeats(spark.createDataFrame([(1, "a b"), (2, None)], "id bigint, body string"), "id", "body").collect()
    assert sorted((r["id"], r.kept_text) for r in rows) == [(1, "a b"), (2, "")]
