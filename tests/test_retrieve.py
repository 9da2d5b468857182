import re
import subprocess
import sys
import tracemalloc

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle

from dossierkit.operators import retrieve as R
from dossierkit.plans.answers import answers

SEPARATORS = ["\n\n", "\n", " ", ""]


def brute_split(text, size, overlap, separators):
    """The splitting rule on lists of strings, as plainly as possible."""
    at = next((i for i, s in enumerate(separators) if s == "" or s in text), None)
    if at is None:
        return [text]
    sep, rest = separators[at], separators[at + 1 :]
    if sep:
        first, *others = text.split(sep)
        pieces = [first, *[sep + p for p in others]]
    else:
        pieces = list(text)
    chunks, run = [], []

    def flush():
        window = []
        for piece in run:
            if len("".join(window)) + len(piece) > size and window:
                chunks.append("".join(window))
                while len("".join(window)) > overlap or (len("".join(window)) + len(piece) > size and window):
                    window.pop(0)
            window.append(piece)
        if window:
            chunks.append("".join(window))
        run.clear()

    for piece in filter(None, pieces):
        if len(piece) < size:
            run.append(piece)
        else:
            flush()
            chunks.extend(brute_split(piece, size, overlap, rest) if rest else [piece])
    flush()
    return [c.strip() for c in chunks if c.strip()]


texts = st.lists(st.sampled_from(["a", "bb", " ", "\n", "\n\n", "cccc", "dddddddd", "\xa0", "é"]), max_size=60).map("".join)


@settings(max_examples=600, deadline=None)
@given(texts, st.integers(2, 25), st.data())
def test_split_against_brute_force(text, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    assert R.split_text(text, size, overlap, SEPARATORS) == brute_split(text, size, overlap, SEPARATORS)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(2, 25))
def test_split_invariants(text, size):
    chunks = R.split_text(text, size, size // 3, SEPARATORS)
    assert all(0 < len(c) <= size and c == c.strip() and c in text for c in chunks)
    if len(text) <= size:
        assert chunks == ([text.strip()] if text.strip() else [])
    for word in map(str.strip, re.split("[ \n]+", text)):
        assert not word or len(word) >= size or any(word in c for c in chunks)


def test_chunk_text(spark):
    words = " ".join(f"word{i}" for i in range(2000))
    docs = [(1, "short"), (2, ""), (3, " \n"), (4, words), (5, "x" * 2500), (6, "y" * 1000), (7, None), (8, "\xa0é ")]
    df = spark.createDataFrame(docs, "i int, text string")
    found = {}
    for r in R.chunk_text(df, "text").orderBy("i", "chunk_no").collect():
        found.setdefault(r.i, []).append(r.chunk)
        assert r.chunk_no == len(found[r.i]) - 1
    assert found == {i: brute_split(t, 1000, 100, SEPARATORS) for i, t in docs if t and t.strip()}


def test_chunks_of_whole_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    expected = {r.doc_id: brute_split(r.text, 300, 40, SEPARATORS) for r in df.collect() if r.doc_id % 10 == 0}
    found = {}
    for r in R.chunk_text(df, "text", 300, 40).orderBy("doc_id", "chunk_no").collect():
        found.setdefault(r.doc_id, []).append(r.chunk)
    assert {k: found.get(k, []) for k in expected} == expected


def nearest(vectors, questions, k):
    out = set()
    for q, question in enumerate(questions):
        distance = ((vectors - question) ** 2).sum(axis=1)
        for rank, i in enumerate(sorted(range(len(vectors)), key=lambda i: (distance[i], i))[:k]):
            out.add((q, rank + 1, i, round(float(distance[i]), 9)))
    return out


NAMES = dict(corpus_id="id", corpus_vector="v", query_id="q", query_vector="u")


@pytest.mark.parametrize("limit", [100, 7, 1])
def test_knn_in_blocks_of_questions(spark, limit):
    rng = np.random.default_rng(5)
    vectors = rng.integers(-2, 3, (120, 4)).astype(float)
    questions = rng.integers(-2, 3, (19, 4)).astype(float)
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, v array<float>")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(questions)], "q int, u array<double>")
    bad = [[float("nan")] * 4, [0.0, 0.0, 0.0, None], [0.0], [0.0] * 5, None, [float("inf"), 0.0, 0.0, 0.0], []]
    damaged = [(None, [0.0] * 4), *[(1000 + i, v) for i, v in enumerate(bad)]]
    # a bad row in every batch of the others
    mixed = spark.createDataFrame([row for i, v in enumerate(vectors) for row in ((i, v.tolist()), damaged[i % len(damaged)])], corpus.schema)
    for rows in (corpus.repartition(5), mixed.repartition(3), mixed.coalesce(1)):
        found = R.knn(rows, asked, 3, query_limit=limit, **NAMES)
        assert found.schema["id"].dataType.simpleString() == "bigint"
        assert {(r.q, r.rank, r.id, round(r.distance, 9)) for r in found.collect()} == nearest(vectors, questions, 3)
    counted = R.unusable_vectors(mixed, "v", 4).first()
    assert (counted.n, counted.unusable) == (240, sum(i % 8 != 0 for i in range(120)))


@pytest.mark.parametrize("bad", [[1.0], [float("nan"), 1.0], [None, 1.0], []])
def test_bad_questions_raise(spark, bad):
    corpus = spark.createDataFrame([(1, [1.0, 2.0])], "id int, v array<float>")
    asked = spark.createDataFrame([(1, [1.0, 2.0]), (2, bad)], "q int, u array<double>").coalesce(1)
    with pytest.raises(ValueError, match="finite numbers"):
        R.knn(corpus, asked, 3, **NAMES)


def test_knn_with_text_ids_and_few_rows(spark):
    corpus = spark.createDataFrame([("b", [1.0]), ("a", [1.0])], "id string, v array<float>")
    asked = spark.createDataFrame([("q", [0.0]), (None, [0.0]), ("none", None)], "q string, u array<float>")
    for limit in (5, 1):
        found = R.knn(corpus, asked, 3, query_limit=limit, **NAMES)
        assert [tuple(r) for r in found.orderBy("rank").collect()] == [("q", 1, "a", 1.0), ("q", 2, "b", 1.0)]
    assert R.knn(corpus, asked.limit(0), 3, **NAMES).count() == 0
    assert R.knn(corpus.limit(0), asked, 3, **NAMES).count() == 0


def test_only_few_hits_are_broadcast(spark, monkeypatch, plan):
    corpus = spark.createDataFrame([(1, [1.0])], "id int, v array<float>")
    asked = spark.createDataFrame([(i, [0.0]) for i in range(4)], "q int, u array<float>")
    hint = lambda: "broadcast" in R.knn(corpus, asked, 3, **NAMES)._jdf.queryExecution().logical().toString()
    assert hint()
    monkeypatch.setattr(R, "BROADCAST_ROWS", 11)
    assert not hint()


def test_hits_without_a_text_stay(spark):
    hits = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (2, 1, 7)], "q int, rank int, id int")
    texts = spark.createDataFrame([(6, "six")], "id int, text string")
    found = R.assemble_context(hits, texts, query_id="q", corpus_id="id", text="text")
    assert sorted(map(tuple, found.collect())) == [(1, "\n\nsix"), (2, "")]


def test_text_without_separators_is_cut_by_arithmetic():
    text = "漢" * 10_000_000
    tracemalloc.start()
    chunks = R.split_text(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(chunks) == 11111 and {len(c) for c in chunks[:-1]} == {1000} and len(chunks[-1]) == 1000
    assert peak < 4 * len(text)
    for size, overlap, n in ((5, 2, 23), (5, 4, 9), (2, 0, 7), (1, 0, 4)):
        assert R.split_text("abcdefghijklmnopqrstuvwxyz"[:n], size, overlap) == brute_split("abcdefghijklmnopqrstuvwxyz"[:n], size, overlap, SEPARATORS)


def test_top_k_cuts_before_the_shuffle(spark, plan):
    corpus = spark.createDataFrame([(1, [1.0])], "id int, v array<float>")
    asked = spark.createDataFrame([(1, [0.0])], "q int, u array<float>")
    text = plan(R.knn(corpus, asked, 3, corpus_id="id", corpus_vector="v", query_id="q", query_vector="u"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial") < text.index("MapInArrow")


def test_compose_document(spark):
    df = spark.createDataFrame(
        [("S", "T", "L", ["a", "b"], None, "U", None, "text")],
        "Section string, Title string, Link string, `Author(s)` array<string>, `Date Posted` string, "
        "`Date Updated` string, Updates string, `Full Article` string",
    )
    expected = "TITLE: T\nLINK: L\nDATE_POSTED: \nDATE_UPDATED: U\nAUTHORS: a,b\nSECTION: S\nUPDATES: \n\ntext"
    assert df.select(R.compose_document().alias("d")).first().d == expected


def test_answers(spark):
    chunks = spark.createDataFrame(
        [(1, "/1", "One", "first", [1.0, 0.0]), (2, None, None, "second", [0.0, 1.0]), (3, "/3", "Three", "third", [9.0, 9.0])],
        "chunk_id int, link string, title string, chunk string, vector array<float>",
    )
    questions = spark.createDataFrame([(7, [0.9, 0.1])], "question_id int, vector array<float>")
    row = answers(chunks, questions, 2).first()
    assert row.context == "first\n\nsecond"
    assert [tuple(s) for s in row.sources] == [(1, "One", "/1"), (2, "No title found", "No link found")]


def test_list_sources_keeps_hits_without_a_page(spark):
    hits = spark.createDataFrame([(1, 1, 5), (1, 2, 6)], "q int, rank int, id int")
    pages = spark.createDataFrame([(5, "T", "/t")], "id int, title string, link string")
    found = R.list_sources(hits, pages, query_id="q", corpus_id="id", title="title", link="link")
    assert sorted(map(tuple, found.collect())) == [(1, 1, "T", "/t"), (1, 2, "No title found", "No link found")]


def test_tasks_need_no_installed_package(tmp_path):
    (tmp_path / "split.bin").write_bytes(cloudpickle.dumps(R.split_text))
    code = "import pickle; print(pickle.load(open('split.bin', 'rb'))('ab cd', 3, 0))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=False)
    assert done.stdout.strip() == "['ab', 'cd']", done.stderr
