"""Nearest neighbours through pivots against all distances."""

import re

import numpy as np
import pytest
from pyspark.sql import Observation

from dossierkit.operators import vector_index as V


def nearest(vectors, questions, k):
    out = []
    for q, question in questions:
        scored = sorted((float(((np.array(v) - question) ** 2).sum()), i) for i, v in vectors)
        out += [(q, rank + 1, i, round(d, 9)) for rank, (d, i) in enumerate(scored[:k])]
    return sorted(out)


def found(spark, path, vectors, questions, k, kind="bigint", seen=None, **more):
    corpus = spark.createDataFrame(vectors, f"`the id` {kind}, v array<double>").repartition(3)
    asked = spark.createDataFrame(questions, "q bigint, u array<double>").repartition(2)
    index = V.build(corpus, str(path), corpus_id="the id", corpus_vector="v", **more)
    rows = V.search(index, asked, k, query_id="q", query_vector="u", seen=seen)
    assert rows.columns == ["q", "rank", "the id", "distance"]
    return sorted((*tuple(r)[:3], round(r.distance, 9)) for r in rows.collect())


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(V, "QUESTIONS", 4)
    monkeypatch.setattr(V, "SLICE", 5)
    monkeypatch.setattr(V, "BLOCK_ROWS", 6)


def test_ties_and_repeats_against_all_distances(spark, tmp_path, small):
    rng = np.random.default_rng(5)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.integers(-2, 3, (300, 3)).astype(float))]
    questions = [(i, v.tolist()) for i, v in enumerate(rng.integers(-3, 4, (40, 3)).astype(float))]
    assert found(spark, tmp_path / "i", vectors, questions, 3) == nearest(vectors, questions, 3)


def test_clustered_vectors_are_mostly_passed_over(spark, tmp_path):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((20, 8)) * 20
    vectors = [(i, (centres[i % 20] + rng.standard_normal(8)).tolist()) for i in range(2000)]
    questions = [(i, (centres[i % 20] + rng.standard_normal(8)).tolist()) for i in range(60)]
    seen = Observation("compared")
    assert found(spark, tmp_path / "i", vectors, questions, 5, seen=seen) == nearest(vectors, questions, 5)
    assert 60 * 5 <= seen.get["compared"] < 2000 * 60 / 4


def test_one_hot_cell(spark, tmp_path, small):
    vectors = [(i, [1.0, 1.0]) for i in range(80)] + [(100 + i, [float(i), 0.0]) for i in range(10)]
    questions = [(i, [1.0, 1.0 + i % 2]) for i in range(15)]
    assert found(spark, tmp_path / "i", vectors, questions, 4) == nearest(vectors, questions, 4)
    assert found(spark, tmp_path / "j", vectors, questions, 4, pivots=1) == nearest(vectors, questions, 4)


def test_text_ids_and_fewer_rows_than_asked_for(spark, tmp_path):
    vectors = [("b", [1.0]), ("a", [1.0]), ("c", [-4.0])]
    assert found(spark, tmp_path / "i", vectors, [(1, [0.0])], 5, "string") == nearest(vectors, [(1, [0.0])], 5)


def test_damaged_rows_and_questions(spark, tmp_path):
    good = [(i, [float(i), 1.0]) for i in range(20)]
    bad = [(100, None), (101, []), (102, [1.0]), (103, [1.0, None]), (104, [float("nan"), 1.0]), (105, [float("inf"), 1.0]), (None, [0.0, 1.0])]
    questions = [(1, [0.2, 1.0]), (2, None), (None, [0.0, 0.0])]
    assert found(spark, tmp_path / "i", good + bad, questions, 2) == nearest(good, questions[:1], 2)
    for i, question in enumerate(([1.0], [1.0, None], [1.0, float("nan")])):
        with pytest.raises(ValueError, match="finite numbers"):
            found(spark, tmp_path / f"q{i}", good, [(1, question)], 2)


def test_no_rows_and_no_questions(spark, tmp_path):
    assert found(spark, tmp_path / "i", [(1, [1.0])], [], 2) == []
    assert found(spark, tmp_path / "j", [], [], 2) == []


def test_a_search_reads_the_cells_it_needs(spark, tmp_path, plan):
    vectors = [(i, [float(i), 0.0]) for i in range(500)]
    corpus = spark.createDataFrame(vectors, "id bigint, v array<double>")
    index = V.build(corpus, str(tmp_path / "i"), corpus_id="id", corpus_vector="v")
    asked = spark.createDataFrame([(1, [3.0, 0.0])], "q bigint, u array<double>")
    text = plan(V.search(index, asked, 40, query_id="q", query_vector="u"))
    assert re.search(r"PartitionFilters: \[[^\]]*_cell#\d+ (IN|=)", text)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_a_question_is_not_copied_to_every_cell(spark, tmp_path, monkeypatch):
    kept = []

    def seen(df, name):
        kept.append((name, keep(df, name)))
        return kept[-1][1]

    keep = V.staged
    monkeypatch.setattr(V, "staged", seen)
    # nothing can be passed over: all vectors are about as far from each other
    vectors = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(7).standard_normal((400, 48)))]
    assert found(spark, tmp_path / "i", vectors, vectors, 2) == nearest(vectors, vectors, 2)
    visits = [df.count() for name, df in kept if name == "visits"]
    # a row per question, and some that tell the cells of each task
    assert len(visits) == 2 and max(visits) <= 2 * len(vectors)
