"""Hard negatives against all pairs, intervals against exact scores, and edge cases."""

import math

import numpy as np
import pytest

from dossierkit.llm import negatives as N

NAN, INF = float("nan"), float("inf")


def usable(row):
    key, vector, label = row
    return key is not None and label is not None and vector and all(x is not None and math.isfinite(x) for x in vector)


def brute(rows, every):
    """Result rows by all pairs in whole numbers; anchors are the keys divisible by ``every``."""
    rows = [(k, [math.floor(256 * x) for x in v], lab) for k, v, lab in filter(usable, rows)]
    out = []
    for key, vector, label in rows:
        if key % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), k, lab) for k, v, lab in rows if len(v) == len(vector) and k != key)
        for minus, positive, _ in [s for s in scored if s[2] == label][: N.POSITIVES]:
            band = [s for s in scored if s[2] != label and N.LOW * -minus <= 100 * -s[0] <= N.HIGH * -minus]
            out += [(key, positive, i + 1, k, -minus, -s) for i, (s, k, _) in enumerate(band[: N.NEGATIVES])]
    return sorted(out)


def run(spark, rows, every):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "id bigint, v array<double>, lab int, _id string, rank int")
    whole = N.integer_vectors(df, "id", "v", "lab")
    return sorted(map(tuple, N.hard_negatives(whole, whole.filter(f"_id % {every} = 0")).collect()))


def vectors(n, size, seed, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((5, size)) / np.sqrt(size)
    out = []
    for i in range(n):
        v = centres[rng.integers(5)] + rng.standard_normal(size) / np.sqrt(size) * rng.choice([0.2, 0.6, 1.5])
        out.append((i, v.tolist(), int(rng.integers(labels))))
    return out


@pytest.mark.parametrize("size", [3, 64, 70])
def test_against_all_pairs(spark, monkeypatch, size):
    monkeypatch.setattr(N, "ANCHORS", 5)
    monkeypatch.setattr(N, "ROWS", 40)
    monkeypatch.setattr(N, "SLICE", 7)
    rows = vectors(250, size, size)
    got = run(spark, rows, 9)
    assert got and got == brute(rows, 9)


EDGES = [
    (0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [1.0, 0.1], 1), (3, [0.8, 0.0], 2), (4, [0.8, 0.0], 2), (5, [0.5, 0.0], None),
    (6, None, 2), (7, [NAN, 1.0], 2), (8, [INF, 1.0], 2), (9, [None, 1.0], 2), (10, [], 1), (None, [0.8, 0.0], 2), (20, [0.0, 0.0], 1),
    (12, [0.7, -0.3], 3), (13, [-1.0, 0.0], 2), (14, [0.5, 0.5, 0.5], 2), (15, [0.999, 0.0], 4), (30, [-0.5, -0.5], 3), (40, [3000.0, 1.0], 1),
]


def test_edges(spark):
    assert run(spark, EDGES, 10) == brute(EDGES, 10)
    assert run(spark, EDGES[5:10], 1) == []
    assert run(spark, [], 1) == []


def test_hot_vector_and_ties(spark, monkeypatch):
    monkeypatch.setattr(N, "ROWS", 16)
    monkeypatch.setattr(N, "SLICE", 5)
    one = [0.5, 0.25, -0.125]
    rows = [(i, one, i % 2) for i in range(150)] + [(200 + i, [0.4, 0.25, -0.1], i % 2) for i in range(50)]
    assert run(spark, rows, 10) == brute(rows, 10)


def test_huge_numbers(spark):
    """Products that double precision cannot hold are exact; vectors whose scores need more than a long are left out."""
    rng = np.random.default_rng(4)
    rows = [(i, (rng.integers(1, 1 << 18, 4) + rng.random(4)).tolist(), i % 2) for i in range(40)]
    assert run(spark, rows, 5) == brute(rows, 5)
    assert run(spark, [*rows, (100, [1e30, 1.0, 1.0, 1.0], 1), (101, [1e308, 1.0, 1.0, 1.0], 1)], 5) == brute(rows, 5)


@pytest.mark.parametrize("size", [5, 64, 200])
def test_intervals_hold_every_score_and_narrow_the_search(size):
    rng = np.random.default_rng(size)
    rows = np.floor(40 * rng.standard_normal((400, size)))
    rows[0] = 0
    anchors = np.vstack([rows[:20], np.floor(40 * rng.standard_normal((20, size)))])
    rotate = N.rotation(size + -size % 64)
    assert np.allclose(rotate @ rotate.T, np.eye(len(rotate)))
    low, high = N.Asked(anchors, rotate).bounds(N.Coded(rows, rotate))
    exact = rows @ anchors.T
    assert (low <= exact).all() and (exact <= high).all()
    norms = np.linalg.norm(rows, axis=1)[1:, None] * np.linalg.norm(anchors, axis=1)
    widest = np.divide((high - low)[1:], 2 * norms, out=np.zeros_like(norms), where=norms > 0)
    assert widest.max() < 0.9  # narrower than what norms alone tell, which is 1


def test_repeated_ids(spark):
    """Rows that repeat an id are rows of their own, an anchor's id stands for one anchor."""
    rows = [(0, [1.0, 0.0], 1), (0, [0.9, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.0], 2), (2, [0.9, 0.0], 2)]
    got = run(spark, rows, 10)
    assert {r[:2] for r in got} == {(0, 1)} and len(got) == 4
    assert [r[2] for r in got] == [1, 1, 2, 2]
