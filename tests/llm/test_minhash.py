"""Near-duplicate components against all pairs, the sketch itself, and edge cases."""

import re

import numpy as np
import pytest

from __spark_entry__ import queries
from dossierkit.llm import minhash
from dossierkit.llm.components import components
from dossierkit.llm.wordhash import Words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, length):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + length]) for i in range(max(1, len(words) - length + 1)))


def brute(rows, length, percent=80):
    """{key: (component, size)} by comparing all pairs that share a shingle."""
    sets = [(k, shingles(t, length)) for k, t in rows if k is not None]
    parent = {k: k for k, _ in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    by_shingle = {}
    for i, (_, s) in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    for i, (k, s) in enumerate(sets):
        counts = {}
        for x in s:
            for j in by_shingle[x]:
                if j < i:
                    counts[j] = counts.get(j, 0) + 1
        for j, n in counts.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                a, b = sorted((find(k), find(sets[j][0])))
                parent[b] = a
    return {k: find(k) for k, _ in sets}, {}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_finds_the_components_of_all_pairs(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    expected, _ = brute(docs, 2)
    rows = queries()["op8_minhash_near_dedup"](spark, sf).collect()
    assert {r.doc_id: r.component_id for r in rows} == expected and len(rows) == len(docs)
    sizes = {k: len(shingles(t, 2)) for k, t in docs}
    assert all(r.n_shingles == sizes[r.doc_id] and r.kept == (r.doc_id == r.component_id) for r in rows)


def test_sketch_is_full_and_estimates_similarity():
    rng = np.random.default_rng(5)

    def of(lists):
        texts = [" ".join(map(str, x)).encode() for x in lists]
        data = np.frombuffer(b"".join(texts), np.uint8)
        return minhash.sketches(minhash.Shingles(Words(data, np.cumsum([0, *map(len, texts)])), 1))

    for size in (1, 2, 30, 400):
        errors = []
        for _ in range(20):
            base = rng.integers(0, 10**12, 2 * size)
            a, b = of([base[: size + size // 2], base[size // 2 :]])
            assert (a != minhash.EMPTY).all() and (b != minhash.EMPTY).all()
            true = len(set(base[: size + size // 2]) & set(base[size // 2 :])) / len(set(base))
            errors.append((a == b).mean() - true)
        assert abs(np.mean(errors)) < 0.06 and max(map(abs, errors)) < 0.35
    assert (of([[1], []])[1] == minhash.EMPTY).all()


LONG = [f"w{i}" for i in range(40)]
CASES = [
    (1, " ".join(LONG)), (2, " ".join(LONG).upper()), (3, " ".join(LONG + ["end"])), (4, None), (5, ""), (6, " \t"),
    (7, "One"), (8, "one"), (9, "one two"), (None, " ".join(LONG)), (10, " ".join(LONG[:20])), (11, "x " * 4000),
    (12, "x " * 5000), (13, " ".join(LONG[5:] + [f"v{i}" for i in range(5)])), (13, "one two"), (0, "É w"), (14, "é w"),
]


@pytest.mark.parametrize("length", [1, 2, 5])
def test_edges(spark, length):
    df = spark.createDataFrame([(k, t, 7, "x") for k, t in CASES], "id bigint, body string, n_shingles int, component_id string")
    rows = minhash.near_duplicates(df, "id", "body", length).collect()
    expected, _ = brute(CASES, length)
    assert len(rows) == len(CASES)
    for r in rows:
        assert r.component_id == expected.get(r["id"]) and r.kept == (r["id"] is None or r["id"] == r.component_id)


def test_chains_and_stars_in_one_bucket(spark, monkeypatch):
    """Neighbours are alike, the ends of a chain are not; leaders have more pairs than one part holds."""
    monkeypatch.setattr(minhash, "LEADER_PAIRS", 3)
    monkeypatch.setattr(minhash, "BLOCK", 4)
    base = [f"t{i}" for i in range(30)]
    chain = [(k, " ".join(base[k:] + [f"u{i}" for i in range(k)])) for k in range(0, 31)]
    star = [(100 + k, " ".join(base[::-1][:29] + [f"s{k}"])) for k in range(25)]
    rows = minhash.near_duplicates(spark.createDataFrame(chain + star, "id bigint, body string"), "id", "body", 1).collect()
    assert {r["id"]: r.component_id for r in rows} == brute(chain + star, 1)[0]


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (230, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    links += [(2000, 2001 + i) for i in range(50)] + [(5, 5), (7000, 7000), (1000, 1001)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = components(spark.createDataFrame([*links, (None, 4)], "l bigint, r bigint"), "l", "r").collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "l bigint, r bigint"), "l", "r").collect() == []


def test_no_rows(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "id bigint, body string"), "id", "body").collect() == []
