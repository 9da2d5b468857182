"""Vector components against all pairs, and edge cases."""

import numpy as np
import pytest

from dossierkit.llm import components, embeddings

NAN, INF = float("nan"), float("inf")


def brute(rows, cosine):
    """{position: (links, component)} of (key, vector, label) rows by all pairs."""
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float) / max(map(abs, v))
        return v / np.sqrt(v @ v)

    units = [unit(v) if k is not None and lab is not None else None for k, v, lab in rows]
    parent = {k: k for k, _, _ in rows if k is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(len(rows)):
            if i != j and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]:
                if len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine:
                    links[i] += 1
                    a, b = sorted((find(rows[i][0]), find(rows[j][0])))
                    parent[b] = a
    return [(k, n, find(k) if k is not None else None) for (k, _, _), n in zip(rows, links)]


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "id bigint, v array<double>, lab int, n_links int, _id string")
    out = embeddings.near_vectors(df, "id", "v", "lab", **more).collect()
    for r in out:
        assert r.kept == (r["id"] is None or r["id"] == r.component_id)
    return sorted([(r["id"], r.n_links, r.component_id) for r in out], key=str)


EDGES = [
    (1, [1.0, 0.0, 0.0], 0), (2, [2.0, 0.0, 0.0], 0), (3, [1.0, 0.0, 0.0], 1), (4, [1.0, 0.0, 0.0], None), (5, None, 0),
    (6, [0.0, 0.0, 0.0], 0), (7, [NAN, 0.0, 0.0], 0), (8, [1.0, None, 0.0], 0), (9, [INF, 0.0, 0.0], 0), (10, [], 0),
    (11, [1.0, 0.0], 0), (12, [1.0, 0.1, 0.0], 0), (None, [1.0, 0.0, 0.0], 0), (0, [1e-300, 0.0, -0.0], 0),
    (13, [1e300, 1e299, 0.0], 0), (14, [-1.0, 0.0, 0.0], 0),
]


def test_edges(spark):
    assert run(spark, EDGES) == sorted(brute(EDGES, embeddings.COSINE), key=str)


@pytest.mark.parametrize("block", [4, 512])
def test_hot_groups_over_many_cells(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "SLICE", 50)
    rng = np.random.default_rng(1)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.2 * rng.standard_normal(16)).tolist(), 1) for i in range(120)]
    rows += [(1000 + i, base.tolist(), 1) for i in range(30)]
    rows += [(2000 + i, rng.standard_normal(16).tolist(), i % 2) for i in range(100)]
    order = rng.permutation(len(rows))
    rows = [(int(k), *rows[i][1:]) for k, i in enumerate(order)]
    assert run(spark, rows) == sorted(brute(rows, embeddings.COSINE), key=str)


def test_repeated_keys_and_no_rows(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 1.0], 0), (3, [1.0, 1.0], 0)]
    got = run(spark, rows)
    assert got == [(1, 1, 1)] * 3 + [(2, 1, 1), (3, 0, 3)]
    assert run(spark, []) == []


def test_tables_keep_the_promised_recall():
    same = (1 - np.arccos(0.93) / np.pi) ** embeddings.BITS
    assert (1 - same) ** embeddings.tables_for(0.93, embeddings.BITS, 1e-6) <= 1e-6


def test_keys_and_links_do_not_pass_through_the_driver(spark, monkeypatch, plan):
    # What every table makes of a vector is sized as the vectors themselves: no join may trust that.
    plans = []

    def seen(df):
        plans.append(plan(df))
        return checkpointed(df)

    checkpointed = components.checkpointed
    monkeypatch.setattr(embeddings, "checkpointed", seen)
    monkeypatch.setattr(components, "checkpointed", seen)
    monkeypatch.setattr(components, "SEND", 0, raising=False)
    rows = [(i, [1.0, i / 1000, 0.0], 0) for i in range(40)] + [(50, [1.0, 0.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, lab int")
    out = embeddings.near_vectors(df, "id", "v", "lab")
    assert {(r["id"], r.n_links, r.component_id) for r in out.collect()} == {(k, 40, 0) for k, _, _ in rows}
    plans.append(plan(out))
    assert sum(p.count("SortMergeJoin") for p in plans) >= 7
    assert not [p for p in plans if "Broadcast" in p]
