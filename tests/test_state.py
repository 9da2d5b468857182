"""States over landings against one run over all of them."""

import random

import pytest
from pyspark.sql import functions as F

from dossierkit.operators import state as S
from dossierkit.operators.resolve import first_available, last_wins
from dossierkit.sources import sinks

LOG = "landing int, code string, region int, status int, body string"


def landings(seed, n=3):
    rng = random.Random(seed)
    return [(i, f"c{rng.randint(0, 40)}", j, rng.choice([200, 404, 500]), f"{i}-{j}") for i in range(n) for j in range(60)]


def test_settled_keys_are_not_tried_again(spark, tmp_path):
    rows = landings(1)
    ok = F.col("status") == 200
    whole = first_available(spark.createDataFrame(rows, LOG), ["code"], ["landing", "region"], ok).filter("landing IS NOT NULL")
    state = S.State(spark, str(tmp_path / "s"), ("code",), 4)
    assert state.read() is None
    for i in range(3):
        log = spark.createDataFrame([r for r in rows if r[0] == i], LOG)
        out = S.settle(state, log, ["landing", "region"], ok)
    columns = whole.columns
    assert sorted(map(tuple, out.select(columns).collect())) == sorted(map(tuple, whole.collect()))
    # a later landing cannot change what is settled
    again = spark.createDataFrame([(9, r["code"], 0, 200, "no") for r in whole.collect()], LOG)
    assert S.settle(state, again, ["landing", "region"], ok).filter("body = 'no'").count() == 0


def test_a_landing_that_fails_leaves_the_state(spark, tmp_path, monkeypatch):
    state = S.State(spark, str(tmp_path / "s"), ("k",), 2)
    state.write(spark.createDataFrame([(1, "a")], "k int, v string"))

    def killed(*a, **b):
        raise RuntimeError("killed")

    broken = S.State(spark, state.folder, ("k",), 2)
    with monkeypatch.context() as m:
        m.setattr(sinks, "staged", killed)
        with pytest.raises(RuntimeError):
            broken.write(spark.createDataFrame([(2, "b")], "k int, v string"))
    assert [tuple(r) for r in state.read().collect()] == [(1, "a")]


def cells():
    return {"x 1": (F.col("cell") == "x", F.col("value")), "y": (F.col("cell") == "y", F.col("value"))}


ROWS = "k string, `a.b` int, cell string, at int, no int, value double"


def cell_rows(seed, n):
    rng = random.Random(seed)
    return [(rng.choice("abcdef"), rng.randint(0, 2), rng.choice("xyz"), rng.choice([None, *range(50)]), i + 1000 * seed, rng.choice([None, 1.0, 2.0, float(i)])) for i in range(n)]


def test_merged_cells_equal_a_rebuild(spark, tmp_path):
    keys, order = ("k", "a.b"), ["at", "no"]
    state = S.State(spark, str(tmp_path / "s"), keys, 4)
    parts = [cell_rows(s, 80) for s in (1, 2, 3)]
    for part in parts:
        merged = S.merge_cells(state, S.cell_states(spark.createDataFrame(part, ROWS), keys, order, cells()))
    rebuilt = S.cell_states(spark.createDataFrame(sum(parts, []), ROWS), keys, order, cells())
    got, wanted = (sorted(map(str, S.cell_values(df, keys).select("k", "`a.b`", "`x 1`", "y").collect())) for df in (merged, rebuilt))
    assert got == wanted
    # the same as keeping the last row of each key and cell
    df = spark.createDataFrame([r for r in sum(parts, []) if r[3] is not None and r[2] == "y"], ROWS)
    last = {(r["k"], r["a.b"]): r["value"] for r in last_wins(df.drop("cell"), list(keys), order).collect()}
    assert {(r["k"], r["a.b"]): r["y"] for r in S.cell_values(merged, keys).collect() if (r["k"], r["a.b"]) in last} == last


def test_a_merge_shuffles_the_new_rows_only(spark, tmp_path, plan):
    state = S.State(spark, str(tmp_path / "s"), ("k",))
    rows = spark.createDataFrame(cell_rows(1, 50), ROWS)
    before = state.write(S.cell_states(rows, ["k"], ["at", "no"], cells()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(S.merged_cells(before, S.cell_states(rows, ["k"], ["at", "no"], cells()), ("k",)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text
