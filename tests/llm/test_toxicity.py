"""Held-out accuracy, fewer false positives on neutral mentions of groups, and edge cases."""

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from __spark_entry__ import queries
from dossierkit.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries()["op6_toxicity"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    hits = sum(r.predicted and labels[r.doc_id] for r in held)
    assert right / len(held) > 0.99
    assert hits / sum(labels[r.doc_id] for r in held) > 0.92
    assert hits / sum(r.predicted for r in held) > 0.99


def sentences(seed, n):
    """Toxic sentences hold an insult or, some of them, none that can be seen; most name a group."""
    rng = np.random.default_rng(seed)
    filler = [f"{a}{b}" for a in "bcdfgklm" for b in ("ato", "eni", "olu", "iru", "aso")]
    out = []
    for i in range(n):
        toxic = int(rng.random() < 0.4)
        words = [f"w{''.join(rng.choice(list('abcdefgh'), 4))}"] + rng.choice(filler, 8).tolist()
        if toxic and rng.random() < 0.5:
            words.insert(3, rng.choice(["vermin", "scum"]))
        if rng.random() < (0.95 if toxic else 0.02):
            words.insert(5, "women")
        out.append((i, " ".join(words), toxic))
    return out


def test_swapped_groups_change_little_and_neutral_mentions_are_let_go(spark):
    train = spark.createDataFrame(sentences(1, 1500), "id bigint, body string, t int")
    neutral = [f"{x} ato women {y} beni" for x in ("kolu", "miru", "faso", "deni") for y in ("lato", "gaso", "colu")]
    toxic = [f"{x} women scum {x}" for x in ("kolu", "miru")]
    probe = spark.createDataFrame([(t,) for t in neutral + toxic + [t.replace("women", "men") for t in neutral]], "body string")
    got = {}
    for swap in (0.0, 1.0):
        model = toxicity.fit(train, train, "id", "body", "t", swap=swap)
        got[swap] = {r[0]: r[1] for r in probe.select("body", toxicity.score(model, F.col("body"))).collect()}
    false = {s: sum(got[s][t] >= 0.7 for t in neutral) for s in got}
    change = {s: max(abs(got[s][t] - got[s][t.replace("women", "men")]) for t in neutral) for s in got}
    assert false[0.0] > 6 and false[1.0] == 0
    assert change[1.0] < change[0.0] / 3 and change[1.0] < 0.1
    assert all(got[1.0][t] >= 0.7 for t in toxic)


def test_the_penalty_is_the_sum_over_counterfactuals():
    counts = np.array([[2.0, 0, 1], [0, 1, 3]])
    w = np.array([0.5, -1.0, 2.0])
    total = 0.0
    for row in counts:
        for a, b in ((0, 1), (1, 0)):
            own, other = w[a] + (w[2] if a == 0 else 0), w[b] + (w[2] if b == 0 else 0)
            total += ((row[a] * (other - own)) ** 2 + (row[a] * own) ** 2) / 2
    assert math.isclose(w @ toxicity.swap_penalty(counts, [[[0, 2], [1]]]) @ w, total)


def test_weights_are_those_of_plain_gradient_steps():
    rng = np.random.default_rng(4)
    x = np.hstack([rng.integers(0, 4, (300, 6)), np.ones((300, 1))]).astype(float)
    y = (rng.random(300) < 1 / (1 + np.exp(-(x @ [1, -1, 0.5, 0, 0, -0.5, -0.3])))).astype(float)
    penalty = np.diag([0.5] * 6 + [0.0]) + toxicity.swap_penalty(x, [[[0], [1, 4]]])
    w = np.zeros(7)
    for _ in range(20000):
        w -= 3e-4 * (x.T @ (1 / (1 + np.exp(-(x @ w))) - y) + penalty @ w)
    assert np.allclose(toxicity._solved(x, y, penalty), w, atol=1e-5)


def test_words_count_by_their_log_likelihood_ratio(spark):
    cells = [(5, 5), (5, 0), (5, 2), (40, 4), (100, 10), (60, 0)]
    df = spark.createDataFrame([(i, t, c) for i, (c, t) in enumerate(cells)], "i int, t bigint, c bigint")
    got = {r.i: r[1] for r in df.select("i", toxicity._ratio(1000, 100)).collect()}
    for i, (c, t) in enumerate(cells):
        seen = np.array([[t, c - t], [100 - t, 900 - c + t]], float)
        expected = np.outer(seen.sum(1), seen.sum(0)) / 1000
        parts = seen[seen > 0] * np.log(seen[seen > 0] / expected[seen > 0])
        assert math.isclose(got[i], 2 * parts.sum(), abs_tol=1e-9)


def test_equal_texts_take_the_label_of_the_least_key(spark):
    rows = [(i, f"scum number {chr(97 + i)}", 1) for i in range(20)] + [(100 + i, f"scum number {chr(97 + i)}", 0) for i in range(20)]
    rows += [(200 + i, f"fine number {chr(97 + i)}", 0) for i in range(20)]
    df = spark.createDataFrame(rows, "id bigint, body string, t int")
    model = toxicity.fit(df, df, "id", "body", "t")
    got = df.select("body", toxicity.score(model, F.col("body")).alias("s")).distinct().collect()
    assert all((r.s > 0.9) == r.body.startswith("scum") for r in got)


def test_texts_that_share_a_passage_all_count():
    """A fifth of each text is shared; one of the 60 texts has a copy with a changed end."""
    rng = np.random.default_rng(5)
    words = ["".join(w) for w in rng.choice(list("abcdefgh"), (4000, 6))]
    texts = [" ".join(words[:20] + words[20 + 60 * i : 80 + 60 * i]) for i in range(60)]
    texts.append(texts[0] + " end")
    columns = {"_row": range(61), "_toxic": [1] * 61, "_text": texts}
    batch = toxicity.pa.RecordBatch.from_arrays([toxicity.pa.array(c) for c in columns.values()], list(columns))
    marks = [(r["_least"], r["_most"]) for b in toxicity._marked(iter([batch])) for r in b.to_pylist()]
    assert len(set(marks)) > 55 and marks[0] == marks[60]


def test_edges(spark):
    texts = [(1, "good words here"), (2, "bad scum words"), (3, None), (4, ""), (2, "bad scum words"), (None, "scum"), (5, "x" * 100000), (6, "scum " * 50000)]
    df = spark.createDataFrame([(*t, 0.5, "q") for t in texts], "id bigint, body string, score double, _text string")
    many = [(i, f"x{chr(97 + i)} bad scum y{chr(97 + i)}", 1) for i in range(20)] + [(40 + i, f"z{chr(97 + i)} good day q{chr(97 + i)}", 0) for i in range(25)]
    train = spark.createDataFrame([*many, (70, "odd", 2), (71, "odd", None), (72, None, 1), (None, "x", 1)], "id bigint, body string, t int")
    model = toxicity.fit(train, train, "id", "body", "t")
    got = [r[0] for r in df.select(toxicity.score(model, F.col("body"))).collect()]
    assert len(got) == len(texts) and all(0 <= g <= 1 for g in got) and got[1] == got[4] > got[0] and got[2] == got[3]
    for rows in ([], [(1, "x", 1)], [(1, None, 0), (2, "", 0)]):
        one = spark.createDataFrame(rows, "id bigint, body string, t int")
        flat = [r[0] for r in df.select(toxicity.score(toxicity.fit(one, one, "id", "body", "t"), F.col("body"))).collect()]
        assert len(set(flat)) == 1 and math.isclose(flat[0], sum(r[2] for r in rows) / len(rows) if rows else 0.5, abs_tol=1e-5)
    none = spark.createDataFrame([], "body string")
    assert none.select(toxicity.score(model, F.col("body"))).collect() == []
