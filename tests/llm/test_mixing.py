"""Target totals, nonnegative rates against a plain solver, held-out accuracy, and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from dossierkit.llm import mixing
from dossierkit.llm.queries import DOMAINS, SHARES, domain_labels


def projected(n, p, targets, rounds=60000):
    """Least squares by plain projected gradient steps, tokens as the metric."""
    r = np.ones(len(n))
    base = (n[:, None] * p).sum(0)
    for _ in range(rounds):
        r = np.maximum(0, r + p @ ((targets - (n * r) @ p) / np.maximum(base, 1e-9)))
    return r


def test_query_reaches_the_targets(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries()["op4_source_mixing"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    p = np.array([[r[f"p_{d}"] for d in DOMAINS] for r in rows])
    n, rate, copies = (np.array([r[c] for r in rows]) for c in ("n_tokens", "rate", "copies"))
    assert np.allclose(p.sum(1), 1) and (rate >= 0).all()
    assert np.allclose((n * rate) @ p / n.sum(), SHARES, atol=1e-6)
    assert np.allclose((n * copies) @ p / n.sum(), SHARES, atol=0.03)
    assert ((copies >= np.floor(rate)) & (copies <= np.ceil(rate))).all()


def test_held_out_accuracy_of_the_classifier(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), domain_labels(spark, sf)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = mixing.fit_classifier(docs, "doc_id", "text", labels.filter(~held), "domain", DOMAINS)
    judged = model.posteriors(docs, "text").join(labels.filter(held), "doc_id").select("domain", "posterior").collect()
    right = sum(DOMAINS[int(np.argmax(r.posterior))] == r.domain for r in judged)
    common = max(sum(r.domain == d for r in judged) for d in DOMAINS)
    assert right / len(judged) > 0.92 > common / len(judged)


@pytest.mark.parametrize("shares", [(0.5, 0.3, 0.2), (0.98, 0.01, 0.01), (0.97, 0.03, 0.0), (1.0, 0.0, 0.0)])
def test_rates_are_those_of_the_least_squares(spark, shares):
    rng = np.random.default_rng(2)
    n, p = rng.integers(0, 500, 200), rng.dirichlet([0.3, 0.3, 0.3], 200)
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "n_tokens bigint, posterior array<double>")
    fit = mixing.fit_rates(df, shares)
    rates = np.array([r[0] for r in df.select(fit.rate()).collect()])
    targets = np.array(shares) * n.sum()
    assert (rates >= 0).all() and np.allclose((n * rates) @ p, fit.totals)
    plain = (n * projected(n, p, targets)) @ p
    assert np.linalg.norm(targets - fit.totals) <= np.linalg.norm(targets - plain) + 1e-4 * n.sum()
    assert fit.steps < 20


def test_equal_texts_take_the_domain_of_the_least_key(spark):
    rows = [(i, "same text here", "good" if i == 3 else "poor") for i in range(3, 40)] + [(50 + i, f"other {i}", "poor") for i in range(3)]
    df = spark.createDataFrame(rows, "id bigint, body string, d string")
    model = mixing.fit_classifier(df, "id", "body", df, "d", ["good", "poor"])
    assert model.prior == [2 / 6, 4 / 6]


def test_budget_and_missing_domain(spark):
    rows = [(100, [1.0, 0.0]), (300, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "n_tokens bigint, posterior array<double>")
    fit = mixing.fit_rates(df, [0.5, 0.5], budget=1000)
    assert np.allclose(fit.totals, [500, 0]) and [round(r[0], 6) for r in df.select(fit.rate()).collect()] == [1.25, 1.25]
    for empty in (df.limit(0), df.withColumn("n_tokens", F.lit(0).cast("bigint"))):
        assert mixing.fit_rates(empty, [0.5, 0.5]).lean == [0.0, 0.0]
    with pytest.raises(ValueError, match="shares"):
        mixing.fit_rates(df, [-1, 2])


def test_edges(spark, plan):
    texts = [(1, "plain words stand here"), (2, "A## B%% C$$"), (3, None), (4, ""), (5, " \n"), (1, "plain words stand here"), (None, "x"), (6, "long " * 50000)]
    df = spark.createDataFrame([(*t, 4, "y") for t in texts], "id bigint, body string, n_tokens int, posterior string")
    train = spark.createDataFrame([(i, f"plain words number{i} here and there", "good") for i in range(30)] + [(100 + i, f"A## B{i}%% C$$ D**", "poor") for i in range(30)] + [(None, "x", "good"), (300, "x", None), (301, "x", "else")], "id bigint, body string, d string")
    model = mixing.fit_classifier(train, "id", "body", train, "d", ["good", "poor", "absent"])
    out = mixing.mixed(df, "id", "body", model, [0.5, 0.4, 0.1])
    assert "Python" not in plan(out)
    rows = out.collect()
    assert sorted(((r["id"], r.body) for r in rows), key=str) == sorted(texts, key=str)
    assert all(abs(sum(r.posterior) - 1) < 1e-9 and r.rate >= 0 for r in rows)
    assert {r.n_tokens for r in rows if not (r.body or "").strip()} == {0}
    best = {r["id"]: int(np.argmax(r.posterior)) for r in rows}
    assert best[1] == 0 and best[2] == 1
    assert mixing.mixed(df.limit(0), "id", "body", model, [1, 1, 1]).collect() == []
    even = mixing.fit_classifier(train.limit(0), "id", "body", train.limit(0), "d", ["a", "b"])
    assert {tuple(r.posterior) for r in even.posteriors(df, "body").collect()} == {(0.5, 0.5)}
