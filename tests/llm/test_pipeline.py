"""Each stage of the pipeline on its own input against a brute-force version."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dossierkit.llm import contamination, mixing, toxicity
from dossierkit.llm.queries import TOXIC, domain_labels, training_labels
from tests_llm_brute import leaks, near

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, written and reread as the pipeline does."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs, after
        docs = after
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert all(after.columns == COLUMNS for name, (_, after) in stages.items() if name != "sharding")


def test_toxicity(spark, stages):
    before, after = map(texts, stages["toxicity"])
    model = toxicity.fit(stages["toxicity"][0], training_labels(spark, SF), "doc_id", "text", "toxic")
    scores = dict(zip(before, model.scores(pa.array([(t or "").lower() for t in before.values()], pa.large_string()))))
    assert set(after) == {k for k, s in scores.items() if s < TOXIC} and len(after) < len(before)


def test_near_duplicates(stages):
    before, after = map(texts, stages["near_duplicates"])
    component = near(list(before.items()), 5)
    assert set(after) == {k for k, c in component.items() if k == c} and len(after) < len(before)
    assert all(after[k] == before[k] for k in after)


def test_decontamination(spark, stages):
    before, after = map(texts, stages["decontamination"])
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    assert set(before) - set(after) == {d for d, _, _ in leaks(before.items(), items.items(), contamination.RATE)} != set()


def test_mixing(spark, stages):
    before, after = stages["mixing"]
    model = mixing.fit_classifier(before, "doc_id", "text", domain_labels(spark, SF), "domain", list(corpus_pipeline.TARGETS))
    judged = {r.doc_id: r for r in model.posteriors(before, "text").collect()}
    copies = {}
    for r in after.select("doc_id").collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    n = np.array([r.n_tokens * copies.get(k, 0) for k, r in judged.items()])
    p = np.array([r.posterior for r in judged.values()])
    wanted = np.array(list(corpus_pipeline.TARGETS.values()))
    assert np.allclose(n @ p / sum(r.n_tokens for r in judged.values()), wanted, atol=0.05)
    assert after.exceptAll(before.crossJoin(spark.range(3)).drop("id")).count() == 0


def test_sharding(stages):
    before, after = stages["sharding"]
    rows = after.collect()
    assert len(rows) == before.count() and set(after.columns) == {*COLUMNS, "shard", "slot"}
    for s in range(16):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))


def test_run_gives_the_last_stage(spark, stages):
    found = corpus_pipeline.run(spark, SF).select("doc_id", "shard", "slot").collect()
    expected = stages["sharding"][1].select("doc_id", "shard", "slot").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, expected))


def test_stages_take_nulls_repeats_and_no_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (900001, None, "en", "s", 0), (900002, "", "en", "s", 0), (900003, "w " * 40000, "en", "s", 1)], docs.schema)
    few = docs.limit(40).unionByName(odd).unionByName(docs.filter("doc_id = 3"))
    for rows in (few, docs.limit(0)):
        n = rows.count()
        for _, stage in corpus_pipeline.STAGES:
            found = stage(spark, rows, SF).collect()
            assert len(found) <= 3 * n
            assert n == 0 or {900001, 900002} & {r.doc_id for r in found}


def test_near_duplicates_go_by_row(spark):
    """Repeated ids do not take unique texts along, and repeated rows leave one."""
    t, u, w = (" ".join(f"{x}{i}" for i in range(30)) for x in "tuw")
    rows = [(1, w), (2, w), (2, u), (3, t), (3, t), (None, t), (4, None), (4, None), (5, ""), (None, "alone " + u[::-1])]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id bigint, text string, _row int").withColumn("_ROW_", F.lit("x"))
    found = corpus_pipeline.one_of_each_group(spark, docs, SF)
    assert found.columns == docs.columns
    wanted = [(1, w), (2, u), (3, t), (4, None), (4, None), (5, ""), (None, "alone " + u[::-1])]
    assert sorted([(r.doc_id, r.text) for r in found.collect()], key=str) == sorted(wanted, key=str)


def test_stages_keep_other_columns_whatever_their_names(spark):
    names = ["n_tokens", "posterior", "rate", "copies", "_copy", "_words", "_label", "shingles", "kept", "component_id", "Rate2", "found", "score"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = docs.select("*", *[F.concat(F.lit(f"{n} of "), "doc_id").alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, odd, SF)
        assert found.columns == odd.columns, name
        rows = found.collect()
        assert rows and all(r[n] == f"{n} of {r.doc_id}" for r in rows for n in names), name
