"""Shares of weighted shards, what moves when a shard is added, gapless slots, and edge cases."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from dossierkit.llm import sharding

WORDS = [f"w[{i}]" for i in range(4)]


def shards(spark, weights, n=60000):
    keys = spark.range(n).withColumn("w", sharding.key_hash(F.col("id")))
    return {r["id"]: r.s for r in keys.select("id", sharding.rendezvous(WORDS, weights).alias("s")).collect()}


def test_shares_follow_the_weights(spark):
    for weights in ([1.0] * 16, [1, 2, 3.5, 0.5, 10]):
        counts = Counter(shards(spark, weights).values())
        for shard, weight in enumerate(weights):
            expected = 60000 * weight / sum(weights)
            assert abs(counts[shard] - expected) < 5 * expected**0.5


def test_another_shard_takes_rows_into_itself_only(spark):
    before, after = shards(spark, [1.0, 2.0, 1.0]), shards(spark, [1.0, 2.0, 1.0, 0.5])
    moved = [k for k in before if before[k] != after[k]]
    assert all(after[k] == 3 for k in moved) and abs(len(moved) - 60000 * 0.5 / 4.5) < 500
    heavier = shards(spark, [1.0, 2.0, 1.5])
    assert all(heavier[k] == 2 for k in before if before[k] != heavier[k])


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries()["op1_rendezvous_sharding"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 16)
    for shard in range(16):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


@pytest.mark.parametrize("cells", [1, 3, 256])
def test_edges(spark, cells):
    data = [(k, t) for k, t in [(None, "a"), (None, None), (1, "b"), (1, "b"), (1, "c"), (2, ""), (3, "x" * 100000)] for _ in range(3)]
    df = spark.createDataFrame([(*d, 9, "old") for d in data], "id bigint, body string, Slot int, _hash string")
    rows = sharding.assign_shards(df, "id", [1.0, 1.0, 1.0], 1.0, cells=cells).collect()
    assert sorted(((r["id"], r.body) for r in rows), key=str) == sorted(data, key=str)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    for key in (None, 1):
        assert len({(r.shard, r.grown_shard) for r in rows if r["id"] == key}) == 1
    assert set(rows[0].asDict()) == {"id", "body", "shard", "slot", "grown_shard"}


def test_no_rows_one_shard_and_bad_weights(spark):
    empty = spark.createDataFrame([], "id bigint")
    assert sharding.assign_shards(empty, "id", [1.0] * 4, 1.0).collect() == []
    one = sharding.assign_shards(spark.range(50), "id", [0.3]).collect()
    assert sorted(r.slot for r in one) == list(range(50)) and {r.shard for r in one} == {0}
    for weights in ([], [1.0, 0.0], [-1.0]):
        with pytest.raises(ValueError, match="weights"):
            sharding.assign_shards(empty, "id", weights)
    with pytest.raises(ValueError, match="cells"):
        sharding.assign_shards(empty, "id", [1.0] * 10000)


def test_no_python_on_the_way(spark, plan):
    text = plan(queries()["op1_rendezvous_sharding"](spark, "/root/testdata/sf0.001"))
    assert "Python" not in text and "Arrow" not in text.replace("ArrowUDF", "") and "SinglePartition" not in text
