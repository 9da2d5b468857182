import random

import pytest
from pyspark.sql import functions as F

from dossierkit.operators import resolve as R


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_last_wins_keeps_a_null_value(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", 1.0), ("a", 2, "y", None), ("b", 1, "z", 3.0)], "k string, n int, t string, v double"
    )
    assert rows(R.last_wins(df, ["k"], ["n"])) == [("a", "y", None), ("b", "z", 3.0)]
    assert rows(R.last_wins(df.drop("t"), ["k"], ["n"])) == [("a", None), ("b", 3.0)]


def test_first_available_reports_misses(spark):
    log = spark.createDataFrame(
        [("a", 0, 404, "x"), ("a", 1, 200, "y"), ("a", 2, 200, "z"), ("b", 0, 500, "x"), ("c", 1, None, None)],
        "code string, region_no int, status int, body string",
    )
    found = R.first_available(log, ["code"], ["region_no"], F.col("status") == 200)
    assert rows(found.select("code", "region_no", "body")) == [("a", 1, "y"), ("b", None, None), ("c", None, None)]


def test_candidates(spark):
    df = R.candidates(spark.createDataFrame([("x",)], "entity string"), ("t", ["p", "q"]), ("e", ["gif", "png"]))
    urls = R.candidate_urls(df, "/%s_%s.%s", "entity", "t", "e")
    assert [r.url for r in urls.orderBy("t_no", "e_no").collect()] == ["/x_p.gif", "/x_p.png", "/x_q.gif", "/x_q.png"]


def test_explode_entities(spark):
    df = spark.createDataFrame([(1, "The Gambia[a], Chad and the Niger")], "i int, cell string")
    assert rows(R.explode_entities(df, "cell")) == [
        (1, 0, "Gambia", "gambia"),
        (1, 1, "Chad", "chad"),
        (1, 2, "Niger", "niger"),
    ]


def test_distinct_codes(spark):
    df = spark.createDataFrame([(["a", "b"],), (["b", "c"],)], "codes array<string>")
    assert rows(R.distinct_codes(df, "codes")) == [("a",), ("b",), ("c",)]


def test_skew_left_join_is_a_left_join(spark):
    rng = random.Random(3)
    keys = [None if rng.random() < 0.1 else "hot" if rng.random() < 0.4 else f"k{rng.randint(0, 50)}" for _ in range(500)]
    left = spark.createDataFrame(list(enumerate(keys)), "i int, k string")
    right = spark.createDataFrame([("hot", 0), (None, 9)] + [(f"k{n}", n) for n in range(0, 50, 2)], "k string, v int")
    expected = rows(left.join(right, "k", "left").select("i", "k", "v"))
    assert rows(R.skew_left_join(left, right, "k", ["i"]).select("i", "k", "v")) == expected


@pytest.fixture
def plain_joins(spark):
    """Shuffled joins without the adaptive planner, which would hide how rows are dealt."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rows_without_a_key_are_dealt_evenly(spark, plain_joins):
    key = F.expr("if(id % 10 = 0, concat('k', id % 100), null)").alias("k")
    left = spark.range(20000).select(F.col("id").alias("i"), key)
    right = spark.createDataFrame([("k0", 1)], "k string, v int")
    joined = R.skew_left_join(left, right, "k", ["i"])
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 20000 and len(sizes) == 8 and max(sizes) < 1.5 * 20000 / 8


def test_the_left_side_is_read_once(spark, plain_joins, plan):
    left = spark.range(100).selectExpr("id AS i", "concat('k', id) AS k")
    aliases = spark.createDataFrame([("k1", "k2")], "alias string, target string")
    matched = R.alias_join(left, "k", aliases, "alias", "target", ["i"])
    found = R.enrich(matched, [F.col("k")], {"one": R.Source(spark.createDataFrame([("k2", 1)], "key string, v int"), "key", 1)})
    assert plan(found).count("Range (") == 1


def test_enrich_keeps_equal_rows(spark):
    spine = spark.createDataFrame([("m", "r")] * 3 + [(None, None)] * 2 + [("x", "x")], "a string, b string")
    one = spark.createDataFrame([("r", 2)], "key string, v int")
    found = R.enrich(spine, [F.col("a"), F.col("b")], {"one": R.Source(one, "key", 2)})
    assert rows(found.select("a", "b", "one.v")) == [("m", "r", 2)] * 3 + [("x", "x", None)] + [(None, None, None)] * 2


def test_enrich_takes_the_first_key_that_hits(spark):
    spine = spark.createDataFrame(
        [("m", "r", "s"), ("m", "r", "t"), ("x", "r", "s"), ("x", "y", "s"), ("x", "x", "x"), (None, None, None)],
        "a string, b string, c string",
    )
    one = spark.createDataFrame([("m", 1), ("r", 2), ("s", 3), (None, 9)], "key string, v int")
    two = spark.createDataFrame([("s", "S"), ("r", "R")], "key string, w string")
    keys = [F.col("a"), F.col("b"), F.col("c")]
    found = R.enrich(spine, keys, {"one": R.Source(one, "key", 3), "two": R.Source(two, "key", 2)})
    assert rows(found.select("a", "b", "c", "one.v", "two.w")) == [
        ("m", "r", "s", 1, "R"),
        ("m", "r", "t", 1, "R"),
        ("x", "r", "s", 2, "R"),
        ("x", "x", "x", None, None),
        ("x", "y", "s", 3, None),
        (None, None, None, None, None),
    ]


def test_alias_join(spark):
    df = spark.createDataFrame([(1, "usa"), (2, "chad"), (3, None)], "i int, k string")
    aliases = spark.createDataFrame([("usa", "united states")], "alias string, target string")
    found = R.alias_join(df, "k", aliases, "alias", "target", ["i"])
    assert found.columns == ["i", "k"]
    assert rows(found) == [(1, "united states"), (2, "chad"), (3, None)]


def test_a_large_source_is_cut_before_it_is_shuffled(spark, plain_joins, plan, monkeypatch):
    spine = spark.createDataFrame([(f"k{i}", f"r{i}") for i in range(5)] + [(None, None)], "a string, b string")
    log = spark.range(5000).selectExpr("concat('r', id % 2000) AS key", "id AS at", "id * 2 AS v")
    keys = [F.col("a"), F.col("b")]

    def found(**more):
        return R.enrich(spine, keys, {"one": R.Source(R.last_wins(log, ["key"], ["at"]), "key", 2)}, **more)

    wanted = rows(found().select("a", "one.v"))
    assert rows(found(reduce=True).select("a", "one.v")) == wanted
    text = plan(found(reduce=True))
    # from the bottom of the source: rows, the cut, the partial aggregate, the shuffle
    below = text[: text.index("Range (")]
    assert below.rindex("LeftSemi") > below.rindex("Aggregate") > below.rindex("Exchange hashpartitioning")
    monkeypatch.setattr(R, "REDUCE_KEYS", 3)
    assert "LeftSemi" not in plan(found(reduce=True)) and rows(found(reduce=True).select("a", "one.v")) == wanted
