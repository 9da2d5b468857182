from functools import reduce

from pyspark.sql import functions as F

from dossierkit.operators import shape as S
from dossierkit.operators.counts import Counts, load_counts, observed
from dossierkit.operators.resolve import last_wins


def test_pivot_keeps_the_last_value_and_has_one_exchange(spark, plan):
    df = spark.createDataFrame(
        [("a", "G", 2020, 1.0, 0), ("a", "G", 2020, None, 1), ("a", "P", 2021, 5.0, 0), ("b", "X", 2020, 9.0, 0), ("b", "G", 1999, 9.0, 0)],
        "c string, indicator string, year int, value double, pos int",
    )
    wide = S.indicator_pivot(df, ["c"], ["G", "P"], range(2020, 2022), ordinal="pos")
    assert wide.columns == ["c", "G 2020", "G 2021", "P 2020", "P 2021"]
    assert [tuple(r) for r in wide.collect()] == [("a", None, None, None, 5.0)]
    assert plan(wide).count("Exchange hash") == 1
    unique = S.indicator_pivot(df.filter("pos = 0"), ["c"], ["G", "P"], range(2020, 2022))
    assert [tuple(r) for r in unique.collect()] == [("a", 1.0, None, None, 5.0)]


def test_outer_merge_equals_a_chain_of_full_joins(spark, plan):
    metrics = [f"m.{i}" for i in range(6)]
    long = spark.range(300).select(
        F.concat(F.lit("k"), (F.col("id") * 7 % 23).cast("string")).alias("Country"),
        F.concat(F.lit("m."), (F.col("id") * 5 % 11).cast("string")).alias("metric"),
        F.when(F.col("id") % 13 > 0, F.col("id").cast("double")).alias("value"),
        F.col("id").alias("ordinal"),
    ).filter(F.col("metric").isin(metrics))
    last = last_wins(long, ["Country", "metric"], ["ordinal"])
    merged = S.outer_merge(last, "Country", metrics)
    tables = [last.filter(F.col("metric") == m).select("Country", F.col("value").alias(m)) for m in metrics]
    chained = reduce(lambda a, b: S.outer_join_pair(a, b, "Country"), tables)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, chained.select(*[f"`{c}`" for c in merged.columns]).collect()))
    assert plan(S.outer_merge(long, "Country", metrics)).count("Exchange hash") == 1


def test_outer_merge_keeps_a_key_without_numbers(spark):
    df = spark.createDataFrame([("a", "x", None)], "Country string, metric string, value double")
    assert [tuple(r) for r in S.outer_merge(df, "Country", ["x", "y"]).collect()] == [("a", None, None)]


def test_column_policies(spark):
    df = spark.createDataFrame([("n", "$1,5 x", 7, "bad")], "name string, `a.b` string, i int, t string")
    assert [tuple(r) for r in S.clean_columns(df, ["name"]).collect()] == [("n", 15.0, 7.0, None)]
    assert [tuple(r) for r in S.to_numeric(df, ["name"]).collect()] == [("n", None, 7.0, None)]
    assert S.reconcile(df, ["i", "absent", "name"], drop=["t"]).columns == ["i", "name", "a.b"]
    assert S.has_name(spark.createDataFrame([("",), (None,), ("x",)], "name string"), "name").count() == 1


def test_order_is_by_code_point(spark):
    df = spark.createDataFrame([("b",), ("É",), ("a",), ("Z",)], "k string")
    assert [r.k for r in S.order_by_key(df, "k").collect()] == sorted("bÉaZ")


def test_counts(spark, tmp_path):
    df = spark.range(10)
    assert {tuple(r) for r in load_counts({"a": df, "b": df.limit(0)}).collect()} == {("a", 10), ("b", 0)}
    watched, seen = observed(df, "rows", bad=F.col("id") > 6)
    watched.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"n": 10, "bad": 3}


def test_only_decimal_numbers_are_numeric(spark):
    texts = {"12d": None, "1.5f": None, "0x1p3": None, " 7.5 ": 7.5, "-2e3": -2000.0, "+.5": 0.5, "5.": 5.0, "1,5": None, "": None, None: None, "e5": None}
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    found = S.to_numeric(df, ["i"]).orderBy("i").collect()
    assert [r.x for r in found] == list(texts.values())
    assert S.to_numeric(spark.createDataFrame([(1, 2)], "i int, x int"), ["i"]).first().x == 2.0


def test_counts_of_several_sources_in_one_action(spark, tmp_path):
    counts = Counts()
    one = counts.watched(spark.range(10), "a", bad=F.col("id") > 6)
    two = counts.watched(spark.range(10), "b", bad=F.expr("if(id = 0, null, false)"), rows=F.col("id") < 4)
    none = counts.watched(spark.range(0), "c", bad=F.lit(False))
    one.join(two, "id", "full").join(none, "id", "full").write.parquet(str(tmp_path / "out"))
    assert counts.read() == {"a": (10, 3), "b": (4, 1), "c": (0, 0)}
    assert sorted(map(tuple, counts.table(spark).collect())) == [("a", 10, 3), ("b", 4, 1), ("c", 0, 0)]
