"""JSON records: texts by path, latest years, payloads, and what settings must not change."""

import json

import pytest

from dossierkit.operators import records as R


@pytest.fixture
def texts(spark):
    def run(fields, bodies):
        df = spark.createDataFrame(list(enumerate(bodies)), "i int, `b.x` string")
        return R.json_fields(df, "b.x", fields).orderBy("i").collect()

    return run


def test_json_text(texts):
    doc = {
        "total": {"text": "5 m"}, "number": 3, "list": [1], "plain": "str", "empty": {}, "deep": {"z": {"q": 7, "ä": [1.50, None, True]}, "b": 2},
        "big": {"text": 1e10}, "none": {"text": None}, "a (b), c - d": {"text": "odd key"}, "null": None, "object": {"text": {"b": 1, "a": "x"}}, "yes": {"text": True},
    }
    fields = {k: R.json_text("P", k) for k in [*doc, "absent"]}
    fields |= {"further": R.json_text("P", "plain", "further"), "nothing": R.json_text("P", "absent", default=None)}
    found = texts(fields, [json.dumps({"P": doc}).replace("1.5,", "1.50,")])[0].asDict()
    assert found == {
        "i": 0, "total": "5 m", "number": "N/A", "list": "N/A", "plain": "str", "empty": "N/A", "deep": '{"z":{"q":7,"ä":[1.50,null,true]},"b":2}',
        "big": "10000000000", "none": None, "a (b), c - d": "odd key", "null": "N/A", "object": '{"b":1,"a":"x"}', "yes": "true", "absent": "N/A",
        "further": "N/A", "nothing": None, R.BAD_RECORD: False,
    }


def test_latest_year(texts):
    bodies = [
        {"E": {"GDP (x) 2021": {"text": "a"}, "GDP (x) 2023 est": {"text": "b"}, "GDP (x)2025": "no", "x GDP (x) 2026": "no"}},
        {"E": {"GDP (x) 2023": {"n": 1}, "GDP (x) 2022": "older"}},
        {"E": {"GDP (x) 2023": 5, "GDP (x) 2022": "older"}},
        {"E": {"GDP (x) 2023 b": "second", "GDP (x)  2023 a": "first"}},
        {"E": {"GDP (x) 2020": "no", "GDP (x) 2021 est.": {"zeta": "11 x", "alpha": "22 y"}}},
        {"E": 3},
    ]
    found = texts({"y": R.latest_year_text("E", base="GDP (x)")}, [*map(json.dumps, bodies), "bad", None])
    assert [r["y"] for r in found] == ["b", '{"n":1}', "N/A", "second", '{"zeta":"11 x","alpha":"22 y"}', "N/A", "N/A", "N/A"]
    assert [r[R.BAD_RECORD] for r in found] == [False] * 6 + [True] * 2


def test_numbers_keep_their_digits(texts):
    numbers = ["1e-12", "1.23456789012345e-3", "-2.5e3", "1e20", "7.5e-7", "1.50", "0", "12345678901234567890", "1e300", "1e999999999", "0.0"]
    found = [r["a"] for r in texts({"a": R.json_text("a")}, [f'{{"a":{{"text":{n}}}}}' for n in numbers])]
    assert found[:8] == ["0.000000000001", "0.00123456789012345", "-2500", "100000000000000000000", "0.00000075", "1.5", "0", "12345678901234567890"]
    assert float(found[8]) == 1e300 and found[9:] == ["1e999999999", "0"]


def test_what_is_no_record(texts):
    deep = "[" * 200_000 + "]" * 200_000
    bodies = ["", " ", "[1]", "3", '"x"', "null", "{", '{"a":NaN}', '{"a":1}x', deep, '{"a":"' + "\\ud800" + '"}', '{"a":"\\ud83d\\ude00"}', ' {"a":"ok"} ']
    found = texts({"a": R.json_text("a", default="-")}, bodies)
    assert [r[R.BAD_RECORD] for r in found] == [True] * 10 + [False] * 3
    assert [r["a"] for r in found] == ["-"] * 10 + ["�", "😀", "ok"]


@pytest.mark.parametrize("allowed", ["true", "false"])
def test_repeated_keys_keep_the_last_under_every_setting(spark, texts, allowed):
    before = spark.conf.get("spark.sql.variant.allowDuplicateKeys")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", allowed)
    try:
        found = texts({"a": R.json_text("a"), "b": R.json_text("b", "c")}, ['{"a":"1","b":{"c":"x"},"a":"2","b":{"c":"y","c":"z"}}'])[0]
        assert (found["a"], found["b"], found[R.BAD_RECORD]) == ("2", "z", False)
        payload = '[{"p":1,"p":2},[{"date":"2020","date":"2021","value":1,"value":2}]]'
        df = spark.createDataFrame([(payload,)], "x string")
        assert [tuple(r) for r in R.indicator_rows(df, "x", (2000, 2030)).collect()] == [(0, 2021, 2.0)]
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", before)


def test_indicator_rows(spark):
    payloads = {
        '[{"p":1},[{"date":"2021","value":1.5},{"date":2020,"value":null},{"date":"2019","value":"12,3"},{"date":"1950","value":1}]]': [
            (0, 2021, 1.5), (1, 2020, None), (2, 2019, 123.0),
        ],
        '[{},[{"date":"2021","value":1},{"date":" 2021 ","value":2e3},{"date":"2020","value":"n/a"}]]': [(1, 2021, 2000.0), (2, 2020, None)],
        '[{},[{"date":"2021","value":1},{"date":"2020Q1","value":2}]]': None,
        '[{},[{"value":1}]]': None,
        '[{},[null]]': None,
        '[{"p":1}]': None,
        '[{"p":1},null]': None,
        "junk": None,
        "[{},[]]": [],
        "": None,
    }
    df = spark.createDataFrame([(i, p or None) for i, p in enumerate(payloads)], "i int, x string")
    points = R.payload_points(df, "x", (1960, 2030)).collect()
    assert sorted(r["i"] for r in points if r["pos"] < 0) == list(range(len(payloads)))
    assert {r["i"] for r in points if r[R.BAD_RECORD]} == {i for i, v in enumerate(payloads.values()) if v is None}
    for i, wanted in enumerate(payloads.values()):
        assert [(r["pos"], r["year"], r["value"]) for r in points if r["i"] == i and r["pos"] >= 0] == (wanted or [])
    assert R.indicator_rows(df, "x", (1960, 2030)).columns == ["i", "pos", "year", "value"]


def test_one_parse_for_all_fields(spark, plan):
    df = spark.createDataFrame([("{}",)], "x string")
    text = plan(R.json_fields(df, "x", {f"f{i}": R.json_text("a", str(i)) for i in range(15)}))
    assert text.count("MapInArrow") == 1 and "parse_json" not in text and "get_json_object" not in text
