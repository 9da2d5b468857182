import json
import re

import pytest
from pyspark.sql import functions as F

from dossierkit.catalog import common, resolution
from dossierkit.operators.counts import Counts
from dossierkit.plans.articles import CSV_COLUMNS
from dossierkit.sources import dims, landed, sinks

RECORD = {
    "Section": "Air",
    "Title": 'A "quoted", title',
    "Link": "/a",
    "Author(s)": ["X", "Y"],
    "Date Posted": "Jan 22, 2025",
    "Date Updated": None,
    "Updates": "line\nbreak; and, more",
    "Full Article": "téxt \\ back",
}


def test_read_pages_takes_status_200_only(spark, tmp_path):
    rows = [(1, 200, "a"), (2, 404, "b"), (3, None, "c")]
    spark.createDataFrame(rows, "page_id int, status int, html string").write.parquet(str(tmp_path / "p"))
    assert [r.page_id for r in landed.read_pages(spark, str(tmp_path / "p")).collect()] == [1]


def test_articles_from_one_array_and_from_lines(spark, tmp_path):
    (tmp_path / "array.json").write_text(json.dumps([RECORD, {"Title": "only"}], indent=2, ensure_ascii=False), "utf-8")
    both = sorted(landed.read_articles(spark, str(tmp_path / "array.json"), one_array=True).collect(), key=lambda r: r.Title)
    assert both[0].asDict() == {**RECORD, "Date Updated": ""}
    assert both[1]["Author(s)"] == [] and both[1]["Full Article"] == "" and both[1].Title == "only"
    df = spark.createDataFrame([tuple(RECORD.values())], landed.ARTICLE_SCHEMA)
    sinks.write_json(df.coalesce(1), str(tmp_path / "lines"))
    line = next((tmp_path / "lines").glob("*.json")).read_text("utf-8")
    assert json.loads(line) == RECORD and "téxt" in line
    assert landed.read_articles(spark, str(tmp_path / "lines")).first() == both[0]


def test_csv(spark, tmp_path):
    df = spark.createDataFrame([tuple(RECORD.values())], landed.ARTICLE_SCHEMA)
    sinks.write_csv(df.coalesce(1), str(tmp_path / "csv"), CSV_COLUMNS)
    assert next((tmp_path / "csv").glob("*.csv")).read_text("utf-8").splitlines()[0] == ",".join(CSV_COLUMNS)
    back = sinks.read_csv(spark, str(tmp_path / "csv"), ", ".join(f"`{c}` string" for c in CSV_COLUMNS)).first()
    assert back.asDict() == {**RECORD, "Author(s)": "X; Y"}


def test_csv_keeps_blanks(spark, tmp_path):
    texts = ["  lead", "trail  ", "\tx", " both "]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    sinks.write_csv(df.coalesce(1), str(tmp_path / "csv"), ["x"])
    assert [r.x for r in sinks.read_csv(spark, str(tmp_path / "csv"), "x string").collect()] == texts


def test_bad_records_are_told_apart(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"Title":"a"}\n{"Title":\n{"Title":"b"}\nnot json\n', "utf-8")
    path = str(tmp_path / "lines.json")
    assert sorted(r.Title for r in landed.read_articles(spark, path).collect()) == ["a", "b"]
    bad = landed.landed_articles(spark, path).filter("_bad_record IS NOT NULL")
    assert sorted(r._bad_record for r in bad.collect()) == ["not json", '{"Title":']


def test_asset_catalog(spark, tmp_path):
    folder = tmp_path / "country_maps" / "Antigua and Barbuda"
    folder.mkdir(parents=True)
    (folder / "Antigua and Barbuda_physical_map.gif").write_bytes(b"123")
    (folder / "notes.txt").write_text("x")
    found = landed.asset_catalog(spark, str(tmp_path / "country_maps")).drop("path").collect()
    assert [tuple(r) for r in found] == [("Antigua and Barbuda", "physical", "gif", 3)]


def test_assets_are_what_their_names_say(spark, tmp_path):
    contents = {
        "a_physical_map.gif": b"GIF89a..", "b_physical_map.gif": b"\x89PNG\r\n\x1a\nxx", "c_political_map.png": b"\x89PNG\r\n\x1a\nxx", "d_political_map.png": b"",
        "e_political_map.jpeg": b"\xff\xd8\xff\xe0", "f_political_map.gif": b"<html>", "g_political_map.gif": b"GIF",
    }
    for name, content in contents.items():
        folder = tmp_path / "maps" / f"{name[0]} é+%"
        folder.mkdir(parents=True)
        (folder / name).write_bytes(content)
    found = {r.entity[0]: r for r in landed.checked_assets(spark, str(tmp_path / "maps")).collect()}
    assert {k: (r.kind, r.as_named) for k, r in found.items()} == {
        "a": ("gif", True), "b": ("png", False), "c": ("png", True), "e": ("jpg", True), "f": (None, False), "g": (None, False),
    }
    assert found["a"].entity == "a é+%" and found["a"].size == 8
    # a mislabelled file is not the first available one
    ok = [(k, r.extension) for k, r in found.items() if r.as_named]
    assert sorted(ok) == [("a", "gif"), ("c", "png"), ("e", "jpeg")]


def test_shared_folder_is_below_the_checkpoint_folder(spark):
    one, two = sinks.shared_folder(spark, "t"), sinks.shared_folder(spark, "t")
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints"
    assert one != two and one.startswith(f"{base}/t-")


def test_dims(spark, evaluate, tmp_path):
    assert len(dims.METRIC_NAMES) == len(set(dims.METRIC_NAMES)) == 50
    assert [len(m) for m in dims.METRICS.values()] == [7, 9, 5, 10, 4, 6, 9]
    assert dims.metric_dim(spark).count() == 50
    assert evaluate(dims.metric_of("x"), ["https://h/navy-ships.php", "/x"]) == ["naval_fleet_strength", None]
    assert evaluate(dims.map_name("x"), ["New Zealand", "Timor-Leste", "Holy See"]) == ["new-zealand", "east-timor", "vatican-city"]
    (tmp_path / "c.csv").write_text("Country,Alpha-2,Alpha-3,Numeric Code\nAfghanistan,AF,AFG,004\n")
    assert dims.country_dim(spark, str(tmp_path / "c.csv")).first()["Numeric Code"] == "004"


def test_spread(spark):
    assert common.spread(spark.range(10).coalesce(1), "id").rdd.getNumPartitions() == 8
    assert common.spread(spark.range(10, numPartitions=20), "id").rdd.getNumPartitions() == 20


def test_an_export_is_worked_out_once_and_shown_when_it_is_complete(spark, tmp_path):
    folder = str(tmp_path / "exports")
    assert sinks.complete_exports(spark, folder) == []
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    def frame(n):
        return spark.range(n).mapInArrow(count, "id bigint")

    writers = {"csv": lambda df, path: sinks.write_csv(df, path, ["id"]), "json": sinks.write_json}
    counts = Counts()
    first = sinks.export(counts.watched(frame(7), "rows", bad=F.col("id") > 4), folder, writers, counts)
    assert passed.value == 7
    assert sinks.complete_exports(spark, folder) == [first] and first.counts == {"rows": (7, 2)}

    def killed(df, path):
        df.limit(1).write.json(path)
        raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        sinks.export(frame(8), folder, {**writers, "last": killed})
    assert sinks.complete_exports(spark, folder) == [first]
    assert spark.read.json(first.path("json")).count() == 7
    second = sinks.export(frame(9), folder, writers)
    assert sinks.complete_exports(spark, folder) == [first, second]
    assert sinks.read_csv(spark, second.path("csv"), "id bigint").count() == 9


def test_asset_files_are_written_by_all_cores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(resolution, "shared_folder", lambda spark, name: str(tmp_path / name))
    assert resolution.asset_files(spark, "/root/testdata/sf0.01").count() == 200
    tasks = [re.match(r"part-(\d+)", f.name)[1] for f in (tmp_path / "assets").rglob("part-*")]
    assert len(tasks) == 200 and max(map(tasks.count, tasks)) < 100


def test_many_files_are_written_as_spark_writes_them_but_without_its_writer(spark, tmp_path, monkeypatch):
    names = ["a b", "a+b", "a/b=c%2F:x", None, "", "[x]{y}", "twice", "twice", "q'\"#?*^\\"]
    rows = [(i, n, k, "html" if i == 7 else "GIF89a" if k == "gif" else "\u00ff\u00d8\u00ff\u00e0") for i, n in enumerate(names) for k in ("gif", "jpg")]
    df = spark.createDataFrame(rows, "i int, entity string, extension string, content string").withColumn("type", F.lit("map"))
    by, columns = ["entity", "type", "extension"], ["entity", "extension", "kind", "as_named", "size"]

    def written(folder):
        sinks.write_files(df.repartition(1, "i"), str(tmp_path / folder), by, "content")
        return sorted(map(str, landed.checked_assets(spark, str(tmp_path / folder), landed.BY_PARTITION).select(columns).collect()))

    sinks.write_files(df.filter("i < 0"), str(tmp_path / "none"), by, "content")
    assert landed.checked_assets(spark, str(tmp_path / "none"), landed.BY_PARTITION).count() == 0
    own = written("own")
    assert len(own) == 14 and not list((tmp_path / "own").rglob(".*"))  # no names but one, and the same twice: one file each
    monkeypatch.setattr(sinks, "machine_folder", lambda spark, folder: None)
    assert own == written("spark") and list((tmp_path / "spark").rglob("*.crc"))
    assert sinks.partition_folder("n", "\u00e9 z") == "n=%C3%A9 z"


def test_files_of_another_store_are_left_to_spark(spark, tmp_path):
    assert sinks.machine_folder(spark, f"file://{tmp_path}/a b") == sinks.machine_folder(spark, f"{tmp_path}/a b") == f"{tmp_path}/a b"
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.shop.link./in", f"file://{tmp_path}")
    assert sinks.machine_folder(spark, "viewfs://shop/in/a") is None


def test_asset_files_do_not_go_through_spark_writer(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(resolution, "shared_folder", lambda spark, name: str(tmp_path / name))
    assert resolution.asset_files(spark, "/root/testdata/sf0.001").count() == 20
    assert len(list((tmp_path / "assets").rglob("part-*"))) == 20 and not list((tmp_path / "assets").rglob("*.crc"))


def test_heavy_rows_come_in_parts_of_a_size(spark, monkeypatch, plan):
    monkeypatch.setattr(common, "HEAVY_ROWS", 10, raising=False)
    rows = common.table(spark, "/root/testdata/sf0.001", "customer", "c_custkey")
    assert rows.rdd.getNumPartitions() == -(-rows.count() // 10)
    # a scan of small rows makes many large ones: they are dealt before, and no log goes to every task
    text = plan(resolution.map_files(spark, "/root/testdata/sf0.001"))
    assert "BroadcastHashJoin" not in text and text.count("REPARTITION_BY_NUM") == 2
