"""Landed tables, article files and image catalogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OK = 200

# Fields of an article record.
ARTICLE_SCHEMA = (
    "`Section` string, `Title` string, `Link` string, `Author(s)` array<string>, `Date Posted` string, "
    "`Date Updated` string, `Updates` string, `Full Article` string"
)


def fetched(status: Column) -> Column:
    """A fetch that brought content."""
    return status == OK


def fetched_pages(pages: DataFrame) -> DataFrame:
    """Pages that were fetched."""
    return pages.filter(fetched(F.col("status")))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages that were fetched."""
    return fetched_pages(spark.read.parquet(path))


BAD_RECORD = "_bad_record"


def read_articles(spark: SparkSession, path: str, one_array: bool = False) -> DataFrame:
    """Article records; missing fields become '' or an empty list, records that are no JSON are left out.

    ``one_array`` is for a file that is a single JSON array, which one task must read; JSON Lines
    (the default) splits. ``landed_articles`` keeps the bad records.
    """
    raw = landed_articles(spark, path, one_array)
    return raw.filter(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)


def landed_articles(spark: SparkSession, path: str, one_array: bool = False) -> DataFrame:
    """The same with all records, and the text of a bad one in ``_bad_record``."""
    schema = f"{ARTICLE_SCHEMA}, {BAD_RECORD} string"
    raw = spark.read.schema(schema).options(multiLine=one_array, columnNameOfCorruptRecord=BAD_RECORD).json(path)
    empty = F.array().cast("array<string>")

    def filled(c: str):
        return F.col(c) if c == BAD_RECORD else F.coalesce(f"`{c}`", empty if c == "Author(s)" else F.lit("")).alias(c)

    return raw.select(*[filled(c) for c in raw.columns])


# The bytes that image files begin with, and the extensions that go with them.
SIGNATURES = {"gif": ("474946383761", "474946383961"), "png": ("89504E470D0A1A0A",), "jpg": ("FFD8FF",)}
EXTENSIONS = {"jpeg": "jpg"}

# Where entity, type and extension stand in a path: the layout of downloaded maps, or of tables by partition.
BY_NAME = r"([^/]+)/[^/]+_([a-z]+)_map\.([a-z]+)$"
BY_PARTITION = r"entity=([^/]+)/type=([^/]+)/extension=([^/]+)/[^/]+$"


def asset_catalog(spark: SparkSession, path: str, shape: str = BY_NAME) -> DataFrame:
    """Image files below a folder: ``entity, type, extension, size, path``, without their content.

    ``shape`` finds the first three in a path, such as ``<entity>/<entity>_<type>_map.<extension>``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return _assets(files, shape).select("entity", "type", "extension", F.col("length").alias("size"), "path")


def _assets(files: DataFrame, shape: str) -> DataFrame:
    parts = {n: F.regexp_extract("path", shape, i) for i, n in enumerate(("entity", "type", "extension"), 1)}
    # Names may be escaped in paths; one that is no escape stays as it is.
    parts["entity"] = F.coalesce(F.try_url_decode(F.replace(parts["entity"], F.lit("+"), F.lit("%2B"))), parts["entity"])
    return files.withColumns(parts).filter(F.col("type") != "")


def image_kind(content: Column) -> Column:
    """What a file is by its first bytes; null when it is none of ``SIGNATURES``."""
    head = F.hex(F.substring(content, 1, 8))
    kind = F.lit(None).cast("string")
    for name, marks in SIGNATURES.items():
        for mark in marks:
            kind = F.when(head.startswith(mark), F.lit(name)).otherwise(kind)
    return kind


def checked_assets(spark: SparkSession, path: str, shape: str = BY_NAME) -> DataFrame:
    """The catalog with ``kind``, what the content is, and ``as_named``, whether the extension says so.

    Files are read whole for it; a broken file has no kind and is not as named. Empty files are not
    listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    found = _assets(files, shape).withColumn("kind", image_kind(F.col("content")))
    named = F.lower("extension")
    for other, name in EXTENSIONS.items():
        named = F.when(named == other, F.lit(name)).otherwise(named)
    as_named = F.coalesce(F.col("kind") == named, F.lit(False)).alias("as_named")
    return found.select("entity", "type", "extension", F.col("length").alias("size"), "kind", as_named, "path")
