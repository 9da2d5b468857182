"""The corpus pipeline: every stage takes documents and hands on what it decides to keep.

``STAGES`` are applied in order, each to the Parquet files that the one before left. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierkit.llm import contamination, minhash, mixing, sharding, toxicity
from dossierkit.llm.queries import SHARDS, TOXIC, domain_labels, training_labels
from dossierkit.llm.shared import checkpointed, shared_folder

# Target shares of the tokens of each domain that the first stage leaves.
TARGETS = {"good": 0.9, "poor": 0.1}


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of ``TOXIC`` or more go; documents without text stay."""
    model = toxicity.fit(docs, training_labels(spark, sf_dir), "doc_id", "text", "toxic")
    return docs.filter(toxicity.score(model, F.col("text")) < TOXIC)


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have, in any letter case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates (shingles of five words, similarity 0.8) the one with the smallest id stays.

    Rows count, not ids: rows that repeat an id are compared like any others, and of rows alike in
    all one stays. Null ids come last. A document without words is alone, so it stays.
    """
    row, group = _unused(docs, "_row"), _unused(docs, "_group")
    # Numbered in a table that is written, so that every reading has the same numbers.
    rows = checkpointed(docs.withColumn(row, F.monotonically_increasing_id()))
    found = minhash.near_duplicates(rows, row, "text").select(row, F.col("component_id").alias(group))
    members = rows.select(row, "doc_id").join(found, row)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", F.col(row).alias("first")))["first"]
    # Every row has a group, so the first rows are all that stays; the join is by row, never by group.
    stays = members.groupBy(group).agg(first.alias(row)).select(row)
    return rows.join(stays, row, "left_semi").select(*[f"`{c}`" for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with up to 20 % of its words changed, go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination.without_items(docs, "text", items, "item_id", "text")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says, so that the domains reach ``TARGETS``."""
    labels, columns = domain_labels(spark, sf_dir), docs.columns
    # Other columns go by under names of their own: results are called like some of them may be.
    others = {c: f"_{i}_of_documents" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    docs = docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(n) for c, n in others.items()])
    model = mixing.fit_classifier(docs, "doc_id", "text", labels, "domain", list(TARGETS))
    mixed = mixing.mixed(docs, "doc_id", "text", model, list(TARGETS.values()))
    # A filter on the copies would be pushed down and work out everything twice and more.
    each = mixed.withColumn("_copy", F.explode_outer(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return each.filter("_copy IS NOT NULL").select(*[F.col(others.get(c, c)).alias(c) for c in columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their slot in it."""
    return sharding.assign_shards(docs, "doc_id", [1.0] * SHARDS)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

# A fitted classifier, connected components and edit distances are beyond SQL; tests hold each
# stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, with Parquet files in the shared folder between them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
