"""What the operators share: cutting lineage, and plain SQL text of literals."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Separators of words: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, name: str = "") -> str:
    """The folder that ``spark.checkpoint.dir`` names, or a folder in it.

    Only a session that names none gets one below its warehouse, which is shared as well.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
    return f"{folder.rstrip('/')}/{name}" if name else folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Rows written as Parquet to the shared folder and read again, with their lineage cut.

    A table and not ``checkpoint()``: that keeps what the planner knows of a plan, which grows with
    every round of a loop until planning takes longer than the work. Tables of an application are
    below ``tables-<application id>`` and can go when it has ended.
    """
    spark = df.sparkSession
    path = shared_folder(spark, f"tables-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(text: str) -> str:
    """A string literal of Spark SQL."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def string_array(values: Sequence[str]) -> str:
    """An array literal; typed also if it is empty."""
    return f"cast(array({', '.join(quoted(v) for v in values)}) as array<string>)"


def without(df: DataFrame, *names: str) -> DataFrame:
    """The columns that do not clash with a result's names, in any letter case."""
    taken = {n.lower() for n in names}
    return df.select(*[f"`{c.replace('`', '``')}`" for c in df.columns if c.lower() not in taken])


def sampled(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows, or all if there are fewer: those whose key has a small hash.

    The same keys are taken at every run; nothing is sorted or sent to one task.
    """
    total = df.count()
    if total <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(1 << 40)) < int(rows / total * (1 << 40)))
