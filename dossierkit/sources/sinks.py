"""JSON and CSV output, and the shared folder for tables in between."""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierkit.functions.sqltext import col
from dossierkit.operators.counts import Counts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIST_SEPARATOR = "; "
LATIN_1 = "ISO-8859-1"


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON Lines, UTF-8, with nulls written out."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


# Bytes of a CSV file are bounded by its rows: a file with line breaks in fields is read by one task.
CSV_FILE_ROWS = 200_000
_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(df: DataFrame, path: str, columns: Sequence[str], mode: str = "errorifexists") -> None:
    """CSV with header in the given column order; null is empty, lists are joined, blanks stay."""

    def flat(name: str):
        c = col(name)
        is_list = df.schema[name].dataType.typeName() == "array"
        return F.array_join(c, LIST_SEPARATOR).alias(name) if is_list else c

    out = df.select(*[flat(c) for c in columns]).write.mode(mode).option("maxRecordsPerFile", CSV_FILE_ROWS)
    out.options(**_CSV, nullValue="", emptyValue="").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What ``write_csv`` wrote."""
    return spark.read.schema(schema).options(**_CSV, multiLine=True).csv(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that ``spark.checkpoint.dir`` names.

    A session that names none has it below its warehouse, which executors share as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def machine_folder(spark: SparkSession, folder: str) -> str | None:
    """A folder's path, if it is one of the file system (``file:``) and not of another store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    scheme = path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
    return path.toUri().getPath() if scheme == "file" else None


# How Spark names the partition of a missing value, and what it escapes in names.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = frozenset([*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"])


def partition_folder(name: str, value: str | None) -> str:
    """``name=value`` as Spark writes it; what is not ASCII is escaped too, as locales may differ."""
    plain = "".join("".join(f"%{b:02X}" for b in c.encode()) if c in _ESCAPED or c > "\x7f" else c for c in value or NO_VALUE)
    return f"{name}={plain}"


def _writing(root: str, by: Sequence[str], content: str):
    """Writes one file for all following rows with the same ``by``; gives the number of files."""

    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            yield from zip(zip(*(batch.column(c).to_pylist() for c in by)), batch.column(content).to_pylist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task that runs again puts its files in place of those that it left.
        name, made = f"part-{TaskContext.get().partitionId():05d}", 0
        for values, group in groupby(rows(batches), key=lambda row: row[0]):
            folder = os.path.join(root, *map(partition_folder, by, values))
            os.makedirs(folder, exist_ok=True)
            part = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
            with open(part, "wb") as file:
                for _, line in group:
                    file.write(f"{line or ''}\n".encode(LATIN_1, "replace"))
            os.replace(part, os.path.join(folder, name))
            made += 1
        yield pa.RecordBatch.from_pydict({"files": [made]})

    return run


def write_files(df: DataFrame, folder: str, by: Sequence[str], content: str) -> None:
    """A file for each ``by`` that a task has, below ``folder/<name>=<value>/...``, with a line for each ``content``.

    Contents are Latin-1, without quotes and separators of CSV.
    Spark makes files of the file system at the cost of a process for every file and folder
    (``chmod``), which is longer than all else where there are many: there they are written by
    Python. Other stores are left to Spark.
    """
    values = [F.nullif(col(c).cast("string"), F.lit("")).alias(c) for c in by]  # both are no value
    df = df.select(*values, content).sortWithinPartitions(*by)
    root = machine_folder(df.sparkSession, folder)
    if root is None:
        df.write.partitionBy(*by).option("encoding", LATIN_1).csv(folder)
        return
    os.makedirs(root)
    df.mapInArrow(_writing(root, by, content), "files bigint").write.format("noop").mode("overwrite").save()


# Name of what an export writes last.
MARKER = "complete"


@dataclass(frozen=True)
class Export:
    """A complete export: where its formats are, and what was counted while it was made."""

    folder: str
    version: str
    formats: tuple[str, ...]
    counts: dict[str, tuple[int, int]] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.folder}/{self.version}/{name}"


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """Rows worked out once: written as Parquet to the shared folder and read again."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export(
    df: DataFrame, folder: str, writers: Mapping[str, Callable[[DataFrame, str], None]], counts: Counts | None = None
) -> Export:
    """Rows in several formats below ``folder/<version>``, out of one evaluation.

    The rows are staged first, so all formats hold the same. A marker with the counts is written
    when all formats are there: ``complete_exports`` shows only those, so a reader never sees half
    an export, and an export that failed or was killed leaves the one before in force. Versions
    sort by the time they began.
    """
    spark = df.sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    rows = staged(df)
    for name, write in writers.items():
        write(rows, f"{folder}/{version}/{name}")
    done = Export(folder, version, tuple(writers), counts.read() if counts else {})
    said = json.dumps({"version": version, "formats": done.formats, "counts": done.counts})
    spark.createDataFrame([(said,)], "value string").coalesce(1).write.text(f"{folder}/{version}/{MARKER}")
    return done


def complete_exports(spark: SparkSession, folder: str) -> list[Export]:
    """The complete exports of a folder, the last one last."""
    try:
        lines = spark.read.text(f"{folder}/*/{MARKER}").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    found = [json.loads(r["value"]) for r in lines]
    made = [Export(folder, f["version"], tuple(f["formats"]), {k: tuple(v) for k, v in f["counts"].items()}) for f in found]
    return sorted(made, key=lambda e: e.version)
