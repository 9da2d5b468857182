"""What earlier landings settled: tables of one row per key that later landings are merged into.

A state is written as a whole, in versions: a marker behind each says that it is complete
(``sinks.export``), so a run that was killed leaves the one before in force. Rows of a state lie in
buckets of the key, so a merge shuffles the new rows only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierkit.functions.sqltext import col, cols
from dossierkit.functions.sqltext import name as quoted
from dossierkit.operators.resolve import first_available
from dossierkit.sources.sinks import complete_exports, export

# Name of a version's files; their number of buckets follows.
_ROWS = "rows-"


@dataclass(frozen=True)
class State:
    """A folder of versions, each one row per key in buckets.

    ``buckets`` is the session's number of shuffle partitions if it is not given: a merge whose new
    rows are dealt over as many partitions shuffles them once and the state not at all.
    """

    spark: SparkSession
    folder: str
    keys: tuple[str, ...]
    buckets: int | None = None

    def read(self) -> DataFrame | None:
        """The last complete version; None before the first."""
        done = complete_exports(self.spark, self.folder)
        if not done:
            return None
        rows = done[-1].formats[0]
        path, buckets = done[-1].path(rows), int(rows.removeprefix(_ROWS))
        schema = self.spark.read.parquet(path).schema
        fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
        keys = ", ".join(cols(self.keys))
        table = f"state_{uuid.uuid4().hex}"
        # A name in the session's catalog, which is where buckets are known; the files stay as they are.
        self.spark.sql(f"CREATE TABLE {table} ({fields}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(table)

    def write(self, df: DataFrame) -> DataFrame:
        """A new version; it is in force once all of it is there."""

        buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

        def bucketed(rows: DataFrame, path: str) -> None:
            one, *others = self.keys
            dealt = rows.repartition(buckets, *cols(self.keys))
            table = f"written_{uuid.uuid4().hex}"
            writer = dealt.write.format("parquet").option("path", path).bucketBy(buckets, one, *others).sortBy(one, *others)
            writer.saveAsTable(table)
            self.spark.sql(f"DROP TABLE {table}")  # the files of a table with a path stay

        export(df, self.folder, {f"{_ROWS}{buckets}": bucketed})
        return self.read()


def settle(state: State, log: DataFrame, priority: Sequence[str], ok: Column) -> DataFrame:
    """First available candidates of a landing, for keys that no landing before had settled; the new state.

    Keys that are settled are left out before the rows of the landing are sorted out, so of those
    only the keys are read. The state holds the settled keys with what they brought. Several
    landings give what one run over all of them gives when a landing comes before the next.
    """
    keys = list(state.keys)
    before = state.read()
    if before is not None:
        log = log.join(before.select(*cols(keys)), keys, "left_anti")
    found = first_available(log, keys, priority, ok)
    # A miss has nothing of what it brought, not even its place.
    found = found.filter(col(priority[0]).isNotNull())
    return state.write(found if before is None else before.unionByName(found))


def cell_states(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str], cells: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Per key and cell the last value as ``struct(order, value)``; null where no row has the cell.

    ``cells`` are (whether a row has the cell, its value). A null value counts, a null order does not.
    """
    order = F.struct(*cols(ordinal))
    known = F.lit(True)
    for o in ordinal:
        known = known & col(o).isNotNull()
    states = [
        F.max_by(F.when(has & known, F.struct(order.alias("order"), value.alias("value"))), F.when(has & known, order)).alias(name)
        for name, (has, value) in cells.items()
    ]
    return df.groupBy(*cols(keys)).agg(*states)


def merge_cells(state: State, new: DataFrame) -> DataFrame:
    """The new state after ``cell_states`` of a later landing; of equal orders the earlier landing's stays.

    The state's side is read by bucket: only the new rows are shuffled.
    """
    before = state.read()
    if before is None:
        return state.write(new)
    return state.write(merged_cells(before, new, state.keys))


def merged_cells(before: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two tables of states to one; keys that are null do not merge."""
    cells = [c for c in before.columns if c not in keys]
    old, late = before.alias("old"), new.alias("new")
    same = [F.col(f"old.{quoted(k)}") == F.col(f"new.{quoted(k)}") for k in keys]
    both = old.join(late, same, "full")

    def newer(c: str) -> Column:
        o, n = F.col(f"old.{quoted(c)}"), F.col(f"new.{quoted(c)}")
        takes = o.isNull() | (n.isNotNull() & (n["order"] > o["order"]))
        return F.when(takes, n).otherwise(o).alias(c)

    names = [F.coalesce(F.col(f"old.{quoted(k)}"), F.col(f"new.{quoted(k)}")).alias(k) for k in keys]
    return both.select(*names, *[newer(c) for c in cells])


def cell_values(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The values of a table of states."""
    return state.select(*cols(keys), *[col(c)["value"].alias(c) for c in state.columns if c not in keys])
