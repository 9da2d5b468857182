"""Row counts of sources."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: ``source`` and ``n``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("source"), "n") for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def observed(df: DataFrame, name: str, **checks) -> tuple[DataFrame, Observation]:
    """The same rows with a count (and counts of further conditions) taken on the way to a sink."""
    seen = Observation(name)
    bad = [F.count_if(test).alias(label) for label, test in checks.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("n"), *bad), seen


def _found(seen: Observation) -> tuple[int, int]:
    try:
        found = seen.get
    except Py4JJavaError:
        # The optimizer leaves out what it knows to be empty, and with it the counts.
        return 0, 0
    return int(found["n_rows"]), int(found["n_bad"])


class Counts:
    """Rows and bad rows of several sources, counted by the action that works the flow out."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watched(self, df: DataFrame, name: str, bad: Column, rows: Column | None = None) -> DataFrame:
        """The same rows; ``rows`` tells which of them count (all), ``bad`` which cannot be used."""
        which = F.lit(True) if rows is None else rows
        watched, self._seen[name] = observed(df, name, n_rows=which, n_bad=F.coalesce(bad, F.lit(True)))
        return watched

    def read(self) -> dict[str, tuple[int, int]]:
        """``n`` and ``n_bad`` by source; waits for the first action on the flow."""
        return {name: _found(seen) for name, seen in self._seen.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        """``source, n, n_bad``; one row per source."""
        return spark.createDataFrame([(s, *c) for s, c in self.read().items()], "source string, n bigint, n_bad bigint")
