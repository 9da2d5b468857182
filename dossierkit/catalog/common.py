"""Expressions that read the same in both engines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from dossierkit.functions.text import year_window

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# The order dates run from 1995 to 2001.
AS_OF = dt.date(2002, 6, 30)
WINDOW = year_window(AS_OF)
YEARS = range(WINDOW[0], WINDOW[1] + 1)

# Rows of a part, where the work per row is heavy.
HEAVY_ROWS = 50_000


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows over all cores when the scan has fewer partitions than there are cores.

    For the driver tables, each of which is one file; a landed table has more partitions than that.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str, heavy_by: str | None = None) -> DataFrame:
    """A driver table; ``heavy_by`` is its key where the work per row is heavy.

    Such rows come in parts of about ``HEAVY_ROWS``: a file of small rows is one part of a scan, and what
    a task makes of it would grow with the table.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if not heavy_by:
        return df
    parts = -(-df.count() // HEAVY_ROWS)
    return df.repartition(parts, heavy_by) if parts > max(df.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism) else spread(df, heavy_by)


def text(c: str) -> str:
    return f"cast({c} as string)"


# White space as DuckDB's regex engine writes it.
WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def squeeze(c: str) -> str:
    """White space to one space, in DuckDB."""
    return f"trim(regexp_replace({c}, '{WS}+', ' ', 'g'))"


def cents(c: str) -> str:
    """Amount in cents, as an integer: sums of it do not depend on their order."""
    return f"cast(round({c} * 100) as bigint)"


def whole(c: str) -> str:
    """Integer part of a non-negative amount in cents."""
    return f"cast(floor(({c}) / 100) as bigint)"


def money(c: str) -> str:
    """A non-negative amount in cents as text with two digits behind the point."""
    return f"({text(whole(c))} || '.' || lpad({text(f'({c}) % 100')}, 2, '0'))"


def grouped(c: str) -> str:
    """A non-negative integer as text with commas, below a billion."""
    low = f"lpad({text(f'({c}) % 1000')}, 3, '0')"
    thousands = f"cast(floor(({c}) / 1000) as bigint)"
    mid = f"lpad({text(f'({thousands}) % 1000')}, 3, '0')"
    millions = f"cast(floor(({c}) / 1000000) as bigint)"
    return (
        f"(case when ({c}) < 1000 then {text(c)} when ({c}) < 1000000 then {text(thousands)} || ',' || {low} "
        f"else {text(millions)} || ',' || {mid} || ',' || {low} end)"
    )
