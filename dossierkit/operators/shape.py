"""Pivots, outer merges, column policies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType

from dossierkit.functions.sqltext import col, cols, quote
from dossierkit.functions.sqltext import name as quoted
from dossierkit.functions.text import clean_numeric


def indicator_pivot(
    df: DataFrame,
    keys: Sequence[str],
    indicators: Sequence[str],
    years: Sequence[int],
    *,
    indicator: str = "indicator",
    year: str = "year",
    value: str = "value",
    ordinal: str | None = None,
) -> DataFrame:
    """Long indicator rows to columns ``"<indicator> <year>"``; cells that never occur are null.

    Other indicators and years do not count, so a key that only has those gives no row.

    One conditional aggregate, so one exchange. With ``ordinal`` the last value of a cell wins;
    without, a cell must have one value. Rows are numbered by cell first, so that an aggregate
    compares an integer.
    """
    cells = [(title, y) for title in indicators for y in years]
    first, last = min(years), max(years)
    place = f"array_position(array({', '.join(map(quote, indicators))}), {quoted(indicator)})"
    number = f"CAST(({place} - 1) * {last - first + 1} + {quoted(year)} - {first} AS int)"
    inside = df.filter(F.expr(f"{place} > 0 AND {quoted(year)} BETWEEN {first} AND {last}"))
    numbered = inside.select(*cols(keys), F.expr(number).alias("_cell"), *cols([value, *([ordinal] if ordinal else [])]))

    def cell(title: str, y: int) -> Column:
        here = f"_cell = {list(indicators).index(title) * (last - first + 1) + y - first}"
        if ordinal:
            found = f"max_by({quoted(value)}, CASE WHEN {here} THEN {quoted(ordinal)} END)"
        else:
            found = f"max({quoted(value)}) FILTER (WHERE {here})"
        return F.expr(found).alias(f"{title} {y}")

    return numbered.groupBy(*cols(keys)).agg(*[cell(title, y) for title, y in cells])


def year_sums(
    df: DataFrame, key: str, date: str, value: str, name: str, years: Sequence[int]
) -> DataFrame:
    """Sum of a value per key and year as columns ``"<name> <year>"``; years without rows are null."""
    flat = df.select(col(key), F.expr(f"year({date})").alias("_year"), F.expr(value).alias("_value"))
    sums = [F.expr(f"sum(_value) FILTER (WHERE _year = {y})").alias(f"{name} {y}") for y in years]
    return flat.groupBy(col(key)).agg(*sums)


def outer_merge(
    df: DataFrame, key: str, metrics: Sequence[str], *, metric: str = "metric", value: str = "value"
) -> DataFrame:
    """Full outer merge of many two-column tables in long form, one column per metric.

    One conditional aggregate in place of a chain of full outer joins: one exchange for any number
    of tables. A key with only null values keeps its row. Key and metric must be unique, as they
    are after ``last_wins``; with one buffer per metric the aggregate stays in generated code.
    """

    def cell(m: str) -> Column:
        return F.expr(f"max({quoted(value)}) FILTER (WHERE {quoted(metric)} = {quote(m)})").alias(m)

    return df.groupBy(col(key)).agg(*[cell(m) for m in metrics])


def outer_join_pair(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join of two tables on one key."""
    return left.join(right, key, "full")


# A decimal number, with or without an exponent, and blanks around it.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_numeric(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """All columns but ``keep`` as DOUBLE; what is not a decimal number becomes null."""

    def number(c: str, kind: DataType) -> str:
        if isinstance(kind, NumericType):
            return f"CAST({c} AS double) AS {c}"
        return f"CASE WHEN regexp_like({c}, {quote(_NUMBER)}) THEN try_cast(trim({c}) AS double) END AS {c}"

    return df.selectExpr(
        *[quoted(f.name) if f.name in keep else number(quoted(f.name), f.dataType) for f in df.schema.fields]
    )


def clean_columns(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """First number of every column but ``keep``; numbers pass through as DOUBLE."""

    def clean(c: str, kind: DataType) -> str:
        number = f"CAST({c} AS double)" if isinstance(kind, NumericType) else clean_numeric(c)
        return f"{number} AS {c}"

    return df.selectExpr(
        *[quoted(f.name) if f.name in keep else clean(quoted(f.name), f.dataType) for f in df.schema.fields]
    )


def reconcile(df: DataFrame, declared: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """Columns in declared order as far as present, then the others sorted."""
    present = set(df.columns) - set(drop)
    order = [c for c in declared if c in present]
    return df.select(*cols(order + sorted(present - set(declared))))


def has_name(df: DataFrame, name: str) -> DataFrame:
    """Records that have a name."""
    return df.filter(col(name) != "")


def order_by_key(df: DataFrame, key: str) -> DataFrame:
    """Sorted by key in code-point order."""
    return df.orderBy(col(key))
