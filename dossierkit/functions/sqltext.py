"""Writing Spark SQL expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F

_numbers = count()


def quote(value: str) -> str:
    """String literal."""
    out = value.replace("\\", "\\\\").replace("'", "\\'")
    return "'" + "".join(c if c.isprintable() or c == " " else f"\\u{ord(c):04x}" for c in out) + "'"


def name(column: str) -> str:
    """Column reference by exact name, which may hold dots and brackets."""
    return "`" + column.replace("`", "``") + "`"


def _variable() -> str:
    return f"v{next(_numbers)}"


def let(value: str, body: Callable[[str], str]) -> str:
    """Evaluate ``value`` once and use it any number of times in ``body``."""
    return at(transform(f"array({value})", body), 0)


def transform(items: str, body: Callable[[str], str]) -> str:
    x = _variable()
    return f"transform({items}, {x} -> {body(x)})"


def transform_at(items: str, body: Callable[[str, str], str]) -> str:
    x, i = _variable(), _variable()
    return f"transform({items}, ({x}, {i}) -> {body(x, i)})"


def keep(items: str, test: Callable[[str], str]) -> str:
    x = _variable()
    return f"filter({items}, {x} -> {test(x)})"


def at(items: str, i: int) -> str:
    """Element by position from 0; null when there is none."""
    return f"get({items}, {i})"


# Stands between pieces while a text is split; pages are free of it after noise is dropped.
_CUT = "\\u0000"


def split_on(text: str, pattern: str) -> str:
    """Text split at a regex.

    ``split`` compiles a regex anew for every row, ``regexp_replace`` only once; a single character
    needs no regex at all.
    """
    return f"split(regexp_replace({text}, {quote(pattern)}, '{_CUT}'), '{_CUT}')"


def matches(text: str, pattern: str) -> str:
    return f"regexp_like({text}, {quote(pattern)})"


def literal_map(values: Mapping[str, str]) -> str:
    """A short fixed list as a map."""
    return "map(" + ", ".join(quote(x) for pair in values.items() for x in pair) + ")"


def col(column: str) -> Column:
    """Column by exact name."""
    return F.col(name(column))


def cols(columns: Iterable[str]) -> list[str]:
    """References by exact name, for ``select``, ``groupBy`` and functions."""
    return [name(c) for c in columns]
