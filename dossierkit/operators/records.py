"""Texts and numbers out of JSON records: every record is parsed once, for all its fields.

What a record gives does not depend on the session: of repeated keys the last one counts, numbers
keep the digits they were written with, and a record that is no JSON is told apart.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator, Mapping
from decimal import Decimal
from typing import NamedTuple

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierkit.functions.sqltext import cols, name
from dossierkit.functions.text import WHITESPACE, clean_numeric
from dossierkit.operators.arrow import records_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Column of ``json_fields`` that tells whether a text is no JSON object.
BAD_RECORD = "_bad_record"
# Numbers with a greater exponent are shown as they are written.
LONGEST_EXPONENT = 400

_YEAR = rf"[{re.escape(WHITESPACE)}]+([0-9]{{4}})"


class Number(str):
    """A JSON number as it is written."""

    __slots__ = ()


def _refuse(constant: str):
    raise ValueError(f"{constant} is not JSON")


def parsed(text: str):
    """(value, whether the text is JSON)."""
    try:
        return json.loads(text, parse_int=Number, parse_float=Number, parse_constant=_refuse), True
    except (ValueError, RecursionError):
        return None, False


def encodable(text: str) -> str:
    """The text with halves of surrogate pairs, which JSON can spell out, replaced."""
    return text if text.isascii() else text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def compact(value) -> str:
    """JSON text without spaces, keys in source order, numbers as they were written."""
    if isinstance(value, Number):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{compact(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(compact, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


def scalar_text(value) -> str | None:
    """Text of what an object has as its ``text``; a number is written without an exponent."""
    if value is None:
        return None
    if isinstance(value, Number):
        number = Decimal(value)
        if not any(c in value for c in ".eE") or abs(number.adjusted()) > LONGEST_EXPONENT:
            return str(value)
        plain = format(number, "f")
        return plain.rstrip("0").rstrip(".") if "." in plain else plain
    return encodable(value if isinstance(value, str) else compact(value))


def node_text(node, default: str | None) -> str | None:
    """A string, the ``text`` of an object or the JSON of an object without one; else ``default``."""
    if isinstance(node, str) and not isinstance(node, Number):
        return encodable(node)
    if isinstance(node, dict) and node:
        return scalar_text(node["text"]) if "text" in node else encodable(compact(node))
    return default


class JsonText(NamedTuple):
    """The text at a path of keys. With ``base``: of the entry ``"<base> YYYY…"`` with the greatest year."""

    keys: tuple[str, ...] = ()
    base: str | None = None
    default: str | None = "N/A"


def json_text(*keys: str, default: str | None = "N/A") -> JsonText:
    return JsonText(keys, None, default)


def latest_year_text(*keys: str, base: str, default: str | None = "N/A") -> JsonText:
    """Of equal years the first key in code-point order counts; a latest entry without a text gives the default."""
    return JsonText(keys, base, default)


def _found(record, field: JsonText) -> str | None:
    node = record
    for key in field.keys:
        node = node.get(key) if isinstance(node, dict) else None
    if field.base is not None:
        shape = re.compile(re.escape(field.base) + _YEAR)
        dated = [(-int(m[1]), key) for key in node if (m := shape.match(key))] if isinstance(node, dict) else []
        node = node[min(dated)[1]] if dated else None
    return node_text(node, field.default)


def json_fields(df: DataFrame, column: str, fields: Mapping[str, JsonText]) -> DataFrame:
    """The other columns, the text of each field and ``BAD_RECORD``; ``column`` is parsed once.

    A text that is no JSON object, or null, is a bad record; all its fields have their defaults.
    """

    def read(text: str) -> Iterator[tuple]:
        record, _ = parsed(text)
        yield *[_found(record, f) for f in fields.values()], not isinstance(record, dict)

    return records_of(df, column, name(column), [*[(f, "string") for f in fields], (BAD_RECORD, "boolean")], read)


def _points(rows) -> list[tuple[int, int, object]] | None:
    """(place, year, value) of rows; None when one is no object or has no year. Of a year the last one stays."""
    last: dict[int, tuple[int, int, object]] = {}
    for place, row in enumerate(rows):
        date = row.get("date") if isinstance(row, dict) else None
        date = date.strip(WHITESPACE) if isinstance(date, str) else ""
        if not re.fullmatch(r"[+-]?[0-9]{1,9}", date):
            return None
        last[int(date)] = (place, int(date), row.get("value"))
    return sorted(last.values(), key=lambda p: p[0])


def payload_points(df: DataFrame, payload: str, window: tuple[int, int]) -> DataFrame:
    """Year and value pairs of ``[meta, rows]`` payloads: the other columns, ``pos``, ``year``, ``value``, ``BAD_RECORD``.

    Each payload begins with a row whose ``pos`` is -1; it is bad when the payload is not of that
    form, or when one date is not a year: such a payload is dropped whole. ``payload_rows`` leaves
    these rows out, so that they can be counted on the way.
    """
    start, end = window

    def read(text: str) -> Iterator[tuple]:
        value, _ = parsed(text)
        rows = value[1] if isinstance(value, list) and len(value) > 1 and isinstance(value[1], list) else None
        points = None if rows is None else _points(rows)
        yield -1, None, None, None, points is None
        for place, year, v in points or ():
            if start <= year <= end:
                number = isinstance(v, Number) or isinstance(v, bool)
                yield place, year, float(v) if number else None, encodable(v) if isinstance(v, str) and not number else None, False

    kinds = [("pos", "int"), ("year", "int"), ("_number", "double"), ("_text", "string"), (BAD_RECORD, "boolean")]
    found = records_of(df, payload, name(payload), kinds, read)
    value = F.expr(f"coalesce({clean_numeric('_text')}, _number)").alias("value")
    return found.select(*cols(c for c in df.columns if c != payload), "pos", "year", value, BAD_RECORD)


def payload_rows(points: DataFrame) -> DataFrame:
    """The pairs of ``payload_points`` alone."""
    return points.filter("pos >= 0").drop(BAD_RECORD)


def indicator_rows(df: DataFrame, payload: str, window: tuple[int, int]) -> DataFrame:
    """Long rows of indicator payloads: the other columns, ``pos``, ``year`` and ``value``."""
    return payload_rows(payload_points(df, payload, window))
