"""Cleaning of text, numbers, dates and names."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from dossierkit.functions.sqltext import keep, let, literal_map, quote, split_on, transform

# The characters that count as white space, as a regex and as text.
WS = r"(?U:[\x1c-\x1f\s])"
WHITESPACE = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)

# Unit -> (multiplier, divisor). Any other unit leaves the number as it is.
UNIT_SCALES = {
    "B": ("1e9D", "1D"),
    "Billion": ("1e9D", "1D"),
    "M": ("1e6D", "1D"),
    "Million": ("1e6D", "1D"),
    "T": ("1e12D", "1D"),
    "Trillion": ("1e12D", "1D"),
    "%": ("1D", "100D"),
}

# Fixed value: a byline item of this length or more is not a date phrase.
DATE_ITEM_LIMIT = 60

# Fixed value: number of years in a reporting window.
WINDOW_YEARS = 8


def strip(c: str) -> str:
    """Cut white space (Unicode) from both ends."""
    return f"btrim({c}, {quote(WHITESPACE)})"


def clean_text(c: str) -> str:
    """Squeeze every run of white space to one space; null becomes ''."""
    return f"coalesce(trim(regexp_replace({c}, {quote(WS + '+')}, ' ')), '')"


def clean_numeric(c: str) -> str:
    """First number in a text, with ``$ , %`` ignored; null when there is none.

    Placeholders such as 'N/A' or '-' hold no digit, so they need no rule of their own.
    """
    number = quote(r"-?\d+(?:\.\d+)?")
    return f"try_cast(regexp_extract(translate({c}, '$,%', ''), {number}, 0) AS double)"


def parse_value(c: str) -> str:
    """Number with an optional unit, only when that is the whole string."""
    raw = f"CASE WHEN contains({c}, '$') THEN {strip(f"translate({c}, '$', '')")} ELSE {c} END"
    shape = quote(rf"(?d)^{WS}*([\d,.]+){WS}*([A-Za-z.%/]*)$")
    number = f"try_cast(translate(regexp_extract({raw}, {shape}, 1), ',', '') AS double)"
    scales = ", ".join(f"{quote(unit)}, struct({times} AS x, {by} AS y)" for unit, (times, by) in UNIT_SCALES.items())
    scale = f"coalesce(try_element_at(map({scales}), regexp_extract({raw}, {shape}, 2)), struct(1D AS x, 1D AS y))"
    return f"({number} * {scale}.x / {scale}.y)"


def country_key(c: str) -> str:
    """Join key of a name: trimmed and lower case."""
    return f"lower({strip(c)})"


def lookup(c: str, values: Mapping[str, str]) -> str:
    """Value of a key in a short fixed list; null when absent. Use a join for a table."""
    return f"try_element_at({literal_map(values)}, {c})"


def normalise_name(c: str, aliases: Mapping[str, str]) -> str:
    """Replace a name by its alias in a short fixed list; other names stay."""
    return let(c, lambda x: f"coalesce({lookup(x, aliases)}, {x})")


def entities(c: str) -> str:
    """Names that share one cell: footnotes cut, split at ', ' and ' and ', leading 'the ' cut."""
    footnote, the = quote(r"(?d)\[.*?\]"), quote("^(?i:the )")
    parts = split_on(strip(f"regexp_replace({c}, {footnote}, '')"), ", | and ")
    names = keep(transform(parts, strip), lambda x: f"{x} != ''")
    return transform(names, lambda x: f"regexp_replace({x}, {the}, '')")


def date_items(items: str) -> str:
    """Byline items that are short enough and speak of a posting or an update."""
    return keep(
        items,
        lambda x: f"(contains({x}, 'Posted') OR contains({x}, 'Updated')) AND length({x}) < {DATE_ITEM_LIMIT}",
    )


def _date_phrase(text: str, word: str) -> str:
    shape = quote(rf"(?iu){word}{WS}+(on{WS}+.*|[\p{{L}}\p{{N}}_]+)$")
    return f"nullif(trim(replace(regexp_extract({text}, {shape}, 1), 'on ', '')), '')"


def posted(c: str) -> str:
    """Date text after 'Posted': one word, or everything after 'on'; null when absent."""
    return _date_phrase(clean_text(c), "Posted")


def updated(c: str) -> str:
    """Date text after 'Updated': one word, or everything after 'on'; null when absent."""
    return _date_phrase(clean_text(c), "Updated")


# Fixed value: the first letters of the months, in order.
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def typed_date(c: str) -> str:
    """Date of a date text such as 'Jan 22, 2025' or 'Mon January 6 2025'; null when it is none, or no such day."""
    shape = quote(r"(?i)(?:^|[^a-z])([a-z]{3})[a-z]*\.?\s+([0-9]{1,2}),?\s+([0-9]{4})(?![0-9])")

    def date(parts: str) -> str:
        place = f"locate(lower({parts}.m), '{MONTHS}')"
        iso = f"format_string('%s-%02d-%02d', {parts}.y, ({place} + 2) div 3, cast({parts}.d AS int))"
        return f"CASE WHEN length({parts}.m) = 3 AND {place} % 3 = 1 THEN try_cast({iso} AS date) END"

    found = ", ".join(f"regexp_extract({c}, {shape}, {i}) AS {n}" for i, n in enumerate("mdy", 1))
    return let(f"struct({found})", date)


def last_found(items: str, find: Callable[[str], str]) -> str:
    """``find`` over every item of an array; the last non-null answer."""
    return f"try_element_at({keep(transform(items, find), lambda x: f'{x} IS NOT NULL')}, -1)"


def _author_list(text: str) -> str:
    parts = split_on(text, r"(?U)[,&]|\band\b")
    return keep(transform(parts, clean_text), lambda x: f"{x} != ''")


def split_authors(c: str) -> str:
    """Authors of a byline; every 'By ' is dropped."""
    return _author_list(f"replace({clean_text(c)}, 'By ', '')")


def split_authors_loose(c: str) -> str:
    """Authors of an unmarked byline; only one leading 'by ' (any case) is dropped."""
    return _author_list(f"regexp_replace({clean_text(c)}, {quote('^(?i:by )')}, '')")


def join_tags(items: str, sep: str = ", ") -> str:
    """Cleaned tags as one text."""
    return f"array_join({transform(items, clean_text)}, {quote(sep)})"


def first_text(*texts: str, missing: tuple[str, ...] = ("", "none", "N/A"), default: str | None = None) -> str:
    """First text that is neither null nor one of the ``missing`` marks."""
    marks = ", ".join(map(quote, missing))
    kept = [let(c, lambda x: f"CASE WHEN {x} NOT IN ({marks}) THEN {x} END") for c in texts]
    return f"coalesce({', '.join(kept)}, {'NULL' if default is None else quote(default)})"


def year_window(as_of: dt.date, years: int = WINDOW_YEARS) -> tuple[int, int]:
    """First and last year of the reporting window, which ends the year before ``as_of``."""
    return as_of.year - years, as_of.year - 1


def in_window(date: str, window: tuple[int, int]) -> str:
    """Date inside the window, as literal bounds so that the scan can use them."""
    start, end = window
    return f"({date} >= TIMESTAMP_NTZ '{start}-01-01' AND {date} < TIMESTAMP_NTZ '{end + 1}-01-01')"
