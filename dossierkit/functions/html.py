"""Text out of HTML fragments, as Spark SQL expressions.

Script, style and comment content is never text. Entities need their ';'. '>' inside a quoted
attribute value does not end a tag. Elements are found by ``functions.structure``.
"""

from __future__ import annotations

import re
from html.entities import html5

from dossierkit.functions.sqltext import let, matches, quote, split_on, transform, transform_at
from dossierkit.functions.structure import INSIDE
from dossierkit.functions.text import clean_text, strip

TAG = rf"<[A-Za-z/!?]{INSIDE}>"
_NOISE = (
    r"(?s)<(?:!--.*?-->|(?i:script)\b.*?(?:</(?i:script)\s*>|\z)|(?i:style)\b.*?(?:</(?i:style)\s*>|\z))|\x00"
)
# Stands for removed content, so that the texts on its two sides stay apart.
_GAP = "<!>"

# Named entities as one text, which the optimizer folds to a map; the five that every page uses
# come first because look-up is a scan.
_COMMON = ("amp", "lt", "gt", "quot", "nbsp")
_CHARS = {n: html5[f"{n};"] for n in (*_COMMON, *sorted(n[:-1] for n in html5 if n.endswith(";")))}
_NAMED = "str_to_map({}, '\\u0001', '\\u0002')".format(
    quote("\x01".join(f"{name}\x02{char}" for name, char in _CHARS.items()))
)


# What browsers read numbers 128 to 159 as: the characters of windows-1252, as far as it has them.
_WINDOWS = "".join(bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(128, 160))


def drop_noise(html: str) -> str:
    """HTML without scripts, styles and comments."""
    return f"regexp_replace({html}, {quote(_NOISE)}, '{_GAP}')"


def _char(code: str) -> str:
    """Character of a reference by number; the replacement character when there is none."""
    valid = f"({code} BETWEEN 1 AND {0xD7FF} OR {code} BETWEEN {0xE000} AND {0x10FFFF})"
    windows = f"{code} BETWEEN 128 AND 159 THEN substring({quote(_WINDOWS)}, int({code}) - 127, 1)"
    return f"CASE WHEN {windows} WHEN {valid} THEN decode(unhex(lpad(hex({code}), 8, '0')), 'UTF-32') ELSE '�' END"


def unescape(c: str) -> str:
    """Entities decoded, each exactly once."""
    ref = quote(r"^(#[0-9]{1,9}|#[xX][0-9A-Fa-f]{1,8}|[A-Za-z][A-Za-z0-9]*);")

    def decoded(part: str, r: str) -> str:
        code = f"CASE WHEN {matches(r, '^#[xX]')} THEN conv(substring({r}, 3), 16, 10) ELSE substring({r}, 2) END"
        number = let(f"try_cast({code} AS bigint)", _char)
        char = f"CASE WHEN startswith({r}, '#') THEN {number} ELSE try_element_at({_NAMED}, {r}) END"
        return f"coalesce({char} || substring({part}, length({r}) + 2), '&' || {part})"

    def piece(part: str, i: str) -> str:
        return f"CASE WHEN {i} = 0 THEN {part} ELSE {let(f'regexp_extract({part}, {ref}, 1)', lambda r: decoded(part, r))} END"

    decoded_text = f"array_join({transform_at(f"split({c}, '&')", piece)}, '')"
    return f"CASE WHEN contains({c}, '&') THEN {decoded_text} ELSE {c} END" if re.fullmatch(r"[\w.`]+", c) else decoded_text


def bare_text(html: str, sep: str = "") -> str:
    """Text of a fragment with each tag as ``sep``, white space as it is."""
    plain = f"regexp_replace({html}, {quote(TAG)}, {quote(sep)})"
    if not re.fullmatch(r"[\w.`]+", html):
        return unescape(plain)
    return f"CASE WHEN contains({html}, '&') THEN {unescape(plain)} ELSE {plain} END"


def spaced_text(html: str) -> str:
    """Text of a fragment with tags as spaces, squeezed."""
    return clean_text(bare_text(html, " "))


def joined_text(html: str) -> str:
    """Text of a fragment with tags as nothing, squeezed."""
    return clean_text(bare_text(html))


def stripped_text(html: str) -> str:
    """Text parts of a fragment, each stripped, joined without a separator. Without tags and entities it is one part."""
    parts = f"array_join({transform(split_on(html, TAG), lambda p: strip(unescape(p)))}, '')"
    return f"CASE WHEN contains({html}, '<') OR contains({html}, '&') THEN {parts} ELSE {strip(html)} END"
