"""A structural index of a page: every element as an interval of its element numbers and of its text.

One pass over the tags keeps the elements that are open. Elements are numbered as they open, so
what an element contains is a range of numbers, and looking up a field is a search in the sorted
numbers of a name or class, not another reading of the page.

Grammar: '>' inside a quoted attribute value does not end a tag. Void elements hold nothing. A cell
ends at the next cell or row of its table, a row at the next row or section; a paragraph ends at
its end tag, at the next paragraph or with the element around it. An end tag closes what is still
open inside its element; inside a cell it closes nothing outside, unless it belongs to the table.
What is still open ends with the page. Content of scripts, styles and comments is not expected:
``html.drop_noise`` takes it out before.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The inside of a tag: '=' may lead a quoted value, and only there do quotes count. Reads the same
# in Java, where it ends tags for the text functions.
INSIDE = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_TAG = re.compile(rf"<(/?)([A-Za-z][^\s/>]*)({INSIDE})>")
_ANY_TAG = re.compile(rf"<[A-Za-z/!?]{INSIDE}>")
_ENTITY = re.compile(r"&(?:#[0-9]{1,9}|#[xX][0-9A-Fa-f]{1,8}|[A-Za-z][A-Za-z0-9]*);")
_VALUE = r"""(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_ATTRIBUTE = re.compile(rf"""([^\s"'>/=]+)(?:\s*=\s*{_VALUE})?""")
# A class in front of which no quoted value stands; others are looked up attribute by attribute.
_CLASS = re.compile(rf"""[^"']*?(?:^|[\s/])(?i:class)\s*=\s*{_VALUE}""")

# Elements without content, and the parts of tables with what their begin closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CELLS = frozenset(("td", "th"))
_ROWS = _CELLS | {"tr"}
_SECTIONS = _ROWS | {"tbody", "thead", "tfoot"}
_TABLE = _SECTIONS | {"table"}
_CLOSES = {"td": _CELLS, "th": _CELLS, "tr": _ROWS, "tbody": _SECTIONS, "thead": _SECTIONS, "tfoot": _SECTIONS}


class Find(NamedTuple):
    """Which elements are meant: by name, one word of the class, the whole class, the id, a text in an attribute."""

    name: str | None = None
    cls: str | None = None
    whole_cls: str | None = None
    id: str | None = None
    held: tuple[str, str] | None = None


class Pick(NamedTuple):
    """A field: the first path that finds something. A path goes from outside in.

    A step is a ``Find``, or a tuple of which the first one counts that is there. ``many`` takes all
    elements of all elements of the step before, in page order, else it is the first of the first;
    ``last`` takes the last instead. A path without steps is the element around itself. The value is
    the inner HTML or, with ``attribute``, the raw text of that attribute.
    """

    paths: tuple[tuple[Find | tuple[Find, ...], ...], ...]
    many: bool = False
    attribute: str | None = None
    last: bool = False


def field(*path: Find | tuple[Find, ...], many: bool = False, attribute: str | None = None, last: bool = False) -> Pick:
    """A field with one path."""
    return Pick((path,), many, attribute, last)


def attribute(attributes: str, name: str) -> str | None:
    """Raw value of an attribute in the inside of an opening tag; None when absent."""
    for found in _ATTRIBUTE.finditer(attributes):
        if found[1].lower() == name:
            return next((g for g in found.groups()[1:] if g is not None), "")
    return None


def class_words(attributes: str) -> set[str]:
    found = _CLASS.match(attributes)
    value = next(g for g in found.groups() if g is not None) if found else attribute(attributes, "class")
    return set((value or "").split())


def plain_text(html: str) -> str:
    """Text parts of a fragment, each stripped, joined without a separator."""
    return "".join(_ENTITY.sub(lambda e: unescape(e[0]), part).strip() for part in _ANY_TAG.split(html))


class Index:
    """Elements of one page, numbered in the order of their opening tags."""

    def __init__(self, html: str):
        self.html = html
        self.names: list[str] = []
        self.attributes: list[str] = []
        self.start: list[int] = []  # of the inner HTML
        self.end: list[int] = []
        self.after: list[int] = []  # first element that the element does not contain
        self.by_name: dict[str, list[int]] = {}
        self.by_class: dict[str, list[int]] = {}
        self._read()

    def _read(self) -> None:
        names, open_now, paragraph, level = self.names, [], -1, 0
        count: dict[str, int] = {}

        def close(depth: int, at: int) -> None:
            """Elements from ``depth`` of the open ones on end here, and a paragraph that began inside."""
            nonlocal paragraph
            if paragraph >= 0 and level > depth:
                self.end[paragraph], self.after[paragraph] = at, len(names)
                paragraph = -1
            for i in open_now[depth:]:
                self.end[i], self.after[i] = at, len(names)
                count[names[i]] -= 1
            del open_now[depth:]

        for tag in _TAG.finditer(self.html):
            ends, name, inside = tag.groups()
            name = name.lower()
            if name == "p":
                if paragraph >= 0:
                    self.end[paragraph], self.after[paragraph] = tag.start(), len(names)
                    paragraph = -1
                if ends:
                    continue
                paragraph, level = len(names), len(open_now)
            elif ends:
                if not count.get(name):
                    continue
                for depth in range(len(open_now) - 1, -1, -1):
                    other = names[open_now[depth]]
                    if other == name:
                        close(depth, tag.start())
                        break
                    if other == "table" or (other in _CELLS and name not in _TABLE):
                        break
                continue
            elif name in _CLOSES:
                closed, lowest = _CLOSES[name], None
                for depth in range(len(open_now) - 1, -1, -1):
                    other = names[open_now[depth]]
                    if other == "table":
                        break
                    if other in closed:
                        lowest = depth
                if lowest is not None:
                    close(lowest, tag.start())
            number = len(names)
            names.append(name)
            self.attributes.append(inside)
            self.start.append(tag.end())
            self.end.append(tag.end() if name in VOID else len(self.html))
            self.after.append(number + 1 if name in VOID else -1)
            self.by_name.setdefault(name, []).append(number)
            if "class" in inside or "CLASS" in inside or "Class" in inside:
                for word in class_words(inside):
                    self.by_class.setdefault(word, []).append(number)
            if name not in VOID and name != "p":
                open_now.append(number)
                count[name] = count.get(name, 0) + 1
        for number in open_now if paragraph < 0 else [*open_now, paragraph]:
            self.after[number] = len(names)

    def inner(self, number: int) -> str:
        return self.html[self.start[number] : self.end[number]]

    def inside(self, number: int) -> tuple[int, int]:
        """Range of the elements in an element."""
        return number + 1, self.after[number]

    def all(self, find: Find, within: tuple[int, int] | None = None) -> Iterator[int]:
        """Elements of a range that match, in page order."""
        low, high = within or (0, len(self.names))
        if find.cls:
            numbers = self.by_class.get(find.cls, ())
        else:
            numbers = self.by_name.get(find.name, ()) if find.name else range(len(self.names))
        for i in range(bisect_left(numbers, low), len(numbers)):
            number = numbers[i]
            if number >= high:
                return
            if self._matches(number, find):
                yield number

    def _matches(self, number: int, find: Find) -> bool:
        inside = self.attributes[number]
        return (
            (not find.name or self.names[number] == find.name)
            and (find.whole_cls is None or attribute(inside, "class") == find.whole_cls)
            and (find.id is None or attribute(inside, "id") == find.id)
            and (find.held is None or find.held[1] in (attribute(inside, find.held[0]) or ""))
        )

    def first(self, step: Find | tuple[Find, ...], within: tuple[int, int] | None) -> int | None:
        """First element of a step's first alternative that is there."""
        finds = (step,) if isinstance(step, Find) else step
        return next((n for find in finds if (n := next(self.all(find, within), None)) is not None), None)

    def outermost(self, find: Find, within: tuple[int, int] | None = None) -> Iterator[int]:
        """Matching elements that lie in no matching element before them."""
        end = -1
        for number in self.all(find, within):
            if number >= end:
                end = self.after[number]
                yield number

    def _path(self, path: tuple, within: tuple[int, int] | None, pick: Pick) -> list[int]:
        step, *rest = path
        if not rest:
            if not pick.many and not pick.last:
                number = self.first(step, within)
                return [] if number is None else [number]
            finds = (step,) if isinstance(step, Find) else step
            numbers = next((found for find in finds if (found := list(self.all(find, within)))), [])
            return numbers if pick.many else numbers[-1:]
        if pick.many:
            return [n for outer in self.outermost(step, within) for n in self._path(tuple(rest), self.inside(outer), pick)]
        outer = self.first(step, within)
        return [] if outer is None else self._path(tuple(rest), self.inside(outer), pick)

    def value(self, pick: Pick, within: tuple[int, int] | None = None, own: int | None = None) -> str | list[str] | None:
        """The field's raw text, or texts; None (or no texts) when nothing is there. ``own`` is the element around."""
        found: list[int] = []
        for path in pick.paths:
            found = self._path(path, within, pick) if path else ([] if own is None else [own])
            if found:
                break
        texts = [self.inner(n) if pick.attribute is None else attribute(self.attributes[n], pick.attribute) for n in found]
        return texts if pick.many else (texts[0] if texts else None)
