"""Rows out of landed pages. Everything here is row-local: no shuffle.

Pages are read through a structural index (``functions.structure``): an Arrow function cuts each page
once and hands on the raw HTML of rows, cards and fields; their texts are made by Spark expressions.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierkit.functions import html as H
from dossierkit.functions.sqltext import col, cols, let, name, transform
from dossierkit.functions.structure import Find, Index, Pick, field, plain_text
from dossierkit.functions.text import (
    date_items,
    join_tags,
    last_found,
    posted,
    split_authors,
    split_authors_loose,
    strip,
    updated,
)
from dossierkit.operators.arrow import records_of

# Tasks get the helpers of this module with their function: executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

def _others(df: DataFrame, column: str) -> list[str]:
    return [c for c in df.columns if c != column]


def from_index(df: DataFrame, html: str, fields: Sequence[tuple[str, str]], read: Callable[[Index], Iterator[tuple]]) -> DataFrame:
    """For each page the records that ``read`` takes from its index, beside the page's other columns."""
    return records_of(df, html, H.drop_noise(name(html)), fields, lambda page: read(Index(page)))


def html_table_rows(
    df: DataFrame,
    html: str,
    *,
    min_cells: int,
    table_id: str | None = None,
    table_class: str | None = None,
    headers: Sequence[str] | None = None,
    fallback_headers: Sequence[str] | None = None,
    body_only: bool = False,
    skip_first: bool = False,
) -> DataFrame:
    """Rows of one table per page: the other columns, ``row_no`` and ``cells`` (texts).

    The table is the first that meets ``table_id``, ``table_class`` and ``headers`` together; if no
    table does, the first whose head holds all ``fallback_headers``. Rows with fewer than
    ``min_cells`` cells are left out. Rows and cells of tables inside the table count as its own,
    and a cell's text holds theirs.
    """
    wanted = Find("table", table_class, id=table_id)
    head, fallback = frozenset(headers or ()), frozenset(fallback_headers or ())

    def has(index: Index, within: tuple[int, int], texts: frozenset[str]) -> bool:
        return texts <= {plain_text(index.inner(n)) for n in index.all(Find("th"), within)}

    def choose(index: Index) -> int | None:
        for table in index.all(wanted):
            if not head or has(index, index.inside(table), head):
                return table
        for table in index.all(Find("table")) if fallback else ():
            thead = index.first(Find("thead"), index.inside(table))
            if thead is not None and has(index, index.inside(thead), fallback):
                return table
        return None

    def read(index: Index) -> Iterator[tuple]:
        table = choose(index)
        if table is not None and body_only:
            table = index.first(Find("tbody"), index.inside(table))
        if table is None:
            return
        for row_no, row in enumerate(list(index.all(Find("tr"), index.inside(table)))[skip_first:]):
            cells = [index.inner(n) for n in index.all(Find("td"), index.inside(row))]
            if len(cells) >= min_cells:
                yield row_no, cells

    rows = from_index(df, html, [("row_no", "int"), ("cells", "texts")], read)
    texts = F.expr(transform("cells", H.stripped_text)).alias("cells")
    return rows.select(*cols(_others(df, html)), "row_no", texts)


def html_cards(
    df: DataFrame,
    html: str,
    card: Find,
    picks: Mapping[str, Pick],
    *,
    required: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """One row per card of a page: the other columns, ``card_no`` and the raw HTML (or list) of each pick.

    Cards do not nest: one inside another belongs to that. Cards whose ``required`` pick is absent,
    blank or (with ``pattern``, of the decoded text) does not match are left out.
    """

    def read(index: Index) -> Iterator[tuple]:
        for card_no, number in enumerate(index.outermost(card)):
            within = index.inside(number)
            values = [index.value(p, within, number) for p in picks.values()]
            if required is None or values[place]:
                yield card_no, *values

    place = list(picks).index(required) if required else 0
    fields = [("card_no", "int"), *[(n, "texts" if p.many else "string") for n, p in picks.items()]]
    out = from_index(df, html, fields, read)
    if required:
        value = F.expr(H.unescape(name(required)))
        out = out.filter(value != "")
        if pattern:
            out = out.filter(F.rlike(value, F.lit(pattern)))
    return out


# Where the parts of an article card are.
CARD = Find("div", "card-post")
CARD_LINK = (Find("a", "card-post-title-link"), Find("a", "card-post-image-link"))
CARD_TITLE = Find("h3", "card-post-title")
CARD_PICKS = {
    "link": field(CARD_LINK, attribute="href"),
    "title": Pick(((CARD_LINK, CARD_TITLE), (CARD_TITLE,))),
    "tags": Pick(((Find(cls="post-tax-badges"), Find(cls="cat-name-badge")), (Find("a", "cat-name-badge"),)), many=True),
    "items": field(Find(cls="card-post-inline-meta"), Find(cls="inline-meta-item"), many=True),
    "authors": field(Find(cls="card-post-byline"), Find("span", "byline-text"), many=True),
    "byline": field(Find(cls="card-post-byline")),
    "dek": field(Find("p", "card-post-dek")),
}


def _texts(items: str) -> str:
    return transform(items, H.joined_text)


def article_cards(df: DataFrame, html: str) -> DataFrame:
    """Article records of listing pages, without the full text.

    The link is the title link, else the image link; the title is in the link, else in the card.
    """
    found = html_cards(df, html, CARD, CARD_PICKS)
    loose = split_authors_loose(H.joined_text("byline"))
    kept = cols(_others(df, html))
    # Dates are looked up in the texts of the items twice.
    parts = found.select(*kept, "card_no", "link", "title", "tags", "authors", "byline", "dek", F.expr(date_items(_texts("items"))).alias("items"))
    fields = {
        "Section": join_tags(_texts("tags")),
        "Title": H.joined_text("title"),
        "Link": strip(f"coalesce({H.unescape('link')}, '')"),
        "Author(s)": let(_texts("authors"), lambda m: f"CASE WHEN size({m}) > 0 THEN flatten({transform(m, split_authors)}) ELSE {loose} END"),
        "Date Posted": f"coalesce({last_found('items', posted)}, '')",
        "Date Updated": f"coalesce({last_found('items', updated)}, '')",
        "Updates": H.joined_text("dek"),
    }
    out = parts.select(*kept, "card_no", *[F.expr(f).alias(title) for title, f in fields.items()])
    return out.filter(col("Link") != "")


# Where the parts of a metric block are.
BLOCK = Find("a", held=("href", "country-military-strength-detail"))
_SPAN, _VALUE = Find("span"), Find("div", "valueContainer")
BLOCK_PICKS = {
    "title": field(Find("div", "longFormName"), _SPAN),
    "span": field(_VALUE, _SPAN, last=True),
    "value": field(_VALUE),
    "link": Pick(((),), attribute="href"),
}


def metric_blocks(df: DataFrame, html: str) -> DataFrame:
    """Country, raw value and link of every block of a metric page; blocks without a name are left out."""
    fields = {
        "country": strip(H.bare_text("title")),
        "raw_value": f"coalesce({strip(H.bare_text('coalesce(span, value)'))}, '')",
        "link": f"coalesce({H.unescape('link')}, '')",
    }
    found = html_cards(df, html, BLOCK, BLOCK_PICKS).filter("title IS NOT NULL")
    return found.select(*cols(_others(df, html)), "card_no", *[F.expr(f).alias(title) for title, f in fields.items()])


# Where labels and values of a detail page are.
LABEL_CONTAINER = Find("div", "specsGenContainers")
LABEL_VALUE = Find("span", whole_cls="textWhite textShadow")


def label_values(
    df: DataFrame,
    html: str,
    labels: Mapping[str, str],
    container: Find = LABEL_CONTAINER,
    value: Find = LABEL_VALUE,
) -> DataFrame:
    """Value of each label on a detail page: the other columns, ``field`` and ``raw_value``.

    ``labels`` are patterns. The first span of the page that holds nothing but text with the label
    counts, and the first value span of the container around it; a label outside of a container or
    without a value gives no row.
    """
    shapes = {title: re.compile(shape) for title, shape in labels.items()}

    def read(index: Index) -> Iterator[tuple]:
        places = list(index.outermost(container))
        spans = [(n, text) for n in index.all(Find("span")) if "<" not in (text := index.inner(n))]
        for title, shape in shapes.items():
            span = next((n for n, text in spans if shape.search(text)), None)
            around = next((c for c in places if span is not None and c < span < index.after[c]), None)
            found = None if around is None else index.first(value, index.inside(around))
            if found is not None:
                yield title, index.inner(found)

    rows = from_index(df, html, [("field", "string"), ("_value", "string")], read)
    return rows.select(*cols(_others(df, html)), "field", F.expr(strip(H.bare_text("_value"))).alias("raw_value"))


def page_fields(df: DataFrame, html: str, picks: Mapping[str, Pick]) -> DataFrame:
    """One row per page: the other columns and the raw HTML (or list) of each pick."""

    def read(index: Index) -> Iterator[tuple]:
        yield tuple(index.value(p) for p in picks.values())

    return from_index(df, html, [(n, "texts" if p.many else "string") for n, p in picks.items()], read)


# Fixed value: the element that holds an article's text.
MAIN = Find("div", "entry-content")


def main_text(df: DataFrame, html: str, text: str, container: Find = MAIN) -> DataFrame:
    """The other columns and ``text``: paragraphs of the container, of the whole page where there is none.

    Joined by spaces; of null pages it is empty.
    """

    def read(index: Index) -> Iterator[tuple]:
        place = index.first(container, None)
        yield ([index.inner(n) for n in index.all(Find("p"), None if place is None else index.inside(place))],)

    rows = from_index(df, html, [("_paragraphs", "texts")], read)
    return rows.select(*cols(_others(df, html)), F.expr(f"array_join({transform('_paragraphs', H.spaced_text)}, ' ')").alias(text))


def page_links(df: DataFrame, html: str, pattern: str | None = None) -> DataFrame:
    """Links of a page: the other columns, ``link_no``, ``href`` and ``label``."""
    picks = {"href": Pick(((),), attribute="href"), "label": Pick(((),))}
    links = html_cards(df, html, Find("a"), picks, required="href", pattern=pattern)
    return links.select(*cols(_others(df, html)), F.col("card_no").alias("link_no"), F.expr(H.unescape("href")).alias("href"), F.expr(H.joined_text("label")).alias("label"))
