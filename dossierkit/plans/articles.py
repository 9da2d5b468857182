"""Listing and detail pages to articles, and articles to chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierkit.functions.sqltext import cols
from dossierkit.functions.text import strip
from dossierkit.operators.extract import article_cards, main_text, page_links
from dossierkit.operators.resolve import last_wins, skew_left_join
from dossierkit.operators.retrieve import chunk_text, compose_document

# Columns of an article record, and their order in a CSV file.
ARTICLE_COLUMNS = [
    "Section",
    "Title",
    "Link",
    "Author(s)",
    "Date Posted",
    "Date Updated",
    "Updates",
    "Full Article",
]
CSV_COLUMNS = [
    "Section",
    "Title",
    "Full Article",
    "Author(s)",
    "Date Posted",
    "Date Updated",
    "Updates",
    "Link",
]


def articles(listing: DataFrame, details: DataFrame) -> DataFrame:
    """``listing(page_id, html)`` and ``details(url, ordinal, html)`` to article records.

    One row per card; a card without a detail page has an empty full text. The last fetch of a URL
    counts. Only pages that a listing links to are read: the others go before their text is
    extracted, by a cheap pass for the links alone.
    """
    cards = article_cards(listing.select("page_id", "html"), "html")
    linked = page_links(listing.select("html"), "html").select(F.expr(strip("href")).alias("Link")).distinct()
    fetched = details.select(F.col("url").alias("Link"), "ordinal", "html").join(linked, "Link", "left_semi")
    texts = main_text(last_wins(fetched, ["Link"], ["ordinal"]), "html", "Full Article")
    joined = skew_left_join(cards, texts, "Link", ["page_id", "card_no"])
    full = F.coalesce("`Full Article`", F.lit(""))
    return joined.withColumn("Full Article", full).select("page_id", "card_no", *cols(ARTICLE_COLUMNS))


def article_chunks(records: DataFrame) -> DataFrame:
    """Article records to ``link, title, chunk_no, chunk``."""
    documents = records.select(
        F.coalesce("Link", F.lit("")).alias("link"),
        F.coalesce("Title", F.lit("")).alias("title"),
        compose_document().alias("document"),
    )
    return chunk_text(documents, "document")
