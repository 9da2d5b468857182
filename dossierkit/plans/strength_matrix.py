"""Metric and detail pages to one wide row per country."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierkit.functions.text import parse_value
from dossierkit.operators.extract import label_values, metric_blocks
from dossierkit.operators.resolve import last_wins
from dossierkit.operators.shape import order_by_key, outer_merge, to_numeric
from dossierkit.sources.dims import DETAIL_LABELS, METRIC_NAMES, metric_dim, metric_of
from dossierkit.sources.landed import fetched_pages

FIELDS = METRIC_NAMES + list(DETAIL_LABELS)


# Fixed value: the page that lists all countries.
LISTING = "countries-listing.php"


def detail_links(listing: DataFrame, site: str) -> DataFrame:
    """``listing(ordinal, html)`` to the last detail URL of each country."""
    links = metric_blocks(listing, "html").select(
        "country", F.concat(F.lit(site), F.col("link")).alias("url"), "ordinal", "card_no"
    )
    return last_wins(links, ["country"], ["ordinal", "card_no"])


def metric_requests(spark: SparkSession, site: str) -> DataFrame:
    """``metric, url`` of every metric page of a site."""
    return metric_dim(spark).select("metric", F.concat(F.lit(site), "page").alias("url"))


def matrix_of_pages(pages: DataFrame, site: str) -> DataFrame:
    """``pages(url, status, ordinal, html)`` of a whole site to the matrix: metric, listing and detail pages."""
    pages = fetched_pages(pages).select("url", "ordinal", "html")
    metrics = pages.withColumn("metric", F.expr(metric_of("url"))).filter("metric IS NOT NULL")
    listing = pages.filter(F.substring_index("url", "/", -1) == LISTING).drop("url")
    details = pages.join(detail_links(listing, site), "url").select("country", "ordinal", "html")
    return strength_matrix(metrics.select("metric", "ordinal", "html"), details)


def strength_matrix(metric_pages: DataFrame, detail_pages: DataFrame) -> DataFrame:
    """``metric_pages(metric, ordinal, html)`` and ``detail_pages(country, ordinal, html)`` to a matrix.

    Both become long rows; one aggregate keeps the last value per country and field, another makes
    the columns. All fields are there whatever was landed.
    """
    metrics = metric_blocks(metric_pages, "html").select(
        "country", "metric", "raw_value", F.struct("ordinal", "card_no").alias("ordinal")
    )
    details = label_values(detail_pages, "html", DETAIL_LABELS).select(
        "country",
        F.col("field").alias("metric"),
        "raw_value",
        F.struct("ordinal", F.lit(0).alias("card_no")).alias("ordinal"),
    )
    long = metrics.unionByName(details).select(
        F.col("country").alias("Country"), "metric", F.expr(parse_value("raw_value")).alias("value"), "ordinal"
    )
    wide = outer_merge(last_wins(long, ["Country", "metric"], ["ordinal"]), "Country", FIELDS)
    return order_by_key(to_numeric(wide, ["Country"]), "Country")
