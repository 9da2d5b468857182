"""Rows and fields out of HTML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierkit.catalog.common import squeeze, cents, grouped, table, text, whole
from dossierkit.functions import html as H
from dossierkit.functions.sqltext import transform
from dossierkit.functions.structure import Find, field
from dossierkit.functions.text import join_tags as joined_tags
from dossierkit.operators import extract
from dossierkit.plans.country_profile import CURRENCY_HEADERS
from dossierkit.sources.dims import DETAIL_LABELS

# A page per customer: decoys in a comment, a script and another table; a short row; entities.
# A row with a table in a cell, and '>' in attributes. Every twentieth page has no such table.
_TABLE_PAGE = (
    "'<html><!-- <table class=\"wikitable\"><tr><td>no</td></tr></table> --><script>var t=\"<table>\";</script>"
    '<table class="other"><tr><th>Symbol</th></tr><tr><td>a</td><td>b</td><td>c</td><td>d</td></tr></table>'
    "<table class=\"big ' || case when c_custkey % 20 = 0 then 'plain' else 'wikitable' end || ' sortable\"><tr>"
    + "".join(f"<th> <b>{h}</b></th>" for h in CURRENCY_HEADERS)
    + "</tr><TR><td> <a href=\"x\">The ' || c_name || '</a> [a]</td><td>' || c_mktsegment || ' &amp; Co</td>"
    "<td>&#36;</td><td>' || substr(c_mktsegment, 1, 3) || '</td></TR><tr><td>short</td></tr>"
    "<tr><td>Isle ' || " + text("c_custkey") + " || '<td>&lt;b&gt;<td> <i>x</i> y <td>&nbsp;Z&nbsp;</tr>"
    "<tr><td title=\"a > b\">Nest ' || " + text("c_custkey") + " || '</td><td><table class=\"x\"><tr><td>in</td></tr></table></td>"
    "<td data-x=\"<i>\">e</td></tr></table>'"
)


def html_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "customer", "c_custkey").select("c_custkey", F.expr(_TABLE_PAGE).alias("html"))
    rows = extract.html_table_rows(
        pages, "html", table_class="wikitable", headers=CURRENCY_HEADERS, min_cells=4, skip_first=True
    )
    cells = [F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(4)]
    return rows.select("c_custkey", F.col("row_no").cast("bigint").alias("row_no"), *cells)


# A listing page per part: a full card, a card without a link, a card that needs every fallback.
_CARD_PAGE = (
    "'<div class=\"list\"><div data-x=\"a>b\" class=\"big card-post\"><a title=\"1 > 0\" class=\"card-post-title-link\" href=\"/p/' || "
    + text("p_partkey")
    + " || '?a=1&amp;b=2\"><h3 class=\"card-post-title\" title=\"<b>\"> ' || p_name || ' <br alt=\">\">news </h3></a>"
    "<div class=\"post-tax-badges\"><a class=\"cat-name-badge\">' || p_brand || '</a><div>"
    "<span class=\"x cat-name-badge\">' || p_type || '</span></div></div><div class=\"card-post-inline-meta\">"
    '<span class="inline-meta-item">Posted on Jan 2, 2025</span><span class="inline-meta-item">5 Comments</span>'
    "<span class=\"inline-meta-item\">Updated ' || p_type || '</span></div><div class=\"card-post-byline\">"
    "<span class=\"byline-text\">By Ann and ' || p_brand || '</span></div>"
    "<p class=\"card-post-dek\">Dek <b>' || p_name || '</b></p></div>"
    '<div class="card-post"><h3 class="card-post-title">No link</h3></div>'
    "<div class=\"card-post\"><a class=\"card-post-image-link\" href=\"/img/' || "
    + text("p_partkey")
    + " || '\"></a><div><h3 class=\"card-post-title\">Image &amp; ' || p_name || '</h3></div>"
    "<a class=\"cat-name-badge\">' || p_brand || '</a><div class=\"card-post-byline\"> by Cy, Di </div></div></div>"
    "<p class=\"card-post-dek\">footer</p>'"
)


def html_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "part", "p_partkey").select("p_partkey", F.expr(_CARD_PAGE).alias("html"))
    cards = extract.article_cards(pages, "html")
    return cards.select(
        "p_partkey",
        F.col("card_no").cast("bigint").alias("card_no"),
        F.col("Section").alias("section"),
        F.col("Title").alias("title"),
        F.col("Link").alias("link"),
        F.array_join("Author(s)", "; ").alias("authors"),
        F.col("Date Posted").alias("posted"),
        F.col("Date Updated").alias("updated"),
        F.col("Updates").alias("updates"),
    )


_AMOUNT = grouped(whole(cents("p_retailprice * p_size")))


def _container(label: str, value: str) -> str:
    return (
        f"'<div class=\"specsGenContainers x\"><span class=\"t\">{label}: </span><div>' || {value} || '</div></div>'"
    )


# A detail page per part: a decoy container behind the first, a label without a value, missing
# labels, and on every fifth page a label outside of any container in front of the others.
_DETAIL_PAGE = " || ".join(
    [
        "'<html>' || case when p_partkey % 5 = 0 then "
        "'<span>Army Personnel</span><span class=\"textWhite textShadow\">9</span>' else '' end",
        _container("Army Personnel", f"'<span class=\"textWhite textShadow\"> ' || {_AMOUNT} || ' </span>'"),
        _container("Army Personnel", "'<span class=\"textWhite textShadow\">7</span>'"),
        _container("Navy Personnel", "'<span class=\"textWhite\">8</span>'"),
        _container(
            "Mobilization Year 4+",
            f"'<span>x</span><span class=\"textWhite textShadow\">$' || {text('p_size')} || ' M</span>'",
        ),
        "case when p_partkey % 3 = 0 then "
        + _container("Tot Mil. Personnel", "'<span class=\"textWhite textShadow\">' || p_name || '</span>'")
        + " else '' end",
    ]
)


def label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "part", "p_partkey").select("p_partkey", F.expr(_DETAIL_PAGE).alias("html"))
    return extract.label_values(pages, "html", DETAIL_LABELS)


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id").select("page_id", "html")
    links = extract.page_links(pages, "html", pattern="^/.*[a-z]$")
    return links.select("page_id", F.col("link_no").cast("bigint").alias("link_no"), "href", "label")


def join_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Navigation labels of a page as one text, beside its title."""
    pages = table(spark, sf_dir, "pages", "page_id").select("page_id", "html")
    picks = {"links": field(Find("a"), many=True), "title": field(Find("title"))}
    found = extract.page_fields(pages, "html", picks)
    labels = joined_tags(transform("links", H.joined_text))
    return found.selectExpr("page_id", f"{labels} AS tags", f"{H.joined_text('title')} AS title")


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id").select("page_id", "html")
    return extract.main_text(pages, "html", "text", Find("article"))


QUERIES = {
    "html_table_rows": html_table_rows,
    "html_cards": html_cards,
    "label_values": label_values,
    "page_links": page_links,
    "join_tags": join_tags,
    "main_text": main_text,
}


def decoded(c: str) -> str:
    """The entities that the pages hold, in DuckDB; '&amp;' last."""
    pairs = (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))
    for name, char in pairs:
        c = f"replace({c}, '{name}', '{char}')"
    return c


NOISE = r"(?s)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
TAGS = "<[A-Za-z/!?][^>]*>"


def paragraphs_sql(body: str) -> str:
    """Paragraph texts of a fragment, joined, in DuckDB."""
    inner = f"regexp_replace(split_part(split_part(p, '</p>', 1), '</article>', 1), '{TAGS}', ' ', 'g')"
    pieces = f"string_split_regex({body}, '<p(?:\\s[^>]*)?>')[2:]"
    return f"array_to_string(list_transform({pieces}, lambda p: {squeeze(decoded(inner))}), ' ')"


ORACLE = {
    "html_table_rows": """
        select c_custkey, cast(row_no as bigint) as row_no, c0, c1, c2, c3 from (
            select c_custkey, 0 as row_no, 'The ' || c_name || '[a]' as c0, c_mktsegment || ' & Co' as c1, '$' as c2,
                substr(c_mktsegment, 1, 3) as c3 from customer
            union all
            select c_custkey, 2, 'Isle ' || cast(c_custkey as varchar), '<b>', 'xy', 'Z' from customer
            union all
            select c_custkey, 3, 'Nest ' || cast(c_custkey as varchar), 'in', 'in', 'e' from customer)
        where c_custkey % 20 <> 0
    """,
    "html_cards": """
        select p_partkey, cast(0 as bigint) as card_no, p_brand || ', ' || p_type as section, p_name || ' news' as title,
            '/p/' || cast(p_partkey as varchar) || '?a=1&b=2' as link, 'Ann; ' || p_brand as authors,
            'Jan 2, 2025' as posted, p_type as updated, 'Dek ' || p_name as updates from part
        union all
        select p_partkey, 2, p_brand, 'Image & ' || p_name, '/img/' || cast(p_partkey as varchar), 'Cy; Di', '', '', ''
        from part
    """,
    "label_values": f"""
        select p_partkey, 'army_personnel' as field, {_AMOUNT} as raw_value from part where p_partkey % 5 <> 0
        union all
        select p_partkey, 'mobilization_year_4_plus', '$' || cast(p_size as varchar) || ' M' from part
        union all
        select p_partkey, 'total_military_personnel', p_name from part where p_partkey % 3 = 0
    """,
    "page_links": r"""
        select page_id, cast(link_no - 1 as bigint) as link_no, href, label from (
            select page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) as href,
                unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) as label,
                generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1), 1) as link_no
            from pages)
        where regexp_matches(href, '^/.*[a-z]$')
    """,
    "join_tags": f"""
        select page_id, array_to_string(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1), ', ') as tags,
            {squeeze(decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)"))} as title
        from pages
    """,
    "main_text": f"""
        with clean as (select page_id, regexp_replace(html, '{NOISE}', '<!>', 'g') as html from pages)
        select page_id, {paragraphs_sql("split_part(split_part(html, '<article>', 2), '</article>', 1)")} as text from clean
    """,
}
