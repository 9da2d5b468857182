"""Cleaning of text, numbers, dates, names, JSON texts and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierkit.catalog.common import squeeze, WINDOW, cents, grouped, money, table, text, whole
from dossierkit.functions import shares
from dossierkit.functions import text as T
from dossierkit.functions.sqltext import let, transform
from dossierkit.operators import records
from dossierkit.operators.records import indicator_rows as rows_of_payload
from dossierkit.operators.resolve import explode_entities as names_of_cell


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id")
    return documents.select("doc_id", F.expr(T.clean_text("text")).alias("text"))


_PRICE = cents("l_extendedprice")
_NUMERIC = f"""case when l_orderkey % 7 = 0 then 'N/A' when l_orderkey % 11 = 0 then ' - '
    when l_linenumber % 4 = 0 then '$' || {grouped(whole(_PRICE))} || '.' || lpad({text(f"({_PRICE}) % 100")}, 2, '0') || ' (est.)'
    when l_linenumber % 4 = 1 then '-' || {money(_PRICE)} || ' %'
    when l_linenumber % 4 = 2 then 'about ' || {grouped(whole(_PRICE))} || '-7 million'
    else '(' || {text(whole(_PRICE))} || ')' end"""


def clean_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem", "l_orderkey")
    return lineitem.select("l_orderkey", "l_linenumber", F.expr(T.clean_numeric(_NUMERIC)).alias("number"))


def clean_numeric_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First number of whole documents."""
    documents = table(spark, sf_dir, "documents", "doc_id")
    return documents.select("doc_id", F.expr(T.clean_numeric("text")).alias("number"))


_VALUE = f"""case when l_orderkey % 2 = 0 then '$' else '' end || {grouped(whole(_PRICE))} ||
    case l_linenumber % 7 when 0 then '' when 1 then 'B' when 2 then ' M' when 3 then ' Million' when 4 then '%'
    when 5 then ' km' else ' B Cu.M' end"""


def parse_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem", "l_orderkey")
    raw = lineitem.select("l_orderkey", "l_linenumber", F.expr(_VALUE).alias("raw"))
    return raw.select("l_orderkey", "l_linenumber", F.expr(T.parse_value("raw")).alias("amount"))


_DAY = "cast(cast(o_orderdate as date) as string)"
_PHRASE = f"""case o_orderkey % 6 when 0 then 'Posted on ' || {_DAY} when 1 then '  Updated   Yesterday '
    when 2 then 'Posted 2 Days Ago' when 3 then 'Posted on Jan 22 Updated on ' || {_DAY}
    when 4 then 'posted ON ' || {_DAY} else 'By someone' end"""
_SECOND = "case when o_orderkey % 5 = 0 then 'Updated Today' else 'Posted on ' || repeat('x', 60) end"


def posted_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of two byline items per order; the later item wins."""
    orders = table(spark, sf_dir, "orders", "o_orderkey")
    texts = transform(f"array({_PHRASE}, {_SECOND})", T.clean_text)
    items = orders.select("o_orderkey", F.expr(T.date_items(texts)).alias("items"))
    return items.select(
        "o_orderkey",
        F.expr(T.last_found("items", T.posted)).alias("date_posted"),
        F.expr(T.last_found("items", T.updated)).alias("date_updated"),
    )


def typed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date texts of orders beside what they mean; some are no dates."""
    said = F.expr(
        "case o_orderkey % 4 when 0 then 'Posted on ' || date_format(o_orderdate, 'MMM d, yyyy') when 1 then 'Posted on ' || date_format(o_orderdate, 'EEE MMMM d yyyy') "
        "when 2 then 'Posted Yesterday' else 'Posted on Feb 30, 2025' end"
    )
    orders = table(spark, sf_dir, "orders", "o_orderkey").select("o_orderkey", said.alias("item"))
    found = orders.select("o_orderkey", F.expr(T.posted("item")).alias("date_posted"))
    return found.select("o_orderkey", "date_posted", F.expr(f"cast({T.typed_date('date_posted')} AS string)").alias("day"))


_BYLINE = f"""case when c_custkey % 10 = 9 then ' , & ' else
    'By ' || c_name || ' and Rand' || {text('c_custkey')} || ',  Anderson & ' || c_mktsegment end"""


def split_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    authors = F.expr(T.split_authors(_BYLINE))
    return table(spark, sf_dir, "customer", "c_custkey").select(
        "c_custkey", F.array_join(authors, "; ").alias("authors"), F.size(authors).cast("bigint").alias("n")
    )


_CELL = f"'The ' || c_name || '[a], Isle ' || {text('c_custkey')} || ' and  the ' || c_mktsegment || ' [1]'"


def explode_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "customer", "c_custkey").select("c_custkey", F.expr(_CELL).alias("cell"))
    return names_of_cell(cells, "cell").withColumn("entity_no", F.col("entity_no").cast("bigint"))


# Population as an object with a total, as plain text, as a number (which is not text), or absent.
_BALANCE = f"abs({cents('c_acctbal')})"
_PROFILE = f"""'{{"People and Society":{{"Population":' ||
    case c_custkey % 4 when 0 then '{{"total":{{"text":"' || {text('c_custkey')} || ' people"}}}}'
    when 1 then '{{"text":"' || {text('c_custkey')} || '"}}' when 2 then {text('c_custkey')} else '{{}}' end ||
    '}},"Government":{{"Country name":{{"conventional short form":{{"text":"' ||
    case when c_custkey % 3 = 0 then 'none' else c_name end ||
    '"}},"conventional long form":"Land of ' || c_name || '"}}}},"Economy":{{"Real GDP per capita":{{' ||
    case when c_custkey % 6 = 0 then '' else
    '"Real GDP per capita 2021":{{"text":"$' || {money(_BALANCE)} || '"}},' ||
    '"Real GDP per capita 2023":{{"text":"$' || {grouped(whole(_BALANCE))} || ' (est.)"}},' ||
    '"Real GDP per capita 2022":{{"text":"$1"}}' end || '}}}}}}'"""


def json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population and name with their fallbacks."""
    profiles = table(spark, sf_dir, "customer", "c_custkey").select("c_custkey", F.expr(_PROFILE).alias("body"))
    people, names = ("People and Society", "Population"), ("Government", "Country name")
    fields = {
        "total": records.json_text(*people, "total"),
        "all": records.json_text(*people),
        "short": records.json_text(*names, "conventional short form", default=None),
        "long": records.json_text(*names, "conventional long form", default=None),
    }
    name = T.first_text("short", "long", default="Unknown")
    found = records.json_fields(profiles, "body", fields)
    return found.selectExpr("c_custkey", "coalesce(nullif(total, 'N/A'), `all`) AS population", f"{name} AS name")


def latest_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = table(spark, sf_dir, "customer", "c_custkey").select("c_custkey", F.expr(_PROFILE).alias("body"))
    field = "Real GDP per capita"
    found = records.json_fields(profiles, "body", {"gdp": records.latest_year_text("Economy", field, base=field)})
    return found.selectExpr("c_custkey", "gdp", f"{T.clean_numeric('gdp')} AS number")


def event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON texts as they are: a number is no text, an object is its JSON."""
    events = table(spark, sf_dir, "events", "event_id").select("event_id", "props")
    found = records.json_fields(events, "props", {"k": records.json_text("k"), "whole": records.json_text()})
    return found.selectExpr("event_id", "k", f"{T.clean_numeric('whole')} AS number")


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per customer: a row per year with the value of its orders.

    Orders are cut to one row per customer and year first, so a payload has as many entries as
    there are years.
    """
    orders = table(spark, sf_dir, "orders")
    yearly = orders.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(
        F.sum(F.expr(cents("o_totalprice"))).alias("cents")
    )
    entry = f"""'{{"date":"' || {text('y')} || case when o_custkey % 50 = 49 and y = 1997 then 'Q1' else '' end ||
        '","value":' || case when (o_custkey + y) % 6 = 0 then 'null' else {money('cents')} end || '}}'"""
    entries = F.array_sort(F.collect_list(F.struct("y", F.expr(entry).alias("entry"))))
    body = F.concat(
        F.lit('[{"page":1},['), F.array_join(F.transform(entries, lambda e: e["entry"]), ","), F.lit("]]")
    )
    return yearly.groupBy("o_custkey").agg(body.alias("body"))


def indicator_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rows_of_payload(payloads(spark, sf_dir), "body", (WINDOW[0] + 2, WINDOW[1]))
    return rows.select("o_custkey", F.col("year").cast("bigint").alias("year"), "value")


_SHARES = f"""case when o_orderkey % 13 = 0 then 'None' else 'Muslim ' || {text('o_orderkey % 61')} || '.5%, Roman Catholic ' ||
    {text('o_orderkey % 29')} || '% (2020 est., x 7%); other ' || {text('o_orderkey % 7')} || ' % , Sunni 1.25%, rest 3%' ||
    chr(10) || 'note: hindu 5%' end"""


def parse_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.expr(let(_SHARES, shares.parse_shares))
    orders = table(spark, sf_dir, "orders", "o_orderkey").select("o_orderkey", F.posexplode(parsed).alias("rank", "share"))
    return orders.select("o_orderkey", (F.col("rank") + 1).cast("bigint").alias("rank"), "share.name", "share.pct")


def share_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey")
    parsed = orders.select("o_orderkey", F.expr(let(_SHARES, shares.parse_shares)).alias("shares"))
    return parsed.selectExpr("o_orderkey", *shares.share_slots("shares"))


QUERIES = {
    "clean_text": clean_text,
    "clean_numeric": clean_numeric,
    "clean_numeric_documents": clean_numeric_documents,
    "parse_value": parse_value,
    "posted_updated": posted_updated,
    "typed_dates": typed_dates,
    "split_authors": split_authors,
    "explode_entities": explode_entities,
    "json_text": json_text,
    "latest_year": latest_year,
    "event_props": event_props,
    "indicator_rows": indicator_rows,
    "parse_shares": parse_shares,
    "share_slots": share_slots,
}

_RANKED = """
    select o_orderkey, row_number() over (partition by o_orderkey order by pct desc, grp) as rank, name, pct
    from (
        select o_orderkey, unnest([
            {'grp': 0, 'name': 'Catholic', 'pct': cast(o_orderkey % 29 as double)},
            {'grp': 4, 'name': 'Muslim', 'pct': o_orderkey % 61 + cast(1.75 as double)},
            {'grp': 10, 'name': 'Other', 'pct': cast(o_orderkey % 7 as double)}], recursive := true)
        from orders where o_orderkey % 13 <> 0
    ) where pct > 0.01
"""

ORACLE = {
    "clean_text": f"select doc_id, coalesce({squeeze('text')}, '') as text from documents",
    "clean_numeric": f"""
        select l_orderkey, l_linenumber, case when l_orderkey % 7 = 0 or l_orderkey % 11 = 0 then null
            when l_linenumber % 4 = 0 then cast({_PRICE} as double) / cast(100 as double)
            when l_linenumber % 4 = 1 then -cast({_PRICE} as double) / cast(100 as double)
            else cast({whole(_PRICE)} as double) end as number from lineitem
    """,
    "clean_numeric_documents": """
        select doc_id, try_cast(regexp_extract(regexp_replace(text, '[$,%]', '', 'g'), '-?\\d+(?:\\.\\d+)?') as double) as number
        from documents
    """,
    "parse_value": f"""
        select l_orderkey, l_linenumber, cast({whole(_PRICE)} as double) * case l_linenumber % 7 when 1 then 1e9
            when 2 then 1e6 when 3 then 1e6 when 6 then null else cast(1 as double) end /
            case when l_linenumber % 7 = 4 then cast(100 as double) else cast(1 as double) end as amount from lineitem
    """,
    "posted_updated": f"""
        select o_orderkey,
            case o_orderkey % 6 when 0 then {_DAY} when 3 then 'Jan 22 Updated ' || {_DAY} end as date_posted,
            case when o_orderkey % 5 = 0 then 'Today' when o_orderkey % 6 = 1 then 'Yesterday'
                when o_orderkey % 6 = 3 then {_DAY} end as date_updated
        from orders
    """,
    "typed_dates": """
        select o_orderkey, case o_orderkey % 4 when 0 then strftime(o_orderdate, '%b %-d, %Y')
                when 1 then replace(strftime(o_orderdate, '%a %B %-d %Y'), 'on ', '') when 2 then 'Yesterday' else 'Feb 30, 2025' end as date_posted,
            case when o_orderkey % 4 = 0 or (o_orderkey % 4 = 1 and strftime(o_orderdate, '%a') <> 'Mon') then strftime(o_orderdate, '%Y-%m-%d') end as day
        from orders
    """,
    "split_authors": """
        select c_custkey, case when c_custkey % 10 = 9 then '' else
            c_name || '; Rand' || cast(c_custkey as varchar) || '; Anderson; ' || c_mktsegment end as authors,
            cast(case when c_custkey % 10 = 9 then 0 else 4 end as bigint) as n
        from customer
    """,
    "explode_entities": """
        select c_custkey, cast(entity_no as bigint) as entity_no, entity, lower(entity) as entity_key from (
            select c_custkey, 0 as entity_no, c_name as entity from customer
            union all select c_custkey, 1, 'Isle ' || cast(c_custkey as varchar) from customer
            union all select c_custkey, 2, c_mktsegment from customer)
    """,
    "json_text": """
        select c_custkey, case c_custkey % 4 when 0 then cast(c_custkey as varchar) || ' people'
            when 1 then cast(c_custkey as varchar) else 'N/A' end as population,
            case when c_custkey % 3 = 0 then 'Land of ' || c_name else c_name end as name
        from customer
    """,
    "latest_year": f"""
        select c_custkey, case when c_custkey % 6 = 0 then 'N/A' else '$' || {grouped(whole(_BALANCE))} || ' (est.)' end as gdp,
            case when c_custkey % 6 = 0 then null else cast({whole(_BALANCE)} as double) end as number
        from customer
    """,
    "event_props": """
        select event_id, 'N/A' as k, cast(json_extract_string(props, '$.k') as double) as number from events
    """,
    "indicator_rows": f"""
        with yearly as (
            select o_custkey, year(o_orderdate) as y, sum({cents('o_totalprice')}) as cents from orders group by all
        )
        select o_custkey, cast(y as bigint) as year,
            case when (o_custkey + y) % 6 = 0 then null else cast(cents as double) / cast(100 as double) end as value
        from yearly
        where y between {WINDOW[0] + 2} and {WINDOW[1]}
            and not (o_custkey % 50 = 49 and o_custkey in (select o_custkey from yearly where y = 1997))
    """,
    "parse_shares": _RANKED,
    "share_slots": f"""
        with ranked as ({_RANKED})
        select o.o_orderkey, {", ".join(
            f'max(name) filter (where rank = {i}) as "Religion {i} Name", '
            f'max(pct) filter (where rank = {i}) as "Religion {i} Percentage"' for i in range(1, 6))}
        from orders o left join ranked on o.o_orderkey = ranked.o_orderkey group by o.o_orderkey
    """,
}
