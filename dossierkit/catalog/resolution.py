"""Keys, joins, merges, pivots and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierkit.catalog.common import AS_OF, TABLES, WINDOW, YEARS, cents, money, table, text
from dossierkit.functions.text import country_key, in_window
from dossierkit.operators import resolve, shape, state
from dossierkit.operators.counts import load_counts as count_tables
from dossierkit.plans import country_profile as profile
from dossierkit.plans import maps
from dossierkit.sources.dims import INDICATORS, MAP_EXTENSIONS, MAP_TYPES, REGIONS
from dossierkit.sources.landed import BY_PARTITION, checked_assets, fetched
from dossierkit.sources.sinks import shared_folder, write_files


def indicator_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value per nation and year. Orders are cut to one row per customer before any join."""
    orders = table(spark, sf_dir, "orders").filter(in_window("o_orderdate", WINDOW))
    per_customer = shape.year_sums(orders, "o_custkey", "o_orderdate", cents("o_totalprice"), "Order Value", YEARS)
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    names = [f"Order Value {y}" for y in YEARS]
    per_nation = (
        per_customer.join(customer, "o_custkey").groupBy("c_nationkey").agg(*[F.sum(f"`{n}`").alias(n) for n in names])
    )
    spine = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    joined = spine.join(per_nation, "c_nationkey", "left")
    return joined.select("country", *[(F.col(f"`{n}`").cast("double") / 100).alias(n) for n in names])


_YEAR_SUMS = ", ".join(
    f"cast(sum({cents('o_totalprice')}) filter (where year(o_orderdate) = {y}) as double) / cast(100 as double)"
    f' as "Order Value {y}"'
    for y in YEARS
)

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def indicator_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last order value per customer, priority and year, as one pivot."""
    long = (
        table(spark, sf_dir, "orders")
        .filter(in_window("o_orderdate", WINDOW))
        .select(
            "o_custkey",
            F.col("o_orderpriority").alias("indicator"),
            F.year("o_orderdate").alias("year"),
            F.col("o_totalprice").alias("value"),
            F.col("o_orderkey").alias("pos"),
        )
    )
    return shape.indicator_pivot(long, ["o_custkey"], PRIORITIES, YEARS, ordinal="pos")


_LATEST = ", ".join(
    f"arg_max(o_totalprice, o_orderkey) filter (where o_orderpriority = '{p}' and year(o_orderdate) = {y})"
    f' as "{p} {y}"'
    for p in PRIORITIES
    for y in YEARS
)


def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    rows = events.withColumn("order", F.col("event_id"))
    return resolve.last_wins(rows, ["user_id"], ["ts", "order"])


def first_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First map file that exists, per customer and map type; misses stay with nulls."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"))
    tried = resolve.candidates(customer, ("map_type", MAP_TYPES), ("extension", MAP_EXTENSIONS))
    urls = resolve.candidate_urls(tried, "/img/maps/%s_%s_map.%s", "entity", "map_type", "extension")
    status = F.expr("case when (entity * 7 + map_type_no * 3 + extension_no * 5) % 4 = 0 then 200 else 404 end")
    log = urls.withColumn("status", status).drop("map_type_no")
    found = resolve.first_available(log, ["entity", "map_type"], ["extension_no"], fetched(F.col("status")))
    return found.select("entity", "map_type", "extension", "url")


def map_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as countries: map requests against a fetch log that knows half of them."""
    customer = table(spark, sf_dir, "customer", "c_custkey")
    requests = maps.map_requests(customer.select(F.expr("replace(c_name, '#', ' ')").alias("country")))
    stem = "'https://srv1.worldometers.info/img/maps/' || lower(replace(c_name, '#', '-')) || "
    log = customer.select(
        F.inline(
            F.expr(
                f"""array(
                    struct({stem} '_physical_map.gif' AS url, if(c_custkey % 3 = 0, 200, 404) AS status),
                    struct({stem} '_physical_map.png' AS url, if(c_custkey % 2 = 0, 200, 500) AS status),
                    struct({stem} '_political_map.png' AS url, 200 AS status))"""
            )
        )
    )
    return maps.map_files(requests, log)


def distinct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.split("p_name", " ").alias("codes"))
    return resolve.distinct_codes(part, "codes")


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tables({name: table(spark, sf_dir, name) for name in TABLES})


# A customer's nation in five spellings; the last hits nothing.
_SPELLING = (
    "case c_custkey % 5 when 0 then n_name when 1 then '  ' || lower(n_name) || ' ' "
    f"when 2 then 'Republic of ' || n_name when 3 then 'N-' || {text('n_nationkey')} else 'Nowhere' end"
)


def alias_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region of a customer by a nation name in varying spelling: alias, raw key, short form, 'N/A'.

    Every third customer is there twice, and every seventh has no name.
    """
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    named = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    twice = F.explode(F.expr("if(c_custkey % 3 = 0, array(1, 2), array(1))")).alias("_copy")
    raw = F.expr(f"if(c_custkey % 7 = 0, null, {country_key(_SPELLING)})").alias("raw")
    spine = named.select("c_custkey", raw, twice).drop("_copy")
    aliases = nation.select(
        F.expr(f"'n-' || {text('n_nationkey')}").alias("alias"), F.lower("n_name").alias("target")
    )
    matched = resolve.alias_join(spine.withColumn("match", F.col("raw")), "match", aliases, "alias", "target", ["c_custkey"])
    regions = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.lower("n_name").alias("key"), "n_nationkey", "r_name"
    )
    keys = [F.col("match"), F.col("raw"), F.regexp_replace("raw", "^republic of ", "")]
    found = resolve.enrich(matched, keys, {"nation": resolve.Source(regions, "key", 3)})
    return found.select(
        "c_custkey",
        F.col("nation.n_nationkey").cast("bigint").alias("nationkey"),
        F.coalesce("nation.r_name", F.lit("N/A")).alias("region"),
    )


def outer_join_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances of customers against those of suppliers, by nation and key; either side may be missing.

    A customer's key runs over three times a supplier's, so many keys are on one side only.
    """

    def balances(name: str, p: str, parts: int, key: str, out: str) -> DataFrame:
        nation = F.col(f"{p}_nationkey").cast("bigint") * 1000 + F.col(key) % parts
        sums = table(spark, sf_dir, name).groupBy(nation.alias("place")).agg(F.sum(F.expr(cents(f"{p}_acctbal"))).alias("total"))
        return sums.select("place", (F.col("total") / 100).alias(out))

    return shape.outer_join_pair(
        balances("customer", "c", 90, "c_custkey", "customer_total"), balances("supplier", "s", 120, "s_suppkey", "supplier_total"), "place"
    )


def _balance_sql(name: str, p: str, parts: int, key: str, out: str) -> str:
    return (
        f"select cast({p}_nationkey as bigint) * 1000 + {key} % {parts} as place, "
        f"cast(sum({cents(f'{p}_acctbal')}) as double) / cast(100 as double) as {out} from {name} group by 1"
    )


# Amounts as text, some of them not numbers.
_AMOUNT = f"case when o_orderkey % 9 = 0 then 'n/a' else {money(cents('o_totalprice'))} end"
# Among them what a Java parser takes for numbers, and numbers between blanks.
_LITERAL = f"case o_orderkey % 11 when 0 then '12d' when 1 then '1.5f' when 2 then '0x1p3' when 3 then ' 7.5 ' when 4 then '-2e3' else {_AMOUNT} end"


def to_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    raw = orders.select(
        F.expr(text("o_orderkey")).alias("order"), F.expr(_LITERAL).alias("amount"), F.expr(text("o_custkey")).alias("customer")
    )
    return shape.to_numeric(raw, ["order"])


def clean_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column policy: names stay, all else becomes its first number; columns in declared order."""
    orders = table(spark, sf_dir, "orders")
    raw = orders.select(
        "o_orderpriority",
        F.expr(f"'$ ' || {_AMOUNT} || ' (est.)'").alias("amount"),
        F.col("o_custkey").alias("customer"),
        F.expr(text("o_orderkey")).alias("order"),
        F.expr("o_orderpriority || '%'").alias("priority"),
    )
    return shape.reconcile(shape.clean_columns(raw, ["order", "o_orderpriority"]), ["order", "absent", "amount"])


def indicator_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as countries: the URL of every indicator's payload."""
    codes = table(spark, sf_dir, "customer").select(F.expr(f"'C' || {text('c_custkey')}").alias("country_code"))
    return profile.indicator_requests(codes, AS_OF)


# Which region has a code's record, and a fetch that fails before.
_REGION = "c_custkey % 10"
_FAILED = "c_custkey % 4"


def factbook_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as codes: the first region that has a record; a third have none, others fail at first."""
    customer = table(spark, sf_dir, "customer")
    requests = profile.factbook_requests(customer.select(F.expr(f"'c' || {text('c_custkey')}").alias("code")))
    regions = F.array(*[F.lit(r) for r in REGIONS])
    url = F.format_string(profile.FACTBOOK_URL, F.col("region"), F.concat(F.lit("c"), "c_custkey"))
    tried = customer.select("c_custkey", F.posexplode(regions).alias("no", "region")).filter(f"no = {_REGION} OR no = {_FAILED}")
    status = F.expr(f"case when no = {_REGION} and c_custkey % 3 <> 0 then 200 else 404 end")
    found = profile.answers_of(requests, tried.select(url.alias("url"), status.alias("status")))
    first = resolve.first_available(found, ["code"], ["region_no"], fetched(F.col("status")))
    return first.select("code", "region", "url")


def settled_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as codes over two landings: what the first one settled is not tried again."""
    log = table(spark, sf_dir, "customer").selectExpr("concat('c', c_custkey) AS code", "c_custkey", "explode(array(0, 1)) AS landing")
    log = log.selectExpr("*", "explode(array(0, 1)) AS region_no")
    log = log.selectExpr("code", "landing", "region_no", "if((c_custkey + 3 * landing + region_no) % 4 = 0, 200, 404) AS status", "concat(landing, '/', region_no, '/', c_custkey) AS body")
    settled = state.State(spark, shared_folder(spark, "settled"), ("code",))
    for landing in (0, 1):
        found = state.settle(settled, log.filter(F.col("landing") == landing), ["landing", "region_no"], fetched(F.col("status")))
    return found.select("code", "landing", "region_no", "body")


def merged_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last price and last urgent status of each customer, merged out of two landings of orders."""
    orders = table(spark, sf_dir, "orders")
    cells = {"price": (F.lit(True), F.col("o_totalprice")), "urgent": (F.col("o_orderpriority") == PRIORITIES[0], F.col("o_orderstatus"))}
    merged = state.State(spark, shared_folder(spark, "cells"), ("o_custkey",))
    early = F.col("o_orderpriority") < PRIORITIES[2]
    for landing in (orders.filter(early), orders.filter(~early)):
        found = state.merge_cells(merged, state.cell_states(landing, ["o_custkey"], ["o_orderdate", "o_orderkey"], cells))
    return state.cell_values(found, ["o_custkey"])


# What files of suppliers begin with, as Latin-1 text: a GIF, a JPEG, a page in place of an image.
_CONTENTS = "case (s_suppkey + no) % 3 when 0 then 'GIF89a' when 1 then '\u00ff\u00d8\u00ff\u00e0' else 'html' end"


def asset_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image files of suppliers, some of them mislabelled, as the catalog finds them by name and content."""
    # A file each: making them is the work, so all cores make some.
    files = table(spark, sf_dir, "supplier", "s_suppkey").selectExpr("s_suppkey", "s_name", "posexplode(array('gif', 'jpg')) AS (no, extension)")
    files = files.selectExpr("s_name AS entity", "if(no = 0, 'physical', 'political') AS type", "extension", f"{_CONTENTS} AS content")
    path = shared_folder(spark, "assets")
    write_files(files, path, ["entity", "type", "extension"], "content")
    found = checked_assets(spark, path, BY_PARTITION)
    return found.select("entity", "type", "extension", "kind", "as_named")


QUERIES = {
    "asset_files": asset_files,
    "settled_landings": settled_landings,
    "merged_last_wins": merged_last_wins,
    "indicator_requests": indicator_requests,
    "factbook_files": factbook_files,
    "indicator_pivot": indicator_pivot,
    "indicator_latest": indicator_latest,
    "last_wins": last_wins,
    "first_available": first_available,
    "map_files": map_files,
    "distinct_codes": distinct_codes,
    "load_counts": load_counts,
    "alias_join": alias_join,
    "outer_join_pair": outer_join_pair,
    "to_numeric": to_numeric,
    "clean_columns": clean_columns,
}

_FACTBOOK = "https://raw.githubusercontent.com/factbook/factbook.json/master/"
ORACLE = {
    "indicator_requests": f"""
        select 'C' || cast(c_custkey as varchar) as country_code, indicator,
               'http://api.worldbank.org/v2/country/C' || cast(c_custkey as varchar) || '/indicator/' || indicator
                   || '?format=json&date={WINDOW[0] - 1}:{WINDOW[1]}&per_page=100' as url
        from customer, (values {", ".join(f"('{i}')" for i in INDICATORS)}) as t(indicator)
    """,
    "factbook_files": f"""
        with regions as (select unnest([{", ".join(f"'{r}'" for r in REGIONS)}]) as region, unnest(range(10)) as no),
        found as (select 'c' || cast(c_custkey as varchar) as code, case when c_custkey % 3 <> 0 then {_REGION} end as no from customer)
        select code, region, case when region is not null then '{_FACTBOOK}' || region || '/' || code || '.json' end as url
        from found left join regions using (no)
    """,
    "indicator_pivot": f"""
        with sums as (
            select c_nationkey, {_YEAR_SUMS}
            from orders join customer on o_custkey = c_custkey
            group by c_nationkey
        )
        select n_name as country, {", ".join(f'"Order Value {y}"' for y in YEARS)}
        from nation left join sums on n_nationkey = c_nationkey
    """,
    "indicator_latest": f"""
        select o_custkey, {_LATEST} from orders
        where year(o_orderdate) between {WINDOW[0]} and {WINDOW[1]} group by o_custkey
    """,
    "last_wins": """
        select user_id, event_id, event_type, value, props from (
            select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events
        ) where n = 1
    """,
    "first_available": """
        with tried as (
            select c_custkey as entity, t.map_type, x.extension, x.extension_no,
                   case when (c_custkey * 7 + t.map_type_no * 3 + x.extension_no * 5) % 4 = 0 then 200 else 404 end as status
            from customer
            cross join (values (0, 'physical'), (1, 'political')) as t(map_type_no, map_type)
            cross join (values (0, 'gif'), (1, 'png')) as x(extension_no, extension)
        ), ranked as (
            select *, row_number() over (partition by entity, map_type order by extension_no) as n
            from tried where status = 200
        ), keys as (select distinct entity, map_type from tried)
        select keys.entity, keys.map_type, extension,
               '/img/maps/' || cast(ranked.entity as varchar) || '_' || ranked.map_type || '_map.' || extension as url
        from keys left join ranked on keys.entity = ranked.entity and keys.map_type = ranked.map_type and n = 1
    """,
    "map_files": """
        with found as (
            select replace(c_name, '#', ' ') as country, map_type, case when map_type = 'political' then 'png'
                when c_custkey % 3 = 0 then 'gif' when c_custkey % 2 = 0 then 'png' end as extension
            from customer, (values ('physical'), ('political')) as t(map_type)
        )
        select country, map_type, extension,
            'https://srv1.worldometers.info/img/maps/' || lower(replace(country, ' ', '-')) || '_' || map_type
                || '_map.' || extension as url,
            'country_maps/' || country || '/' || country || '_' || map_type || '_map.' || extension as path
        from found
    """,
    "distinct_codes": "select distinct unnest(string_split(p_name, ' ')) as code from part",
    "asset_files": """
        with files as (
            select s_name as entity, type, extension, case (s_suppkey + no) % 3 when 0 then 'gif' when 1 then 'jpg' end as kind
            from supplier, (values (0, 'physical', 'gif'), (1, 'political', 'jpg')) f(no, type, extension))
        select *, coalesce(kind = extension, false) as as_named from files
    """,
    "settled_landings": """
        select 'c' || cast(c_custkey as varchar) as code, landing, region_no,
            cast(landing as varchar) || '/' || cast(region_no as varchar) || '/' || cast(c_custkey as varchar) as body
        from customer, (values (0), (1)) l(landing), (values (0), (1)) r(region_no) where (c_custkey + 3 * landing + region_no) % 4 = 0
        qualify row_number() over (partition by c_custkey order by landing, region_no) = 1
    """,
    "merged_last_wins": f"""
        select o_custkey, arg_max(o_totalprice, {{'d': o_orderdate, 'k': o_orderkey}}) as price,
            arg_max(o_orderstatus, {{'d': o_orderdate, 'k': o_orderkey}}) filter (where o_orderpriority = '{PRIORITIES[0]}') as urgent
        from orders group by o_custkey
    """,
    "load_counts": " union all ".join(f"select '{t}' as source, count(*) as n from {t}" for t in TABLES),
    "alias_join": f"""
        with spine as (
            select c_custkey, case when c_custkey % 7 <> 0 then trim(lower({_SPELLING})) end as raw
            from customer join nation on c_nationkey = n_nationkey, (values (1), (2)) as t(copy)
            where copy = 1 or c_custkey % 3 = 0
        ), target as (
            select lower(n_name) as key, n_nationkey, r_name from nation join region on n_regionkey = r_regionkey
        )
        select c_custkey, cast(coalesce(m.n_nationkey, r.n_nationkey, s.n_nationkey) as bigint) as nationkey,
               coalesce(m.r_name, r.r_name, s.r_name, 'N/A') as region
        from spine
        left join target m on spine.raw = 'n-' || cast(m.n_nationkey as varchar)
        left join target r on spine.raw = r.key
        left join target s on regexp_replace(spine.raw, '^republic of ', '') = s.key
    """,
    "outer_join_pair": f"""
        with a as ({_balance_sql("customer", "c", 90, "c_custkey", "customer_total")}),
             b as ({_balance_sql("supplier", "s", 120, "s_suppkey", "supplier_total")})
        select place, customer_total, supplier_total from a full join b using (place)
    """,
    "to_numeric": f"""
        select cast(o_orderkey as varchar) as "order", case o_orderkey % 11 when 0 then null when 1 then null when 2 then null
                   when 3 then cast(7.5 as double) when 4 then cast(-2000 as double) else try_cast({_AMOUNT} as double) end as amount,
               cast(o_custkey as double) as customer from orders
    """,
    "clean_columns": f"""
        select cast(o_orderkey as varchar) as "order", try_cast({_AMOUNT} as double) as amount,
               cast(o_custkey as double) as customer, o_orderpriority,
               cast(substr(o_orderpriority, 1, 1) as double) as priority from orders
    """,
}
