"""The whole flows on sources that are derived from the driver tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierkit.catalog.common import AS_OF, WINDOW, YEARS, cents, grouped, money, table, text, whole
from dossierkit.functions.shares import RELIGION_RULES
from dossierkit.operators.counts import Counts
from dossierkit.plans import country_profile as profile
from dossierkit.plans import strength_matrix as strength
from dossierkit.sources.dims import DETAIL_LABELS, INDICATORS, METRIC_NAMES, country_dim
from dossierkit.sources.sinks import complete_exports, read_csv, shared_folder, staged, write_csv

# Customers stand for countries: every source grows with the customer and order tables.
_K = "c_custkey"
_BAL = f"abs({cents('c_acctbal')})"
_HUNDRED = "cast(100 as double)"


def _number(c: str) -> str:
    return f"cast({c} as double)"


def _share(c: str) -> str:
    return f"{_number(c)} / {_HUNDRED}"


# Column -> (cell text, number that the text must become).
_POPULATION = {
    "Population (Worldometer)": (grouped(f"({_K} + 1000)"), _number(f"{_K} + 1000")),
    "Yearly Change %": (f"{money(f'({_K} % 500)')} || ' %'", _share(f"{_K} % 500")),
    "Net Change": (f"'-' || {grouped(f'({_K} + 1)')}", f"-{_number(f'{_K} + 1')}"),
    "Density (P/Km²)": (text(f"{_K} % 900"), _number(f"{_K} % 900")),
    "Land Area (Km²)": (f"{grouped(whole(_BAL))} || ' <sup>km</sup>'", _number(whole(_BAL))),
    "Migrants (net)": (
        f"case when {_K} % 2 = 0 then 'N.A.' else {text(_K)} end",
        f"case when {_K} % 2 = 1 then {_number(_K)} end",
    ),
    "Fertility Rate": (money(f"({_K} % 700)"), _share(f"{_K} % 700")),
    "Median Age": (text(f"{_K} % 90"), _number(f"{_K} % 90")),
    "Urban Pop %": (f"{text(f'{_K} % 100')} || ' %'", _number(f"{_K} % 100")),
    "World Share %": (f"{money(f'({_K} % 2000)')} || '%'", _share(f"{_K} % 2000")),
}
_LIFE = {
    "Life Expectancy (both)": (money(f"(6000 + {_K} % 3000)"), _share(f"6000 + {_K} % 3000")),
    "Life Expectancy (female)": (money(f"(6100 + {_K} % 3000)"), _share(f"6100 + {_K} % 3000")),
    "Life Expectancy (male)": (money(f"(5900 + {_K} % 3000)"), _share(f"5900 + {_K} % 3000")),
}


def _cells(values) -> str:
    return " || ".join(f"'<td> ' || {v} || '</td>'" for v in values)


def _obj(**fields: str) -> str:
    """JSON object text out of field name -> expression of the field's JSON text."""
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in fields.items()) + " || '}'"


def _quoted(c: str) -> str:
    return f"'\"' || {c} || '\"'"


def _text_of(c: str) -> str:
    return _obj(text=_quoted(c))


_RELIGIONS = (
    f"'Muslim ' || {text(f'{_K} % 61')} || '.5%, Roman Catholic ' || {text(f'{_K} % 29')} || "
    f"'% (2020 est.); other ' || {text(f'{_K} % 7')} || '%, folk religion 0.25 %'"
)
# Column -> (field text, number that the text must become).
_FACTBOOK = {
    "Population (Factbook)": (f"{grouped(f'({_K} + 5)')} || ' (July 2023 est.)'", _number(f"{_K} + 5")),
    "Population Growth Rate (Factbook)": (f"'-' || {money(f'({_K} % 300)')} || '%'", f"-{_share(f'{_K} % 300')}"),
    "Age Structure 0-14% (Factbook)": (f"{text(f'{_K} % 40')} || '% (male 1)'", _number(f"{_K} % 40")),
    "Age Structure 15-64% (Factbook)": (f"{text(f'{_K} % 60')} || '%'", _number(f"{_K} % 60")),
    "Unemployment Rate (Factbook)": (f"{text(f'{_K} % 30')} || '% (2022)'", _number(f"{_K} % 30")),
    "GDP (PPP) (Factbook)": (f"'$' || {money(_BAL)} || ' trillion'", _share(_BAL)),
    "GDP (Official Exchange Rate) (Factbook)": (f"'$' || {grouped(whole(_BAL))}", _number(whole(_BAL))),
    "GDP Comp. - Agriculture % (Factbook)": (f"{text(f'{_K} % 50')} || '%'", _number(f"{_K} % 50")),
    "GDP Comp. - Services % (Factbook)": (f"{text(f'{_K} % 70')} || '%'", _number(f"{_K} % 70")),
}


def _fact(name: str) -> str:
    return _text_of(_FACTBOOK[f"{name} (Factbook)"][0])


_PPP = "Real GDP (purchasing power parity)"
_BODY = _obj(
    **{
        "Government": _obj(**{"Country name": _obj(**{"conventional short form": _text_of("c_name")})}),
        "People and Society": _obj(
            **{
                "Population": _obj(total=_fact("Population"), male=_text_of("'3'")),
                "Population growth rate": _fact("Population Growth Rate"),
                "Religions": _text_of(_RELIGIONS),
                "Age structure": _obj(
                    **{
                        "0-14 years": _fact("Age Structure 0-14%"),
                        "15-64 years": _quoted(_FACTBOOK["Age Structure 15-64% (Factbook)"][0]),
                    }
                ),
            }
        ),
        "Economy": _obj(
            **{
                "Unemployment rate": _fact("Unemployment Rate"),
                _PPP: _obj(**{f"{_PPP} 2021": _text_of("'$1'"), f"{_PPP} 2023": _fact("GDP (PPP)"), "note": "'7'"}),
                "GDP (official exchange rate)": _fact("GDP (Official Exchange Rate)"),
                "GDP - composition, by sector of origin": _obj(
                    agriculture=_fact("GDP Comp. - Agriculture %"), services=_fact("GDP Comp. - Services %")
                ),
            }
        ),
    }
)

_CURRENCY_PAGE = (
    "'<table class=\"wikitable\"><tr>"
    + "".join(f"<th>{h}</th>" for h in profile.CURRENCY_HEADERS)
    + "</tr><tr><td>The ' || c_name || '[a]</td><td>Old</td><td>o</td><td>OLD</td></tr><tr><td>Isle ' || "
    f"{text(_K)} || ' and ' || c_name || '[b]</td><td>' || c_mktsegment || ' &amp; Co</td><td>$</td><td>' || "
    f"substr(c_mktsegment, 1, 3) || '</td></tr></table>'"
)
_POPULATION_PAGE = (
    "case when c_custkey % 3 = 0 then '<table class=\"x\"><thead><tr>"
    + "".join(f"<th>{h}</th>" for h in profile.POPULATION_HEADERS)
    + "</tr></thead>' else '<table id=\"main_table_countries_today\">' end || '<tbody><tr><td>1</td><td> ' || c_name || ' </td>' || "
    + _cells(v[0] for v in _POPULATION.values())
    + " || '</tr><tr><td>2</td><td>short</td></tr></tbody></table>'"
)
_LIFE_PAGE = (
    "'<table class=\"table table-striped\"><tbody><tr><td>#</td><td>' || c_name || '</td><td>0</td><td>0</td><td>0</td></tr>"
    "<tr><td>1</td><td>' || c_name || '</td>' || " + _cells(v[0] for v in _LIFE.values()) + " || '</tr></tbody></table>'"
)
# Three indicators have data; one of them never answers with 200, and one was fetched twice.
_PAYLOADS = [
    ("NY.GDP.MKTP.CD", 200, 1, "value"),
    ("SP.POP.TOTL", 200, 1, "n"),
    ("SP.POP.TOTL", 200, 0, "older"),
    ("SL.UEM.TOTL.ZS", 500, 1, "n"),
]


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads per customer and indicator; orders are cut to one row per customer and year first."""
    yearly = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("y"))
        .agg(F.sum(F.expr(cents("o_totalprice"))).alias("cents"), F.count(F.lit(1)).alias("n"))
    )
    date = f"""'{{"date":"' || {text('y')} || '","value":' || """
    entries = F.array_sort(
        F.collect_list(
            F.struct(
                "y",
                F.expr(f"{date} case when n % 4 = 3 then 'null' else {money('cents')} end || '}}'").alias("value"),
                F.expr(f"{date} {text('n')} || '}}'").alias("n"),
                F.expr(f"{date} {text('n + 9')} || '}}'").alias("older"),
            )
        )
    )

    def body(field: str):
        rows = F.array_join(F.transform("entries", lambda e: e[field]), ",")
        return F.concat(F.lit('[{"page":1},['), rows, F.lit("]]"))

    landed = F.array(
        *[
            F.struct(
                F.lit(code).alias("indicator"), F.lit(status).alias("status"), F.lit(ordinal).alias("ordinal"), body(field).alias("body")
            )
            for code, status, ordinal, field in _PAYLOADS
        ]
    )
    per_customer = yearly.groupBy("o_custkey").agg(entries.alias("entries"))
    return per_customer.select(F.expr(f"'C' || {text('o_custkey')}").alias("country_code"), F.inline(landed))


def landed_sources(spark: SparkSession, sf_dir: str) -> profile.Landed:
    customer = table(spark, sf_dir, "customer", "c_custkey")
    spine = customer.select(
        F.expr(f"case when {_K} % 97 = 0 then '' else c_name end").alias("Country"),
        F.expr("substr(c_mktsegment, 1, 2)").alias("Alpha-2"),
        F.expr(f"'C' || {text(_K)}").alias("Alpha-3"),
        F.expr(f"lpad({text(_K)}, 9, '0')").alias("Numeric Code"),
    )

    def page(url: str, html: str, missing: str) -> DataFrame:
        """A page, and a later fetch of it that failed. As parts of their own: who asks for a page does not make the others."""
        shown = F.expr(f"case when {missing} then '<p>no table</p>' else {html} end")
        failed = F.expr(f"replace({html}, '<td>', '<td>9')")
        first = customer.select(F.lit(url).alias("url"), F.lit(200).alias("status"), F.col(_K).alias("ordinal"), shown.alias("html"))
        return first.union(customer.select(F.lit(url).alias("url"), F.lit(404).alias("status"), (F.col(_K) + 10**9).alias("ordinal"), failed.alias("html")))

    pages = page(profile.CURRENCY_URL, _CURRENCY_PAGE, f"{_K} % 5 = 0")
    pages = pages.union(page(profile.POPULATION_URL, _POPULATION_PAGE, f"{_K} % 7 = 0"))
    pages = pages.union(page(profile.LIFE_URL, _LIFE_PAGE, f"{_K} % 4 = 0"))
    tries = customer.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("region_no"))
    log = tries.select(
        F.expr(f"'C' || {text(_K)}").alias("code"),
        "region_no",
        F.expr(f"case when {_K} % 6 = 5 or (region_no = 0 and {_K} % 2 = 0) then 404 else 200 end").alias("status"),
        F.expr(f"case when {_K} % 11 = 0 then '{{oops' else {_BODY} end").alias("body"),
    )
    return profile.landed_pages(spine, pages, _payloads(spark, sf_dir), log)


def country_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as countries, through the whole flow: 101 columns."""
    return profile.profile_table(profile.country_profile(landed_sources(spark, sf_dir), AS_OF))


def profile_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile exported as CSV and JSON, and the CSV read back; the countries come out of a CSV file."""
    landed = landed_sources(spark, sf_dir)
    path = shared_folder(spark, "profile")
    write_csv(landed.spine, f"{path}/countries", landed.spine.columns)
    landed = replace(landed, spine=country_dim(spark, f"{path}/countries"))
    done = profile.export_profile(landed, AS_OF, f"{path}/exports")
    return profile.exported_table(spark, done, AS_OF)


def profile_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The religion texts and shares of the profile's last export, read back from its JSON."""
    folder = shared_folder(spark, "profile-json")
    profile.export_profile(landed_sources(spark, sf_dir), AS_OF, folder)
    path = complete_exports(spark, folder)[-1].path("json")
    back = spark.read.schema("`Country` string, `Religions (Factbook)` string, `Religions Parsed` map<string,double>").json(path)
    shares = F.map_entries("`Religions Parsed`")
    return back.select(
        F.col("Country").alias("country"),
        F.col("`Religions (Factbook)`").alias("religions"),
        F.array_join(F.transform(shares, lambda e: F.concat_ws("=", e["key"], F.format_number(e["value"], 2))), ";").alias("shares"),
    )


def source_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads, records and countries of the profile and how many could not be used, counted by the pass that builds it."""
    counts = Counts()
    built = profile.country_profile(landed_sources(spark, sf_dir), AS_OF, counts)
    staged(counts.watched(built, profile.COUNTRIES, bad=F.col(f"`{profile.FACTBOOK_NAME}`").isNull()))
    return counts.table(spark)


def _shares_sql() -> str:
    """Shares of each customer, greatest first."""
    group = {name: i for i, name in enumerate(RELIGION_RULES)}
    return f"""
        entries as (
            select c_custkey as id, unnest([
                {{'grp': {group['Catholic']}, 'name': 'Catholic', 'pct': cast(c_custkey % 29 as double)}},
                {{'grp': {group['Muslim']}, 'name': 'Muslim', 'pct': c_custkey % 61 + cast(0.5 as double)}},
                {{'grp': {group['Folk Religion']}, 'name': 'Folk Religion', 'pct': cast(0.25 as double)}},
                {{'grp': {group['Other']}, 'name': 'Other', 'pct': cast(c_custkey % 7 as double)}}], recursive := true)
            from customer where {_KNOWN}
        ), ranked as (
            select *, row_number() over (partition by id order by pct desc, grp) as rank from entries where pct > 0.01
        )"""


# Customers whose factbook record was found and can be read.
_KNOWN = "(c_custkey % 6 <> 5 and c_custkey % 11 <> 0)"


def _profile_sql() -> str:
    columns = {
        "Country": "c_name",
        "Alpha-2": "substr(c_mktsegment, 1, 2)",
        "Alpha-3": "'C' || cast(c_custkey as varchar)",
        "Numeric Code": "lpad(cast(c_custkey as varchar), 9, '0')",
        "Currency Name": "case when c_custkey % 5 = 0 then 'N/A' else c_mktsegment || ' & Co' end",
        "Currency Symbol": "case when c_custkey % 5 = 0 then 'N/A' else '$' end",
        "ISO Code": "case when c_custkey % 5 = 0 then 'N/A' else substr(c_mktsegment, 1, 3) end",
    }
    yearly = {
        "GDP (Current US$)": f"max(case when n % 4 = 3 then null else {_share('cents')} end)",
        "Population WB": "max(cast(n as double))",
    }
    for name in INDICATORS.values():
        for y in YEARS:
            known = name in yearly
            columns[f"{name} {y}"] = f'"{name} {y}"' if known else "cast(null as double)"
    sums = ", ".join(f'{sql} filter (where y = {y}) as "{name} {y}"' for name, sql in yearly.items() for y in YEARS)
    for name, (_, number) in _POPULATION.items():
        columns[name] = f"case when c_custkey % 7 <> 0 then {number} end"
    for name, (_, number) in _LIFE.items():
        columns[name] = f"case when c_custkey % 4 <> 0 then {number} end"
    known = _KNOWN
    columns[profile.FACTBOOK_NAME] = f"case when {known} then c_name end"
    for name in profile.FACTBOOK:
        number = _FACTBOOK.get(name, ("", "cast(null as double)"))[1]
        columns[name] = f"case when {known} then {number} end"
    for i in range(1, 6):
        columns[f"Religion {i} Name"] = f"shares.name{i}"
        columns[f"Religion {i} Percentage"] = f"shares.pct{i}"
    slots = ", ".join(
        f"max(name) filter (where rank = {i}) as name{i}, max(pct) filter (where rank = {i}) as pct{i}" for i in range(1, 6)
    )
    return f"""
        with yearly as (
            select o_custkey, year(o_orderdate) as y, sum({cents('o_totalprice')}) as cents, count(*) as n
            from orders where year(o_orderdate) between {WINDOW[0]} and {WINDOW[1]} group by all
        ), indicators as (select o_custkey, {sums} from yearly group by o_custkey),
        {_shares_sql()}, shares as (select id, {slots} from ranked group by id)
        select {", ".join(f'{sql} as "{name}"' for name, sql in columns.items())}
        from customer
        left join indicators on o_custkey = c_custkey
        left join shares on id = c_custkey
        where c_custkey % 97 <> 0
    """


# A metric page per customer, a detail page per supplier; some values are no numbers.
_WHOLE = whole(_BAL)
_RAW = (
    f"case c_custkey % 6 when 0 then {grouped(_WHOLE)} when 1 then '$' || {text(_WHOLE)} || ' Billion' "
    f"when 2 then {text(_WHOLE)} || '%' when 3 then {text(_WHOLE)} || ' km' when 4 then '-' || {text(_WHOLE)} else '' end"
)
_METRIC_PAGE = (
    "'<a href=\"/countries.php\">x</a><a class=\"b\" href=\"country-military-strength-detail.php?id=' || n_name || '\">"
    "<div class=\"longFormName\"><span> ' || n_name || ' </span></div><div class=\"shortFormName\"><span>N</span></div>"
    f"<div class=\"valueContainer\"><span>#1</span><span> ' || {_RAW} || ' </span></div></a>"
    "<a href=\"country-military-strength-detail.php\"><div class=\"valueContainer\">5</div></a>'"
)
_SUPPLIER_WHOLE = whole(f"abs({cents('s_acctbal')})")
_DETAIL_PAGE = " || ".join(
    f"case when s_suppkey % 9 = {i} then '' else '<div class=\"specsGenContainers\"><div><span>"
    f"{label.replace(chr(92), '')}</span></div><div><span class=\"textWhite textShadow\">' || "
    f"{grouped(f'({_SUPPLIER_WHOLE} + {i})')} || '</span></div></div>' end"
    for i, label in enumerate(DETAIL_LABELS.values())
)


def strength_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations by 50 metrics and 9 detail fields, from a page per customer and per supplier."""
    nation = table(spark, sf_dir, "nation")
    names = F.array(*[F.lit(m) for m in METRIC_NAMES])
    metric_pages = (
        table(spark, sf_dir, "customer", "c_custkey")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.get(names, (F.col("c_custkey") % len(METRIC_NAMES)).cast("int")).alias("metric"),
            F.col("c_custkey").alias("ordinal"),
            F.expr(_METRIC_PAGE).alias("html"),
        )
    )
    detail_pages = (
        table(spark, sf_dir, "supplier", "s_suppkey")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("country"), F.col("s_suppkey").alias("ordinal"), F.expr(_DETAIL_PAGE).alias("html"))
    )
    return strength.strength_matrix(metric_pages, detail_pages)


def _matrix_sql() -> str:
    """The chain of full outer joins that the one aggregate stands for."""
    value = (
        f"case c_custkey % 6 when 0 then {_number(_WHOLE)} when 1 then {_number(_WHOLE)} * 1e9 "
        f"when 2 then {_share(_WHOLE)} when 3 then {_number(_WHOLE)} end"
    )
    tables = [
        f"(select n_name as \"Country\", arg_max({{'v': {value}}}, c_custkey).v as \"{m}\" from customer "
        f"join nation on c_nationkey = n_nationkey where c_custkey % {len(METRIC_NAMES)} = {i} group by 1)"
        for i, m in enumerate(METRIC_NAMES)
    ] + [
        f"(select n_name as \"Country\", cast(arg_max({_SUPPLIER_WHOLE} + {i}, s_suppkey) as double) as \"{m}\" from supplier "
        f"join nation on s_nationkey = n_nationkey where s_suppkey % 9 <> {i} group by 1)"
        for i, m in enumerate(DETAIL_LABELS)
    ]
    return "select * from " + " full join ".join(
        t if i == 0 else f'{t} using ("Country")' for i, t in enumerate(tables)
    )


SITE = "https://h.example/"


def site_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same matrix out of one table of a whole site's pages, written as CSV and read back.

    Each page has a later fetch that failed; the listing page has a block per nation.
    """
    nation = table(spark, sf_dir, "nation")
    requests = strength.metric_requests(spark, SITE)
    names = F.array(*[F.lit(m) for m in METRIC_NAMES])
    customer = table(spark, sf_dir, "customer", "c_custkey").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    named = customer.withColumn("metric", F.get(names, (F.col("c_custkey") % len(METRIC_NAMES)).cast("int")))
    metric_pages = named.join(F.broadcast(requests), "metric").select("url", F.col("c_custkey").alias("ordinal"), F.expr(_METRIC_PAGE).alias("html"))
    block = (
        "'<a href=\"country-military-strength-detail.php?id=' || n_name || '\"><div class=\"longFormName\"><span>' || n_name || "
        "'</span></div><div class=\"valueContainer\"></div></a>'"
    )
    listing = nation.select(
        F.lit(SITE + strength.LISTING).alias("url"), F.col("n_nationkey").cast("bigint").alias("ordinal"), F.expr(block).alias("html")
    )
    supplier = table(spark, sf_dir, "supplier", "s_suppkey").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    details = supplier.select(
        F.concat(F.lit(f"{SITE}country-military-strength-detail.php?id="), "n_name").alias("url"), F.col("s_suppkey").alias("ordinal"), F.expr(_DETAIL_PAGE).alias("html")
    )
    pages = metric_pages.unionByName(listing).unionByName(details)
    failed = F.struct(F.lit(500).alias("status"), (F.col("ordinal") + 10**9).alias("ordinal"), F.expr("replace(html, '1', '2')").alias("html"))
    both = pages.select("url", F.inline(F.array(F.struct(F.lit(200).alias("status"), "ordinal", "html"), failed)))
    matrix = strength.matrix_of_pages(both, SITE)
    path = shared_folder(spark, "matrix")
    write_csv(matrix, path, matrix.columns)
    return read_csv(spark, path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in matrix.schema.fields))


QUERIES = {
    "country_profile": country_profile,
    "strength_matrix": strength_matrix,
    "profile_export": profile_export,
    "profile_json": profile_json,
    "source_report": source_report,
    "site_matrix": site_matrix,
}

ORACLE = {
    "country_profile": _profile_sql(),
    "strength_matrix": _matrix_sql(),
    "profile_export": _profile_sql(),
    "profile_json": f"""
        with {_shares_sql()},
        shares as (select id, string_agg(name || '=' || printf('%.2f', pct), ';' order by rank) as shares from ranked group by id)
        select c_name as country, case when {_KNOWN} then 'Muslim ' || cast(c_custkey % 61 as varchar) || '.5%, Roman Catholic '
                   || cast(c_custkey % 29 as varchar) || '% (2020 est.); other ' || cast(c_custkey % 7 as varchar)
                   || '%, folk religion 0.25 %' end as religions, coalesce(shares, '') as shares
        from customer left join shares on id = c_custkey where c_custkey % 97 <> 0
    """,
    "source_report": """
        with payloads as (select count(distinct o_custkey) as n from orders),
        records as (select c_custkey % 11 = 0 as bad from customer where c_custkey % 6 <> 5)
        select 'indicator payloads' as source, cast(3 * n as bigint) as n, cast(0 as bigint) as n_bad from payloads
        union all select 'factbook records', count(*), count(*) filter (where bad) from records
        union all select 'countries', count(*), count(*) filter (where c_custkey % 6 = 5 or c_custkey % 11 = 0)
            from customer where c_custkey % 97 <> 0
    """,
    "site_matrix": _matrix_sql(),
}
