"""Five landed sources to one wide row per country."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierkit.functions.shares import SLOTS, parse_shares, share_slots, shares_map
from dossierkit.functions.sqltext import col, cols, name
from dossierkit.functions.text import country_key, first_text, lookup, normalise_name, year_window
from dossierkit.operators.counts import Counts
from dossierkit.operators.extract import html_table_rows
from dossierkit.operators.records import BAD_RECORD, json_fields, json_text, latest_year_text, payload_points, payload_rows
from dossierkit.operators.resolve import Source, candidate_urls, candidates, distinct_codes, enrich, explode_entities, first_available, last_wins
from dossierkit.operators.shape import clean_columns, has_name, indicator_pivot
from dossierkit.sources.dims import (
    CODE_OVERRIDES,
    CURRENCY_ALIASES,
    FACTBOOK_ALIASES,
    INDICATORS,
    MATCH_ALIASES,
    PAGE_ALIASES,
    REGIONS,
)
from dossierkit.sources.landed import fetched, fetched_pages
from dossierkit.sources.sinks import Export, export, read_csv, write_csv, write_json

# Columns of the profile, and the headers that mark the source tables.
IDENTITY = ["Country", "Alpha-2", "Alpha-3", "Numeric Code"]
CURRENCY = ["Currency Name", "Currency Symbol", "ISO Code"]
POPULATION = [
    "Population (Worldometer)",
    "Yearly Change %",
    "Net Change",
    "Density (P/Km²)",
    "Land Area (Km²)",
    "Migrants (net)",
    "Fertility Rate",
    "Median Age",
    "Urban Pop %",
    "World Share %",
]
LIFE = ["Life Expectancy (both)", "Life Expectancy (female)", "Life Expectancy (male)"]
FACTBOOK_NAME = "Factbook Country Name"
RELIGIONS = "Religions (Factbook)"
RELIGIONS_PARSED = "Religions Parsed"
FACTBOOK = [
    "Population (Factbook)",
    "Population Growth Rate (Factbook)",
    "Age Structure 0-14% (Factbook)",
    "Age Structure 15-64% (Factbook)",
    "Age Structure 65+% (Factbook)",
    "Unemployment Rate (Factbook)",
    "GDP (PPP) (Factbook)",
    "GDP Growth Rate (Factbook)",
    "GDP Per Capita (PPP) (Factbook)",
    "GDP (Official Exchange Rate) (Factbook)",
    "Inflation Rate (Factbook)",
    "GDP Comp. - Agriculture % (Factbook)",
    "GDP Comp. - Industry % (Factbook)",
    "GDP Comp. - Services % (Factbook)",
]
CURRENCY_HEADERS = ["State or territory", "Currency", "Symbol", "ISO code"]
POPULATION_HEADERS = ["Country (or dependency)", "Population (2023)", "Density (P/Km²)"]
LIFE_HEADERS = [
    "Country",
    "Life Expectancy (both sexes)",
    "Female Life Expectancy",
    "Male Life Expectancy",
]
KEEP = [*IDENTITY, *CURRENCY, FACTBOOK_NAME, RELIGIONS]


def _cells(first: int, names: list[str]) -> list[Column]:
    return [F.get("cells", F.lit(first + i)).alias(n) for i, n in enumerate(names)]


def currency_table(pages: DataFrame) -> DataFrame:
    """``pages(ordinal, html)`` to the last currency record of each country."""
    rows = html_table_rows(
        pages, "html", table_class="wikitable", headers=CURRENCY_HEADERS, min_cells=4, skip_first=True
    )
    named = rows.select("ordinal", "row_no", F.get("cells", F.lit(0)).alias("cell"), *_cells(1, CURRENCY))
    each = explode_entities(named, "cell").withColumnRenamed("entity_key", "key")
    return last_wins(each.drop("entity"), ["key"], ["ordinal", "row_no", "entity_no"])


def _named_rows(rows: DataFrame, names: list[str]) -> DataFrame:
    country = normalise_name("get(cells, 1)", PAGE_ALIASES)
    keyed = rows.select(F.expr(f"lower({country})").alias("key"), "ordinal", "row_no", *_cells(2, names))
    return last_wins(keyed, ["key"], ["ordinal", "row_no"])


def population_table(pages: DataFrame) -> DataFrame:
    """``pages(ordinal, html)`` to the last population record of each country."""
    rows = html_table_rows(
        pages,
        "html",
        table_id="main_table_countries_today",
        fallback_headers=POPULATION_HEADERS,
        body_only=True,
        min_cells=12,
    )
    return _named_rows(rows, POPULATION)


def life_table(pages: DataFrame) -> DataFrame:
    """``pages(ordinal, html)`` to the last life expectancy record; the first body row is a header."""
    rows = html_table_rows(
        pages,
        "html",
        table_class="table-striped",
        fallback_headers=LIFE_HEADERS,
        body_only=True,
        skip_first=True,
        min_cells=5,
    )
    return _named_rows(rows, LIFE)


# Names of the counts that a profile takes on its way.
PAYLOADS, RECORDS, COUNTRIES = "indicator payloads", "factbook records", "countries"


def factbook_table(log: DataFrame, counts: Counts | None = None) -> DataFrame:
    """``log(code, region_no, status, body)`` to the last factbook record of each name.

    The first region that answered counts, even when its body is not JSON: such a code gives no
    record, and ``counts`` shows how many of those that answered. Of keys that an object repeats the
    last one counts.
    """
    answered = first_available(log, ["code"], ["region_no"], fetched(F.col("status"))).filter("region_no IS NOT NULL")

    def total(name: str) -> str:
        return f"coalesce(nullif({name}_total, 'N/A'), {name})"

    # Where the fields of a record are.
    people, economy = "People and Society", "Economy"
    sectors = "GDP - composition, by sector of origin"
    parsed = {
        "short": json_text("Government", "Country name", "conventional short form", default=None),
        "long": json_text("Government", "Country name", "conventional long form", default=None),
        "religions": json_text(people, "Religions"),
        "population_total": json_text(people, "Population", "total"),
        "population": json_text(people, "Population"),
        "growth": json_text(people, "Population growth rate"),
        "young": json_text(people, "Age structure", "0-14 years"),
        "adult": json_text(people, "Age structure", "15-64 years"),
        "old": json_text(people, "Age structure", "65 years and over"),
        "unemployment_total": json_text(economy, "Unemployment rate", "total"),
        "unemployment": json_text(economy, "Unemployment rate"),
        "official": json_text(economy, "GDP (official exchange rate)"),
        **{part: json_text(economy, sectors, part) for part in ("agriculture", "industry", "services")},
        **{
            short: latest_year_text(economy, title, base=title)
            for short, title in {
                "ppp": "Real GDP (purchasing power parity)",
                "real": "Real GDP growth rate",
                "head": "Real GDP per capita",
                "inflation": "Inflation rate (consumer prices)",
            }.items()
        },
    }
    fields = {
        FACTBOOK_NAME: normalise_name(first_text("short", "long", default="Unknown"), FACTBOOK_ALIASES),
        RELIGIONS: "religions",
        "Population (Factbook)": total("population"),
        "Population Growth Rate (Factbook)": "growth",
        "Age Structure 0-14% (Factbook)": "young",
        "Age Structure 15-64% (Factbook)": "adult",
        "Age Structure 65+% (Factbook)": "old",
        "Unemployment Rate (Factbook)": total("unemployment"),
        "GDP (PPP) (Factbook)": "ppp",
        "GDP Growth Rate (Factbook)": "real",
        "GDP Per Capita (PPP) (Factbook)": "head",
        "GDP (Official Exchange Rate) (Factbook)": "official",
        "Inflation Rate (Factbook)": "inflation",
        "GDP Comp. - Agriculture % (Factbook)": "agriculture",
        "GDP Comp. - Industry % (Factbook)": "industry",
        "GDP Comp. - Services % (Factbook)": "services",
    }
    found = json_fields(answered.select("code", "region_no", "body"), "body", parsed)
    if counts:
        found = counts.watched(found, RECORDS, bad=col(BAD_RECORD))
    records = found.filter(~col(BAD_RECORD)).select("code", "region_no", *[F.expr(e).alias(n) for n, e in fields.items()])
    keyed = records.withColumn("key", F.lower(col(FACTBOOK_NAME)))
    return last_wins(keyed, ["key"], ["region_no", "code"])


def indicator_table(payloads: DataFrame, as_of: dt.date, counts: Counts | None = None) -> DataFrame:
    """``payloads(country_code, indicator, ordinal, status, body)`` to one row per code with year columns.

    The last payload that has a value for a cell counts; a null value counts as well. ``counts``
    shows the payloads, and how many cannot be read.
    """
    window = year_window(as_of)
    landed = payloads.filter(fetched(F.col("status")) & F.col("indicator").isin(*INDICATORS))
    # Named by payload, not by point.
    named = landed.select("country_code", F.expr(normalise_name("indicator", INDICATORS)).alias("indicator"), "ordinal", "body")
    points = payload_points(named, "body", window)
    if counts:
        points = counts.watched(points, PAYLOADS, rows=F.col("pos") < 0, bad=col(BAD_RECORD))
    years = range(window[0], window[1] + 1)
    return indicator_pivot(payload_rows(points), ["country_code"], list(INDICATORS.values()), years, ordinal="ordinal")


# Where payloads and records are fetched from, and the years asked for before the window.
INDICATOR_URL = "http://api.worldbank.org/v2/country/%s/indicator/%s?format=json&date=%s:%s&per_page=100"
FACTBOOK_URL = "https://raw.githubusercontent.com/factbook/factbook.json/master/%s/%s.json"
YEARS_BEFORE = 1


def indicator_requests(codes: DataFrame, as_of: dt.date) -> DataFrame:
    """``codes(country_code)`` to the URL of each indicator's payload: ``country_code, indicator, url``."""
    first, last = year_window(as_of)
    tried = candidates(codes.select("country_code"), ("indicator", list(INDICATORS)))
    asked = tried.withColumns({"_first": F.lit(first - YEARS_BEFORE), "_last": F.lit(last)})
    urls = candidate_urls(asked, INDICATOR_URL, "country_code", "indicator", "_first", "_last")
    return urls.select("country_code", "indicator", "url")


def factbook_requests(codes: DataFrame) -> DataFrame:
    """``codes(code)`` to every URL that may hold its record: ``code, region, region_no, url``."""
    tried = candidates(distinct_codes(codes.select(F.array("code").alias("codes")), "codes"), ("region", REGIONS))
    return candidate_urls(tried, FACTBOOK_URL, "region", "code").select("code", "region", "region_no", "url")


def answers_of(requests: DataFrame, fetches: DataFrame) -> DataFrame:
    """Requests with what ``fetches(url, status, ...)`` brought; a URL that was not fetched has no status."""
    return requests.join(fetches, "url", "left")


# Stands in front of codes where names and codes are keys of one join.
CODE_MARK = "'\\u0001'"

# The pages that hold the three tables.
CURRENCY_URL = "https://en.wikipedia.org/wiki/List_of_circulating_currencies"
POPULATION_URL = "https://www.worldometers.info/world-population/population-by-country/"
LIFE_URL = "https://www.worldometers.info/demographics/life-expectancy/"


@dataclass(frozen=True)
class Landed:
    """The landed tables that a profile is built from."""

    spine: DataFrame
    currency_pages: DataFrame
    indicator_payloads: DataFrame
    population_pages: DataFrame
    life_pages: DataFrame
    factbook_log: DataFrame


def landed_pages(spine: DataFrame, pages: DataFrame, payloads: DataFrame, log: DataFrame) -> Landed:
    """Sources out of one table ``pages(url, status, ordinal, html)``, the indicator payloads and the fetch log."""
    found = fetched_pages(pages)

    def of(url: str) -> DataFrame:
        return found.filter(F.col("url") == url).select("ordinal", "html")

    return Landed(spine, of(CURRENCY_URL), payloads, of(POPULATION_URL), of(LIFE_URL), log)


def country_profile(landed: Landed, as_of: dt.date, counts: Counts | None = None) -> DataFrame:
    """One row per country of the spine: the flat columns, the religion text and the parsed shares.

    All five sources come in by one join: four by names, the indicators by code. ``counts`` takes
    how many payloads and records there were, and how many could not be read, in the same pass.
    """
    spine = has_name(landed.spine.select(*cols(IDENTITY)), "Country")
    raw = country_key("Country")
    code = f"coalesce({lookup('Country', CODE_OVERRIDES)}, {name('Alpha-3')})"
    names = [normalise_name(raw, MATCH_ALIASES), raw, normalise_name(raw, CURRENCY_ALIASES)]
    keys = [F.expr(k) for k in (*names, f"{CODE_MARK} || {code}")]
    marked = landed.indicator_payloads.withColumn("country_code", F.expr(f"{CODE_MARK} || country_code"))
    indicators = indicator_table(marked, as_of, counts)
    years = [c for c in indicators.columns if c != "country_code"]
    sources = {
        "currency": Source(currency_table(landed.currency_pages), "key", 3),
        "population": Source(population_table(landed.population_pages), "key", 2),
        "life": Source(life_table(landed.life_pages), "key", 2),
        "factbook": Source(factbook_table(landed.factbook_log, counts), "key", 2),
        "indicators": Source(indicators, "country_code", 4),
    }
    found = enrich(spine, keys, sources, reduce=True)

    def field(source: str, column: str) -> str:
        return f"{source}.{name(column)} AS {name(column)}"

    wide = found.selectExpr(
        *cols(IDENTITY),
        *[f"coalesce(currency.{name(c)}, 'N/A') AS {name(c)}" for c in CURRENCY],
        *[field("indicators", c) for c in years],
        *[field("population", c) for c in POPULATION],
        *[field("life", c) for c in LIFE],
        *[field("factbook", c) for c in [FACTBOOK_NAME, RELIGIONS, *FACTBOOK]],
    )
    clean = clean_columns(wide, KEEP)
    return clean.withColumn(RELIGIONS_PARSED, F.expr(parse_shares(name(RELIGIONS))))


def profile_records(profile: DataFrame) -> DataFrame:
    """The nested records for JSON: shares as a map, greatest first."""
    return profile.withColumn(RELIGIONS_PARSED, F.expr(shares_map(name(RELIGIONS_PARSED))))


def table_columns(as_of: dt.date) -> list[tuple[str, str]]:
    """Names and types of the flat table."""
    first, last = year_window(as_of)
    years = [f"{i} {y}" for i in INDICATORS.values() for y in range(first, last + 1)]
    texts, numbers = [*IDENTITY, *CURRENCY], [*years, *POPULATION, *LIFE]
    slots = [(f"Religion {i} {part}", kind) for i in range(1, SLOTS + 1) for part, kind in (("Name", "string"), ("Percentage", "double"))]
    return [
        *[(c, "string") for c in texts],
        *[(c, "double") for c in numbers],
        (FACTBOOK_NAME, "string"),
        *[(c, "double") for c in FACTBOOK],
        *slots,
    ]


def profile_table(profile: DataFrame) -> DataFrame:
    """The flat table: declared columns in order, shares as slots."""
    flat = [c for c in profile.columns if c not in (RELIGIONS, RELIGIONS_PARSED)]
    return profile.selectExpr(*cols(flat), *share_slots(name(RELIGIONS_PARSED)))


def export_profile(landed: Landed, as_of: dt.date, folder: str) -> Export:
    """The profile of landed sources as ``json`` (nested records) and ``csv`` (flat table), worked out once.

    Its ``counts`` hold the payloads and records that were read, those that could not be, and the
    countries without a record.
    """
    counts = Counts()
    profile = counts.watched(country_profile(landed, as_of, counts), COUNTRIES, bad=col(FACTBOOK_NAME).isNull())

    def as_csv(staged: DataFrame, path: str) -> None:
        table = profile_table(staged)
        write_csv(table, path, table.columns)

    writers = {"csv": as_csv, "json": lambda staged, path: write_json(profile_records(staged), path)}
    return export(profile, folder, writers, counts)


def exported_table(spark: SparkSession, exported: Export, as_of: dt.date) -> DataFrame:
    """The flat table of an export, read back from its CSV files."""
    return read_csv(spark, exported.path("csv"), ", ".join(f"{name(c)} {kind}" for c, kind in table_columns(as_of)))
