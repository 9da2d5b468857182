"""The whole flows on small landed sources, with the answers written out."""

import datetime as dt
import json
from dataclasses import replace

from pyspark.sql import functions as F

from dossierkit.catalog import profiles
from dossierkit.operators.counts import Counts
from dossierkit.operators.extract import article_cards, html_table_rows, label_values, page_links
from dossierkit.plans import articles as A
from dossierkit.plans import country_profile as C
from dossierkit.plans import maps as M
from dossierkit.plans import strength_matrix as S
from dossierkit.sources.dims import DETAIL_LABELS

AS_OF = dt.date(2025, 2, 1)


def table(attrs, headers, rows, body=True):
    head = "".join(f"<th>{h}</th>" for h in headers)
    inner = "".join("<tr>" + "".join(f"<td> {c} </td>" for c in r) + "</tr>" for r in rows)
    return f"<table {attrs}><thead><tr>{head}</tr></thead>" + (f"<tbody>{inner}</tbody>" if body else inner) + "</table>"


def factbook(name, religions="Muslim 60%, Catholic 30%", **economy):
    return json.dumps(
        {
            "Government": {"Country name": {"conventional short form": {"text": name}}},
            "People and Society": {
                "Religions": {"text": religions},
                "Population": {"total": {"text": "1,000 (2024 est.)"}},
                "Age structure": {"0-14 years": {"text": "20.5%"}},
            },
            "Economy": {
                "Unemployment rate": {"Unemployment rate 2021": {"text": "4%"}},
                "Real GDP per capita": {"Real GDP per capita 2022": {"text": "$5,000"}, "Real GDP per capita 2023": {"text": "$6,000"}},
                **economy,
            },
        }
    )


def landed(spark):
    page = "ordinal int, html string"
    spine = [
        ("United States", "US", "USA", "840"),
        ("Korea, Republic of", "KR", "KOR", "410"),
        ("Czechia", "CZ", "CZE", "203"),
        ("Antigua and Barbuda", "AG", "ATG", "028"),
        ("Kosovo", "XK", "XKK", "999"),
        ("", "??", "???", "000"),
    ]
    currency = table(
        'class="wikitable sortable"',
        C.CURRENCY_HEADERS,
        [
            ("The United States of America[a]", "Old dollar", "$", "OLD"),
            ("United States of America and Antigua and Barbuda", "Dollar", "&#36;", "USD"),
            ("South Korea", "Won", "₩", "KRW"),
            ("Czechia", "Koruna", "Kč", "CZK"),
        ],
        body=False,
    )
    decoy = table('class="wikitable"', ["Symbol"], [("Czechia", "x", "x", "x")], body=False)
    population = table(
        'id="main_table_countries_today"',
        [],
        [
            ("1", "United States", "345,426,571", "0.57 %", "1,949,236", "38", "9,147,420", "1,286,132", "1.6", "38", "82 %", "4.23 %"),
            ("2", "Czechia", "short"),
        ],
    )
    life = table(
        'class="table table-striped"',
        [],
        [("0", "Czechia", "1", "1", "1"), ("1", "United States", "79.5", "82.0", "77.0"), ("2", "Czechia", "80", "83", "77")],
    )
    log = [
        ("us", 0, 404, "no"),
        ("us", 1, 200, factbook("United States", "Protestant 46.5%, Roman Catholic 20.8%, Jewish 1.9%, none 22.8%")),
        ("us", 2, 200, factbook("Wrong")),
        ("ez", 0, 200, factbook("Czechia")),
        ("ks", 0, 200, factbook("Korea, South")),
        ("xx", 0, 200, "{oops"),
        ("xx", 1, 200, factbook("Kosovo")),
    ]
    payload = '[{"page":1},[{"date":"2024","value":2.5},{"date":"2023","value":null},{"date":"2016","value":9}]]'
    payloads = [
        ("USA", "NY.GDP.MKTP.CD", 2, 200, payload),
        ("USA", "NY.GDP.MKTP.CD", 1, 200, payload.replace("2.5", "9")),
        ("USA", "SP.POP.TOTL", 1, 500, payload),
        ("XKX", "MS.MIL.XPND.GD.ZS", 1, 200, payload),
        ("CZE", "NY.GDP.MKTP.CD", 1, 200, '[{},[{"date":"2024Q1","value":1}]]'),
    ]
    return C.Landed(
        spark.createDataFrame(spine, "Country string, `Alpha-2` string, `Alpha-3` string, `Numeric Code` string"),
        spark.createDataFrame([(1, decoy + currency)], page),
        spark.createDataFrame(payloads, "country_code string, indicator string, ordinal int, status int, body string"),
        spark.createDataFrame([(1, population)], page),
        spark.createDataFrame([(1, life)], page),
        spark.createDataFrame(log, "code string, region_no int, status int, body string"),
    )


def test_country_profile(spark):
    profile = C.country_profile(landed(spark), AS_OF)
    flat = C.profile_table(profile)
    assert len(flat.columns) == 101
    rows = {r.Country: r.asDict() for r in flat.collect()}
    assert set(rows) == {"United States", "Korea, Republic of", "Czechia", "Antigua and Barbuda", "Kosovo"}
    us = rows["United States"]
    assert (us["Numeric Code"], us["Currency Name"], us["Currency Symbol"], us["ISO Code"]) == ("840", "Dollar", "$", "USD")
    assert (us["GDP (Current US$) 2024"], us["GDP (Current US$) 2023"], us["Population WB 2024"]) == (2.5, None, None)
    assert "GDP (Current US$) 2016" not in us and "GDP (Current US$) 2017" in us
    assert (us["Population (Worldometer)"], us["World Share %"], us["Life Expectancy (female)"]) == (345426571.0, 4.23, 82.0)
    assert (us["Factbook Country Name"], us["Population (Factbook)"]) == ("United States of America", 1000.0)
    assert (us["GDP Per Capita (PPP) (Factbook)"], us["GDP (PPP) (Factbook)"]) == (6000.0, None)
    # an object without text is its JSON, whose first number is the year in the key
    assert us["Unemployment Rate (Factbook)"] == 2021.0
    assert [us[f"Religion {i} Name"] for i in range(1, 6)] == ["Protestant", "Unaffiliated", "Catholic", "Jewish", None]
    korea = rows["Korea, Republic of"]
    assert (korea["Currency Name"], korea["Factbook Country Name"]) == ("Won", None)
    czechia = rows["Czechia"]
    # the name is replaced in the source but not in the spine, so this one misses
    assert (czechia["Currency Name"], czechia["Factbook Country Name"], czechia["Population (Worldometer)"]) == ("Koruna", None, None)
    assert (czechia["Life Expectancy (both)"], czechia["GDP (Current US$) 2024"]) == (80.0, None)
    # the shared cell became two countries
    assert rows["Antigua and Barbuda"]["Currency Name"] == "N/A"
    kosovo = rows["Kosovo"]
    assert kosovo["Defense Expenditure (% of GDP) 2024"] == 2.5
    # the first answer was not JSON, and the search ends there
    assert kosovo["Factbook Country Name"] is None


def test_profile_counts_and_does_not_depend_on_the_session(spark, tmp_path):
    """A record with repeated keys is read alike under every setting, and nothing sets one."""
    setting = "spark.sql.variant.allowDuplicateKeys"
    one = landed(spark)
    twice = factbook("Kosovo").replace('{"Government"', '{"Government":{"x":1},"Government"')
    log = one.factbook_log.filter("code <> 'xx' OR region_no > 0").withColumn("body", F.when(F.col("code") == "xx", F.lit(twice)).otherwise(F.col("body")))
    log = log.union(spark.createDataFrame([("yy", 0, 200, "{oops"), ("zz", 0, 404, "{oops")], log.schema))
    before, profiles = spark.conf.get(setting), []
    for value in ("true", "false"):
        spark.conf.set(setting, value)
        counts = Counts()
        profile = C.country_profile(replace(one, factbook_log=log), AS_OF, counts)
        rows = profile.orderBy("Country").collect()
        assert spark.conf.get(setting) == value
        # fetched: four payloads and of the records one that is no JSON
        assert counts.read() == {C.PAYLOADS: (4, 1), C.RECORDS: (5, 1)}
        profiles.append([r.asDict() for r in rows])
    spark.conf.set(setting, before)
    assert profiles[0] == profiles[1]
    assert {r["Country"]: r["Factbook Country Name"] for r in profiles[0]}["Kosovo"] == "Kosovo"


def test_export_of_a_profile(spark, plan, tmp_path):
    one = landed(spark)
    done = C.export_profile(one, AS_OF, str(tmp_path / "out"))
    assert done.counts == {C.PAYLOADS: (4, 1), C.RECORDS: (4, 1), C.COUNTRIES: (5, 4)}
    back = C.exported_table(spark, done, AS_OF)
    flat = C.profile_table(C.country_profile(one, AS_OF))
    assert C.table_columns(AS_OF) == [(f.name, f.dataType.simpleString()) for f in flat.schema]
    assert back.orderBy("Country").collect() == flat.orderBy("Country").collect()
    assert spark.read.json(done.path("json")).count() == 5


def test_sources_out_of_one_page_table(spark):
    one = landed(spark)
    urls = {C.CURRENCY_URL: one.currency_pages, C.POPULATION_URL: one.population_pages, C.LIFE_URL: one.life_pages}
    rows = [(url, 200, r.ordinal, r.html) for url, df in urls.items() for r in df.collect()]
    rows += [(url, 404, 99, html.replace("<td> ", "<td> 9")) for url, _, _, html in rows]
    pages = spark.createDataFrame(rows + [("https://h/", 200, 1, "x")], "url string, status int, ordinal int, html string")
    other = C.landed_pages(one.spine, pages, one.indicator_payloads, one.factbook_log)
    expected = C.country_profile(one, AS_OF).orderBy("Country").collect()
    found = C.country_profile(other, AS_OF)
    assert found.orderBy("Country").collect() == expected
    us = C.profile_records(found).filter("Country = 'United States'")
    shares = us.selectExpr("to_json(`Religions Parsed`) AS shares").first().shares
    assert list(json.loads(shares).items()) == [("Protestant", 46.5), ("Unaffiliated", 22.8), ("Catholic", 20.8), ("Jewish", 1.9)]


def test_table_by_headers_when_the_id_is_missing(spark):
    rows = [("1", "Chad", *map(str, range(10)))]
    html = table("", ["x"], rows) + table("", C.POPULATION_HEADERS, [("1", "Mali", *map(str, range(10)))])
    pages = spark.createDataFrame([(1, html), (2, table("", ["x"], rows))], "ordinal int, html string")
    found = C.population_table(pages).collect()
    assert [(r.key, r["World Share %"]) for r in found] == [("mali", "9")]


def test_table_without_a_body_gives_nothing(spark):
    html = table('id="main_table_countries_today"', [], [["1"] * 12], body=False)
    pages = spark.createDataFrame([(1, html)], "ordinal int, html string")
    assert html_table_rows(pages, "html", table_id="main_table_countries_today", body_only=True, min_cells=1).count() == 0


def block(name, value):
    shown = f'<div class="longFormName"><span> {name} </span></div>' if name else ""
    return (
        f'<a class="x" href="country-military-strength-detail.php?country_id={name}&amp;x=1"><div>{shown}</div>'
        f'<div class="valueContainer">{value}</div></a>'
    )


def test_strength_matrix(spark):
    metric_pages = [
        ("aircraft_total", 1, block("Chad", "<span>#1</span><span>1,234</span>") + block("Mali", "<span>old</span>")),
        ("aircraft_total", 2, block("Mali", " $2.5 Million ") + block(None, "5") + '<a href="/other">x</a>'),
        ("external_debt", 1, block("Niger", "<span>-5</span>") + block("Chad", "<span>5%</span>")),
    ]
    def detail(label, value):
        return f'<div class="specsGenContainers"><span>{label}:</span>{value}</div>'

    shown = '<span class="textWhite textShadow"> 7,000 </span>'
    details = [
        ("Chad", 1, detail("Army Personnel", shown) + detail("Army Personnel", "no") + detail("Mobilization Year 4+", shown)),
        ("Togo", 1, "<span>Army Personnel</span>" + detail("Army Personnel", shown) + detail("Navy Personnel", "<span>1</span>")),
        ("Togo", 2, detail("Tot Mil. Personnel", shown.replace("7,000", "n/a"))),
    ]
    matrix = S.strength_matrix(
        spark.createDataFrame(metric_pages, "metric string, ordinal int, html string"),
        spark.createDataFrame(details, "country string, ordinal int, html string"),
    )
    assert matrix.columns == ["Country", *S.FIELDS] and len(matrix.columns) == 60
    rows = [r.asDict() for r in matrix.collect()]
    assert [r["Country"] for r in rows] == ["Chad", "Mali", "Niger", "Togo"]
    values = [{k: v for k, v in r.items() if v is not None and k != "Country"} for r in rows]
    assert values == [
        {"aircraft_total": 1234.0, "external_debt": 0.05, "army_personnel": 7000.0, "mobilization_year_4_plus": 7000.0},
        {"aircraft_total": 2.5e6},
        {},
        {},
    ]


def test_matrix_of_a_whole_site(spark):
    shown = '<div class="specsGenContainers"><span>Army Personnel</span><span class="textWhite textShadow">7</span></div>'
    pages = [
        ("https://h/navy-ships.php", 200, 1, block("Chad", "<span>3</span>")),
        ("https://h/navy-ships.php", 500, 9, block("Chad", "<span>4</span>")),
        ("https://h/countries-listing.php", 200, 2, block("Chad", "") + block("Mali", "")),
        ("https://h/country-military-strength-detail.php?country_id=Mali&x=1", 200, 3, shown),
        ("https://h/other.php", 200, 4, block("Niger", "<span>3</span>")),
    ]
    matrix = S.matrix_of_pages(spark.createDataFrame(pages, "url string, status int, ordinal int, html string"), "https://h/")
    rows = [{k: v for k, v in r.asDict().items() if v is not None} for r in matrix.collect()]
    assert rows == [{"Country": "Chad", "naval_fleet_strength": 3.0}, {"Country": "Mali", "army_personnel": 7.0}]


def test_labels_need_a_value_span_of_the_whole_class(spark):
    html = '<div class="specsGenContainers"><span>Navy Personnel</span><span class="textWhite">8</span></div>'
    assert label_values(spark.createDataFrame([(html,)], "html string"), "html", DETAIL_LABELS).count() == 0


CARD = """<div class="x card-post"><a class="card-post-image-link" href="/wrong"></a>
 <a class="card-post-title-link" href=" /a?x=1&amp;y=2 "><h3 class="card-post-title"> Big
  news </h3></a><div class="post-tax-badges"><a class="cat-name-badge">Air</a> <a class="cat-name-badge"> Sea </a></div>
 <div class="card-post-inline-meta"><div class="inline-meta-item">Posted on Jan 2</div><div class="inline-meta-item">Updated
 Yesterday</div></div><div class="card-post-byline"><span class="byline-text">By A and B</span><span class="byline-text">C</span></div>
 <p class="card-post-dek">Dek</p></div>"""


def test_articles(spark):
    loose = '<div class="card-post"><a class="card-post-image-link" href="/gone">x</a><div class="card-post-byline">by D</div></div>'
    empty = '<div class="card-post"><a class="card-post-title-link" href=""></a><a class="card-post-image-link" href="/z"></a></div>'
    listing = spark.createDataFrame([(1, f"<main>{CARD}{empty}{loose}</main><p class='card-post-dek'>no</p>")], "page_id int, html string")
    details = spark.createDataFrame(
        [
            ("/a?x=1&y=2", 1, "<p>old</p>"),
            ("/a?x=1&y=2", 2, '<p>out</p><div class="entry-content"><p>new <div>in</div></p><p>text</p></div>'),
        ],
        "url string, ordinal int, html string",
    )
    rows = A.articles(listing, details).orderBy("card_no").collect()
    assert [tuple(r)[2:] for r in rows] == [
        ("Air, Sea", "Big news", "/a?x=1&y=2", ["A", "B", "C"], "Jan 2", "Yesterday", "Dek", "new in text"),
        ("", "", "/gone", ["D"], "", "", "", ""),
    ]
    chunks = A.article_chunks(A.articles(listing, details)).collect()
    assert {(c.link, c.title, c.chunk_no) for c in chunks} == {("/a?x=1&y=2", "Big news", 0), ("/gone", "", 0)}
    assert any(c.chunk.endswith("SECTION: Air, Sea\nUPDATES: Dek\n\nnew in text") for c in chunks)


def test_many_cards_with_one_link(spark):
    listing = spark.createDataFrame([(i, CARD) for i in range(200)], "page_id int, html string")
    details = spark.createDataFrame([("/a?x=1&y=2", 1, "<p>text</p>")], "url string, ordinal int, html string")
    found = A.articles(listing, details)
    assert found.filter("`Full Article` = 'text'").count() == 200


def test_cards_need_a_link(spark):
    pages = spark.createDataFrame([(1, '<div class="card-post"><h3 class="card-post-title">T</h3></div>')], "i int, html string")
    assert article_cards(pages, "html").count() == 0


def test_page_links(spark):
    pages = spark.createDataFrame([(1, '<a href="/a"> A <b>b</b></a><a name=x>no</a><A href=/c>C</A>')], "i int, html string")
    assert [tuple(r) for r in page_links(pages, "html").collect()] == [(1, 0, "/a", "A b"), (1, 2, "/c", "C")]
    assert page_links(pages, "html", "c$").count() == 1


def test_maps(spark):
    countries = spark.createDataFrame([("Holy See",), ("New Zealand",)], "country string")
    requests = M.map_requests(countries)
    assert requests.count() == 8
    base = "https://srv1.worldometers.info/img/maps/"
    log = [(f"{base}vatican-city_physical_map.{e}", 200) for e in ("gif", "png")]
    log += [(f"{base}new-zealand_political_map.gif", 404), (f"{base}new-zealand_political_map.png", 200)]
    files = M.map_files(requests, spark.createDataFrame(log, "url string, status int"))
    assert sorted((r.country, r.map_type, r.path) for r in files.collect()) == [
        ("Holy See", "physical", "country_maps/Holy See/Holy See_physical_map.gif"),
        ("Holy See", "political", None),
        ("New Zealand", "physical", None),
        ("New Zealand", "political", "country_maps/New Zealand/New Zealand_political_map.png"),
    ]


def test_a_page_is_derived_without_the_others(spark, plan):
    landed = profiles.landed_sources(spark, "/root/testdata/sf0.001")
    text = plan(landed.currency_pages)
    assert "wikitable" in text and "main_table_countries_today" not in text and "<td>9" not in text
    assert landed.currency_pages.count() == 150
