"""The index of a page, and the operators that read through it."""

import random

import pytest

from dossierkit.functions.structure import Find, Index, Pick, attribute, field, plain_text
from dossierkit.operators import arrow, extract


def inner(html, *path, **more):
    return Index(html).value(field(*path, **more))


def test_element_ends_at_its_own_end_tag():
    html = '<div>0</div><DIV class="q k">a<div>b</div>c<div>d<div>e</div></div></DIV>f'
    assert inner(html, Find("div", "k")) == "a<div>b</div>c<div>d<div>e</div></div>"
    assert inner("<div class=k>open", Find("div", "k")) == "open"
    assert inner("<p>", Find("div", "k")) is None


def test_class_words_and_whole_class():
    html = '<span class="kk">0</span><span class="a k">1<b class=\'k\'>2</b></span><i class="k b">3<i>4</i></i>'
    assert inner(html, Find(cls="k"), many=True) == ["1<b class='k'>2</b>", "2", "3<i>4</i>"]
    assert inner(html, Find("b", "k")) == "2"
    spans = '<span class="textWhite">a</span><span class="textWhite textShadow">b</span>'
    assert inner(spans, Find("span", whole_cls="textWhite textShadow")) == "b"
    assert inner("<a id=x>1</a><a id='y'>2", Find("a", id="y")) == "2"
    assert inner("<a href='/q'>1</a><a HREF='/k?z'>2</a>", Find("a", held=("href", "k?"))) == "2"


def test_greater_signs_in_attributes():
    html = """<div title="a > b" class="k"><i alt='</div>'>x</i></div><div class=k>y"""
    assert inner(html, Find("div", "k"), many=True) == ["<i alt='</div>'>x</i>", "y"]
    assert inner("""<p it's>a</p><p title="x>b""", Find("p"), many=True) == ["a", "b"]


def test_attribute():
    tags = ["x=1 HREF='/u?a=1&amp;b=2'", 'href = "z"', "href=q", "data-href=q", "href=''", 'x="href=1" href=2']
    assert [attribute(t, "href") for t in tags] == ["/u?a=1&amp;b=2", "z", "q", None, "", "2"]


def test_plain_text():
    assert plain_text(" <b>Foo</b> <i> bar&nbsp;</i>b &amp;amp; z ") == "Foobarb &amp; z"


def test_nested_tables_and_open_cells():
    html = "<table id=x><tr><td>1<td>2<table><tr><td>n</table>m<tr><td>3</div></td></tr></table></td>z"
    index = Index(html)
    rows = list(index.all(Find("tr")))
    assert [index.inner(r) for r in rows] == ["<td>1<td>2<table><tr><td>n</table>m", "<td>n", "<td>3</div></td>"]
    assert [[index.inner(c) for c in index.all(Find("td"), index.inside(r))] for r in rows] == [
        ["1", "2<table><tr><td>n</table>m", "n"], ["n"], ["3</div>"],
    ]


def test_an_end_tag_in_a_cell_closes_nothing_outside():
    html = "<div class=k><table><tr><td>a</div>b</td></tr></table>c</div>d"
    assert inner(html, Find("div", "k")).endswith("c")


def test_paths():
    html = (
        "<div class=c><a class=t>1</a><b><i>x</i></b></div><div class=c><b><i>y</i><i>z</i></b><b><i>w</i></b></div>"
    )
    card, b, i = Find("div", "c"), Find("b"), Find("i")
    assert inner(html, card, b, i, many=True) == ["x", "y", "z", "w"]
    assert inner(html, card, b, i) == "x" and inner(html, b, i, last=True) == "x"
    assert inner(html, (Find("q"), Find("a", "t"))) == "1"
    assert Index(html).value(Pick(((Find("q"),), (b, i)), many=True)) == ["x", "y", "z", "w"]
    assert Index(html).value(Pick(((Find("q"),),), many=True)) == [] and inner(html, Find("q"), i) is None
    assert inner("<a x='1'>", Find("a"), attribute="x") == "1" and inner("<a>", Find("a"), attribute="x") is None


def test_intervals_nest_and_hold_their_descendants():
    """On any page, elements but paragraphs nest like brackets, and the range of numbers tells what lies inside."""
    rng = random.Random(1)
    names = "div a b td tr table p br tbody".split()
    for _ in range(300):
        html = "".join(rng.choice(("<{}>", "</{}>", "<{} class=k>", "x{}")).format(rng.choice(names)) for _ in range(rng.randint(0, 40)))
        index = Index(html)
        solid = [n for n in range(len(index.names)) if index.names[n] != "p"]
        for a in solid:
            low, high = index.inside(a)
            inside = {n for n in solid if index.start[a] < index.start[n] and index.end[n] <= index.end[a]}
            assert index.names[a] == "br" or inside == {n for n in solid if low <= n < high}
            assert all(index.end[n] <= index.start[a] or index.start[n] >= index.end[a] for n in solid if n > a and n not in inside and n != a) or index.names[a] == "br"


def test_a_page_of_open_and_stray_tags_takes_linear_time():
    Index("<b>" * 200_000 + "</i>" * 200_000)
    Index("<p>" * 200_000 + '<a title="' * 1000)


def test_main_text(spark):
    pages = {
        '<p>out</p><div class="a entry-content"><p>one<br>two<div>in<p>mid</div>gone<p class=x>three &amp; <b>f</b>our'
        '</p> gap </div><p>out</p><script>"<p>no</p>"</script>': "one two in mid three & f our",
        "<p>a<p>b</p>c<!-- <p>z --><p></p><p>d": "a b  d",
        '<div class="entry-content">none</div><p>x</p>': "",
        '<body><article><p>a</article><footer>f</footer><P>b</body>': "a b",
        '<script>var t="</p><p>x";</script><p>a</p><style>p{}</style>': "a",
        '<div class="entry-content" title="<p>x"><p>y > z</div>': "y > z",
        "": "",
    }
    df = spark.createDataFrame([(i, h) for i, h in enumerate([*pages, None])], "i int, html string")
    got = [r["text"] for r in extract.main_text(df, "html", "text").orderBy("i").collect()]
    assert got == [*pages.values(), ""]


def test_other_columns_stay_and_pages_without_records_go(spark):
    df = spark.createDataFrame([([1], {"k": 1}, "<a href=x>1</a><a>2", "q"), ([2], None, None, "r")], "`a.b` array<int>, m map<string,int>, html string, `c d` string")
    got = extract.page_links(df, "html").collect()
    assert [tuple(r) for r in got] == [([1], {"k": 1}, "q", 0, "x", "1")]
    assert extract.page_links(df.limit(0), "html").collect() == []
    rows = extract.page_fields(df, "html", {"one": field(Find("a")), "all": field(Find("a"), many=True)}).collect()
    assert sorted([r["one"], r["all"]] for r in rows if r["one"]) == [["1", ["1", "2"]]] and len(rows) == 2


@pytest.mark.parametrize("rows", [1, 3])
def test_records_come_in_batches(spark, monkeypatch, rows):
    monkeypatch.setattr(arrow, "BATCH_ROWS", rows)
    df = spark.createDataFrame([(i, "<a href=x>y</a>" * i) for i in range(6)], "i int, html string")
    got = extract.page_links(df, "html").collect()
    assert sorted((r["i"], r["link_no"]) for r in got) == [(i, j) for i in range(6) for j in range(i)]
