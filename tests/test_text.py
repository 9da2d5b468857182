import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from dossierkit.functions import text as T


def pairs(evaluate, expression, table):
    assert evaluate(expression, list(table)) == list(table.values())


def test_strip_and_clean_text(evaluate):
    assert evaluate(T.strip("x"), ["  a b\x1c\n", "\xa0", None]) == ["a b", "", None]
    assert evaluate(T.clean_text("x"), [" a \n\t b\xa0　c ", "", None, "\x1f"]) == ["a b c", "", "", ""]


def test_every_white_space_character_counts(evaluate):
    spaces = [chr(i) for i in range(0x3100) if chr(i).isspace()]
    assert list(T.WHITESPACE) == spaces
    assert evaluate(T.clean_text("x"), [f"a{c}b" for c in spaces]) == ["a b"] * len(spaces)


def test_clean_numeric(evaluate):
    pairs(
        evaluate,
        T.clean_numeric("x"),
        {
            "$1.5 trillion (2023 est.)": 1.5,
            "−0.5 %": 0.5,
            "1,234,567": 1234567.0,
            "N/A": None,
            "-": None,
            "": None,
            "abc": None,
            "-0.5%": -0.5,
            "15-64: 60%": 15.0,
            "(5)": 5.0,
            ".5": 5.0,
            None: None,
        },
    )


def test_parse_value(evaluate):
    pairs(
        evaluate,
        T.parse_value("x"),
        {
            "1,234": 1234.0,
            "$1.2B": 1.2e9,
            "5%": 0.05,
            "2.5 Million": 2.5e6,
            "3 T": 3e12,
            "-5": None,
            "": None,
            "3 B Cu.M": None,
            "12 bbl/day": 12.0,
            "1.2.": None,
            "1.2.3": None,
            ".": None,
            ",": None,
            "1.5M.": 1.5,
            "1.2b": 1.2,
            "$ 5 B ": 5e9,
            "5 B ": None,
            " 5 ": 5.0,
            None: None,
        },
    )


def test_parse_value_of_a_formatted_number_is_the_number(evaluate):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.integers(0, 10**12), min_size=1, max_size=50))
    def check(numbers):
        texts = [f"${n:,} km" for n in numbers]
        assert evaluate(T.parse_value("x"), texts) == [float(n) for n in numbers]

    check()


def test_dates(evaluate):
    phrases = {
        "Posted 2 Days Ago": (None, None),
        "Posted on Mon Jan 6": ("MJan 6", None),
        "Posted On Jan 2": ("On Jan 2", None),
        "Posted on Jan 22 Updated on Jan 23": ("Jan 22 Updated Jan 23", "Jan 23"),
        "posted Yesterday": ("Yesterday", None),
        "Updated  on\n Jan 3, 2025": (None, "Jan 3, 2025"),
    }
    assert evaluate(T.posted("x"), list(phrases)) == [p for p, _ in phrases.values()]
    assert evaluate(T.updated("x"), list(phrases)) == [u for _, u in phrases.values()]


def test_date_items_and_last_found(evaluate):
    items = [["Posted Monday", "5 Comments", "posted Tuesday", "Posted " + "x" * 60, "Updated Friday", "Posted Sunday"]]
    kept = T.date_items("x")
    assert evaluate(kept, items, "array<string>") == [["Posted Monday", "Updated Friday", "Posted Sunday"]]
    assert evaluate(T.last_found(kept, T.posted), items, "array<string>") == ["Sunday"]
    assert evaluate(T.last_found(kept, T.updated), items + [[]], "array<string>") == ["Friday", None]


def test_authors(evaluate):
    assert evaluate(T.split_authors("x"), ["By A B and C, D & E", "by Andy Sand and Éand", " , & "]) == [
        ["A B", "C", "D", "E"],
        ["by Andy Sand", "Éand"],
        [],
    ]
    assert evaluate(T.split_authors_loose("x"), ["by Andy and By Bo"]) == [["Andy", "By Bo"]]


def test_entities(evaluate):
    assert evaluate(T.entities("x"), ["The Gambia[a], Foo[1] and the Bar", "Antigua and Barbuda", "", "a, and b"]) == [
        ["Gambia", "Foo", "Bar"],
        ["Antigua", "Barbuda"],
        [],
        ["a", "and b"],
    ]


def test_names(evaluate):
    aliases = {"United States": "United States of America"}
    assert evaluate(T.normalise_name("x", aliases), ["United States", "Chad", None]) == [
        "United States of America",
        "Chad",
        None,
    ]
    assert evaluate(T.country_key("x"), [" CHAD\xa0"]) == ["chad"]
    assert evaluate(T.join_tags("x"), [[" a ", "b\n c"]], "array<string>") == ["a, b c"]
    assert evaluate(T.first_text("x", "'N/A'", default="Unknown"), ["a", "none", "", None]) == [
        "a",
        "Unknown",
        "Unknown",
        "Unknown",
    ]


def test_window():
    assert T.year_window(dt.date(2025, 3, 1)) == (2017, 2024)


def test_typed_date(evaluate):
    texts = {
        "Jan 22, 2025": dt.date(2025, 1, 22), "MJan 6 2025": None, "Mon January 6, 2025": dt.date(2025, 1, 6), "feb 29, 2024": dt.date(2024, 2, 29),
        "Feb 30, 2024": None, "Today": None, "Sept. 3, 2024": dt.date(2024, 9, 3), "xyz 3, 2024": None, "anf 3, 2024": None, "Dec 31, 20255": None, "": None,
        "Jan 22 Updated Mar 3, 2024": dt.date(2024, 3, 3), None: None,
    }
    assert evaluate(T.typed_date("x"), list(texts)) == list(texts.values())
