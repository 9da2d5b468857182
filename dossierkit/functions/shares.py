"""Shares out of free text such as 'Muslim 90%, Christian 10% (2020 est.)'."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from dossierkit.functions.sqltext import at, keep, let, matches, quote, transform
from dossierkit.functions.text import WS, strip

# Group -> words, in the order in which they are tried.
RELIGION_RULES = {
    "Catholic": ["catholic"],
    "Protestant": ["protestant", "anglican", "lutheran", "evangelical", "presbyterian", "methodist", "baptist"],
    "Orthodox": ["orthodox"],
    "Other Christian": ["christian", "mormon", "jehovah's witness"],
    "Muslim": ["muslim", "sunni", "shia", "shi'a"],
    "Jewish": ["jewish", "judaism"],
    "Hindu": ["hindu"],
    "Buddhist": ["buddhist"],
    "Folk Religion": ["folk religion", "animist", "shamanist", "traditional"],
    "Unaffiliated": ["unaffiliated", "none", "atheist", "agnostic", "secular"],
    "Other": ["other", "sikh", "baháʼí", "baha'i", "zoroastrian", "jain", "spiritualist"],
}

# Texts that hold no shares, the smallest share kept, and the number of slots.
NO_SHARES = ("n/a", "none", "")
MIN_SHARE = 0.01
SLOTS = 5

_PERCENT = rf"(\d{{1,3}}(?:\.\d+)?){WS}*%"
_NOTHING = "CAST(array() AS array<struct<name:string,pct:double>>)"


def _group_of(entry_name: str, rules: Mapping[str, list[str]]) -> str:
    """Position of the first rule with a word that occurs in the name; null when there is none.

    All words are found in one pass. That is only right when no word hides another, so rules with
    such words are tried one by one.
    """
    words = {w: i for i, group in reversed(list(enumerate(rules.values()))) for w in group}
    hidden = any(re.search(rf"\b{re.escape(w)}\b", other) for w in words for other in words if w != other)
    if hidden:
        cases = " ".join(
            f"WHEN {matches(entry_name, _any_word(group))} THEN {i}" for i, group in enumerate(rules.values())
        )
        return f"CASE {cases} END"
    ranks = "map(" + ", ".join(f"{quote(w)}, {i}" for w, i in sorted(words.items(), key=lambda x: x[1])) + ")"
    found = f"regexp_extract_all({entry_name}, {quote(_any_word(words))}, 0)"
    return f"array_min({transform(found, lambda w: f'try_element_at({ranks}, {w})')})"


def _any_word(words: Iterable[str]) -> str:
    return r"(?U)\b(?:" + "|".join(map(re.escape, words)) + r")\b"


def _entry(entry: str, rules: Mapping[str, list[str]]) -> str:
    """Group and share of one entry; the name is what stands before and behind the percentage."""
    share = f"CASE WHEN contains({entry}, '%') THEN try_cast(regexp_extract({entry}, {quote(_PERCENT)}, 1) AS double) END"
    around = quote(rf"(?s)^(.*?){WS}*{_PERCENT}{WS}*(.*)$")
    group = let(f"replace(regexp_replace({entry}, {around}, '$1$3'), '%', '')", lambda n: _group_of(n, rules))
    return let(share, lambda s: f"CASE WHEN {s} > 0 THEN struct({group} AS grp, {s} AS pct) END")


def round_cents(p: str) -> str:
    """A non-negative number to two digits, half to even, judged by its exact binary value.

    ``round`` judges by the shortest decimal text instead: 2.675 is a little less than that, and
    becomes 2.67. The fraction has at most 60 binary digits from 2**-7 on, so as an integer it is
    exact, and decimals compare it exactly. That is only done close to a half.
    """
    unit = 2**60
    fraction = f"CAST(CAST(({p} - floor({p})) * {unit}D AS bigint) AS decimal(19,0)) * 100"

    def up(f: str) -> str:
        cents = f"({f} div {unit})"
        twice = f"2 * ({f} - CAST({cents} AS decimal(3,0)) * {unit})"
        half_up = f"CASE WHEN {twice} > {unit} OR ({twice} = {unit} AND {cents} % 2 = 1) THEN 1 ELSE 0 END"
        return f"CAST(CAST(floor({p}) AS bigint) * 100 + {cents} + {half_up} AS double) / 100D"

    near_half = f"abs(pmod({p} * 200D, 2D) - 1D) < 1e-6D"
    return f"CASE WHEN {near_half} THEN {let(fraction, up)} ELSE floor({p} * 100D + 0.5D) / 100D END"


def parse_shares(c: str, rules: Mapping[str, list[str]] = RELIGION_RULES, threshold: float = MIN_SHARE) -> str:
    """Summed share per group, greatest first, ties in rule order: ``ARRAY<STRUCT<name, pct>>``.

    One text is one row all the way, so no shuffle is needed.
    """
    bare = strip(f"regexp_replace({c}, {quote(r'(?d)\(.*?\)')}, '')")
    entries = transform(f"split(translate({bare}, ';\\n', ',,'), ',')", lambda e: f"lower({strip(e)})")
    kept = keep(entries, lambda e: f"{e} != '' AND NOT startswith({e}, 'note:')")
    parsed = keep(transform(kept, lambda e: _entry(e, rules)), lambda e: f"{e}.grp IS NOT NULL")

    titles = f"array({', '.join(map(quote, rules))})"

    def total(found: str, group: str) -> str:
        hits = keep(found, lambda e: f"{e}.grp = {group}")
        pct = f"aggregate({hits}, 0D, (a, e) -> a + e.pct)"
        return let(
            pct,
            lambda p: f"CASE WHEN {p} > {threshold}D THEN "
            + let(round_cents(p), lambda r: f"struct(-{r} AS falling, {group} AS rule, {r} AS pct)")
            + " END",
        )

    def ranked(found: str) -> str:
        sums = transform(f"array_distinct({transform(found, lambda e: f'{e}.grp')})", lambda g: total(found, g))
        ordered = f"array_sort({keep(sums, lambda s: f'{s} IS NOT NULL')})"
        return transform(ordered, lambda s: f"struct(get({titles}, {s}.rule) AS name, {s}.pct AS pct)")

    marks = ", ".join(map(quote, NO_SHARES))
    return f"CASE WHEN lower({c}) IN ({marks}) THEN {_NOTHING} ELSE coalesce({let(parsed, ranked)}, {_NOTHING}) END"


def share_slots(shares: str, label: str = "Religion", slots: int = SLOTS) -> list[str]:
    """Name and percentage columns of the first ``slots`` shares; null where there are fewer."""
    return [
        f"{at(shares, i)}.{field} AS `{label} {i + 1} {title}`"
        for i in range(slots)
        for field, title in (("name", "Name"), ("pct", "Percentage"))
    ]


def shares_map(shares: str) -> str:
    """Shares as a map, for JSON export."""
    return f"map_from_entries({shares})"
