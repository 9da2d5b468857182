import random

import pytest

from dossierkit.functions import shares as S


# Texts with their shares, greatest first.
TEXTS = {
    "Muslim 90%, Christian 10% (a, b 3%)": [("Muslim", 90.0), ("Other Christian", 10.0)],
    "muslim 90% sunni": [],  # what stands on both sides of a share is one word
    "<1% other, 1-2% jewish; 1000% hindu\nnote: sunni 4%": [("Jewish", 2.0), ("Other", 1.0)],
    "Catholic 20%, Protestant 20%, lutheran 0.5 %, none 0%, x 5%": [("Protestant", 20.5), ("Catholic", 20.0)],
    "jehovah's witnesses 3%, christians 4%, Christian 2%, Jehovah's Witness 1%": [("Other Christian", 3.0)],
    "None": [],
    "N/A": [],
    "": [],
    None: [],
    "Roman Catholic and Muslim 6%, Muslim and Catholic 1%, shi'a 4%, romanian orthodox 5%": [
        ("Catholic", 7.0), ("Orthodox", 5.0), ("Muslim", 4.0),
    ],
    "5% % folk  religion, folk religion 7%": [("Folk Religion", 7.0)],
    "MUSLIM 50.25 %; Hindu 50.25%": [("Muslim", 50.25), ("Hindu", 50.25)],
    "buddhist 0.01%, hindu 0.02%": [("Hindu", 0.02)],
}


def shares(evaluate, texts):
    return [[tuple(s) for s in f] for f in evaluate(S.parse_shares("x"), texts)]


def test_known_texts(evaluate):
    assert shares(evaluate, list(TEXTS)) == list(TEXTS.values())


def entries(rng, n):
    """Entries that have a share each, with the group they belong to."""
    words = [(group, w) for group, listed in S.RELIGION_RULES.items() for w in listed]
    out = []
    for _ in range(n):
        group, word = rng.choice(words)
        share = rng.choice([1, 5, 12.5, 40, 99])
        text = rng.choice([f"{word} {share}%", f"{share}% {word}", f"{word.title()} {share} % (2020 est.)", f"the {word} {share}%"])
        out.append((group, share, text))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_shares_of_a_group_add_up_in_any_order(evaluate, seed):
    rng = random.Random(seed)
    cases = [entries(rng, rng.randint(0, 8)) for _ in range(200)]
    texts, shuffled = [], []
    for case in cases:
        parts = [text for _, _, text in case]
        texts.append(rng.choice([", ", "; ", "\n", ","]).join(parts))
        shuffled.append(", ".join(rng.sample(parts, len(parts))))
    found = shares(evaluate, texts)
    assert [dict(f) for f in shares(evaluate, shuffled)] == [dict(f) for f in found]
    for case, one in zip(cases, found):
        total = {}
        for group, share, _ in case:
            total[group] = total.get(group, 0) + share
        assert dict(one) == total
        assert [p for _, p in one] == sorted((p for _, p in one), reverse=True)


@pytest.mark.parametrize("junk", ["nothing here", "note: sunni 4%", "hindu", "hindu 0%", "(hindu 7%)", "", "tribes 5%"])
def test_entries_without_a_share_or_group_change_nothing(evaluate, junk):
    known = "Muslim 60%, Hindu 30%"
    assert shares(evaluate, [f"{known}, {junk}", f"{junk}; {known}"]) == [shares(evaluate, [known])[0]] * 2


def test_rounding_is_that_of_binary_numbers(evaluate):
    rng = random.Random(4)
    numbers = [2.675, 0.125, 0.375, 1.005, 0.015, 0.025, 99.995, 100.0, 12.5, 1234.565, 0.1 + 0.2, 0.0100001]
    numbers += [rng.randrange(2, 400000) / 2000 for _ in range(2000)] + [rng.random() * 300 + 0.01 for _ in range(500)]
    assert evaluate(S.round_cents("x"), numbers, "double") == [round(n, 2) for n in numbers]


def test_words_that_hide_one_another_are_tried_in_order(evaluate):
    rules = {"B": ["black tea"], "T": ["tea"], "C": ["black"]}
    found = evaluate(S.parse_shares("x", rules), ["black tea 5%, tea 2%, black 1%"])
    assert [tuple(s) for s in found[0]] == [("B", 5.0), ("T", 2.0), ("C", 1.0)]


def test_slots(spark):
    df = spark.createDataFrame([("Muslim 90%, Hindu 5%",), ("None",)], "x string")
    rows = df.selectExpr(f"{S.parse_shares('x')} AS s").selectExpr(*S.share_slots("s")).collect()
    assert tuple(rows[0]) == ("Muslim", 90.0, "Hindu", 5.0, *[None] * 6)
    assert tuple(rows[1]) == (None,) * 10
    as_map = df.selectExpr(f"{S.shares_map(S.parse_shares('x'))} AS m").collect()
    assert as_map[0].m == {"Muslim": 90.0, "Hindu": 5.0}
