"""Spelling variants against all pairs, refinement of hot chunks, and edge cases."""

import random
import re
import zlib
from collections import Counter

import pytest

from dossierkit.llm import spelling as S


def near(a, b):
    """Whether two words differ by exactly one code point."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def counted(docs, shortest=7, least=2, damage=31):
    n = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= shortest and c >= least}


def brute(n):
    forms, out = {}, []
    for w in n:
        others = [o for o in n if o != w and near(w, o)]
        best = min(others, key=lambda o: (-n[o], o), default=None)
        forms[w] = (best if best and n[best] >= 10 * n[w] else None, len(others))
    for w in n:
        root = w
        while forms[root][0]:
            root = forms[root][0]
        form = forms[w][0]
        out.append((w, form, root, n[w], forms[w][1], n[form] if form else None))
    return sorted(out)


def run(spark, docs):
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "id bigint, t string, word string, n int")
    return sorted(map(tuple, S.spelling_forms(S.word_counts(df, "id", "t")).collect()))


def prose(seed, n):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeéÿ") for _ in range(rng.randint(6, 12))) for _ in range(30)]

    def word():
        w = rng.choice(stems[: 1 + int(rng.random() ** 3 * 30)])
        for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcé") + w[i:], w[:i] + rng.choice("abcé") + w[i + 1 :]])
        return w.upper() if rng.random() < 0.1 else w

    return [(i, rng.choice([" ", ", ", "-", "\n"]).join(word() for _ in range(150))) for i in range(n)]


@pytest.mark.parametrize("limit", [1 << 14, 6])
def test_against_all_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(S, "HOT_PAIRS", limit)
    monkeypatch.setattr(S, "WINDOW", 100)
    monkeypatch.setattr(S, "COUNTED", 50)
    docs = [*prose(1, 60), (100, None), (101, ""), (None, "Straßen Straßen straßen"), (3, "×÷abcdefg ×÷abcdefg")]
    got = run(spark, docs)
    assert len(got) > 200 and got == brute(counted(docs))
    assert any(r[1] and r[2] != r[1] for r in got)  # a chain of forms


def test_pairs_come_once(spark, monkeypatch):
    words = ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "aaabaaa", "abababab", "babababa", "aaaaaab", "b", "ab", "abc", "xbc", "xyc", "一bc"]
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n bigint")
    for limit in (1 << 14, 0):
        got = [(r["word"], r["other"]) for r in S.near_words(df, limit).collect()]
        assert len(got) == len(set(got))
        assert set(got) == {(a, b) for a in words for b in words if len(a) > 1 and len(b) > 1 and near(a, b)}


def test_one_begin_for_all_words(spark):
    """A chunk that all words share is refined until groups are small."""
    rng = random.Random(4)
    words = sorted({"prefix" + "".join(rng.choice("abcd") for _ in range(6)) for _ in range(600)})
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n bigint")
    got = {(r["word"], r["other"]) for r in S.near_words(df, 50).collect()}
    assert got == {(a, b) for a in words for b in words if near(a, b)}


def test_ties_repeats_long_words_and_no_rows(spark):
    long = "ab" * 40_000
    text = " ".join(["abcdefg"] * 40 + ["abcdefh"] * 40 + ["abcdefx"] * 2 + [long] * 3 + [long + "c"] * 2)
    docs = [(7, text), (7, text)]
    assert run(spark, docs) == brute(counted(docs))
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "short words only"), (3, "singleton")]) == []
    with pytest.raises(ValueError):
        S.spelling_forms(spark.createDataFrame([], "word string, n bigint"), times=1)


def test_windows_keep_runs_whole(monkeypatch):
    monkeypatch.setattr(S, "WINDOW", 5)
    for text in ("", "abc", "abcdefghijk lm", "ab cde fgh ijklmnop", "a b c d e f g", "-----abc-----def"):
        parts = list(S.windows(text))
        assert "".join(parts) == text
        assert [r for p in parts for r in S._RUN.findall(p)] == S._RUN.findall(text)
