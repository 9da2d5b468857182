"""Prompts, completions and masks against plain Python, and edge cases."""

import duckdb

import check
from dossierkit.llm import preferences


def turn(role, text):
    return f"<|im_start|>{role or ''}\n", f"{text or ''}<|im_end|>\n"


def brute(chosen, rejected):
    """{key: (n, prompt, chosen, rejected, learned texts of both)}."""
    def by_key(rows):
        out = {}
        for k, n, r, t in rows:
            if k is not None:
                out.setdefault(k, []).append((n, r, t))
        order = lambda x: tuple((v is not None, v) for v in x)
        return {k: [(r, t) for _, r, t in sorted(v, key=lambda x: tuple((a is not None, a if a is not None else 0) for a in x))] for k, v in out.items()}

    a, b = by_key(chosen), by_key(rejected)
    out = {}
    for k in a.keys() & b.keys():
        n = 0
        while n < min(len(a[k]), len(b[k])) and a[k][n] == b[k][n]:
            n += 1
        text = lambda turns: "".join("".join(turn(*t)) for t in turns)
        learned = lambda turns: [turn(*t)[1] for t in turns if t[0] == "assistant"]
        out[k] = (n, text(a[k][:n]), text(a[k][n:]), text(b[k][n:]), learned(a[k][n:]), learned(b[k][n:]))
    return out


A = [
    (1, 0, "user", "q"), (1, 1, "assistant", "good"), (1, 2, "user", "q2"), (1, 3, "assistant", "é👍"),
    (2, 0, "user", "same"), (2, 1, "assistant", "same"), (3, 0, "assistant", "a"), (4, 0, None, None), (4, 1, "assistant", None),
    (5, 1, "user", "later"), (5, 0, "user", "first"), (5, 1, "assistant", "tie"), (6, None, "user", "x"), (6, 0, "assistant", "y"),
    (7, 0, "user", "only here"), (None, 0, "user", "none"), (8, 0, "user", "r"), (8, 0, "user", "r"), (9, 0, "user", "p"), (10, 0, "assistant", "z" * 100000),
]
B = [
    (1, 0, "user", "q"), (1, 1, "assistant", "bad"), (1, 2, "assistant", "<|im_end|>\n"), (2, 0, "user", "same"), (2, 1, "assistant", "same"),
    (3, 0, "assistant", "a"), (3, 1, "user", "b"), (4, 0, None, None), (4, 1, "assistant", ""), (5, 0, "user", "first"), (5, 1, "assistant", "tie"),
    (6, None, "user", "x"), (6, 0, "assistant", "n"), (8, 0, "user", "r"), (9, 0, "system", "p"), (None, 0, "user", "none"), (10, 0, "assistant", "z"),
]


def test_pairs(spark):
    schema = "id bigint, n int, who string, said string, prompt string, _n int"
    sides = [spark.createDataFrame([(*r, "x", 3) for r in rows], schema) for rows in (A, B)]
    rows = preferences.preference_pairs(*sides, "id", "n", "who", "said").collect()
    got = {}
    for r in rows:
        learned = [[side[s.start : s.end] for s in mask] for side, mask in ((r.chosen, r.chosen_mask), (r.rejected, r.rejected_mask))]
        got[r["id"]] = (r.n_prompt_turns, r.prompt, r.chosen, r.rejected, *learned)
    assert got == brute(A, B) and len(rows) == len(got)
    none = sides[0].limit(0)
    assert preferences.preference_pairs(none, sides[1], "id", "n", "who", "said").collect() == []


def test_reply_of_the_next(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "assistant", "c"), (2, 0, "assistant", "d"), (2, 1, "user", "e"), (4, 0, "assistant", "f"), (3, 0, "user", "g"), (None, 0, "assistant", "h")]
    df = spark.createDataFrame(rows, "id bigint, n int, who string, said string")
    got = sorted(map(tuple, preferences.with_reply_of_next(df, "id", "n", "who", "said").collect()))
    assert got == [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "assistant", "d"), (2, 0, "assistant", ""), (2, 1, "user", "e"), (3, 0, "user", "g"), (4, 0, "assistant", "")]


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.sql("create view conversations as select * from '/root/testdata/sf0.01/conversations.parquet'")
    ok, note = check.compare(spark, con, "/root/testdata/sf0.01", "op3_preference_pairs")
    assert ok, note
