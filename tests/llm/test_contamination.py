"""Items with errors against dynamic programming over all places, and edge cases."""

import random
import re

import pytest

from __spark_entry__ import queries
from dossierkit.llm import contamination


def words(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def least(pattern, text):
    """Edit distance of the pattern to its best place, by the plain recurrence."""
    column = list(range(len(pattern) + 1))
    best = column[-1]
    for word in text:
        before, column = column, [0]
        for i, p in enumerate(pattern, 1):
            column.append(min(before[i] + 1, column[i - 1] + 1, before[i - 1] + (p != word)))
        best = min(best, column[-1])
    return best


def brute(docs, items, rate):
    out = set()
    for d, text in docs:
        for i, item in items:
            w = words(item)
            if w and i is not None:
                errors = least(w, words(text))
                if errors <= int(rate * len(w) + 1e-9):
                    out.add((d, i, errors))
    return out


def found(spark, docs, items, rate):
    df = spark.createDataFrame([(*d, 3, "x") for d in docs], "id bigint, body string, found int, item string")
    bench = spark.createDataFrame(items, "item bigint, body string")
    rows = contamination.with_items(df, "body", bench, "item", "body", rate).collect()
    assert len(rows) == len(docs)
    kept = contamination.without_items(df, "body", bench, "item", "body", rate)
    assert kept.columns == df.columns
    assert sorted(r["id"] for r in kept.collect()) == sorted(r["id"] for r in rows if not r.found)
    return {(r["id"], f["item"], f.errors) for r in rows for f in r.found}


@pytest.mark.parametrize("rate", [0.0, 0.15, 0.34])
def test_edited_passages(spark, rate):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 40)))) for i in range(40)] + [(90, "  "), (91, None), (None, "w1 w2")]
    docs = []
    for d in range(120):
        text = rng.choices(vocabulary, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            part = words(rng.choice(items[:40])[1])
            for _ in range(rng.randint(0, 6)):
                at = rng.randrange(len(part) + 1)
                part[at : at + rng.randint(0, 1)] = rng.choices(vocabulary, k=rng.randint(0, 1))
            at = rng.randrange(len(text) + 1)
            text[at:at] = part
        docs.append((d, ", ".join(text).upper()))
    docs += [(500, None), (501, ""), (502, "!!"), (503, " ".join(w for _ in range(200) for w in words(items[0][1])))]
    assert found(spark, docs, items, rate) == brute(docs, items, rate)


def test_blocks_of_items_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 150)
    items = [(i, f"alpha{i} beta gamma{i} delta epsilon zeta{i} eta") for i in range(6)] + [(7, "alpha1 beta gamma1 delta epsilon zeta1 eta")]
    docs = [(1, "x " + items[1][1] + " y"), (2, items[5][1].replace("beta", "other")), (2, "none"), (3, "ÉTÉ beta")]
    assert found(spark, docs, items, 0.15) == {(1, 1, 0), (1, 7, 0), (2, 5, 1)}
    assert found(spark, docs, [(1, "été")], 0.15) == {(3, 1, 0)}
    assert found(spark, docs, [], 0.15) == set() == found(spark, [], items, 0.15)


def test_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    rows = queries()["op10_decontamination"](spark, sf).collect()
    assert {(r.doc_id, r.item_id, r.errors) for r in rows} == brute(docs, items, contamination.RATE)
    at = {d: words(t) for d, t in docs}
    for r in rows:
        assert least(words(dict(items)[r.item_id]), at[r.doc_id][max(0, r.end_word - 2 * r.n_words) : r.end_word]) == r.errors
