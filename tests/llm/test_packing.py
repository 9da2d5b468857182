"""Pieces against the tokenizer, bins against a plain packer, and edge cases."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
import tokenizers

from dossierkit.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    model = tokenizers.Tokenizer.from_file(PATH)
    return [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]


def plain_bins(lengths, capacity):
    """Number of bins when the fullest set with the longest length left is taken, bin by bin."""
    left, bins = Counter(lengths), 0
    while left:
        longest = max(left)
        reach = {0: ()}
        for n in sorted(left.elements(), reverse=True):
            if n <= capacity - longest:
                for s, chosen in list(reach.items()):
                    rest = Counter(chosen)[n] < left[n] - (n == longest)
                    if s + n <= capacity - longest and s + n not in reach and rest:
                        reach[s + n] = (*chosen, n)
        left -= Counter([longest, *reach[max(reach)]])
        bins += 1
    return bins


def checked(rows, capacity):
    """Every sequence is filled without gaps and holds ``capacity`` at most; the number of sequences."""
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("seed", range(4))
def test_plan_matches_a_plain_packer(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, 20) for _ in range(60)]
    plan = packing.plan_bins(Counter(lengths), 20)
    used = Counter()
    for times, chosen in plan:
        assert sum(n * m for n, m in chosen.items()) <= 20
        for n, m in chosen.items():
            used[n] += times * m
    assert used == Counter(lengths)
    assert abs(sum(t for t, _ in plan) - plain_bins(lengths, 20)) <= 1


def test_fullest_is_the_best_sum():
    rng = random.Random(3)
    for _ in range(200):
        counts = Counter(rng.randint(1, 15) for _ in range(rng.randint(0, 8)))
        room = rng.randint(0, 30)
        lengths = sorted(counts, reverse=True)
        sums = {0}
        for n in counts.elements():
            sums |= {s + n for s in sums}
        found = packing.fullest(lengths, counts, room)
        assert all(found[n] <= counts[n] for n in found)
        assert sum(n * m for n, m in found.items()) == max(s for s in sums if s <= room)


def test_plan_does_not_grow_with_the_counts():
    plan = packing.plan_bins({n: 10**9 + n for n in range(1, 1025)}, 1024)
    assert len(plan) < 20_000
    used = Counter()
    for times, chosen in plan:
        for n, m in chosen.items():
            used[n] += times * m
    assert used == {n: 10**9 + n for n in range(1, 1025)}


def texts():
    rng = random.Random(1)
    signs = [" ", "\n", "\t", "　", "a", "b c", "é", "漢", "1", ".", "'s", "  ", "ab, ", "<|endoftext|>", "\x1c"]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(300)]


def test_encoder_is_the_library(monkeypatch):
    monkeypatch.setattr(packing, "WINDOW", 10)
    encoder = packing.Encoder(PATH)
    assert encoder.fast
    for text, ids in zip(texts(), library(texts())):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids
    other = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not other.fast
    assert np.frombuffer(other.encode("Some words, some more"), "<u4").tolist()
    blanks = " " * 5000 + "x"
    assert np.frombuffer(encoder.encode(blanks), "<u4").tolist() == library([blanks])[0]


def test_documents_in_sequences(spark, monkeypatch):
    monkeypatch.setattr(packing, "CELL_ROWS", 7)
    rng = random.Random(2)
    words = [None, "", "word " * 4000, "x", "x", *texts(), *["many words " * rng.randint(0, 60) for _ in range(200)]]
    rows = [(i // 2, t, 1, "z") for i, t in enumerate(words)] + [(None, "none", 1, "z")]
    df = spark.createDataFrame(rows, "id bigint, text string, piece int, offset string")
    packed = packing.packed_documents(df, "id", "text", PATH, 100, end=2)
    got = packed.collect()
    wanted = Counter()
    for (key, text, *_), ids in zip(rows, library([r[1] or "" for r in rows])):
        ids = [*ids, 2]
        first = (len(ids) - 1) % 100 + 1
        starts = [0, *range(first, len(ids), 100)]
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            wanted[key, i, a, tuple(ids[a:b])] += 1
    assert Counter((r["id"], r["piece"], r["start"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == wanted
    assert all(r["length"] == len(r["ids"]) // 4 for r in got)
    n = checked(got, 100)
    assert n <= -(-sum(r["length"] for r in got) // 100) + 1
    made = packing.sequences(packed).collect()
    assert len(made) == n and all(r["n_tokens"] * 4 == len(r["ids"]) <= 400 for r in made)
    joined = defaultdict(bytes)
    for r in sorted(got, key=lambda r: r["offset"]):
        joined[r["sequence_id"]] += r["ids"]
    assert {r["sequence_id"]: bytes(r["ids"]) for r in made} == dict(joined)


def test_hot_length_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "CELL_ROWS", 10)
    df = spark.createDataFrame([(i, 3) for i in range(500)] + [(i, 10 - i % 3) for i in range(40)], "id int, length int")
    got = packing.pack(df, capacity=10).collect()
    assert len(got) == 540 and len({(r["sequence_id"], r["offset"]) for r in got}) == 540
    checked(got, 10)
    assert packing.pack(df.limit(0), capacity=10).collect() == []
    empty = packing.token_pieces(spark.createDataFrame([], "id int, text string"), "text", PATH, ["id"])
    assert empty.collect() == []
    none = spark.createDataFrame([(1, ""), (2, None)], "id int, text string")
    assert packing.token_pieces(none, "text", PATH, ["id"]).collect() == []
    for bad in (0, 11, None):
        with pytest.raises(ValueError):
            packing.pack(spark.createDataFrame([(1, bad)], "id int, length int"), capacity=10)


def test_query_digests(spark):
    from dossierkit.llm.queries import best_fit_packing

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = best_fit_packing(spark, sf).collect()
    wanted = Counter()
    for doc, ids in zip(docs, library([d["text"] or "" for d in docs])):
        ids = np.array([*ids, 2], "<u4")
        for i, (start, length) in enumerate(packing.piece_bounds(len(ids), 1024)):
            wanted[doc["doc_id"], i, start, length, zlib.crc32(ids[start : start + length].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == wanted
    assert checked(got, 1024) <= 1.02 * sum(r["length"] for r in got) / 1024
