"""Counts against the library on whole texts, and edge cases."""

import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from __spark_entry__ import queries
from dossierkit.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole(texts):
    model = tokenizers.Tokenizer.from_file(PATH)
    return [len(model.encode(t, add_special_tokens=False).ids) for t in texts]


ODD = [
    "", " ", "a" * 60000, "x <|endoftext|>y don't  z", "<|startoftext|><|endoftext|> a", "İstanbul ΣΑΣ é ́a it's l'été 's",
    "\x00\x01 \x1c a\x85b a\x1fb", "a b　c\xa0d e", "Ǆ ﬀ ß ẞ... É.É á.b dog's cat's!", "word. word, WORD; word!!! $$$ 123 4.5",
    "漢字 かな 👍🏽 é ́", "a\tb\nc\r\nd\x0be\x0cf", "'s 't're don'T we'LL", " ".join(["same"] * 30000),
]


def test_query_against_the_library(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    expected = dict(zip(texts, whole(texts.values())))
    rows = queries()["op7_token_counts"](spark, sf).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == expected and len(rows) == len(texts)
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 2048) for r in rows)


def test_odd_texts_null_repeats_and_clashing_columns(spark):
    rows = [(i, t, 5, "x") for i, t in enumerate(ODD)] + [(100, None, 5, "x"), (0, "twice", 5, "x"), (0, "twice", 5, "x"), (None, "a b", 5, "x")]
    df = spark.createDataFrame(rows, "id bigint, body string, n_tokens int, _text string").coalesce(1)
    got = tokens.count_tokens(df, "body", PATH, ["id", "n_tokens", "_text"]).collect()
    assert [(r["id"], r.n_tokens) for r in got] == list(zip([r[0] for r in rows], whole([r[1] or "" for r in rows])))
    assert got[0].__fields__ == ["id", "n_bytes", "n_tokens"]
    assert tokens.count_tokens(df.limit(0), "body", PATH, ["id"]).collect() == []


@pytest.mark.parametrize("limits", [{"BATCH_BYTES": 10, "ENCODE_CHARS": 7}, {"CACHE_PIECES": 1, "CACHE_WORDS": 1, "CACHE_CHARS": 2}])
def test_batches_and_caches_change_nothing(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(tokens, name, value)
    texts = ODD[3:13] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "id int, body string").coalesce(1)
    assert [r.n_tokens for r in tokens.count_tokens(df, "body", PATH, ["id"]).collect()] == whole(texts)
    counter = tokens.Counter(PATH)
    assert [counter.count([t])[0] for t in texts] == whole(texts)


def test_sentencepiece_on_whole_texts(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    df = spark.createDataFrame(list(enumerate(ODD)), "id int, body string")
    got = {r["id"]: r.n_tokens for r in tokens.count_tokens(df, "body", path, ["id"]).collect()}
    assert got == {i: len(model.encode(t)) for i, t in enumerate(ODD)}


def test_whether_texts_are_cut_is_read_from_the_file():
    assert tokens.drops_white_space(PATH)
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert not tokens.drops_white_space(path)
    model = tokenizers.Tokenizer.from_file(path)
    texts = [*ODD, "One sentence, as it is written, with   blanks."]
    assert tokens.Counter(path).count(texts) == [len(model.encode(t, add_special_tokens=False).ids) for t in texts]
