"""Token counts of whole texts with a public tokenizer, in Arrow batches balanced by bytes."""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierkit.llm.shared import without

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of text that are cut into pieces at a time.
BATCH_BYTES = 4 << 20
# Counts that a task remembers, of pieces and of the words in them, and the longest one kept.
CACHE_PIECES = 400_000
CACHE_WORDS = 600_000
CACHE_CHARS = 64
# A text without a safe boundary is one piece; pieces are encoded in batches of so many characters.
ENCODE_CHARS = 1 << 20

# White space is a safe boundary: the tokenizer's pattern drops it, and none of its tokens or
# added tokens holds any, so the tokens on both sides of it do not depend on each other.
_SAFE = re.compile(r"[ \t\n\r\x0b\x0c]+")
# ``str.split`` is faster and also cuts at these, which are no white space for the tokenizer.
_ODD = re.compile(r"[\x1c-\x1f]")
# A piece of Latin letters and the signs behind them: the pattern parts these as well, and it
# reads letters in lower case.
_ENDED = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?%*&#$|)]*)")


# What such a pattern ends with.
_KEPT = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def drops_white_space(path: str) -> bool:
    """Whether a tokenizer file says that texts may be cut at white space, and letters from the signs behind them.

    So it is if the text is only lower-cased and composed before, and cut by a pattern that keeps
    runs of letters, single digits and runs of other signs, and nothing else. Other files, and those
    that cannot be read that way, encode whole texts.
    """
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    before, first = parts.get("normalizer") or {}, parts.get("pre_tokenizer") or {}
    steps = before.get("normalizers", [before])
    blanks = {"Regex": r"\s+"}
    plain = all(s.get("type") in ("NFC", "Lowercase") or (s.get("type") == "Replace" and s.get("pattern") == blanks and s.get("content") == " ") for s in steps)
    cut = (first.get("pretokenizers") or [first])[0]
    pattern = (cut.get("pattern") or {}).get("Regex", "")
    return plain and cut.get("type") == "Split" and cut.get("invert") is True and cut.get("behavior") == "Removed" and pattern.endswith(_KEPT)


class Counter:
    """Numbers of tokens of texts, from the counts of the pieces between safe boundaries.

    ``splits`` tells whether texts may be cut there (``drops_white_space``). If not, whole texts are
    encoded.
    """

    def __init__(self, path: str, splits: bool | None = None):
        self.splits = splits = drops_white_space(path) if splits is None else splits
        self.known: dict[str, int] = {}
        self.words: dict[str, int] = {"": 0}
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.lengths = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            import tokenizers

            model = tokenizers.Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.lengths = lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]

    def encoded(self, pieces: list[str]) -> list[int]:
        """Lengths only, batch by batch: the encodings of a batch are gone before the next."""
        out, start, size = [], 0, 0
        for i, piece in enumerate(pieces):
            size += len(piece)
            if size >= ENCODE_CHARS:
                out += self.lengths(pieces[start : i + 1])
                start, size = i + 1, 0
        return out + (self.lengths(pieces[start:]) if start < len(pieces) else [])

    def count(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return self.encoded(texts)
        if len(self.known) > CACHE_PIECES:
            self.known.clear()
        if len(self.words) > CACHE_WORDS:
            self.words = {"": 0}
        known, words = self.known, self.words
        cut = [_SAFE.split(t) if _ODD.search(t) else t.split() for t in texts]
        parts = {}
        for piece in set().union(*cut).difference(known):
            ended = _ENDED.fullmatch(piece)
            parts[piece] = (ended[1].lower(), ended[2]) if ended else (piece, "")
        new = list({x for pair in parts.values() for x in pair if x not in words})
        words.update(zip(new, self.encoded(new)))
        known.update((piece, words[a] + words[b]) for piece, (a, b) in parts.items())
        counts = [sum(map(known.__getitem__, pieces)) for pieces in cut]
        for long in [x for x in new if len(x) > CACHE_CHARS]:
            del words[long]
        for long in [x for x in parts if len(x) > CACHE_CHARS]:
            del known[long]
        return counts


def _groups(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``BATCH_BYTES`` each, or one longer row."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > BATCH_BYTES:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def _counting(path: str, splits: bool | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = Counter(path, splits)
        for batch in batches:
            sizes = batch.column("n_bytes").to_numpy(zero_copy_only=False)
            texts = batch.column("_text")
            counts: list[int] = []
            for start, end in _groups(sizes):
                counts += counter.count(texts.slice(start, end - start).to_pylist())
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            names = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], [*names, "n_tokens"])

    return run


def count_tokens(df: DataFrame, text: str, tokenizer: str, keep: list[str], splits: bool | None = None) -> DataFrame:
    """The ``keep`` columns with ``n_bytes`` (UTF-8) and ``n_tokens`` of ``text``; no shuffle.

    ``tokenizer`` is the path of a ``.json`` or ``.model`` file on every machine. No begin, end or
    added tokens are put in; whether texts may be cut at white space is read from the file, unless
    ``splits`` says so; special strings inside a text count as the library takes them. Null
    is an empty text, which has 0 tokens. Every row gives one row; columns of ``keep`` that have a
    result's name are replaced. A very long text is cut at white space; without any, it is encoded
    whole, since no cut would be safe.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text")
    kept = without(df.select(*[f"`{c}`" for c in keep]), "n_bytes", "n_tokens", "_text")
    names = [f"`{c}`" for c in kept.columns]
    rows = df.select(*names, F.octet_length(value).cast("bigint").alias("n_bytes"), value)
    schema = ", ".join([*[f"{n} {t}" for n, (_, t) in zip(names, kept.dtypes)], "n_bytes bigint", "n_tokens bigint"])
    return rows.mapInArrow(_counting(tokenizer, splits), schema)
