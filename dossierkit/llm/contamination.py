"""Benchmark items in documents, with errors: pieces that must occur exactly, then edit distance.

An item of n words may occur with up to k = ``rate`` * n words inserted, deleted or replaced. Cut
into k + 1 pieces, at least one piece then occurs without an error. So the first words of every
piece are looked up in every window of the texts, by hash; around each hit the least number of
errors is worked out with Myers' bit-parallel algorithm over whole words.

Items go to the tasks in blocks of bounded size, texts stay where they are: no shuffle.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierkit.llm.shared import without
from dossierkit.llm.wordhash import WORD_BASE, Words, is_no_letter, finished, ranges_sum, text_groups

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RATE = 0.2
# Words of a piece that are looked up; shorter pieces are looked up whole.
LOOKED_UP = 4
# Bytes of item texts that go to the tasks at a time.
BLOCK_BYTES = 16 << 20


def normal(text: Column) -> Column:
    """Texts are compared in lower case; words are runs of letters and digits."""
    return F.lower(F.coalesce(text, F.lit("")))


def _words(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    for start, end, data, offsets in text_groups(column):
        yield start, end, Words(data, offsets, between=is_no_letter(digits=True))


def least_errors(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of the pattern to any run of the text, and where the first such run ends.

    Myers' bit vectors: bit i of the plus and minus vectors says that row i + 1 of the column of
    distances is one more or one less than row i. The integers are as long as the pattern.
    """
    m = len(pattern)
    where: dict[int, int] = {}
    for i, word in enumerate(pattern):
        where[word] = where.get(word, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, word in enumerate(text, 1):
        eq = where.get(word, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, end = score, j
    return best, end


class Index:
    """Pieces of a block of items: sorted keys by length, and (item, place) of each."""

    def __init__(self, ids: list[int], texts: list[str], rate: float):
        self.ids, self.words, self.errors = ids, [], []
        rows: dict[int, list[tuple[int, int, int]]] = {}
        for _, _, words in _words(pa.array(texts, pa.large_string())):
            for i in range(words.n):
                own = words.hashes[words.first[i] : words.first[i + 1]]
                item = len(self.words)
                self.words.append(own.tolist())
                errors = int(rate * len(own) + 1e-9)
                self.errors.append(errors)
                if not len(own):
                    continue
                cuts = [len(own) * p // (errors + 1) for p in range(errors + 2)]
                for a, b in zip(cuts, cuts[1:]):
                    size = min(LOOKED_UP, b - a)
                    key = finished(ranges_sum(own, np.array([a]), np.array([a + size]), WORD_BASE))[0]
                    rows.setdefault(size, []).append((int(key), item, a))
        self.pieces = {}
        for size, found in rows.items():
            found.sort()
            self.pieces[size] = (np.array([f[0] for f in found], np.uint64), [f[1:] for f in found])

    def found(self, words: Words) -> list[list[dict]]:
        """Of every text: the items it holds, with the errors of the best place."""
        regions: list[dict[int, list[list[int]]]] = [{} for _ in range(words.n)]
        n = len(words.hashes)
        for size, (keys, places) in self.pieces.items():
            if n < size:
                continue
            at = np.arange(n - size + 1)
            at = at[words.doc[: len(at)] == words.doc[size - 1 :]]
            window = finished(ranges_sum(words.hashes, at, at + size, WORD_BASE))
            low = np.searchsorted(keys, window, "left")
            hit = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == window)
            for h, first in zip(hit.tolist(), low[hit].tolist()):
                start, doc = int(at[h]), int(words.doc[at[h]])
                k = first
                while k < len(keys) and keys[k] == window[h]:
                    item, place = places[k]
                    room = self.errors[item]
                    a = max(int(words.first[doc]), start - place - room)
                    b = min(int(words.first[doc + 1]), start - place + len(self.words[item]) + room)
                    regions[doc].setdefault(item, []).append([a, b])
                    k += 1
        out: list[list[dict]] = []
        for doc, items in enumerate(regions):
            own = []
            for item, spans in items.items():
                best = None
                for a, b in _joined(spans):
                    errors, end = least_errors(self.words[item], words.hashes[a:b].tolist())
                    if errors <= self.errors[item] and (best is None or errors < best[0]):
                        best = errors, a + end - int(words.first[doc])
                if best:
                    own.append({"item": self.ids[item], "n_words": len(self.words[item]), "errors": best[0], "end": best[1]})
            out.append(own)
        return out


def _joined(spans: list[list[int]]) -> list[list[int]]:
    """Overlapping regions as one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return out


def _blocks(items: DataFrame, key: str, text: str) -> Iterator[tuple[list[int], list[str]]]:
    ids, texts, size = [], [], 0
    rows = items.select(F.col(f"`{key}`").cast("bigint"), normal(F.col(f"`{text}`"))).filter(F.col(f"`{key}`").isNotNull())
    for item, value in rows.toLocalIterator():
        ids.append(item)
        texts.append(value)
        size += len(value) + 100
        if size >= BLOCK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


FOUND = "array<struct<item: bigint, n_words: int, errors: int, end: int>>"


def _searching(index: Index):
    """A function of a text column that lists the items in each text."""
    kind = pa.list_(pa.struct([("item", pa.int64()), ("n_words", pa.int32()), ("errors", pa.int32()), ("end", pa.int32())]))

    @F.arrow_udf(FOUND)
    def search(texts: pa.Array) -> pa.Array:
        out: list[list[dict]] = []
        for _, _, words in _words(texts):
            out += index.found(words)
        return pa.array(out, kind)

    return search


def with_items(df: DataFrame, text: str, items: DataFrame, item_key: str, item_text: str, rate: float = RATE) -> DataFrame:
    """All rows and columns, with ``found``: the benchmark items in the text and their errors.

    ``found`` has a struct for each item: ``item`` (its key), ``n_words`` of it, ``errors`` (the least
    number of words inserted, deleted or replaced, up to ``rate`` of its words, rounded down) and
    ``end`` (the number of words of the text up to the end of that place). Words are runs of
    letters and digits in lower case; beyond ASCII every character is a letter.

    Null and empty texts hold nothing; items without words or key are in nothing. Items that repeat
    a text are all found. A column of ``df`` that is called ``found`` is replaced. Items go to the
    tasks in blocks of ``BLOCK_BYTES``, one pass over the texts for each.
    """
    if not 0 <= rate < 1:
        raise ValueError("0 <= rate < 1")
    out = without(df, "found").withColumn("found", F.array().cast(FOUND))
    for ids, texts in _blocks(items, item_key, item_text):
        search = _searching(Index(ids, texts, rate))
        out = out.withColumn("found", F.concat("found", search(normal(F.col(f"`{text}`")))))
    return out


def without_items(df: DataFrame, text: str, items: DataFrame, item_key: str, item_text: str, rate: float = RATE) -> DataFrame:
    """The rows, with their columns as they are, whose text holds no benchmark item."""
    out = df
    for ids, texts in _blocks(items, item_key, item_text):
        search = _searching(Index(ids, texts, rate))
        out = out.filter(F.size(search(normal(F.col(f"`{text}`")))) == 0)
    return out
