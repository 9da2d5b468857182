"""Removal of word windows that an earlier document holds as well, by level-wise doubling.

A window of ``window`` words holds ``window - length + 1`` windows of a shorter length; the one of
them with the smallest hash stands for it. Where the same long window occurs twice, the same
short one stands for it twice. So the short windows that stand for others are counted first, at
``first_length``; only those that occur in several documents are extended to twice the length,
and so on, until the windows have their full length or no candidates survive. What is left is
compared in full length: by 128 bits, the hash of the short window and that of the long one.

Every level goes through whole texts. Texts are never sent where a window is counted: a level
sends one number per candidate and document, the last one the hashes of the candidates' windows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierkit.llm.bloom import HASHES, Bloom
from dossierkit.llm.shared import checkpointed
from dossierkit.llm.wordhash import WINDOW_BASE, WORD_BASE, Words, finished, ranges_sum, sliding_min, text_groups

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 50
FIRST_LENGTH = 25
# Odd base of the hash of a run's windows.
RUN_BASE = 0xA0761D6478BD642F
# Windows of one row (a bit of a 64-bit mask each), and number of documents from which a short window's rows are dealt window by window.
ROW_WINDOWS = 64
HOT = 2048
PARTS = 256


class Windows:
    """Long windows of a run of texts, in runs that share the short windows that stand for them.

    Run ``r`` holds the windows from word ``start[r]`` on, ``size[r]`` of them, of text ``doc[r]``.
    ``stands[k][r]`` is the hash at level ``k``, ``digest[r]`` that of all its windows.
    """

    def __init__(self, words: Words, window: int, lengths: list[int]):
        n = len(words.hashes)
        self.words = words
        count = max(0, n - window + 1)
        inside = np.zeros(0, np.int64)
        if count:
            inside = np.flatnonzero(words.doc[:count] == words.doc[window - 1 :])
        self.at = inside
        if not len(inside):
            none = np.zeros(0, np.int64)
            self.start = self.size = self.doc = self.offset = none
            self.stands, self.digest, self.long = [none.astype(np.uint64) for _ in lengths], none.astype(np.uint64), none.astype(np.uint64)
            return
        stands = []
        for length in lengths:
            at = np.arange(n - length + 1)
            short = finished(ranges_sum(words.hashes, at, at + length, WORD_BASE))
            stands.append(sliding_min(short, window - length + 1)[inside])
        self.long = finished(ranges_sum(finished(words.hashes), inside, inside + window, WINDOW_BASE))
        change = (np.diff(inside) != 1) | (np.diff(words.doc[inside]) != 0)
        for s in stands:
            change |= s[1:] != s[:-1]
        begins = np.concatenate([[True], change])
        run = np.cumsum(begins) - 1
        place = np.arange(len(inside)) - np.flatnonzero(begins)[run]
        begins |= place % ROW_WINDOWS == 0
        self.offset = np.flatnonzero(begins)
        ends = np.append(self.offset[1:], len(inside))
        self.size = ends - self.offset
        self.start = inside[self.offset]
        self.doc = words.doc[self.start]
        self.stands = [s[self.offset] for s in stands]
        self.digest = finished(ranges_sum(self.long, self.offset, ends, RUN_BASE) + self.size.astype(np.uint64))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and numbers of a list column; a null list is empty."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([[0], np.cumsum(sizes)]), values


def _member(doc: np.ndarray, key: np.ndarray, offsets: np.ndarray, values: np.ndarray, first: int) -> np.ndarray:
    """Whether a run's key is in the list of its text; runs are in the order of texts."""
    out = np.zeros(len(key), dtype=bool)
    bounds = np.searchsorted(doc, np.arange(doc[-1] + 2)) if len(doc) else np.zeros(1, np.int64)
    for d in range(len(bounds) - 1):
        low, high = offsets[first + d], offsets[first + d + 1]
        if high > low and bounds[d + 1] > bounds[d]:
            part = slice(bounds[d], bounds[d + 1])
            out[part] = np.isin(key[part], values[low:high])
    return out


def _short_windows(window: int, lengths: list[int]):
    """(key, doc) of the short windows at the last of ``lengths``; others than candidates of the level before drop out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("_key").to_numpy(zero_copy_only=False)
            lists = _lists(batch.column("_keys")) if len(lengths) > 1 else None
            for start, _, data, offsets in text_groups(batch.column("_text")):
                windows = Windows(Words(data, offsets), window, lengths)
                doc, key = windows.doc, windows.stands[-1].view(np.int64)
                if lists:
                    own = _member(doc, windows.stands[-2].view(np.int64), *lists, start)
                    doc, key = doc[own], key[own]
                if len(key):
                    doc, key = _distinct(doc, key)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(docs[start + doc].astype(np.int64))], ["_short", "_key"])

    return run


def _distinct(doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])
    return doc[new], key[new]


def _candidate_rows(window: int, lengths: list[int], with_windows: bool):
    """Rows of runs whose short window is a candidate: (_short, _digest, _part, _key[, _long])."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column("_key").to_numpy(zero_copy_only=False).astype(np.int64)
            lists, hot = _lists(batch.column("_keys")), _lists(batch.column("_hot"))
            for start, _, data, offsets in text_groups(batch.column("_text")):
                w = Windows(Words(data, offsets), window, lengths)
                short = w.stands[-1].view(np.int64)
                rows = np.flatnonzero(_member(w.doc, short, *lists, start))
                if not len(rows):
                    continue
                order = np.lexsort((w.digest[rows], short[rows], w.doc[rows]))
                rows = rows[order]
                same = (np.diff(w.doc[rows]) == 0) & (np.diff(short[rows]) == 0) & (w.digest[rows][1:] == w.digest[rows][:-1])
                rows = rows[np.concatenate([[True], ~same])]
                if not with_windows:
                    columns = [pa.array(short[rows]), _signed(w.digest[rows]), pa.array(docs[start + w.doc[rows]])]
                    yield pa.RecordBatch.from_arrays(columns, ["_short", "_digest", "_key"])
                    continue
                is_hot = _member(w.doc, short, *hot, start)[rows]
                for chosen, single in ((rows[~is_hot], False), (rows[is_hot], True)):
                    if not len(chosen):
                        continue
                    size = w.size[chosen]
                    bounds = np.concatenate([[0], np.cumsum(size)])
                    within = np.arange(bounds[-1]) - np.repeat(bounds[:-1], size)
                    values = w.long[np.repeat(w.offset[chosen], size) + within]
                    if single:
                        chosen = np.repeat(chosen, size)
                        bounds = np.arange(len(values) + 1)
                        part, place = (values % np.uint64(PARTS)).astype(np.int32) + 1, within
                    else:
                        part, place = np.zeros(len(chosen), np.int32), np.zeros(len(chosen), np.int64)
                    columns = [
                        pa.array(short[chosen]), _signed(w.digest[chosen]), pa.array(part), pa.array(place.astype(np.int32)),
                        pa.array(docs[start + w.doc[chosen]]),
                        pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), _signed(values)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["_short", "_digest", "_part", "_place", "_key", "_long"])

    return run


def _repeated_within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of each context that a document with a smaller key holds as well, as a mask: bit = place.

    Rows come by (_short, _part); those of the last group wait for the next batch.
    """

    def judged(table: pa.Table) -> pa.RecordBatch:
        short, part, first = (table.column(c).to_numpy() for c in ("_short", "_part", "_first"))
        bounds, values = _lists(table.column("_long").combine_chunks())
        size = np.diff(bounds)
        row = np.repeat(np.arange(len(short)), size)
        s, w, d = short[row], values, first[row]
        order = np.lexsort((d, w, s))
        s, w, d, row = s[order], w[order], d[order], row[order]
        begins = np.concatenate([[True], (s[1:] != s[:-1]) | (w[1:] != w[:-1])])
        smallest = d[np.flatnonzero(begins)[np.cumsum(begins) - 1]]
        known = d > smallest
        place = (np.arange(len(values)) - np.repeat(bounds[:-1], size))[order][known]
        row = row[known]
        base = table.column("_place").to_numpy().astype(np.int64)
        mask = np.zeros(len(short), np.uint64)
        np.bitwise_or.at(mask, row, np.uint64(1) << (place + base[row]).astype(np.uint64))
        columns = [pa.array(short), table.column("_digest").combine_chunks(), pa.array(first), _signed(mask), pa.array((base + size).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["_short", "_digest", "_first", "_mask", "_size"])

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        short, part = batch.column("_short").to_numpy(), batch.column("_part").to_numpy()
        last = np.flatnonzero((short != short[-1]) | (part != part[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        same = waiting and waiting[0].column("_short")[0].as_py() == short[0] and waiting[0].column("_part")[0].as_py() == part[0]
        if cut or (waiting and not same):
            done = pa.Table.from_batches([*waiting, batch.slice(0, cut)])
            if done.num_rows:
                yield judged(done)
            waiting = []
        waiting.append(batch.slice(cut))
    if waiting:
        yield judged(pa.Table.from_batches(waiting))


def _cleaning(window: int, lengths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text")
            found = batch.column("_found").to_pylist()
            n_words, n_removed, kept, spans = [], [], [], []
            for start, end, data, offsets in text_groups(texts):
                raw = data.tobytes()
                need = [i for i in range(start, end) if found[i]]
                w = Windows(Words(data, offsets), window, lengths) if need else None
                for i in range(start, end):
                    own = raw[offsets[i - start] : offsets[i - start + 1]].split()
                    gone: list[dict] = []
                    if found[i]:
                        gone = _covered(w, i - start, found[i], window)
                    left, at = [], 0
                    for g in gone:
                        left += own[at : g["start"]]
                        at = g["end"]
                    left = left + own[at:] if gone else own
                    n_words.append(len(own))
                    n_removed.append(len(own) - len(left))
                    kept.append(b" ".join(left).decode())
                    spans.append(gone)
            columns = [batch.column(i) for i in range(batch.num_columns - 2)]
            names = batch.schema.names[:-2]
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            out = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays([*columns, *out], [*names, "n_words", "n_removed", "kept_text", "removed"])

    return run


def _spacing(bloom: Bloom):
    """Rows of ``_cleaning`` for texts that lose nothing: those whose key the filter does not hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            key, places = batch.column(0), [batch.column(f"_place{i}") for i in range(HASHES)]
            own = np.flatnonzero(~bloom.holds(places) | key.is_null().to_numpy(zero_copy_only=False))
            for at in range(0, len(own), ROW_WINDOWS):
                rows = pa.array(own[at : at + ROW_WINDOWS])
                words = [t.encode().split() for t in batch.column("_text").take(rows).to_pylist()]
                n = len(words)
                kept = pa.array([b" ".join(w).decode() for w in words], pa.string())
                columns = [key.take(rows), pa.array([len(w) for w in words], pa.int64()), pa.array([0] * n, pa.int64()), kept, pa.array([[]] * n, span)]
                yield pa.RecordBatch.from_arrays(columns, [batch.schema.names[0], "n_words", "n_removed", "kept_text", "removed"])

    return run


def _covered(w: Windows, doc: int, found: list[dict], window: int) -> list[dict]:
    """Joined spans of words, from 0, that repeated windows of one text cover."""
    verdict = {(f["_short"], f["_digest"]): f["_mask"] for f in found}
    low, high = np.searchsorted(w.doc, [doc, doc + 1])
    short, digest = w.stands[-1].view(np.int64), w.digest.view(np.int64)
    spans: list[dict] = []
    base = int(w.words.first[doc])
    for r in range(low, high):
        mask = verdict.get((short[r], digest[r]), 0)
        for place in range(int(w.size[r]) if mask else 0):
            if not mask >> place & 1:
                continue
            a = int(w.start[r]) - base + place
            if spans and a <= spans[-1]["end"]:
                spans[-1]["end"] = a + window
            else:
                spans.append({"start": a, "end": a + window})
    return spans


def remove_repeats(df: DataFrame, key: str, text: str, window: int = WINDOW, first_length: int = FIRST_LENGTH) -> DataFrame:
    """``key, n_words, n_removed, kept_text, removed`` for every row.

    A window is ``window`` consecutive words ``[^\\x20\\x09-\\x0D]+`` of one text. A word goes if a
    window covers it whose words also start in a row with a smaller key. Windows are judged on the
    input. ``kept_text`` is the other words with one space between, ``removed`` the spans of words
    (from 0, end outside) that went. ``key`` is an integer.

    Null texts have no words. Rows with a null key stay whole and are no source of repeats. Rows that
    repeat a key are no repeats of each other. Texts shorter than a window stay whole. Other
    columns are not looked at.
    """
    if not 0 < first_length <= window:
        raise ValueError("0 < first_length <= window")
    docs = df.select(F.col(f"`{key}`").cast("bigint").alias("_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    known = docs.filter("_key IS NOT NULL")
    lengths: list[int] = []
    candidates = bloom = None
    length = first_length
    while True:
        lengths.append(length)
        source = known if candidates is None else known.filter(bloom.may_hold("_key")).join(candidates.select("_key", "_keys"), "_key")
        # One row per short window and document; the same text pass is made for both uses.
        short = source.mapInArrow(_short_windows(window, lengths), "_short bigint, _key bigint")
        held = short.groupBy("_short").agg(F.min("_key").alias("_low"), F.max("_key").alias("_high"), F.count("*").alias("_docs"))
        repeated = held.filter("_low < _high").select("_short", (F.col("_docs") > HOT).alias("_hot"))
        by_doc = short.join(repeated, "_short").groupBy("_key").agg(
            F.collect_list("_short").alias("_keys"), F.collect_list(F.when(F.col("_hot"), F.col("_short"))).alias("_hot")
        )
        candidates = checkpointed(by_doc)
        bloom = Bloom(candidates, "_key")
        length *= 2
        if length >= window or candidates.isEmpty():
            break
    # Texts without a candidate are not shuffled.
    marked = known.filter(bloom.may_hold("_key")).join(candidates, "_key")
    kinds = "_short bigint, _digest bigint, _part int, _place int, _key bigint, _long array<bigint>"
    rows = marked.mapInArrow(_candidate_rows(window, lengths, True), kinds)
    # Equal contexts become one row before anything is compared; the smallest key stands for them.
    contexts = rows.groupBy("_short", "_digest", "_part", "_place").agg(F.min("_key").alias("_first"), F.first("_long").alias("_long"))
    contexts = contexts.repartition(F.col("_short"), F.col("_part")).sortWithinPartitions("_short", "_part")
    judged = contexts.mapInArrow(_repeated_within, "_short bigint, _digest bigint, _first bigint, _mask bigint, _size int")
    verdicts = judged.groupBy("_short", "_digest").agg(
        F.min("_first").alias("_first"), F.bit_or("_mask").alias("_mask"), F.max("_size").alias("_size")
    )
    holders = marked.mapInArrow(_candidate_rows(window, lengths, False), "_short bigint, _digest bigint, _key bigint")
    later = F.col("_key") > F.col("_first")
    hits = holders.join(verdicts, ["_short", "_digest"]).select(
        "_key", "_short", "_digest",
        # All windows: the lowest ``_size`` bits.
        F.when(later, F.expr(f"shiftrightunsigned(-1L, {ROW_WINDOWS} - _size)")).otherwise(F.col("_mask")).alias("_mask"),
    )
    hits = hits.filter("_mask <> 0")
    found = hits.groupBy("_key").agg(F.collect_list(F.struct("_short", "_digest", "_mask")).alias("_found"))
    schema = f"`{key}` bigint, n_words bigint, n_removed bigint, kept_text string, removed array<struct<start: bigint, end: bigint>>"
    few = docs.filter(F.col("_key").isNotNull() & bloom.may_hold("_key")).join(found, "_key", "left")
    few = few.select(F.col("_key").alias(key), "_text", "_found").mapInArrow(_cleaning(window, lengths), schema)
    # The others need no second Python worker for the filter: the task leaves out what the first part has.
    rest = docs.select(F.col("_key").alias(key), *Bloom.places("_key"), "_text")
    return few.union(rest.mapInArrow(_spacing(bloom), schema))
