"""Spelling variants: words that differ in one code point, found by asymmetric q-chunks.

Of two words one edit apart, take the longer (of equally long ones, either). It contributes two
disjoint chunks, its first and its last half: one edit spoils one of them at most. The other word
contributes its positional grams of a chunk's length. They meet where a gram equals a chunk and
stands within one place of it, as far as one edit can move it, and are then compared in full.

A chunk that too many words share is refined: what is left of its words beside the chunk holds the
edit, so it is cut into chunks and grams again, until groups are small or one letter is left, when
a group has no more words than there are letters for the place.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierkit.llm.shared import checkpointed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LETTERS = "A-Za-zÀ-ÿ"
SHORTEST = 7
LEAST_COUNT = 2
# A form is so many times as frequent as its variant.
TIMES = 10
# One in so many runs loses a letter.
DAMAGE = 31
# Pairs that a chunk may bring before it is refined.
HOT_PAIRS = 1 << 14
# Characters of a text that are searched at a time, and words that a task counts at a time.
WINDOW = 1 << 20
COUNTED = 200_000

_RUN = re.compile(f"[{LETTERS}]+")
# Over UTF-8, where letters beyond A to Z hold no byte of theirs.
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def windows(text: str) -> Iterator[str]:
    """A long text in parts that do not cut a run."""
    start = 0
    while len(text) - start > WINDOW:
        run = _RUN.match(text, start + WINDOW)
        end = run.end() if run else start + WINDOW
        yield text[start:end]
        start = end
    yield text[start:]


def damaged(begun: int, run: str, damage: int) -> str:
    """A run as it counts: one in ``damage`` lacks a letter. ``begun`` is the CRC-32 of what stands before it."""
    h = zlib.crc32(run.encode(), begun)
    if h % damage:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counting(shortest: int, damage: int | None):
    """(word, n) of runs that are long enough; a word may come more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        long_enough = re.compile(f"[{LETTERS}]{{{max(shortest, 1)},}}")

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column("_key").to_pylist(), batch.column("_text")):
                begun = zlib.crc32(f"{key}:".encode())
                for part in windows(text.as_py()):
                    for found in long_enough.findall(part.encode().translate(_LOWER).decode()):
                        if damage:
                            found = damaged(begun, found, damage)
                        counts[found] = counts.get(found, 0) + 1
                    if len(counts) > COUNTED:
                        yield made()
                        counts.clear()
        if counts:
            yield made()

    return run


def word_counts(
    df: DataFrame, key: str, text: str, shortest: int = SHORTEST, least: int = LEAST_COUNT, damage: int | None = DAMAGE
) -> DataFrame:
    """``word, n`` of the runs of ``LETTERS`` in all texts, A to Z in lower case.

    If ``damage`` is given and divides the CRC-32 ``h`` of ``<key>:<run>`` (UTF-8), the run lacks
    its letter ``h % length``; a null key is an empty text there. Words have at least ``shortest``
    letters and ``least`` occurrences. Null texts have none. A task counts before it sends.
    """
    rows = df.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("_key"), F.col(f"`{text}`").alias("_text"))
    counted = rows.filter("_text IS NOT NULL").mapInArrow(_counting(shortest, damage), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) & (F.length("word") >= shortest))


def _split(rows: DataFrame, level: int) -> DataFrame:
    """Rows with both halves of what is left of a word as key: ``_key, _rest, _size`` change.

    ``_size`` is the length of the chunk side's rest; of the grams of a word as long, or shorter by
    one, one edit can leave a chunk's letters only at the begin or at the end. ``_first<level>`` is
    null behind the first half, else the hash of the half that must differ for the pair to count here.
    """
    q = "(_size div 2)"
    first, last = f"left(_rest, {q})", f"right(_rest, {q})"
    cut = f"""array(
        struct(xxhash64(_key, _size, 0, {first}) AS key, substring(_rest, {q} + 1) AS rest, CAST(NULL AS bigint) AS first),
        struct(xxhash64(_key, _size, 1, {last}) AS key, left(_rest, length(_rest) - {q}) AS rest, xxhash64({first}) AS first))"""
    kept = [c for c in rows.columns if c not in ("_key", "_rest", "_size")]
    each = rows.select(*kept, F.expr(f"_size - {q}").alias("_size"), F.explode(F.expr(cut)).alias("_c"))
    return each.select(*kept, "_size", F.col("_c.key").alias("_key"), F.col("_c.rest").alias("_rest"), F.col("_c.first").alias(f"_first{level}"))


def near_words(words: DataFrame, hot_pairs: int | None = None) -> DataFrame:
    """``word, n, other, other_n``: each word with each one that differs by one code point; both ways.

    ``words`` has ``word`` and ``n``; it is read several times, so it should be a written table, and
    words are distinct and not null. Words of one letter are not compared. A pair counts where its
    first whole chunk meets, at every level, so no pair comes twice.
    """
    limit = HOT_PAIRS if hot_pairs is None else hot_pairs
    sized = words.select("word", "n", F.length("word").alias("m")).filter("m > 1")
    start = ["word", "n", F.lit(0).alias("_key"), F.col("word").alias("_rest")]
    long = sized.select(*start, F.col("m").alias("_size"))
    short = sized.select(*start, F.explode(F.array("m", F.col("m") + 1)).alias("_size"))
    found, level = None, 0
    while True:
        long, short = _split(long, level), _split(short, level)
        sides = long.select("_key", "_size", F.lit(1).alias("_long")).union(short.select("_key", "_size", F.lit(0)))
        counts = sides.groupBy("_key").agg((F.sum("_long") * F.sum(1 - F.col("_long"))).alias("_pairs"), F.max("_size").alias("_size"))
        hot = checkpointed(counts.filter((F.col("_pairs") > limit) & (F.col("_size") > 1)).select("_key"))
        a, b = long.join(hot, "_key", "left_anti").drop("_rest"), short.drop("_rest", "_size")
        # Chunk words are at least as long; of equally long words the smaller one contributes the chunk.
        tests = ["(length(a.word) > length(b.word) OR a.word < b.word)"]
        tests += [f"coalesce(a._first{i} <> b._first{i}, true)" for i in range(level + 1)]
        tests += ["a.word <> b.word", "levenshtein(a.word, b.word, 1) = 1"]
        met = a.alias("a").join(b.alias("b"), F.expr(" AND ".join(["a._key = b._key", *tests])))
        met = checkpointed(met.selectExpr("a.word AS a", "a.n AS a_n", "b.word AS b", "b.n AS b_n"))
        found = met if found is None else found.union(met)
        if hot.isEmpty():
            break
        long, short = (checkpointed(side.join(hot, "_key", "left_semi")) for side in (long, short))
        level += 1
    return found.union(found.select("b", "b_n", "a", "a_n")).toDF("word", "n", "other", "other_n")


def spelling_forms(words: DataFrame, times: int = TIMES) -> DataFrame:
    """All ``word, n`` with ``form``, ``root``, ``n_near`` and ``form_n``.

    A word's form is its most frequent near word (of equal ones the first in code-point order), if
    that is ``times`` as frequent at least; the root follows forms to the last. Forms grow more
    frequent at each step, so there are no circles, and steps are followed by doubling.
    """
    if times < 2:
        raise ValueError("times must be 2 or more")
    words = checkpointed(words.select("word", "n"))
    best = F.min(F.struct((-F.col("other_n")).alias("_less"), F.col("other").alias("_other"))).alias("_best")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best, F.max("n").alias("_n"))
    enough = -F.col("_best._less") >= F.col("_n") * times
    near = checkpointed(near.select("word", "n_near", F.when(enough, F.col("_best._other")).alias("form"), F.when(enough, -F.col("_best._less")).alias("form_n")))
    step = near.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    step = checkpointed(step)
    while True:
        further = step.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = checkpointed(step.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        step = longer.select("word", "root")
        if longer.filter("_moved").isEmpty():
            break
    out = words.join(near, "word", "left").join(step, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")
