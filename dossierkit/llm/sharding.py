"""Rendezvous hashing of record keys over weighted shards, with gapless slots in each shard.

Every shard gives every key a score, and the best score takes the record. A shard's score depends
on the key and that shard alone, so another shard takes records only into itself, and a record
that it does not take stays where it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossierkit.llm.shared import without

# Cells that number a shard's records side by side; offsets of all cells are broadcast.
CELLS = 256
MOST_OFFSETS = 1 << 18

# A prime, and the sizes of a key's four words and of a shard's four factors.
PRIME = (1 << 31) - 1
WORD_BITS, FACTOR_BITS = 32, 28
# Scores are compared as integers of 40 bits, then the lower shard wins.
SCALE = 1 << 40
SHARD_BITS = 1 << 20


def key_hash(key: Column) -> Column:
    """The four 32-bit words of the key's MD5; a null key counts as an empty one."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)])


def factors(shard: int) -> list[int]:
    """Four factors of a shard, from the MD5 of its number."""
    digest = hashlib.md5(str(shard).encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) >> (WORD_BITS - FACTOR_BITS) for i in range(4)]


def mixed(words: Sequence[str], shard: int) -> str:
    """SQL: a hash below ``PRIME`` of a key's words. Any four shards' hashes are independent."""
    return "((" + " + ".join(f"{w} * {f}" for w, f in zip(words, factors(shard))) + f") % {PRIME})"


def rendezvous(words: Sequence[str], weights: Sequence[float]) -> Column:
    """Shard 0 to len(weights) - 1 of a hashed key: the greatest ``u ** (1 / weight)``.

    A shard's share of the keys is its weight over the sum of weights.
    """
    if not weights or min(weights) <= 0 or len(weights) > SHARD_BITS:
        raise ValueError("weights must be positive, one for each shard")
    scores = []
    for shard, weight in enumerate(weights):
        unit = f"(({mixed(words, shard)} + 0.5D) / {PRIME}D)"
        score = unit if weight == 1 else f"power({unit}, {1 / weight!r}D)"
        scores.append(f"(cast({score} * {SCALE}D as bigint) * {SHARD_BITS} + {SHARD_BITS - 1 - shard})")
    best = scores[0] if len(scores) == 1 else f"greatest({', '.join(scores)})"
    # Never null, and known to be: a join on it then needs no filter that works out the hash again.
    return F.expr(f"coalesce(cast({SHARD_BITS - 1} - {best} % {SHARD_BITS} as int), 0)")


def assign_shards(
    df: DataFrame,
    key: str,
    weights: Sequence[float],
    grown_by: float | None = None,
    order: Sequence[str] = (),
    cells: int = CELLS,
) -> DataFrame:
    """All rows with ``shard``, ``slot`` and, if ``grown_by`` is a weight, ``grown_shard``.

    Slots of a shard run from 0 without gaps, in the order of (key hash, key, ``order`` columns).
    A shard is numbered in ``cells`` parts by ranges of the hash: rows are counted per cell, the
    counts of the cells before give its first slot, and a window numbers the rows inside. One
    shuffle of the rows, no task with a whole shard. ``grown_shard`` is the shard with one more
    shard of weight ``grown_by``: the same, or the new one.

    Null keys share one shard. Repeated keys get slots of their own in the same shard. An empty
    table gives no rows. Columns of ``df`` that have a result's name are replaced.
    """
    words = ["_hash", "_hash1", "_hash2", "_hash3"]
    made = ["shard", "slot", "grown_shard", "_words", "_cell", "_first", *words]
    if key.lower() in made:
        raise ValueError(f"the key column cannot be called {key}")
    if len(weights) * cells > MOST_OFFSETS:
        raise ValueError(f"shards times cells may be {MOST_OFFSETS} at most")
    rows = without(df, *made).withColumn("_words", key_hash(F.col(f"`{key}`")))
    rows = rows.withColumns({w: F.get("_words", F.lit(i)) for i, w in enumerate(words)})
    rows = rows.withColumn("shard", rendezvous(words, weights))
    rows = rows.withColumn("_cell", F.expr(f"coalesce(cast(_hash * {cells} div {1 << WORD_BITS} as int), 0)"))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    firsts = rows.groupBy("shard", "_cell").count()
    firsts = firsts.select("shard", "_cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("shard", "_cell").orderBy("_hash", f"`{key}`", *[f"`{c}`" for c in order])
    # At most shards * cells rows, which is checked above.
    numbered = rows.withColumn("slot", F.row_number().over(inside) - 1).join(F.broadcast(firsts), ["shard", "_cell"])
    out = numbered.withColumn("slot", F.col("slot").cast("bigint") + F.col("_first"))
    if grown_by is not None:
        out = out.withColumn("grown_shard", rendezvous(words, [*weights, grown_by]))
    return out.drop("_words", "_cell", "_first", *words)
