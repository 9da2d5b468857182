"""Near-duplicate vectors: signs of random projections in several tables, exact cosines, components.

A table's key is the signs of a vector's products with ``BITS`` random hyperplanes. Vectors at the
least cosine share a key in at least one table with probability ``1 - MISS``. Vectors that share a
key meet in a cell, where numpy works out all their cosines in double precision. A pair counts in
the first table in which its keys agree, so nothing has to be sent to drop repeated pairs: a cell
sends one row per vector, with its number of links and one of its linked neighbours.

A bucket with many vectors is dealt over cells of two blocks each, so that no task has more than
two blocks. Equal vectors are one class with a count before anything is compared.

Joins are by shuffles, whatever their sides seem to weigh: Spark sizes what an ``explode`` makes as
its input, a hundredth of it here, and would send all keys of all vectors through the driver.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierkit.llm.components import components
from dossierkit.llm.shared import checkpointed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COSINE = 0.93
BITS = 16
MISS = 1e-6
BLOCK = 512
SEED = 20260107
# Cells compared at a time, as rows of a batch.
SLICE = 4096


def tables_for(cosine: float, bits: int, miss: float) -> int:
    """How many tables lose a pair at the least cosine with probability ``miss``."""
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return math.ceil(math.log(miss) / math.log1p(-same))


def _hyperplanes(dimension: int, tables: int, bits: int) -> np.ndarray:
    return np.random.default_rng([SEED, dimension]).standard_normal((dimension, tables * bits))


def _kind(bits: int) -> str:
    """Type of a key."""
    return "<u2" if bits <= 16 else "<u4"


def _vectors(column: pa.Array) -> list[np.ndarray | None]:
    """Rows as doubles; null, empty, zero and not wholly finite ones are None."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    out: list[np.ndarray | None] = []
    for a, b in zip(bounds, bounds[1:]):
        v = flat[a:b] + 0.0  # minus zero is zero
        out.append(v if len(v) and np.isfinite(v).all() and v.any() else None)
    return out


def _hashing(tables: int, bits: int):
    """(_id, _vector as bytes of unit doubles, _keys) of usable vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, kind = (1 << np.arange(bits)).astype(np.int64), _kind(bits)
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = _vectors(batch.column("_vector"))
            ids, labels = batch.column("_id"), batch.column("_label")
            for start in range(0, len(rows), SLICE):
                by_size: dict[int, list[int]] = {}
                for i in range(start, min(start + SLICE, len(rows))):
                    if rows[i] is not None:
                        by_size.setdefault(len(rows[i]), []).append(i)
                for size, at in by_size.items():
                    if size not in planes:
                        planes[size] = _hyperplanes(size, tables, bits)
                    x = np.stack([rows[i] for i in at])
                    x /= np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
                    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                    signs = (x @ planes[size] >= 0).reshape(len(at), tables, bits)
                    keys = (signs * weights).sum(axis=2).astype(kind)
                    take = pa.array(at)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(take), labels.take(take), pa.array([v.astype("<f8").tobytes() for v in x], pa.binary()), pa.array([k.tobytes() for k in keys], pa.binary())],
                        ["_id", "_label", "_unit", "_keys"],
                    )

    return run


def _compared(cosine: float, bits: int):
    """(_id, _tag, _linked, _n) of a cell's vectors that have links counted there; rows come by cell."""

    def cell(table: int, crossed: bool, block: np.ndarray, ids, tags, counts, units, keys) -> tuple[list, ...]:
        alike = units @ units.T >= cosine
        np.fill_diagonal(alike, False)
        if crossed:
            alike &= block[:, None] != block[None, :]  # pairs inside a block belong to the block's own cell
        i, j = np.nonzero(alike)
        if not len(i):
            return [], [], [], []
        earlier = np.zeros(len(i), dtype=bool)
        if table:
            for part in range(0, len(i), 1 << 16):
                a, b = i[part : part + (1 << 16)], j[part : part + (1 << 16)]
                earlier[part : part + (1 << 16)] = (keys[a, :table] == keys[b, :table]).any(axis=1)
        i, j = i[~earlier], j[~earlier]
        if not len(i):
            return [], [], [], []
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, i, counts[j])
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, i, ids[j])
        # A forest of the cell's links: every tree hangs on its smallest vector.
        root = np.minimum(ids, least)
        while True:
            lower = root.copy()
            np.minimum.at(lower, i, root[j])
            if (lower == root).all():
                break
            root = lower
        has = np.flatnonzero(n)
        return ids[has].tolist(), tags[has].tolist(), root[has].tolist(), n[has].tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None

        def judged(table: pa.Table) -> pa.RecordBatch:
            cells = [table.column(c).to_numpy() for c in ("_bucket", "_i", "_j")]
            change = np.zeros(table.num_rows, dtype=bool)
            change[0] = True
            for c in cells:
                change[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(change)
            ends = np.append(starts[1:], table.num_rows)
            ids, tags, counts, tables, blocks = (table.column(c).to_numpy() for c in ("_id", "_tag", "_count", "_table", "_block"))
            units, keys = table.column("_unit").to_pylist(), table.column("_keys").to_pylist()
            out: tuple[list, ...] = ([], [], [], [])
            for a, b in zip(starts, ends):
                if b - a < 2:
                    continue
                x = np.frombuffer(b"".join(units[a:b]), "<f8").reshape(b - a, -1)
                k = np.frombuffer(b"".join(keys[a:b]), _kind(bits)).reshape(b - a, -1)
                for into, values in zip(out, cell(int(tables[a]), cells[1][a] != cells[2][a], blocks[a:b], ids[a:b], tags[a:b], counts[a:b], x, k)):
                    into += values
            return pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], ["_id", "_tag", "_linked", "_n"])

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                rows = pa.Table.from_batches([batch.slice(start, SLICE)])
                rows = rows if waiting is None else pa.concat_tables([waiting, rows]).combine_chunks()
                last = [rows.column(c).to_numpy() for c in ("_bucket", "_i", "_j")]
                other = np.flatnonzero((last[0] != last[0][-1]) | (last[1] != last[1][-1]) | (last[2] != last[2][-1]))
                cut = int(other[-1]) + 1 if len(other) else 0
                if cut:
                    yield judged(rows.slice(0, cut))
                waiting = rows.slice(cut)
        if waiting is not None and waiting.num_rows:
            yield judged(waiting)

    return run


def near_vectors(
    df: DataFrame, key: str, vector: str, label: str, cosine: float = COSINE, bits: int = BITS, miss: float = MISS
) -> DataFrame:
    """``key, n_links, component_id, kept`` for every row.

    Rows are compared if their labels are equal and not null and their vectors are equally long.
    They are linked if the cosine is at least ``cosine``, in double precision; no other pair is. A
    pair at that cosine is found with probability ``1 - miss``, a closer one with a higher one.
    ``n_links`` counts the other rows a row is linked with, ``component_id`` is the smallest key
    that links reach, ``kept`` whether that is the row itself. ``key`` is an integer.

    Vectors that are null, empty, zero or hold a null or a non-finite number are linked with
    nothing, nor are rows with a null key, which have no component and are kept. Rows that repeat a
    key are one row of the graph, but count as links of each other and of others; each shows the
    largest number of links among them. Other columns are not looked at.
    """
    if not 0 < cosine < 1 or not 0 < bits <= 32:
        raise ValueError("0 < cosine < 1 and 0 < bits <= 32")
    tables = tables_for(cosine, bits, miss)
    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("_id"), F.col(f"`{label}`").alias("_label"), F.col(f"`{vector}`").alias("_vector"))
    kind = dict(rows.dtypes)["_label"]
    usable = rows.filter("_id IS NOT NULL AND _label IS NOT NULL AND _vector IS NOT NULL")
    hashed = checkpointed(usable.mapInArrow(_hashing(tables, bits), f"_id bigint, _label {kind}, _unit binary, _keys binary"))
    classes = hashed.groupBy("_label", "_unit").agg(F.min("_id").alias("_id"), F.count("*").alias("_count"), F.first("_keys").alias("_keys"))
    # Rows that repeat a key with other vectors are told apart by the tag.
    classes = checkpointed(classes.withColumn("_tag", F.xxhash64("_label", "_unit")))
    width = np.dtype(_kind(bits)).itemsize
    own_key = f"substring(_keys, {width} * _table + 1, {width})"
    every_table = F.expr(f"explode(sequence(0, {tables - 1}))").alias("_table")
    buckets = classes.select("_id", "_tag", "_label", F.length("_unit").alias("_size"), "_keys", every_table)
    buckets = buckets.select("_id", "_tag", "_table", F.xxhash64("_label", "_size", "_table", F.expr(own_key)).alias("_bucket"))
    shared = buckets.groupBy("_bucket").agg(F.count("*").alias("_m")).filter("_m > 1")
    members = buckets.join(shared.hint("merge"), "_bucket").withColumn("_blocks", F.expr(f"cast(1 + (_m - 1) div {BLOCK} as int)"))
    members = members.withColumn("_block", F.expr("cast(pmod(xxhash64(_tag, 3), _blocks) as int)"))
    # A vector of block b meets all blocks: one cell for each pair of blocks, one for the block itself.
    cells = members.withColumn("_other", F.expr("explode(sequence(0, _blocks - 1))"))
    cells = cells.select("_id", "_tag", "_table", "_bucket", "_block", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"))
    full = cells.join(classes.select("_id", "_tag", "_count", "_unit", "_keys").hint("merge"), ["_id", "_tag"])
    full = full.repartition(F.col("_bucket"), F.col("_i"), F.col("_j")).sortWithinPartitions("_bucket", "_i", "_j")
    linked = checkpointed(full.mapInArrow(_compared(cosine, bits), "_id bigint, _tag bigint, _linked bigint, _n bigint"))
    copies = hashed.select("_label", "_unit", F.col("_id").alias("_row")).join(classes.select("_label", "_unit", "_id", "_tag", "_count").hint("merge"), ["_label", "_unit"])
    copies = copies.select("_row", F.col("_id").alias("_class"), F.col("_tag").alias("_own"), "_count")
    links = linked.select("_id", "_linked").union(copies.filter("_count > 1").select(F.col("_class").alias("_id"), F.col("_row").alias("_linked")))
    found = components(links, "_id", "_linked")
    counts = linked.groupBy("_id", "_tag").agg(F.sum("_n").alias("_n"))
    by_row = copies.join(counts.hint("merge"), (copies["_class"] == counts["_id"]) & (copies["_own"] == counts["_tag"]), "left")
    by_row = by_row.groupBy("_row").agg(F.max(F.coalesce("_n", F.lit(0)) + F.col("_count") - 1).alias("_links"))
    out = rows.select("_id").join(by_row.hint("merge"), rows["_id"] == by_row["_row"], "left").join(found.hint("merge"), rows["_id"] == found["node"], "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("component", "_id"))
    return out.select(
        F.col("_id").alias(key),
        F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("_id"), F.lit(True)).alias("kept"),
    )
