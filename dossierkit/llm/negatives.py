"""Hard negatives by rotated one-bit codes.

A vector is rotated and kept as the signs of its components, with its norm and the alignment of the
code with it. For an anchor, bit counts of its few-bit components with a code estimate the product
of anchor and code; Cauchy-Schwarz over what the code does not hold bounds the score from both
sides, for certain. Only rows whose interval reaches what is asked for are scored, in integers.

Anchors and rows meet in cells of an anchor block and a row block. A task holds one anchor block
and the best rows so far, and reads the rows of its cell in slices; a hot label is many cells.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dossierkit.llm.shared import checkpointed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# Bounds of a negative's score, in hundredths of the positive's.
LOW, HIGH = 50, 95
# Anchors of a block, and rows that are compared at a time.
ANCHORS, SLICE = 2048, 512
# Rows of a group are dealt over blocks of so many, and over so many blocks at most: they are streamed.
ROWS, MOST_BLOCKS = 4096, 256
# Bits of a component of an anchor; seed of the rotation.
PLANES = 6
SEED = 20260212
# Squared norms from here on could give scores that do not fit in a long, times 100.
NORM_LIMIT = 1 << 55
# Products below this are exact in double precision.
EXACT = float(1 << 52)


def rotation(size: int) -> np.ndarray:
    """A fixed random rotation; sizes are whole words of 64 bits."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, size]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def padded(x: np.ndarray) -> np.ndarray:
    """Rows with zeros up to whole words of 64 components."""
    return np.pad(x, ((0, 0), (0, -x.shape[1] % 64)))


class Coded:
    """Codes of rows: sign bits, norms, alignments, and the norms of what the codes do not hold."""

    def __init__(self, whole: np.ndarray, rotate: np.ndarray):
        turned = padded(whole) @ rotate.T
        self.size = turned.shape[1]
        self.bits = np.packbits(turned >= 0, axis=1).view("<u8")
        self.norm = np.sqrt((whole * whole).sum(axis=1))
        # Product of the vector and its code, a unit vector: at most the norm.
        self.along = np.abs(turned).sum(axis=1) / np.sqrt(self.size)
        self.beside = np.sqrt(np.maximum(self.norm**2 - self.along**2, 0))


class Asked:
    """Anchors with their rotated components in ``PLANES`` bits each."""

    def __init__(self, whole: np.ndarray, rotate: np.ndarray):
        turned = padded(whole) @ rotate.T
        self.size = turned.shape[1]
        self.norm = np.sqrt((whole * whole).sum(axis=1))
        low = turned.min(axis=1, keepdims=True)
        step = (turned.max(axis=1, keepdims=True) - low) / ((1 << PLANES) - 1)
        step[step == 0] = 1
        parts = np.rint((turned - low) / step).astype(np.int64)
        rounded = low + step * parts
        self.low, self.step = low[:, 0], step[:, 0]
        self.total = rounded.sum(axis=1)
        self.off = np.sqrt(((turned - rounded) ** 2).sum(axis=1))
        self.planes = [np.packbits(parts >> j & 1, axis=1).view("<u8") for j in range(PLANES)]

    def bounds(self, codes: Coded) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that each row (down) may have with each anchor (across)."""
        held = np.zeros((len(codes.bits), len(self.norm)), np.int64)
        for word in range(codes.bits.shape[1]):
            bits = codes.bits[:, word, None]
            for j, plane in enumerate(self.planes):
                held += np.bitwise_count(bits & plane[None, :, word]).astype(np.int64) << j
        ones = np.bitwise_count(codes.bits).sum(axis=1, dtype=np.int64)[:, None]
        # Product of the rounded anchor and the code: components where the bit is set, less the others.
        product = (2 * (self.low * ones + self.step * held) - self.total) / np.sqrt(self.size)
        least = np.maximum(np.abs(product) - self.off, 0)
        across = np.sqrt(np.maximum(self.norm**2 - least**2, 0))
        middle = codes.along[:, None] * product
        room = codes.along[:, None] * self.off + codes.beside[:, None] * across
        room += 1e-9 * (1 + codes.norm[:, None] * self.norm)  # what rounding may take
        return middle - room, middle + room


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Integer scores; in double precision where that is exact."""
    most = np.sqrt((rows**2).sum(axis=1).max(initial=0)) * np.sqrt((anchors**2).sum(axis=1).max(initial=0))
    if most < EXACT:
        return np.rint(rows @ anchors.T).astype(np.int64)
    return rows.astype(np.int64) @ anchors.T.astype(np.int64)


class Best:
    """The first ``k`` rows of each slot: greatest score, then smallest id."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot = self.id = self.score = np.empty(0, np.int64)
        # Score that a row must reach to come among the first of a slot.
        self.bar = np.full(slots, np.iinfo(np.int64).min)

    def add(self, slot: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        if not len(slot):
            return
        slot, ids, score = (np.concatenate(x) for x in ((self.slot, slot), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, -score, slot))
        slot, ids, score = slot[order], ids[order], score[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        first = place < self.k
        self.slot, self.id, self.score = slot[first], ids[first], score[first]
        last = place == self.k - 1
        self.bar[slot[last]] = score[last]


def _numbers(column: pa.Array, size: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), size).astype(np.float64)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_id, _label, _size, _vector of integers) of rows that take part."""
    for batch in batches:
        column = batch.column("_raw")
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = column.flatten().cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
        with np.errstate(all="ignore"):
            whole = np.floor(SCALE * flat)
            ends = np.concatenate([[0.0], np.cumsum(np.where(np.isfinite(flat), 0, 1))])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        take, vectors = [], []
        for i in np.flatnonzero((sizes > 0) & (ends[bounds[1:]] == ends[bounds[:-1]])):
            v = whole[bounds[i] : bounds[i + 1]]
            with np.errstate(over="ignore"):
                if (v * v).sum() < NORM_LIMIT:
                    take.append(i)
                    vectors.append(v.astype("<i4").tobytes())
        take = pa.array(take, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id").take(take), batch.column("_label").take(take), pa.array(sizes).take(take).cast(pa.int32()), pa.array(vectors, pa.binary())],
            ["_id", "_label", "_size", "_vector"],
        )


def integer_vectors(df: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``_id, _label, _size, _vector``: floor of ``SCALE`` times each component, as 32-bit integers.

    Rows with a null key, label or vector, an empty vector, or a null or non-finite component take
    no part, nor do those whose squared norm is ``NORM_LIMIT`` or more: their scores may not fit in
    a long.
    """
    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("_id"), F.col(f"`{label}`").alias("_label"), F.col(f"`{vector}`").alias("_raw"))
    kind = dict(rows.dtypes)["_label"]
    return rows.filter("_id IS NOT NULL AND _label IS NOT NULL AND _raw IS NOT NULL").mapInArrow(
        _whole, f"_id bigint, _label {kind}, _size int, _vector binary"
    )


def _same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a[:, None] == b[None, :]


class _Positives:
    """First ``POSITIVES`` rows of each anchor's label. Slots are anchors."""

    def __init__(self, anchors: pa.Table, size: int, rotate: np.ndarray, k: int, _):
        self.ids, self.labels = anchors.column("_id").to_numpy(), anchors.column("_mark").to_numpy()
        self.whole = _numbers(anchors.column("_vector").combine_chunks(), size, "<i4")
        self.asked = Asked(self.whole, rotate)
        self.best = Best(len(self.ids), k)

    def add(self, ids, labels, rows, codes) -> None:
        _, upper = self.asked.bounds(codes)
        may = (upper >= self.best.bar) & _same(labels, self.labels) & ~_same(ids, self.ids)
        some = np.flatnonzero(may.any(axis=1))
        score = products(rows[some], self.whole)
        row, anchor = np.nonzero(may[some] & (score >= self.best.bar))
        self.best.add(anchor, ids[some][row], score[row, anchor])

    def found(self) -> list[np.ndarray]:
        none = np.zeros(len(self.best.slot), np.int64)
        return [self.ids[self.best.slot], none, none, none, self.best.id, self.best.score]


class _Negatives:
    """First ``NEGATIVES`` rows of other labels in the band of each anchor and positive. Slots are such pairs."""

    def __init__(self, anchors: pa.Table, size: int, rotate: np.ndarray, k: int, band: tuple[int, int]):
        self.ids, self.labels = anchors.column("_id").to_numpy(), anchors.column("_mark").to_numpy()
        self.whole = _numbers(anchors.column("_vector").combine_chunks(), size, "<i4")
        self.asked = Asked(self.whole, rotate)
        lists = [x or [] for x in anchors.column("_positives").to_pylist()]
        width = max(map(len, lists), default=0)
        # Bands as integers: low * p <= 100 * s <= high * p. Places without a positive have an empty one.
        self.low, self.high = np.ones((2, len(lists), width), np.int64) * np.array([1, 0])[:, None, None]
        self.positive = np.zeros((2, len(lists), width), np.int64)
        for i, pairs in enumerate(lists):
            for j, p in enumerate(pairs):
                self.positive[:, i, j] = p["_id"], p["_score"]
                self.low[i, j] = -(-band[0] * p["_score"] // 100)
                self.high[i, j] = band[1] * p["_score"] // 100
        self.width = width
        self.best = Best(len(lists) * width, k)

    def add(self, ids, labels, rows, codes) -> None:
        lower, upper = self.asked.bounds(codes)
        other = ~_same(labels, self.labels)
        bar = self.best.bar.reshape(-1, self.width) if self.width else np.empty((len(self.ids), 0), np.int64)
        least = np.maximum(self.low, bar)
        may = np.zeros_like(other)
        for j in range(self.width):
            open_band = least[:, j] <= self.high[:, j]
            may |= (upper >= least[:, j]) & (lower <= self.high[:, j]) & open_band
        may &= other
        some = np.flatnonzero(may.any(axis=1))
        if not len(some):
            return
        score, may, ids = products(rows[some], self.whole), may[some], ids[some]
        slots, names, scores = [], [], []
        for j in range(self.width):
            row, anchor = np.nonzero(may & (score >= least[:, j]) & (score <= self.high[:, j]))
            slots.append(anchor * self.width + j)
            names.append(ids[row])
            scores.append(score[row, anchor])
        self.best.add(*map(np.concatenate, (slots, names, scores)))

    def found(self) -> list[np.ndarray]:
        anchor, place = np.divmod(self.best.slot, max(self.width, 1))
        return [self.ids[anchor], place, self.positive[0][anchor, place], self.positive[1][anchor, place], self.best.id, self.best.score]


_FOUND = "_anchor bigint, _place bigint, _positive bigint, _positive_score bigint, _found bigint, _score bigint"


_POSITIVE = "array<struct<_rank: int, _id: bigint, _score: bigint>>"


def _searching(kind: type, k: int, band: tuple[int, int]):
    """Rows come by cell, its anchors first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotations: dict[int, np.ndarray] = {}
        cell, anchors, search, names = None, [], None, [x.split()[0] for x in _FOUND.split(", ")]

        def made() -> Iterator[pa.RecordBatch]:
            if search is not None and len(search.best.slot):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in search.found()], names)

        for batch in batches:
            here = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("_cell", "_row")]
            change = np.flatnonzero((here[0][1:] != here[0][:-1]) | (here[1][1:] != here[1][:-1])) + 1
            for a, b in zip([0, *change], [*change, batch.num_rows]):
                if a == b:
                    continue
                if here[0][a] != cell:
                    yield from made()
                    cell, anchors, search = here[0][a], [], None
                part = batch.slice(a, b - a)
                if not here[1][a]:
                    anchors.append(part)
                    continue
                if not anchors:
                    continue
                size = part.column("_size")[0].as_py()
                width = size + -size % 64
                if width not in rotations:
                    rotations[width] = rotation(width)
                if search is None:
                    search = kind(pa.Table.from_batches(anchors), size, rotations[width], k, band)
                for start in range(0, part.num_rows, SLICE):
                    some = part.slice(start, SLICE)
                    rows = _numbers(some.column("_vector"), size, "<i4")
                    search.add(some.column("_id").to_numpy(), some.column("_mark").to_numpy(), rows, Coded(rows, rotations[width]))
        yield from made()

    return run


def _searched(anchors: DataFrame, rows: DataFrame, group: list[str], kind: type, k: int, band: tuple[int, int]) -> DataFrame:
    """What ``kind`` finds among the rows of a group for its anchors, of each cell."""
    counts = rows.groupBy(*group).agg(F.count("*").alias("_n"))
    asked = anchors.groupBy(*group).agg(F.count("*").alias("_m"))
    # One row per group that has anchors: how many blocks of each side there are.
    blocks = counts.join(asked, group).select(
        *group, F.expr(f"1 + (_m - 1) div {ANCHORS}").alias("_of"), F.expr(f"least(1 + (_n - 1) div {ROWS}, {MOST_BLOCKS})").alias("_by")
    )

    def dealt(df: DataFrame, own: str, other: str, row: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("_id", "_vector", F.lit(7)), F.col(own))
        each = df.join(blocks, group).withColumn("_o", F.explode(F.expr(f"sequence(0L, {other} - 1)")))
        pair = (block, F.col("_o")) if own == "_of" else (F.col("_o"), block)
        positives = "_positives" if "_positives" in df.columns else f"cast(NULL as {_POSITIVE}) AS _positives"
        each = each.withColumn("_cell", F.xxhash64(*group, *pair)).withColumn("_row", F.lit(row))
        return each.selectExpr("_cell", "_row", "_id", "_mark", "_size", "_vector", positives)

    cells = dealt(anchors, "_of", "_by", False).unionByName(dealt(rows, "_by", "_of", True))
    cells = cells.repartition("_cell").sortWithinPartitions("_cell", "_row")
    return cells.mapInArrow(_searching(kind, k, band), _FOUND)


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Both tables are of ``integer_vectors``; ``anchors`` are some of the rows. An anchor's positives
    are the first ``positives`` rows of its label with another id; for each of them, the first
    ``negatives`` rows of other labels whose score is ``low`` to ``high`` hundredths of the
    positive's come with their rank. The score is the integer product with the anchor; greater
    ones come first, of equal ones the smaller id. Rows of different lengths are not compared.
    Rows that repeat an id are rows of their own, but an anchor's id stands for one anchor: the
    one with the least vector, label and length.

    Every row is compared with every anchor by its code; what is cut is what cannot be among the
    first. A cell sends the first rows of its anchors only.
    """
    # Labels are compared as hashes, which do not depend on their type.
    every = checkpointed(rows.withColumn("_mark", F.xxhash64("_label")))
    first = F.min(F.struct("_vector", "_mark", "_size")).alias("_f")
    chosen = checkpointed(anchors.withColumn("_mark", F.xxhash64("_label")).groupBy("_id").agg(first).select("_id", "_f.*"))
    near = _searched(chosen, every, ["_size", "_mark"], _Positives, positives, (low, high))
    order = Window.partitionBy("_anchor").orderBy(F.desc("_score"), "_found")
    top = near.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= positives)
    lists = top.groupBy(F.col("_anchor").alias("_id")).agg(F.array_sort(F.collect_list(F.struct("_rank", F.col("_found").alias("_id"), "_score"))).alias("_positives"))
    asked = checkpointed(chosen.join(lists, "_id"))
    far = _searched(asked, every, ["_size"], _Negatives, negatives, (low, high))
    order = Window.partitionBy("_anchor", "_place").orderBy(F.desc("_score"), "_found")
    ranked = far.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.select(
        F.col("_anchor").alias("anchor_id"),
        F.col("_positive").alias("positive_id"),
        "rank",
        F.col("_found").alias("negative_id"),
        F.col("_positive_score").alias("positive_score"),
        F.col("_score").alias("negative_score"),
    )
