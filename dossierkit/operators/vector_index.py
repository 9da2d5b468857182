"""Exact nearest neighbours through pivots: a table of vectors by cell, and questions as a table.

Pivots are some of the vectors. Every vector belongs to the cell of its nearest pivot and is kept
with its distance to it; a cell is cut into blocks by that distance. By the triangle inequality a
vector is no nearer to a question than the difference of their distances to a pivot, so whole
cells and parts of them are passed over for certain. What remains is compared exactly, in units of
some neighbouring cells (a bin) and some of the questions that need one of them. A question is sent
once to a bin, and tells its cells apart there, so what is shuffled is not the pairs of questions
and cells; neither side has to fit on one machine.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dossierkit.functions.sqltext import col, cols
from dossierkit.functions.sqltext import name as quoted
from dossierkit.operators.retrieve import QUERY_BYTES, TOP_K, _vectors, usable_vector
from dossierkit.sources.sinks import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pivots at most; they travel to the tasks. An index has about the square root of its rows.
MOST_PIVOTS = 1024
# Cuts of a cell by distance to its pivot, and rows of a block: larger ones are dealt by a hash.
CUTS = 16
BLOCK_ROWS = 1 << 14
# Questions and rows of a unit at most, and rows compared at a time. A unit holds its questions.
QUESTIONS, BIN_ROWS, SLICE = 1 << 16, 1 << 18, 1024
# Units for each core, if there are rows for them, and pairs that are settled at a time.
UNITS, PENDING = 3, 1 << 18
# Room for rounding, as a part of the distances.
ROOM = 1e-9


@dataclass(frozen=True)
class VectorIndex:
    """A written index. ``pivots`` and ``blocks`` are small tables, ``rows`` holds the vectors by cell."""

    spark: SparkSession
    path: str
    corpus_id: str
    kind: str
    size: int

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")


def _numbers(df: DataFrame, column: str) -> str:
    """Kind that a vector is kept and sent as: floats take half the room of doubles."""
    kind = df.schema[column].dataType.simpleString()
    return kind if kind == "array<float>" else "array<double>"


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows (down) to pivots (across)."""
    out = np.empty((len(vectors), len(pivots)))
    for i, pivot in enumerate(pivots):
        out[:, i] = np.sqrt(((vectors - pivot) ** 2).sum(axis=1))
    return out


def _assigning(pivots: np.ndarray, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                far = _distances(_vectors(part.column(1), size), pivots)
                cell = far.argmin(axis=1)
                radius = far[np.arange(len(cell)), cell]
                arrays = [part.column(0), part.column(1), pa.array(cell.astype(np.int32)), pa.array(radius)]
                yield pa.RecordBatch.from_arrays(arrays, ["_id", "_vector", "_cell", "_radius"])

    return run


def build(corpus: DataFrame, path: str, *, corpus_id: str, corpus_vector: str, size: int | None = None, pivots: int | None = None) -> VectorIndex:
    """Write an index of all rows with an id and a usable vector.

    A vector is usable if it has ``size`` numbers (as many as most of the first thousand rows) and
    all of them are finite. Pivots are rows with small hashes; which ones does not change what is found. Rows are
    written by cell and sorted by distance, so a search reads the cells it needs.
    """
    spark = corpus.sparkSession
    given = corpus.filter(col(corpus_id).isNotNull() & col(corpus_vector).isNotNull()).select(*cols([corpus_id, corpus_vector]))
    if size is None:
        lengths = given.limit(1000).groupBy(F.size(col(corpus_vector)).alias("n")).count()
        most = lengths.orderBy(F.desc("count"), "n").first()
        size = most["n"] if most else 0
    numbers = _numbers(corpus, corpus_vector)
    rows = given.filter(usable_vector(corpus_vector, size)).select(col(corpus_id).alias("_id"), col(corpus_vector).cast(numbers).alias("_vector"))
    total = rows.count()
    wanted = pivots or min(MOST_PIVOTS, int(total**0.5) + 1)
    share = min(1.0, 4 * wanted / max(total, 1))
    hashed = rows.select("_vector", F.pmod(F.xxhash64("_vector"), F.lit(1 << 40)).alias("_h")).filter(F.col("_h") <= int(share * (1 << 40)))
    # At most ``wanted`` vectors; the filter keeps the sort small.
    chosen = hashed.distinct().orderBy("_h").limit(wanted).select("_vector").toArrow().column(0)
    points = _vectors(chosen, size) if len(chosen) else np.zeros((1, max(size, 1)))
    kind = rows.schema["_id"].dataType.simpleString()
    placed = staged(rows.mapInArrow(_assigning(points, size), f"_id {kind}, _vector {numbers}, _cell int, _radius double"), "placed")
    shares = ", ".join(str(i / CUTS) for i in range(1, CUTS))
    cuts = placed.groupBy("_cell").agg(F.expr(f"percentile_approx(_radius, array({shares}))").alias("_cuts"))
    # At most as many rows as there are pivots.
    cut = F.expr("size(filter(_cuts, c -> c < _radius))").alias("_cut")
    dealt = placed.join(F.broadcast(cuts), "_cell").select("_id", "_vector", "_cell", "_radius", cut)
    counts = dealt.groupBy("_cell", "_cut").agg(F.expr(f"cast(1 + (count(*) - 1) div {BLOCK_ROWS} as int)").alias("_of"))
    part = F.expr("cast(pmod(xxhash64(_id), _of) as int)").alias("_part")
    # At most ``CUTS`` rows for each pivot.
    blocks = dealt.join(F.broadcast(counts), ["_cell", "_cut"]).select("_id", "_vector", "_radius", "_cell", "_cut", part)
    ordered = blocks.repartitionByRange("_cell", "_cut", "_part").sortWithinPartitions("_cell", "_cut", "_part", "_radius")
    ordered.write.partitionBy("_cell").parquet(f"{path}/rows")
    written = spark.read.schema(StructType([*blocks.schema.fields])).parquet(f"{path}/rows")
    sums = written.groupBy("_cell", "_cut", "_part").agg(F.count("*").alias("n"), F.min("_radius").alias("low"), F.max("_radius").alias("high"))
    sums.write.parquet(f"{path}/blocks")
    spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "cell int, pivot array<double>").coalesce(1).write.parquet(f"{path}/pivots")
    return VectorIndex(spark, path, corpus_id, kind, size)


def _bins(pivots: np.ndarray, cells: list[tuple[int, int, float, float]], target: int) -> dict[int, tuple[int, int]]:
    """First bin and number of bins of each cell: neighbouring cells share one of about ``target`` rows.

    A cell with more rows has bins of its own, over which they are dealt by a hash of the id.
    """
    counts = {c[0]: c[1] for c in cells}
    order, stack = [], [np.array(list(counts), np.int64)]
    while stack:
        some = stack.pop()
        if sum(counts[c] for c in some) <= target or len(some) == 1:
            order.append(some)
            continue
        # Cut in the middle of the widest coordinate.
        points = pivots[some]
        by = some[np.argsort(points[:, np.ptp(points, axis=0).argmax()], kind="stable")]
        stack += [by[: len(by) // 2], by[len(by) // 2 :]]
    out, bin_no, room = {}, -1, 0
    for group in order:
        n = sum(counts[c] for c in group)
        parts = -(-n // target)
        if parts > 1 or n > room:
            bin_no, room = bin_no + 1, target
        for c in group:
            out[int(c)] = (bin_no, parts)
        bin_no, room = bin_no + parts - 1, 0 if parts > 1 else room - n
    return out


def _visiting(pivots: np.ndarray, cells: list[tuple[int, int, float, float]], bins: dict[int, tuple[int, int]], size: int, k: int, first: bool):
    """(_q, _vector, _home, _bound, _bins, _cell) of questions: the bins they visit for their nearest cell, or for others.

    ``cells`` are (cell, rows, least and greatest radius). ``_bound`` is a distance within which ``k``
    rows are known to lie: of the first visit, or from the numbers and radii of cells. Rows with
    ``_cell`` stand for no question: they tell which cells are read.
    """
    numbers = np.array([c[0] for c in cells], np.int64)
    counts = np.array([c[1] for c in cells], np.int64)
    low, high = (np.array([c[i] for c in cells], np.float64) for i in (2, 3))
    of = [list(range(b, b + parts)) for b, parts in (bins[c] for c in numbers)]
    names = ["_q", "_vector", "_home", "_bound", "_bins", "_cell"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = np.zeros(len(cells), bool)
        kinds = None
        for batch in batches:
            kinds = [batch.schema.field(0).type, batch.schema.field(1).type]
            for start in range(0, batch.num_rows if len(cells) else 0, SLICE):
                part = batch.slice(start, SLICE)
                far = _distances(_vectors(part.column(1), size), pivots[numbers])
                known = part.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
                order = np.argsort(far + high, axis=1, kind="stable")
                enough = np.minimum((np.cumsum(counts[order], axis=1) < k).sum(axis=1), len(cells) - 1)
                reach = np.take_along_axis(far + high, order, axis=1)[np.arange(len(far)), enough]
                # Fewer rows than k in all: everything is near enough.
                reach[counts.sum() < k] = np.inf
                bound = np.fmin(known, reach)
                home = far.argmin(axis=1)
                if first:
                    near = np.zeros(far.shape, bool)
                    near[np.arange(len(far)), home] = True
                else:
                    room = ROOM * (1 + far + high)
                    near = np.maximum(far - high, low - far) <= bound[:, None] + room
                    near[np.arange(len(far)), home] = False
                read |= near.any(axis=0)
                visited = [sorted({b for c in np.flatnonzero(row) for b in of[c]}) for row in near]
                arrays = [part.column(0), part.column(1), pa.array(numbers[home].astype(np.int32)), pa.array(bound), pa.array(visited, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([*arrays, pa.nulls(len(far), pa.int32())], names)
        if read.any():
            told = pa.array(numbers[read].astype(np.int32))
            none = [pa.nulls(len(told), kind) for kind in (*kinds, pa.int32(), pa.float64(), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*none, told], names)

    return run


class _Unit:
    """The nearest rows of a unit's questions: only what is near enough is compared in full."""

    def __init__(self, questions: pa.Array, vectors: np.ndarray, home: np.ndarray, bound: np.ndarray, k: int, first: bool):
        self.questions, self.vectors, self.home, self.k, self.first = questions, vectors, home, k, first
        self.norms = (vectors**2).sum(axis=1)
        # One product gives the squared distances, but for rounding.
        self.wide = np.vstack([-2.0 * vectors.T, self.norms, np.ones(len(vectors))])
        # Distances beyond which a row is of no use; they shrink as rows are found.
        self.bound = bound + ROOM * (1 + bound)
        self.question, self.distance, self.ids = np.empty(0, np.int64), np.empty(0), None
        self.pending, self.waiting, self.compared = [], 0, 0

    def add(self, ids: np.ndarray, vectors: np.ndarray, radius: np.ndarray, cell: int, pivot: np.ndarray) -> None:
        """Rows of one cell, in the order of their radius and id."""
        # A row that equals the k before it is never among the nearest.
        same = (vectors[1:] == vectors[:-1]).all(axis=1) & (radius[1:] == radius[:-1])
        place = np.arange(len(ids))
        run = place - np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), place, 0))
        keep = run < self.k
        ids, vectors, radius = ids[keep], vectors[keep], radius[keep]
        if self.first:
            some = np.flatnonzero(self.home == cell)
        else:
            square = self.norms - 2.0 * self.vectors @ pivot + (pivot**2).sum()
            room = ROOM * (1 + self.norms + (pivot**2).sum())
            least, most = np.sqrt(np.maximum(square - room, 0)), np.sqrt(np.maximum(square + room, 0))
            slack = self.bound + ROOM * (1 + radius[-1] + most)
            some = np.flatnonzero(~((least - radius[-1] > slack) | (radius[0] - most > slack)) & (self.home != cell))
        self.compared += len(ids) * len(some)
        norms = (vectors**2).sum(axis=1)
        tall = np.hstack([vectors, np.ones((len(ids), 1)), norms[:, None]])
        for at in range(0, len(some), SLICE):
            these = some[at : at + SLICE]
            whole = these[-1] - these[0] + 1 == len(these)
            rough = tall @ (self.wide[:, these[0] : these[-1] + 1] if whole else self.wide[:, these])
            most = self.bound[these] ** 2 + ROOM * (1 + norms.max() + self.norms[these])
            # What overflows is compared in full.
            row, place = np.divmod(np.flatnonzero(~(rough > most)), len(these))
            if len(row):
                question = these[place]
                distance = ((vectors[row] - self.vectors[question]) ** 2).sum(axis=1)
                self.pending.append((question, distance, ids[row]))
                self.waiting += len(row)
                if self.waiting >= PENDING:
                    self.settle()

    def settle(self) -> None:
        """The nearest of what was found so far, by distance and id."""
        if not self.waiting:
            return
        kept = [] if self.ids is None else [(self.question, self.distance, self.ids)]
        question, distance, ids = (np.concatenate(x) for x in zip(*kept, *self.pending))
        id_rank = np.unique(ids, return_inverse=True)[1]
        order = np.lexsort((id_rank, distance, question))
        question = question[order]
        place = np.arange(len(question)) - np.searchsorted(question, question)
        keep = order[place < self.k]
        self.question, self.distance, self.ids = question[place < self.k], distance[keep], ids[keep]
        last = place[place < self.k] == self.k - 1
        full = self.question[last]
        reached = np.sqrt(self.distance[last])
        self.bound[full] = np.fmin(self.bound[full], reached + ROOM * (1 + reached))
        self.pending, self.waiting = [], 0

    def made(self, kind: pa.DataType) -> Iterator[tuple[pa.Array, ...]]:
        self.settle()
        if self.ids is not None:
            of = np.zeros(len(self.question), np.int64)
            of[0] = self.compared  # pairs compared, on one row of the unit
            yield self.questions.take(pa.array(self.question)), pa.array(self.ids.tolist(), kind), pa.array(self.distance), pa.array(of)


def _comparing(names: list[str], pivots: np.ndarray, size: int, k: int, first: bool):
    """Rows come by unit, its questions first, then its vectors by cell, radius and id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, asked, unit, kind = None, [], None, None

        def made() -> Iterator[pa.RecordBatch]:
            for arrays in unit.made(kind) if unit else ():
                yield pa.RecordBatch.from_arrays([*arrays], names)

        for batch in batches:
            key, row, cell = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_work", "_row", "_cell"))
            kind = batch.schema.field("_id").type
            change = np.flatnonzero((key[1:] != key[:-1]) | (row[1:] != row[:-1]) | (row[1:] & (cell[1:] != cell[:-1]))) + 1
            for a, b in zip([0, *change], [*change, len(key)]):
                if a == b:
                    continue
                if key[a] != work:
                    yield from made()
                    work, asked, unit = key[a], [], None
                part = batch.slice(a, b - a)
                if not row[a]:
                    asked.append(part.select(["_q", "_vector", "_cell", "_far"]))
                    continue
                if unit is None and not asked:
                    continue  # the hash dealt this unit no question
                if unit is None:
                    heads = pa.Table.from_batches(asked)
                    home, bound = (heads.column(c).to_numpy() for c in ("_cell", "_far"))
                    unit = _Unit(heads.column("_q").combine_chunks(), _vectors(heads.column("_vector"), size), home, bound, k, first)
                    asked = []
                for start in range(0, part.num_rows, SLICE):
                    some = part.slice(start, SLICE)
                    ids, radius = (some.column(c).to_numpy(zero_copy_only=False) for c in ("_id", "_far"))
                    unit.add(ids, _vectors(some.column("_vector"), size), radius, cell[a], pivots[cell[a]])
        yield from made()

    return run


def _compare(index: VectorIndex, pivots: np.ndarray, bins: dict[int, tuple[int, int]], visits: DataFrame, group: int, k: int, first: bool) -> DataFrame:
    """``_q, _id, distance, _compared`` of the nearest rows of each unit: a bin and ``group`` of its questions at most."""
    size, spark = index.size, index.spark
    # As many numbers as there are pivots at most; a search then reads these cells alone.
    cells = [r["_cell"] for r in visits.filter("_cell IS NOT NULL").select("_cell").distinct().collect()]
    asked = visits.filter("_cell IS NULL").select("_q", "_vector", "_home", "_bound", F.explode("_bins").alias("_bin"))
    # One row per bin.
    counted = sorted(map(tuple, asked.groupBy("_bin").count().collect()))
    units, base = [], 0
    for bin_no, n in counted:
        units.append((bin_no, base, -(-n // group)))
        base += units[-1][2]
    of = F.broadcast(spark.createDataFrame(units, "_bin int, _base int, _of int"))
    places = F.broadcast(spark.createDataFrame([(c, *bins[c]) for c in cells], "_cell int, _first int, _parts int"))
    rows = index.table("rows").filter(F.col("_cell").isin(cells)).join(places, "_cell")
    rows = rows.withColumn("_bin", F.expr("cast(_first + pmod(xxhash64(_id, 1), _parts) as int)")).join(of, "_bin")
    kind_q, kind_id = visits.schema["_q"].dataType.simpleString(), rows.schema["_id"].dataType.simpleString()
    numbers = "array<float>" if {visits.schema["_vector"].dataType.simpleString(), rows.schema["_vector"].dataType.simpleString()} == {"array<float>"} else "array<double>"
    vector = F.col("_vector").cast(numbers).alias("_vector")
    work = F.expr("cast(_base + pmod(xxhash64(_q), _of) as int)").alias("_work")
    left = asked.join(of, "_bin").select(work, F.lit(False).alias("_row"), "_q", F.lit(None).cast(kind_id).alias("_id"), vector, F.col("_home").alias("_cell"), F.col("_bound").alias("_far"))
    dealt = rows.withColumn("_work", F.explode(F.expr("sequence(_base, _base + _of - 1)")))
    right = dealt.select("_work", F.lit(True).alias("_row"), F.lit(None).cast(kind_q).alias("_q"), "_id", vector, "_cell", F.col("_radius").alias("_far"))
    both = left.union(right).repartitionById(max(base, 1), F.col("_work")).sortWithinPartitions("_work", "_row", "_cell", "_far", "_id")
    schema = f"_q {kind_q}, _id {kind_id}, distance double, _compared bigint"
    return both.mapInArrow(_comparing(["_q", "_id", "distance", "_compared"], pivots, size, k, first), schema)


def search(
    index: VectorIndex, questions: DataFrame, k: int = TOP_K, *, query_id: str, query_vector: str, seen: Observation | None = None
) -> DataFrame:
    """Exact nearest neighbours by squared L2 distance: ``query_id, rank, corpus_id, distance``.

    Ties go to the smaller id. Every question first visits its nearest cell; the distance of its
    ``k``-th row there tells which other cells it needs. Questions and rows are dealt over units so
    that both together are copied least. ``seen`` takes the number of vectors compared as
    ``compared``. Questions without an id or vector are left out; one that is not as long as the
    index's vectors, or holds a number that is not finite, raises an error.
    """
    right = questions.filter(col(query_vector).isNotNull() & col(query_id).isNotNull())
    usable = F.count_if(usable_vector(query_vector, index.size))
    total, fit = right.agg(F.count(F.lit(1)), usable).first()
    if fit < total:
        raise ValueError(f"every question needs {index.size} finite numbers")
    numbers = _numbers(questions, query_vector)
    asked = right.select(col(query_id).alias("_q"), col(query_vector).cast(numbers).alias("_vector"))
    pivots = _vectors(index.table("pivots").orderBy("cell").select("pivot").toArrow().column(0), max(index.size, 1))
    sums = index.table("blocks").groupBy("_cell").agg(F.sum("n"), F.min("low"), F.max("high"))
    # One row per pivot.
    cells = sorted(map(tuple, sums.collect()))
    kind = asked.schema["_q"].dataType.simpleString()
    if not cells or not total:
        kinds = f"{quoted(query_id)} {kind}, rank int, {quoted(index.corpus_id)} {index.kind}, distance double"
        return index.spark.createDataFrame([], kinds)
    rows = sum(c[1] for c in cells)
    # ``across`` bins and ``down`` groups of questions copy the least vectors for so many units.
    wanted = UNITS * index.spark.sparkContext.defaultParallelism
    most = max(1, min(QUESTIONS, QUERY_BYTES // (8 * max(index.size, 1))))
    down = min(wanted, max(1, round((wanted * total / rows) ** 0.5), -(-total // most)))
    across = max(1, -(-wanted // down))
    group = min(most, -(-total // down))
    bins = _bins(pivots, cells, max(SLICE, min(BIN_ROWS, -(-rows // across))))
    schema = f"_q {kind}, _vector {numbers}, _home int, _bound double, _bins array<int>, _cell int"
    unknown = asked.withColumn("_known", F.lit(float("inf")))
    home = staged(unknown.mapInArrow(_visiting(pivots, cells, bins, index.size, k, True), schema), "visits")
    found = staged(_compare(index, pivots, bins, home, group, k, True), "near")
    order = Window.partitionBy("_q").orderBy("distance", "_id")
    kth = found.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") == k).select("_q", F.sqrt("distance").alias("_known"))
    bounded = asked.join(kth, "_q", "left").select("_q", "_vector", F.coalesce("_known", F.lit(float("inf"))).alias("_known"))
    others = staged(bounded.mapInArrow(_visiting(pivots, cells, bins, index.size, k, False), schema), "visits")
    every = found.union(_compare(index, pivots, bins, others, group, k, False))
    if seen is not None:
        every = every.observe(seen, F.sum("_compared").alias("compared"))
    top = every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.select(col("_q").alias(query_id), "rank", col("_id").alias(index.corpus_id), "distance")
