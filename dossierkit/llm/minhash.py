"""Near-duplicate documents: fast similarity sketches, banding, exact verification, components.

A sketch has ``SIZE`` coordinates. In round i every shingle is thrown into one bin with a value
that is larger than all of earlier rounds, and every bin keeps its least value; rounds go on until
no bin is empty. After ``SIZE`` rounds round ``SIZE + b`` throws all shingles into bin b, so every
coordinate is filled in the end. Two sets agree in a coordinate with the probability of their
similarity, with the concentration of ``SIZE`` independent ones, at the cost of about one hash per
shingle for large sets.

Equal sets are one class. Classes that share a band meet in a bucket. Inside a bucket only what can
still change the components is verified: every class against the smallest one, and then, where a
bucket holds more than one component, the members outside of the largest one against all others.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierkit.llm.components import components
from dossierkit.llm.shared import checkpointed
from dossierkit.llm.wordhash import WINDOW_BASE, WORD_BASE, Words, finished, ranges_sum, text_groups

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Coordinates, and how many make a band: at similarity 0.8 a pair shares none of the 32 bands once in 2 * 10**7.
SIZE = 128
BAND = 4
SHINGLE = 5
SIMILARITY = 80
# Pairs of one leader that a task verifies, and members of a block when components of a bucket are compared.
LEADER_PAIRS = 512
BLOCK = 256

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
ROUND = np.uint64(0x9E3779B97F4A7C15)


class Shingles:
    """Distinct word shingles of a run of texts: those of text i are ``values[first[i]:first[i + 1]]``, sorted."""

    def __init__(self, words: Words, length: int):
        n = len(words.hashes)
        count = max(0, n - length + 1)
        at = np.arange(count)
        at = at[words.doc[:count] == words.doc[length - 1 :]] if count else at
        long = finished(ranges_sum(words.hashes, at, at + length, WORD_BASE))
        sizes = np.diff(words.first)
        short = np.flatnonzero((sizes > 0) & (sizes < length))
        # A shorter text is one shingle; its number of words keeps it apart from longer ones.
        begin, end = words.first[short], words.first[short + 1]
        whole = finished(ranges_sum(words.hashes, begin, end, WINDOW_BASE) + (end - begin).astype(np.uint64))
        doc = np.concatenate([words.doc[at], short])
        values = np.concatenate([long, whole])
        order = np.lexsort((values, doc))
        doc, values = doc[order], values[order]
        if len(doc):
            new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (values[1:] != values[:-1])])
            doc, values = doc[new], values[new]
        self.doc, self.values, self.n = doc, values, words.n
        self.first = np.searchsorted(doc, np.arange(words.n + 1))

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of each set."""
        out = []
        for salt in (0, 0x5851F42D4C957F2D):
            total = np.zeros(len(self.values) + 1, dtype=np.uint64)
            np.cumsum(finished(self.values ^ np.uint64(salt)), out=total[1:])
            out.append(finished(total[self.first[1:]] - total[self.first[:-1]] + np.diff(self.first).astype(np.uint64)))
        return out[0], out[1]


def sketches(shingles: Shingles, size: int = SIZE) -> np.ndarray:
    """A row of ``size`` coordinates per text; of a text without shingles all are ``EMPTY``."""
    out = np.full(shingles.n * size, EMPTY, dtype=np.uint64)
    values, doc = shingles.values, shingles.doc
    for i in range(2 * size):
        if not len(values):
            break
        x = finished(values + np.uint64(int(ROUND) * (i + 1) % (1 << 64)))
        place = (x % np.uint64(size)).astype(np.int64) if i < size else np.full(len(x), i - size)
        at = doc * size + place
        free = out[at] == EMPTY
        np.minimum.at(out, at[free], (np.uint64(i) << np.uint64(56)) | (x[free] >> np.uint64(8)))
        open_ = (out.reshape(-1, size) == EMPTY).any(axis=1)
        left = open_[doc]
        values, doc = values[left], doc[left]
    return out.reshape(-1, size)


def bands(sketch: np.ndarray, width: int = BAND) -> np.ndarray:
    """Bucket of each band, which also tells the bands apart."""
    parts = sketch.reshape(len(sketch), -1, width)
    total = np.arange(1, parts.shape[1] + 1, dtype=np.uint64) * ROUND
    for k in range(width):
        total = finished(total + parts[:, :, k])
    return total


def _sketching(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("_key")
            for start, end, data, offsets in text_groups(batch.column("_text")):
                shingles = Shingles(Words(data, offsets, lower=True), length)
                a, b = shingles.digests()
                buckets = bands(sketches(shingles)).view(np.int64)
                width = buckets.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (end - start) * width + 1, width, dtype=np.int32)), pa.array(buckets.ravel()))
                columns = [keys.slice(start, end - start), pa.array(np.diff(shingles.first)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), lists]
                yield pa.RecordBatch.from_arrays(columns, ["_key", "n_shingles", "_a", "_b", "_bands"])

    return run


def _alike(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _verifying(length: int, percent: int):
    """(left, right) of the pairs that reach the similarity; a leader's text stands before those of its pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, []  # a key that repeats has several texts
        met = False
        for batch in batches:
            lead, key = batch.column("_lead").to_numpy(), batch.column("_key").to_numpy()
            left, right = [], []
            for start, end, data, offsets in text_groups(batch.column("_text")):
                shingles = Shingles(Words(data, offsets, lower=True), length)
                for i in range(start, end):
                    values = shingles.values[shingles.first[i - start] : shingles.first[i - start + 1]]
                    if key[i] == lead[i]:
                        own = [*own, values.copy()] if leader == key[i] and not met else [values.copy()]
                        leader, met = key[i], False
                    elif lead[i] == leader:
                        met = True
                        if any(_alike(x, values, percent) for x in own):
                            left.append(leader)
                            right.append(key[i])
                    else:
                        raise RuntimeError(f"the text of row {lead[i]} is missing")
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["left", "right"])

    return run


def _linked(pairs: DataFrame, docs: DataFrame, length: int, percent: int) -> DataFrame:
    """The pairs (lead, key) whose whole texts reach the similarity.

    A leader with many pairs is dealt over several tasks, each with a copy of its text.
    """
    sizes = pairs.groupBy("_lead").agg(F.expr(f"1 + count(*) div {LEADER_PAIRS}").alias("_parts"))
    dealt = pairs.join(sizes, "_lead").select("_lead", "_key", F.expr("pmod(xxhash64(_key), _parts)").alias("_part"))
    leads = dealt.select("_lead", F.col("_lead").alias("_key"), "_part").distinct()
    wanted = dealt.union(leads)
    texts = wanted.join(docs, "_key").repartition(F.col("_lead"), F.col("_part"))
    texts = texts.sortWithinPartitions("_lead", "_part", F.col("_key") != F.col("_lead"))
    return texts.select("_lead", "_key", "_text").mapInArrow(_verifying(length, percent), "left bigint, right bigint")


def near_duplicates(df: DataFrame, key: str, text: str, shingle: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """``key, n_shingles, component_id, kept`` for every row.

    A text's set is its distinct shingles of ``shingle`` words ``[^\\x20\\x09-\\x0D]+`` with A to Z in
    lower case; a text with fewer words is one shingle, a text without words has none. Rows are
    linked if ``100 * intersection >= percent * union``, which whole texts confirm. ``component_id``
    is the smallest key that links reach, ``kept`` whether that is the row itself. ``key`` is an
    integer.

    Null and empty texts are linked with nothing. Rows with a null key are linked with nothing, have
    no component and are kept. Rows that repeat a key are one row of the graph, with the links of
    all of them; all are kept or none.
    Other columns are not looked at.
    """
    docs = df.select(F.col(f"`{key}`").cast("bigint").alias("_key"), F.col(f"`{text}`").alias("_text"))
    schema = "_key bigint, n_shingles bigint, _a bigint, _b bigint, _bands array<bigint>"
    sketched = checkpointed(docs.mapInArrow(_sketching(shingle), schema))
    known = sketched.filter("_key IS NOT NULL AND n_shingles > 0")
    classes = known.groupBy("_a", "_b").agg(F.min("_key").alias("_rep"), F.first("_bands").alias("_bands"))
    classes = checkpointed(classes)
    buckets = classes.select(F.col("_rep").alias("_key"), F.posexplode("_bands").alias("_band", "_bucket"))
    shared = buckets.groupBy("_bucket").agg(F.min("_key").alias("_lead"), F.max("_key").alias("_last")).filter("_lead < _last")
    members = checkpointed(buckets.join(shared.select("_bucket", "_lead"), "_bucket"))
    copies = known.select("_key", "_a", "_b").join(classes.select("_a", "_b", "_rep"), ["_a", "_b"])
    copies = checkpointed(copies.select("_key", "_rep").filter("_key <> _rep"))
    # A key that repeats may stand for several classes.
    twice = copies.groupBy("_key").agg(F.count_distinct("_rep").alias("n")).filter("n > 1").join(copies, "_key")
    pairs = members.filter("_key <> _lead").select("_lead", "_key").distinct()
    links = checkpointed(_linked(pairs, docs, shingle, percent).union(twice.select("_key", "_rep")))
    found = checkpointed(components(links, "left", "right"))
    more = _across(found, members, classes, docs, shingle, percent)
    if more is not None:
        found = checkpointed(components(found.select("node", "component").union(more), "node", "component"))
    by_copy = copies.groupBy("_key").agg(F.min("_rep").alias("_rep"))
    rows = sketched.select("_key", "n_shingles").join(by_copy, "_key", "left").withColumn("_node", F.coalesce("_rep", "_key"))
    rows = rows.join(found, rows["_node"] == found["node"], "left")
    component = F.when(F.col("_key").isNotNull(), F.coalesce("component", "_node"))
    return rows.select(
        F.col("_key").alias(key), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("_key"), F.lit(True)).alias("kept")
    )


def _across(found: DataFrame, members: DataFrame, classes: DataFrame, docs: DataFrame, length: int, percent: int) -> DataFrame | None:
    """Links between the components found so far, ``left`` and ``right``: all that buckets still hold.

    Of two members of a bucket in different components, one at least is outside of the bucket's
    largest component. So these few meet all members: both are dealt over blocks, a cell holds a
    block of each, and a task compares a cell's sets by array operations. Rows grow with members
    times blocks of the few; pairs are never sent. A pair that shares several buckets is compared
    in the first of them.
    """
    held = members.join(found, members["_key"] == found["node"], "left")
    held = held.select("_bucket", "_band", "_key", F.coalesce("component", "_key").alias("_label"))
    # Per bucket and component, then per bucket: partial aggregates of few numbers.
    sizes = held.groupBy("_bucket", "_label").agg(F.count("*").alias("_n"))
    tops = sizes.groupBy("_bucket").agg(F.sum("_n").alias("_m"), F.max(F.struct("_n", "_label")).alias("_top"), F.count("*").alias("_labels"))
    tops = tops.filter("_labels > 1").select(
        "_bucket",
        F.col("_top._label").alias("_top"),
        F.expr(f"int(1 + (_m - _top._n - 1) div {BLOCK})").alias("_few"),
        F.expr(f"int(1 + (_m - 1) div {BLOCK})").alias("_many"),
    )
    marked = checkpointed(held.join(tops, "_bucket"))
    if marked.isEmpty():
        return None

    def block(salt: int, blocks: str):
        return F.expr(f"int(pmod(xxhash64({salt}, _key), {blocks}))")

    def each(blocks: str):
        return F.expr(f"explode(sequence(0, {blocks} - 1))")

    few = marked.filter("_label <> _top").withColumn("_i", block(1, "_few")).withColumn("_j", each("_many")).withColumn("_role", F.lit(0))
    many = marked.withColumn("_i", each("_few")).withColumn("_j", block(2, "_many")).withColumn("_role", F.lit(1))
    columns = ["_bucket", "_band", "_i", "_j", "_role", "_key", "_label", F.expr("_label <> _top").alias("_outside")]
    wanted = few.select(*columns).union(many.select(*columns))
    own = classes.select(F.col("_rep").alias("_key"), "_bands").join(marked.select("_key").distinct(), "_key")
    own = own.groupBy("_key").agg(F.collect_list("_bands").alias("_bands"))
    texts = checkpointed(docs.join(own, "_key"))
    full = wanted.join(texts, "_key").repartition(F.col("_bucket"), F.col("_i"), F.col("_j"))
    full = full.sortWithinPartitions("_bucket", "_i", "_j", "_role")
    links = full.mapInArrow(_crossing(length, percent), "left bigint, right bigint")
    return checkpointed(links.distinct())


def _crossing(length: int, percent: int):
    """(left, right): components that a cell links; rows come by cell, those of the few first."""

    def cell(rows: pa.Table) -> set[tuple[int, int]]:
        role, key, label = (rows.column(c).to_numpy() for c in ("_role", "_key", "_label"))
        n_few = int((role == 0).sum())
        if not 0 < n_few < len(role):
            return set()
        outside = rows.column("_outside").to_numpy()
        band = rows.column("_band")[0].as_py()
        bands = rows.column("_bands").to_pylist()
        sets: list[np.ndarray] = []
        for _, _, data, offsets in text_groups(rows.column("_text").combine_chunks()):
            found = Shingles(Words(data, offsets, lower=True), length)
            sets += [found.values[a:b] for a, b in zip(found.first, found.first[1:])]
        size = np.array([len(s) for s in sets])
        # A key that repeats has the buckets of all its texts; then the first one is not looked for.
        plain = np.array([len(b) == 1 for b in bands])
        before = np.array([b[0][:band] for b in bands], np.int64).reshape(len(bands), band)
        many = np.arange(n_few, len(role))
        many = many[size[many] > 0]
        if not len(many):
            return set()
        every, codes = np.unique(np.concatenate([sets[m] for m in many]), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(size[many])[:-1]])
        out: set[tuple[int, int]] = set()
        for i in range(n_few):
            need = (label[many] != label[i]) & (~outside[many] | (key[many] > key[i]))
            need &= 100 * np.minimum(size[many], size[i]) >= percent * np.maximum(size[many], size[i])
            if plain[i]:
                need &= ~(plain[many] & (before[many] == before[i]).any(axis=1))
            if not need.any():
                continue
            at = np.minimum(np.searchsorted(every, sets[i]), len(every) - 1)
            mine = np.zeros(len(every), np.int64)
            mine[at[every[at] == sets[i]]] = 1
            common = np.add.reduceat(mine[codes], starts)
            linked = need & (100 * common >= percent * (size[many] + size[i] - common))
            out.update((int(label[i]), int(x)) for x in np.unique(label[many][linked]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        now = None

        def judged() -> pa.RecordBatch:
            links = sorted(cell(pa.Table.from_batches(waiting)))
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["left", "right"])

        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("_bucket", "_i", "_j")])
            cuts = [0, *(np.flatnonzero((np.diff(names, axis=1) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if now != tuple(names[:, a]) and waiting:
                    yield judged()
                    waiting = []
                now = tuple(names[:, a])
                waiting.append(batch.slice(a, b - a))
        if waiting:
            yield judged()

    return run
