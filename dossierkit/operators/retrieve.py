"""Documents, chunks and exact nearest neighbours."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossierkit.functions.sqltext import col, cols
from dossierkit.functions.sqltext import name as quoted
from dossierkit.functions.text import strip

# Tasks get the helpers of this module with their function: executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Length of a chunk, overlap of chunks, separators in the order in which they are
# tried, and number of chunks per question.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 100
SEPARATORS = ("\n\n", "\n", " ", "")
TOP_K = 3

# What stands between retrieved chunks, and the defaults of a source list.
CONTEXT_SEPARATOR = "\n\n"
NO_TITLE = "No title found"
NO_LINK = "No link found"

# Question vectors that travel to the tasks at most, and their bytes.
QUERY_LIMIT = 4096
QUERY_BYTES = 32 << 20
# Hits up to this number are sent to every task of a join.
BROADCAST_ROWS = 100_000
# Questions scored at a time within a batch.
SLICE = 256


# Fixed values in it: the labels of the fields.
def compose_document() -> Column:
    """Text of an article record: its fields as labelled lines, then the full text."""

    def field(name: str) -> Column:
        return F.coalesce(col(name), F.lit(""))

    authors = F.coalesce(F.array_join("`Author(s)`", ","), F.lit(""))
    return F.concat(
        F.lit("TITLE: "), field("Title"),
        F.lit("\nLINK: "), field("Link"),
        F.lit("\nDATE_POSTED: "), field("Date Posted"),
        F.lit("\nDATE_UPDATED: "), field("Date Updated"),
        F.lit("\nAUTHORS: "), authors,
        F.lit("\nSECTION: "), field("Section"),
        F.lit("\nUPDATES: "), field("Updates"),
        F.lit("\n\n"), field("Full Article"),
    )


def _pieces(text: str, lo: int, hi: int, separators: Sequence[str]) -> tuple[list[int] | None, Sequence[str]]:
    """Start offsets of the pieces of ``text[lo:hi]``, each led by its separator, and what is left to try.

    None stands for single characters, which need no list.
    """
    for i, sep in enumerate(separators):
        if sep == "":
            return None, ()
        at = text.find(sep, lo, hi)
        if at >= 0:
            starts = [lo] if at > lo else []
            while at >= 0:
                starts.append(at)
                at = text.find(sep, at + len(sep), hi)
            return starts, separators[i + 1 :]
    return [lo], ()


def _characters(lo: int, hi: int, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Chunks of a text without separators: all full, each with the overlap of the one before."""
    if size <= 1:
        yield from ((i, i + 1) for i in range(lo, hi))
        return
    step = max(size - overlap, 1)
    while hi - lo > size:
        yield lo, lo + size
        lo += step
    if lo < hi:
        yield lo, hi


def _spans(
    text: str, lo: int, hi: int, size: int, overlap: int, separators: Sequence[str]
) -> Iterator[tuple[int, int]]:
    """Chunks of ``text[lo:hi]`` as offsets. Pieces are contiguous, so a chunk is a slice.

    A window of pieces grows while it fits. When the next piece does not fit, the window is a
    chunk, and its front moves until no more than the overlap is left and the piece fits. A piece
    that is too long by itself is split by the remaining separators.
    """
    starts, rest = _pieces(text, lo, hi, separators)
    if starts is None:
        yield from _characters(lo, hi, size, overlap)
        return
    front = 0
    for i, (start, stop) in enumerate(zip(starts, [*starts[1:], hi])):
        if stop - start >= size:
            if front < i:
                yield starts[front], start
            front = i + 1
            if rest:
                yield from _spans(text, start, stop, size, overlap, rest)
            else:
                yield start, stop
        elif stop - starts[front] > size:
            yield starts[front], start
            while start - starts[front] > overlap or (stop - starts[front] > size and front < i):
                front += 1
    if front < len(starts):
        yield starts[front], hi


def split_text(
    text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, separators: Sequence[str] = SEPARATORS
) -> list[str]:
    """Chunks of one text: trimmed, blank ones left out."""
    chunks = (text[a:b].strip() for a, b in _spans(text, 0, len(text), size, overlap, separators))
    return [c for c in chunks if c]


def chunk_text(
    df: DataFrame,
    text: str,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
) -> DataFrame:
    """One row per chunk: the other columns, ``chunk_no`` and ``chunk``.

    A text of at most ``size`` characters is one chunk and never leaves the JVM; only longer texts
    go through Arrow.
    """

    @F.pandas_udf("array<string>")
    def split_long(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else split_text(t, size, overlap, separators))

    c = col(text)
    short = F.expr(f"filter(array({strip(quoted(text))}), t -> t != '')")
    long = split_long(F.when(F.length(c) > size, c))
    kept = [x for x in df.columns if x != text]
    return df.select(*cols(kept), F.posexplode(F.when(F.length(c) > size, long).otherwise(short)).alias("chunk_no", "chunk"))


def usable_vector(column: str, size: int) -> Column:
    """Whether a list has ``size`` numbers, none of them null or not finite."""
    c = quoted(column)
    finite = f"forall({c}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    return F.expr(f"coalesce(size({c}) = {size} AND {finite}, false)")


def _vectors(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    """Matrix of a list column with ``size`` numbers in each row, in double precision."""
    flat = pa.chunked_array([column]) if isinstance(column, pa.Array) else column
    values = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in flat.chunks] or [np.empty(0)])
    return values.astype(np.float64).reshape(len(column), size)


class _Nearest:
    """The ``k`` nearest corpus rows of each question among the rows seen so far."""

    def __init__(self, questions: np.ndarray, k: int):
        self.questions, self.k = questions, k
        self.norms = (questions**2).sum(axis=1)
        self.question = np.empty(0, dtype=np.int64)
        self.distance = np.empty(0)
        self.ids = None

    def add(self, ids: np.ndarray, vectors: np.ndarray, allowed: np.ndarray | None = None) -> None:
        """``allowed`` tells for each row (down) and question (across) whether they are to be compared."""
        if not len(ids) or not len(self.questions):
            return
        row, question = self._close(vectors, allowed)
        distance = ((vectors[row] - self.questions[question]) ** 2).sum(axis=1)
        ids = ids[row]
        if self.ids is not None:
            question = np.concatenate([self.question, question])
            distance = np.concatenate([self.distance, distance])
            ids = np.concatenate([self.ids, ids])
        id_rank = np.unique(ids, return_inverse=True)[1]
        order = np.lexsort((id_rank, distance, question))
        question = question[order]
        place = np.arange(len(question)) - np.searchsorted(question, question)
        keep = order[place < self.k]
        first = place < self.k
        self.question, self.distance, self.ids = question[first], distance[keep], ids[keep]

    def _close(self, vectors: np.ndarray, allowed: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that may be among the nearest: by one matrix product, with room for its rounding."""
        norms = (vectors**2).sum(axis=1)[:, None]
        rows, questions = [], []
        for at in range(0, len(self.questions), SLICE):
            part = slice(at, at + SLICE)
            rough = norms + self.norms[None, part] - 2.0 * vectors @ self.questions[part].T
            if allowed is not None:
                rough[~allowed[:, part]] = np.inf
            if len(vectors) > self.k:
                bound = np.partition(rough, self.k - 1, axis=0)[self.k - 1]
                room = 1e-9 * (1.0 + norms.max() + self.norms[part])
                row, question = np.nonzero((rough <= bound + room) & (rough < np.inf))
            else:
                row, question = np.nonzero(rough < np.inf)
            rows.append(row)
            questions.append(question + at)
        return np.concatenate(rows), np.concatenate(questions)


def _table(names: list[str], nearest: _Nearest, question_ids: pa.Array, schema: pa.Schema) -> pa.Table:
    ids = nearest.ids if nearest.ids is not None else np.empty(0, dtype=object)
    arrays = [
        question_ids.take(pa.array(nearest.question)),
        pa.array(ids.tolist(), type=schema.field(names[1]).type),
        pa.array(nearest.distance, type=pa.float64()),
    ]
    return pa.table(dict(zip(names, arrays)))


def knn(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    *,
    corpus_id: str,
    corpus_vector: str,
    query_id: str,
    query_vector: str,
    query_limit: int = QUERY_LIMIT,
) -> DataFrame:
    """Exact nearest neighbours by squared L2 distance: ``query_id, rank, corpus_id, distance``.

    Ties go to the smaller id. Up to ``query_limit`` questions and ``QUERY_BYTES`` travel to the
    tasks, and the corpus stays where it is: each task keeps ``k`` rows per question, and only those
    are shuffled. More questions stay a table and meet the corpus in the cells of a vector index,
    which is written to the shared folder first.

    Corpus rows without an id, or whose vector is null, holds a null or a number that is not finite,
    or is not as long as the questions, are left out (``unusable_vectors`` counts them). A question
    like that raises an error; questions without an id or vector are left out.
    """
    right = queries.filter(col(query_vector).isNotNull() & col(query_id).isNotNull()).select(*cols([query_id, query_vector]))
    shape = right.select(F.size(col(query_vector)).alias("n")).first()
    size = shape["n"] if shape else 0
    if right.filter(~usable_vector(query_vector, size)).limit(1).count():
        raise ValueError(f"every question needs {size} finite numbers")
    left = corpus.filter(col(corpus_id).isNotNull() & usable_vector(corpus_vector, size)).select(*cols([corpus_id, corpus_vector]))
    limit = max(1, min(query_limit, QUERY_BYTES // (8 * max(size, 1))))
    names = [query_id, corpus_id, "distance"]
    asked = right.count()
    if asked > limit:
        from dossierkit.operators import vector_index
        from dossierkit.sources.sinks import shared_folder

        path = shared_folder(corpus.sparkSession, "index")
        index = vector_index.build(left, path, corpus_id=corpus_id, corpus_vector=corpus_vector, size=size)
        top = vector_index.search(index, right, k, query_id=query_id, query_vector=query_vector)
        return top.hint("broadcast") if asked * k <= BROADCAST_ROWS else top
    schema = _schema(left, right, names)
    near = left.mapInArrow(_per_task(names, right.toArrow(), k, size), schema) if asked else left.limit(0).mapInArrow(lambda batches: iter(()), schema)
    order = Window.partitionBy(col(query_id)).orderBy("distance", col(corpus_id))
    top = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    top = top.select(*cols([query_id, "rank", corpus_id, "distance"]))
    # Rows of three numbers, or of short ids.
    return top.hint("broadcast") if asked * k <= BROADCAST_ROWS else top


def unusable_vectors(corpus: DataFrame, vector: str, size: int) -> DataFrame:
    """How many corpus rows a search with ``size`` numbers leaves out: ``n``, ``unusable``."""
    return corpus.agg(F.count(F.lit(1)).alias("n"), F.count_if(~usable_vector(vector, size)).alias("unusable"))


def _schema(left: DataFrame, right: DataFrame, names: list[str]) -> str:
    kinds = [right.schema[0].dataType.simpleString(), left.schema[0].dataType.simpleString(), "double"]
    return ", ".join(f"{quoted(n)} {kind}" for n, kind in zip(names, kinds))


def _per_task(names: list[str], head: pa.Table, k: int, size: int):
    corpus_id = names[1]
    question_ids = head.column(0).combine_chunks()
    questions = _vectors(head.column(1), size)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = _Nearest(questions, k)
        schema = None
        for batch in batches:
            schema = batch.schema
            nearest.add(batch.column(0).to_numpy(zero_copy_only=False), _vectors(batch.column(1), size))
        if nearest.ids is not None:
            fields = pa.schema([(names[0], question_ids.type), schema.field(0).with_name(corpus_id), ("distance", pa.float64())])
            yield from _table(names, nearest, question_ids, fields).to_batches()

    return scan


def assemble_context(
    hits: DataFrame, corpus: DataFrame, *, query_id: str, corpus_id: str, text: str, sep: str = CONTEXT_SEPARATOR
) -> DataFrame:
    """One row per question: the retrieved texts in rank order. A group holds at most k rows.

    A hit without a text stands as an empty one. Corpus rows are cut to the retrieved ones first.
    """
    wanted = corpus.select(corpus_id, text).join(hits.select(corpus_id), corpus_id, "left_semi")
    found = hits.join(wanted, corpus_id, "left").select(query_id, "rank", F.coalesce(text, F.lit("")).alias(text))
    ordered = F.array_sort(F.collect_list(F.struct("rank", text)))
    return found.groupBy(query_id).agg(F.array_join(F.transform(ordered, lambda r: r[text]), sep).alias("context"))


def list_sources(
    hits: DataFrame, corpus: DataFrame, *, query_id: str, corpus_id: str, title: str, link: str
) -> DataFrame:
    """Sources of an answer: question, ``idx`` from 1, ``title`` and ``url`` with defaults.

    Corpus rows are cut to the retrieved ones first, so the corpus is not shuffled.
    """
    wanted = corpus.select(corpus_id, title, link).join(hits.select(corpus_id), corpus_id, "left_semi")
    return hits.join(wanted, corpus_id, "left").select(
        query_id,
        F.col("rank").alias("idx"),
        F.coalesce(title, F.lit(NO_TITLE)).alias("title"),
        F.coalesce(link, F.lit(NO_LINK)).alias("url"),
    )
