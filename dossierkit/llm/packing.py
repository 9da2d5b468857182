"""Best-fit packing of documents into training sequences by minimum bin slack.

Documents are cut into pieces of token ids first. Packing looks at lengths alone: there are at most
``capacity`` different ones, so the table of lengths and their counts has a fixed size, however many
pieces there are. The bins are planned on it: for each, subset sums of the lengths that are left
are worked out as bits of an integer, and the fullest feasible combination with the longest length
left is taken away. As long as the counts last, the same combination is the answer again, so it is
taken as often at once. Pieces of a length are numbered by cells, and a piece's number tells its
bin: no piece passes through the driver, and only numbers are shuffled.
"""

from __future__ import annotations

import bisect
import re
import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dossierkit.llm.shared import checkpointed, without

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 1024
# Ids of a batch of pieces, and characters of a long text that are encoded at a time.
BATCH_IDS = 1 << 20
WINDOW = 1 << 20
# Pieces of one length are numbered in cells of so many rows, in so many cells at most.
CELL_ROWS = 512
MOST_CELLS = 4096
# Rows of pieces are numbered by a key of length and number: lengths below the one, numbers below the other.
_NUMBER_BITS = 40

# A blank before a sign that is no white space ends what stands before it: tokens of the byte-level
# pattern do not reach over it, whatever follows.
_CUT = re.compile(r"(?= \S)")
# White space in a row that the pattern's look-ahead would have to remember place by place.
_BLANKS = re.compile(r"\s{2000}")
# Fixed value: the pattern of byte-level tokenizers.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The signs that stand for bytes in a byte-level vocabulary: printable Latin-1 as it is, others from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or (161 <= b <= 255 and b != 173)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def merge_ranks(parts: dict) -> dict[bytes, int] | None:
    """Tokens by id, as bytes, of a tokenizer file that is plain byte-level BPE whose ids follow its merges; else None."""
    before, model = parts.get("pre_tokenizer") or {}, parts.get("model") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if parts.get("normalizer") or not plain or model.get("type") != "BPE" or any(model.get(o) for o in odd):
        return None
    added = {t["content"] for t in parts.get("added_tokens", [])}
    letters, ids = byte_alphabet(), {t: i for t, i in model["vocab"].items() if t not in added}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    if sorted(ids, key=ids.__getitem__)[256:] != merged or not set(letters) <= set(ids) or set("".join(ids)) > set(letters):
        return None
    return {bytes(letters[c] for c in token): i for token, i in ids.items()}


class Encoder:
    """Ids of texts as ``tokenizers`` gives them, little-endian and unsigned.

    A plain byte-level BPE file is read by ``tiktoken``, which merges the same pairs in the same order
    several times as fast; a long text is then cut where that is safe. Other files, and texts that
    hold an added token or very long white space, are encoded whole by ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        import tokenizers

        self.model = tokenizers.Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.added = [t["content"] for t in parts.get("added_tokens", [])]
        ranks = merge_ranks(parts)
        self.fast = ranks and tiktoken.Encoding(path, pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encoded(self, text: str) -> bytes:
        return np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def windows(self, text: str) -> Iterator[str]:
        """A long text in parts of about ``WINDOW`` characters, each of which begins where it may be cut."""
        start = 0
        while len(text) - start > WINDOW:
            cut = _CUT.search(text, start + WINDOW)
            if not cut:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def encode(self, text: str) -> bytes:
        if not self.fast or any(a in text for a in self.added) or _BLANKS.search(text):
            return self.encoded(text)
        return b"".join(np.array(self.fast.encode_ordinary(part), "<u4").tobytes() for part in self.windows(text))


def piece_bounds(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece: all full but the first, which may be shorter."""
    first = (length - 1) % capacity + 1
    return [(0, first), *[(s, capacity) for s in range(first, length, capacity)]]


def _cutting(path: str, capacity: int, end: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Encoder(path)
        tail = b"" if end is None else np.array([end], "<u4").tobytes()
        for batch in batches:
            names = [*batch.schema.names[:-1], "piece", "start", "length", "ids"]
            rows, pieces, held = [], [], 0

            def made() -> pa.RecordBatch:
                take = pa.array(rows, pa.int64())
                kept = [batch.column(i).take(take) for i in range(batch.num_columns - 1)]
                piece, start, length, ids = zip(*pieces)
                new = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
                return pa.RecordBatch.from_arrays([*kept, *new], names)

            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                ids = encoder.encode(text.as_py()) + tail
                for number, (start, length) in enumerate(piece_bounds(len(ids) // 4, capacity)) if ids else ():
                    rows.append(i)
                    pieces.append((number, start, length, ids[4 * start : 4 * (start + length)]))
                    held += length
                    if held >= BATCH_IDS:
                        yield made()
                        rows, pieces, held = [], [], 0
            if rows:
                yield made()

    return run


def token_pieces(
    df: DataFrame, text: str, tokenizer: str, keep: Sequence[str], capacity: int = CAPACITY, end: int | None = None
) -> DataFrame:
    """The ``keep`` columns with ``piece`` (from 0), ``start``, ``length`` and ``ids`` of every piece; no shuffle.

    ``tokenizer`` is the path of a ``.json`` file on every machine; no special tokens are added but
    ``end``, the id behind every document. ``ids`` are little-endian unsigned 32-bit numbers. Only
    documents longer than ``capacity`` are cut, into full pieces of which the first may be shorter.
    Null is an empty text; without ``end`` it has no piece. Every row is a document of its own,
    also if it repeats another. Columns of ``keep`` that have a result's name are left out. A long
    text is encoded in parts where that is safe.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    value = F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text")
    kept = without(df.select(*[f"`{c}`" for c in keep]), "piece", "start", "length", "ids", "_text")
    names = [f"`{c}`" for c in kept.columns]
    schema = ", ".join([*[f"{n} {t}" for n, (_, t) in zip(names, kept.dtypes)], "piece int, start bigint, length bigint, ids binary"])
    return df.select(*names, value).mapInArrow(_cutting(tokenizer, capacity, end), schema)


def fullest(lengths: Sequence[int], counts: Mapping[int, int], room: int) -> dict[int, int]:
    """The combination of lengths with the greatest sum of at most ``room``: times by length.

    ``lengths`` are in descending order; bit ``s`` of ``sums`` tells whether the sum ``s`` can be
    reached. Copies of a length go in by doubling numbers. Longer lengths are preferred, so short
    ones are left for later bins.
    """
    sums, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in lengths:
        copies, take = min(counts[length], room // length), 1
        while copies > 0:
            take = min(take, copies)
            steps.append((length, take, sums))
            sums |= (sums << (take * length)) & mask
            copies -= take
            take *= 2
        if sums >> room & 1:
            break
    total, chosen = sums.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= take * length
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan_bins(counts: Mapping[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Bins for so many pieces of each length, as (number of equal bins, times by length).

    Each bin has the longest length that is left and the fullest combination beside it.
    """
    left = {n: c for n, c in counts.items() if c}
    ascending = sorted(left)
    plan = []
    while ascending:
        longest = ascending[-1]
        left[longest] -= 1
        room = capacity - longest
        fitting = ascending[: bisect.bisect_right(ascending, room)][::-1]
        chosen = fullest(fitting, left, room)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[n] // m for n, m in chosen.items())
        plan.append((times, chosen))
        for n, m in chosen.items():
            left[n] -= times * m
            if not left[n]:
                del left[n]
                del ascending[bisect.bisect_left(ascending, n)]
    return plan


def _runs(plan: list[tuple[int, dict[int, int]]]) -> tuple[np.ndarray, ...]:
    """Per run of equally placed pieces: key of its first piece, first bin, pieces in a bin, offset."""
    seen: dict[int, int] = {}
    rows, bin_no = [], 0
    for times, chosen in plan:
        offset = 0
        for length in sorted(chosen, reverse=True):
            number = seen.get(length, 0)
            rows.append((length << _NUMBER_BITS | number, bin_no, chosen[length], offset))
            seen[length] = number + times * chosen[length]
            offset += length * chosen[length]
        bin_no += times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else tuple(np.empty(0, np.int64) for _ in range(4))


def _placing(runs: tuple[np.ndarray, ...]):
    keys, bins, inside, offsets = runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("_length", "_number"))
            key = length << _NUMBER_BITS | number
            at = np.searchsorted(keys, key, side="right") - 1
            place = key - keys[at]
            columns = [batch.column(i) for i in range(batch.num_columns - 2)]
            new = [bins[at] + place // inside[at], offsets[at] + place % inside[at] * length]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, new)], [*batch.schema.names[:-2], "sequence_id", "offset"])

    return run


def pack(df: DataFrame, length: str = "length", order: Sequence[str] = (), capacity: int = CAPACITY) -> DataFrame:
    """All rows with the ``sequence_id`` they go to and their ``offset`` in it, without gaps from 0.

    A sequence holds lengths of ``capacity`` in all at most. The rows are read twice and must be
    the same both times: give a written table. Rows of a length are alike to the packing; ``order``
    (or all columns) tells which goes where, and rows alike in it as well can stand for each other.
    Hot lengths are numbered in cells, so no task has all rows of one. What goes to the tasks is
    the plan of bins, whose size depends on ``capacity`` alone. Lengths outside of 1 to
    ``capacity`` and null ones raise an error. Columns called like a result are replaced.
    """
    rows = without(df, "sequence_id", "offset", "_length", "_number", "_cell", "_first", "_cells")
    size = F.col(f"`{length}`").cast("bigint")
    found = {r["n"]: r["count"] for r in df.groupBy(size.alias("n")).count().limit(capacity + 2).collect()}
    if any(n is None or not 1 <= n <= capacity for n in found):
        raise ValueError(f"lengths must lie in 1 to {capacity}")
    runs = _runs(plan_bins(found, capacity))
    names = [f"`{c}`" for c in rows.columns]
    by = [f"`{c}`" for c in (order or rows.columns)]
    spark = df.sparkSession
    cells = [(n, min(MOST_CELLS, -(-c // CELL_ROWS))) for n, c in found.items()]
    # At most ``capacity`` rows.
    sizes = F.broadcast(spark.createDataFrame(cells, "_length bigint, _cells int"))
    dealt = rows.withColumn("_length", size).join(sizes, "_length").withColumn("_cell", F.pmod(F.xxhash64(*by), F.col("_cells")))
    before = Window.partitionBy("_length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    firsts = dealt.groupBy("_length", "_cell").count()
    # At most ``MOST_CELLS`` rows of a length.
    firsts = firsts.select("_length", "_cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_length", "_cell").orderBy(*by)
    numbered = dealt.withColumn("_number", F.row_number().over(inside) - 1).join(firsts, ["_length", "_cell"])
    numbered = numbered.select(*names, "_length", (F.col("_number") + F.col("_first")).alias("_number"))
    schema = ", ".join([*[f"{n} {t}" for n, (_, t) in zip(names, rows.dtypes)], "sequence_id bigint, offset bigint"])
    return numbered.mapInArrow(_placing(runs), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``n_pieces``, ``n_tokens`` and their ``ids`` in order.

    A group is one sequence, so at most ``capacity`` pieces.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    made = packed.groupBy("sequence_id").agg(F.count("*").alias("n_pieces"), ids.alias("ids"))
    return made.select("sequence_id", "n_pieces", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids")


def packed_documents(df: DataFrame, key: str, text: str, tokenizer: str, capacity: int = CAPACITY, end: int | None = None) -> DataFrame:
    """Pieces of all documents with their ids and places; the pieces are written once in between."""
    pieces = checkpointed(token_pieces(df, text, tokenizer, [key], capacity, end))
    return pack(pieces, order=[key, "piece", "start", "length"], capacity=capacity)
