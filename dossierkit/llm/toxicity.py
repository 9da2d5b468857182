"""A toxicity classifier that does not change its mind when groups of people are swapped.

Texts are bags of words and of word beginnings, which inflected and compound words share. Those
whose part in toxic texts differs from that in others beyond a significance bound, and the identity
terms, have weights of a logistic regression, fitted on a bounded sample of labelled rows. For every identity term of a labelled text there are counterfactual texts, with the term
replaced by each other term of its kind and by a word without a weight; the squared changes of the
score between a text and its counterfactuals are added to the loss. A term that is only mentioned
more often in toxic texts then loses its weight to the words that make them toxic.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierkit.llm.shared import checkpointed, sampled
from dossierkit.llm.wordhash import WORD_BASE, Words, finished, is_no_letter, ranges_sum, text_groups

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bounds of the fit: labelled rows, and words and beginnings with a weight (the driver holds their
# product as a matrix). A word counts from a log-likelihood ratio that one in a hundred unrelated
# words reaches, and from some rows on; its occurrences in a text up to a number.
SAMPLE = 8192
VOCABULARY = 2048
SIGNIFICANCE = 6.63
LEAST_ROWS = 5
MOST_COUNT = 5
# Weight of a counterfactual change and of the sizes of weights.
SWAP_PENALTY = 1.0
RIDGE = 0.03
# Bytes of the beginnings of words.
BEGINNINGS = (4, 5, 6, 7)

# Terms that name groups of people, by kind; a term is swapped with others of its kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "female", "male", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy", "lady", "gentleman"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics", "sikhs"),
    ("gay", "lesbian", "bisexual", "straight", "heterosexual", "homosexual", "queer"),
    ("black", "white", "asian", "african", "european", "latino", "arab", "indigenous"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("disabled", "blind", "deaf", "autistic", "elderly", "young"),
)


def normal(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def _words(column: pa.Array, beginnings: tuple[int, ...] = ()) -> Iterator[tuple[int, int, Words]]:
    """Words are runs of letters, in lower case."""
    for start, end, data, offsets in text_groups(column):
        yield start, end, Words(data, offsets, between=is_no_letter(digits=False), prefixes=beginnings)


def word_keys(words: Sequence[str]) -> list[int]:
    """Keys of words, as they stand in texts."""
    out = []
    for _, _, found in _words(pa.array([w.lower() for w in words], pa.large_string())):
        out += found.hashes.view(np.int64).tolist()
    return out


def _keys_of(word: str) -> list[int]:
    """Keys of a word and of its beginnings."""
    out = []
    for _, _, found in _words(pa.array([word.lower()], pa.large_string()), BEGINNINGS):
        out += [int(h.view(np.int64)[0]) for h in (found.hashes, *found.prefixes.values()) if h[0]]
    return out


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_row, _toxic, _least, _most): the ends of the hashes of three words in a row (of one, if fewer).

    Copies of a text with few changes mostly share both; texts that share a passage rarely do.
    """
    for batch in batches:
        for start, end, words in _words(batch.column("_text")):
            least, most = np.full(words.n, np.iinfo(np.int64).max), np.full(words.n, np.iinfo(np.int64).min)
            for size in (3, 1):
                at = np.arange(max(0, len(words.hashes) - size + 1))
                at = at[(words.doc[at] == words.doc[at + size - 1]) & ((size == 3) | (np.diff(words.first)[words.doc[at]] < 3))]
                mark = finished(ranges_sum(words.hashes, at, at + size, WORD_BASE)).view(np.int64)
                np.minimum.at(least, words.doc[at], mark)
                np.maximum.at(most, words.doc[at], mark)
            rest = [batch.column(c).slice(start, end - start) for c in ("_row", "_toxic")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(least), pa.array(most)], ["_row", "_toxic", "_least", "_most"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_row, _toxic, _word, _n) of the distinct words and beginnings of each text."""
    for batch in batches:
        rows, toxic = batch.column("_row").to_numpy(), batch.column("_toxic").to_numpy()
        for start, _, words in _words(batch.column("_text"), BEGINNINGS):
            keys = [words.hashes, *words.prefixes.values()]
            key = np.concatenate(keys).view(np.int64)
            doc = np.concatenate([words.doc] * len(keys))
            doc, key = doc[key != 0], key[key != 0]
            order = np.lexsort((key, doc))
            doc, key = doc[order], key[order]
            new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])]) if len(key) else np.zeros(0, bool))
            n = np.diff(np.append(new, len(key)))
            columns = [rows[start + doc[new]], toxic[start + doc[new]], key[new], n]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["_row", "_toxic", "_word", "_n"])


class Model:
    """Weights of words by key, sorted, and the score of a text without any."""

    def __init__(self, weights: dict[int, float], bias: float):
        self.keys = np.array(sorted(weights), np.int64)
        self.weights = np.array([weights[k] for k in self.keys.tolist()])
        self.bias = bias

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.empty(len(column))
        size = max(1, len(self.keys))
        for start, end, words in _words(column, BEGINNINGS):
            pairs = []
            for hashes in (words.hashes, *words.prefixes.values()) if len(self.keys) else ():
                key = hashes.view(np.int64)
                at = np.minimum(np.searchsorted(self.keys, key), size - 1)
                hit = np.flatnonzero(self.keys[at] == key)
                pairs.append(words.doc[hit] * size + at[hit])
            pair, n = np.unique(np.concatenate(pairs) if pairs else np.zeros(0, np.int64), return_counts=True)
            z = np.full(end - start, self.bias)
            if len(pair):
                np.add.at(z, pair // size, np.minimum(n, MOST_COUNT) * self.weights[pair % size])
            out[start:end] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def _solved(x: np.ndarray, y: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Weights, the last for the bias, of the penalised logistic regression: damped Newton steps."""
    w = np.zeros(x.shape[1])

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - y @ z + 0.5 * w @ penalty @ w

    now = loss(w)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w)))
        curved = penalty + 1e-9 * np.eye(len(w))
        for i in range(0, len(x), 1024):  # no second matrix of all rows
            part = slice(i, i + 1024)
            curved += (x[part] * (p[part] * (1 - p[part]))[:, None]).T @ x[part]
        step = np.linalg.solve(curved, x.T @ (p - y) + penalty @ w)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w, before, now = w - size * step, now, loss(w - size * step)
        if before - now < 1e-9 * max(1.0, now):
            break
    return w


def swap_penalty(counts: np.ndarray, kinds: Sequence[Sequence[Sequence[int]]]) -> np.ndarray:
    """Sum over rows and counterfactuals of the squared change of the score, as a matrix of weights.

    ``kinds`` lists the terms of each kind, a term as the columns of its word and of its beginnings.
    Replacing term a, which a row holds n times, by term b changes the score by n times the
    difference of their weights, and by a word without weight by -n times the weight of a. The
    counterfactuals of a term weigh as much as one together.
    """
    out = np.zeros((counts.shape[1], counts.shape[1]))
    for kind in kinds:
        for a in kind:
            share = float((counts[:, a[0]] ** 2).sum()) / len(kind)
            for b in (b for b in (*kind, ()) if b is not a):
                change = np.zeros(counts.shape[1])
                change[list(b)] += 1
                change[list(a)] -= 1
                at = np.flatnonzero(change)
                out[np.ix_(at, at)] += share * np.outer(change[at], change[at])
    return out


def _term(seen: Column, expected: Column) -> Column:
    return F.when(seen > 0, seen * F.ln(seen / expected)).otherwise(0.0)


def _ratio(n: int, toxic: int) -> Column:
    """Log-likelihood ratio of a word in ``c`` rows, ``t`` of them toxic, against the same part of all ``n`` rows.

    Unlike a difference in standard errors it holds for the few rows of rare words.
    """
    t, c = F.col("t").cast("double"), F.col("c").cast("double")
    ratio = F.lit(0.0)
    for rows, with_word, without_word in ((toxic, t, toxic - t), (n - toxic, c - t, n - toxic - c + t)):
        part = rows / n
        ratio = ratio + _term(with_word, c * part) + _term(without_word, (n - c) * part)
    return 2 * ratio


def fit(
    texts: DataFrame,
    labels: DataFrame,
    key: str,
    text: str,
    toxic: str,
    identity: Sequence[Sequence[str]] = IDENTITY_TERMS,
    swap: float = SWAP_PENALTY,
    sample: int = SAMPLE,
    significance: float = SIGNIFICANCE,
) -> Model:
    """A model of ``labels`` (``key``, ``toxic`` 0 or 1) of ``texts`` (``key``, ``text``).

    About ``sample`` labels are used, by a hash of the key, and copies of a text mostly once; other
    labels than 0 and 1 and null keys are not. Of equal texts with different labels that of the least
    key counts, and the least label if a key has several. All words and beginnings count whose
    log-likelihood ratio is ``significance`` or more, the ``VOCABULARY`` highest if there are more.
    Without rows of both labels every text has the share of toxic rows as its score (0.5 without rows).
    """
    marked = labels.select(F.col(f"`{key}`").cast("bigint").alias("_row"), F.col(f"`{toxic}`").cast("bigint").alias("_toxic"))
    marked = sampled(marked.filter("_toxic IN (0, 1) AND _row IS NOT NULL"), "_row", sample)
    # About ``sample`` rows of two numbers.
    rows = texts.select(F.col(f"`{key}`").cast("bigint").alias("_row"), normal(F.col(f"`{text}`")).alias("_text"))
    rows = rows.join(F.broadcast(marked), "_row").groupBy("_text").agg(F.min(F.struct("_row", "_toxic")).alias("_least"))
    rows = checkpointed(rows.select("_least._row", "_text", "_least._toxic"))
    # One text of a group of copies, and of a key that repeats.
    marks = rows.mapInArrow(_marked, "_row bigint, _toxic bigint, _least bigint, _most bigint")
    firsts = marks.groupBy("_least", "_most", "_toxic").agg(F.min("_row").alias("_row"))
    rows = rows.join(F.broadcast(firsts.select("_row", "_toxic").distinct()), ["_row", "_toxic"]).select("_row", "_text", "_toxic")
    words = rows.mapInArrow(_counted, "_row bigint, _toxic bigint, _word bigint, _n bigint")
    totals = rows.groupBy("_toxic").agg(F.count("*").alias("n")).collect()
    n = {r["_toxic"]: r["n"] for r in totals}
    if not n.get(0) or not n.get(1):
        share = n.get(1, 0) / max(1, sum(n.values())) if n else 0.5
        return Model({}, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    by_word = words.groupBy("_word").agg(F.sum("_toxic").alias("t"), F.count("*").alias("c"))
    rated = by_word.filter(F.col("c") >= LEAST_ROWS).select("_word", _ratio(n[0] + n[1], n[1]).alias("ratio"))
    chosen = rated.filter(F.col("ratio") >= significance).orderBy(F.desc("ratio"), "_word").limit(VOCABULARY).collect()
    named = [[_keys_of(term) for term in kind] for kind in identity]
    keys = sorted({r["_word"] for r in chosen} | {term[0] for kind in named for term in kind})
    column = {k: i for i, k in enumerate(keys)}
    named = [[[column[k] for k in term if k in column] for term in kind] for kind in named]
    # The words with a weight of about ``sample`` rows, as columns: objects would take ten times the room.
    wanted = words.filter(F.col("_word").isin(keys))
    held = wanted.select("_row", F.col("_toxic").cast("tinyint"), "_word", F.least("_n", F.lit(MOST_COUNT)).cast("tinyint").alias("_n")).toArrow()
    row, label, word, times = (held.column(i).to_numpy() for i in range(4))
    order = np.lexsort((label, row))
    row, label, word, times = row[order], label[order], word[order], times[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (label[1:] != label[:-1])
    marked_rows = label[new]
    rest = {t: n[t] - int((marked_rows == t).sum()) for t in (0, 1)}  # rows without any of the words
    y = np.concatenate([marked_rows, np.repeat([0, 1], [rest[0], rest[1]])]).astype(float)
    x = np.zeros((len(y), len(keys) + 1))
    np.maximum.at(x, (np.cumsum(new) - 1, np.searchsorted(keys, word)), times)
    x[:, -1] = 1
    penalty = RIDGE * np.eye(x.shape[1])
    penalty[-1, -1] = 0
    penalty += swap * swap_penalty(x, named)
    weights = _solved(x, y, penalty)
    return Model(dict(zip(keys, weights[:-1].tolist())), float(weights[-1]))


def score(model: Model, text: Column) -> Column:
    """Score of a text from 0 to 1; null is an empty text. The text alone decides."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(texts), pa.float64())

    return scored(normal(text))
