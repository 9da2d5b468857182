"""Document rates that bring a corpus to target token shares of soft domains.

A classifier of the labelled rows gives every document a posterior over the domains. Every
document then gets a nonnegative rate, so that the expected domain token totals, the sum over
documents of rate * tokens * posterior, are as near to the targets as rates can bring them: a
least-squares problem with one unknown per document, solved by projected gradient steps from rates
of 1. A document's gradient is its posterior times a number per domain, so added up and projected
its rate is ``max(0, 1 + posterior * lean)``, and a step needs the totals of the corpus only, a row
of a few sums. A little weight on moving rates away from 1 makes the best ``lean`` the minimum of a
convex function of a few numbers (the dual problem). Steps are preconditioned by its second
derivative, the posterior products of the documents whose rate is not 0, and shortened until the
function falls, so they reach the least squares from anywhere, also for targets out of reach.

Everything is DataFrame expressions. The classifier is naive Bayes over binned measures of style
and over words that mark a domain, fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierkit.llm.shared import checkpointed, quoted, sampled, string_array, without

# Bounds of the fit: labelled rows, bins of a measure, marking words of a domain, and steps (about 15
# where a target is out of reach, 3 else). The fit ends when the gradient is TOLERANCE of all tokens
# at most; RIDGE is the weight of the squared distance of rates from 1.
SAMPLE = 8192
BINS = 10
WORDS = 24
LEAST_ROWS = 8
STEPS = 100
TOLERANCE = 1e-7
RIDGE = 1e-7
# Parts of a step that are tried together, in one pass.
PARTS = (1.0, 1 / 4, 1 / 16, 1 / 64, 1 / 256)

# Measures of style, from the words ``_w`` of a text ``_t``; a text without words has 0 in all.
MEASURES = {
    "length": "char_length(_t) / size(_w)",
    "distinct": "size(_d) / size(_w)",
    "symbols": r"1 - char_length(regexp_replace(_t, '[#$%&*|!<>{}=_]', '')) / char_length(_t)",
    "capitals": "1 - char_length(regexp_replace(_t, '[A-Z]', '')) / char_length(_t)",
    "size": "ln(size(_w))",
}


def _measured(df: DataFrame, text: str) -> DataFrame:
    """Columns ``_w`` (words in lower case), ``_d`` (distinct ones), ``n_tokens`` and the measures."""
    out = df.withColumn("_t", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    out = out.withColumn("_w", F.expr(r"array_remove(split(lower(_t), '[\\x20\\x09-\\x0D]+'), '')"))
    out = out.withColumn("_d", F.array_distinct("_w")).withColumn("n_tokens", F.size("_w").cast("bigint"))
    return out.withColumns({f"_m_{n}": F.expr(f"if(n_tokens = 0, 0D, cast({m.replace(chr(92), chr(92) * 2)} as double))") for n, m in MEASURES.items()})


class Classifier:
    """Naive Bayes tables of domains: prior, cut points, and log shares of the bins of each feature."""

    def __init__(self, domains: Sequence[str], words: Mapping[str, list[str]], cuts: Mapping[str, list[float]]):
        self.domains, self.words, self.cuts = list(domains), {d: words.get(d, []) for d in domains}, cuts
        self.prior = [1.0 / len(domains)] * len(domains)
        self.tables: dict[str, list[list[float]]] = {}

    def bins(self) -> dict[str, str]:
        """SQL of the bin of each feature, from 0."""
        out = {}
        for name, cuts in self.cuts.items():
            out[f"m_{name}"] = " + ".join([f"if(_m_{name} > {c!r}D, 1, 0)" for c in cuts]) or "0"
        for i, domain in enumerate(self.domains):
            known = f"size(array_intersect(_known, {string_array(self.words[domain])}))"
            out[f"w_{i}"] = f"least({known}, 3)"
        return out

    def binned(self, df: DataFrame) -> DataFrame:
        every = sorted({w for words in self.words.values() for w in words})
        out = df.withColumn("_known", F.expr(f"array_intersect(_d, {string_array(every)})"))
        return out.withColumns({f"_b_{n}": F.expr(b) for n, b in self.bins().items()})

    def posteriors(self, df: DataFrame, text: str) -> DataFrame:
        """All rows and columns with ``n_tokens`` and ``posterior``, an array in the order of the domains."""
        made = ("n_tokens", "posterior", "_t", "_w", "_d", "_known")
        rows = self.binned(_measured(without(df, *(c for c in made if c != text)), text))
        scores = []
        for k, prior in enumerate(self.prior):
            parts = [f"{math.log(prior)!r}D"]
            for name, table in self.tables.items():
                shares = ", ".join(f"{math.log(row[k])!r}D" for row in table)
                parts.append(f"array({shares})[_b_{name}]")
            scores.append(" + ".join(parts))
        rows = rows.withColumn("_s", F.expr(f"array({', '.join(scores)})")).withColumn("_top", F.array_max("_s"))
        rows = rows.withColumn("_e", F.expr("transform(_s, s -> exp(s - _top))"))
        total = " + ".join(f"_e[{k}]" for k in range(len(self.domains)))
        keep = [f"`{c}`" for c in without(df, "n_tokens", "posterior").columns]
        return rows.select(*keep, "n_tokens", F.expr(f"transform(_e, e -> e / ({total}))").alias("posterior"))


def fit_classifier(df: DataFrame, key: str, text: str, labels: DataFrame, domain: str, domains: Sequence[str], sample: int = SAMPLE) -> Classifier:
    """Fitted on about ``sample`` rows of ``labels`` (``key``, ``domain``) with their texts in ``df``.

    Rows with other domains or a null key are not used. Marking words are those whose share of a
    domain's rows is furthest above that of other rows, in standard errors. Of equal texts with
    different domains that of the least key counts (the least domain of a key). A domain without rows
    keeps a small prior. Without rows at all every posterior is even.
    """
    marked = labels.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{domain}`").alias("_domain"))
    marked = sampled(marked.filter(F.col("_id").isNotNull() & F.col("_domain").isin(list(domains))), "_id", sample)
    # About ``sample`` rows of a key and a domain.
    rows = df.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_text")).join(F.broadcast(marked), "_id")
    rows = rows.groupBy("_text").agg(F.min(F.struct("_id", "_domain"))["_domain"].alias("_domain"))
    measured = checkpointed(_measured(rows, "_text").drop("_text", "_t", "_w"))
    sizes = {r["_domain"]: r["n"] for r in measured.groupBy("_domain").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    if not total:
        return Classifier(domains, {}, {})
    cut = measured.agg(*[F.percentile_approx(f"_m_{n}", [i / BINS for i in range(1, BINS)], 10000).alias(n) for n in MEASURES]).first()
    cuts = {n: sorted(set(cut[n])) for n in MEASURES}
    words = {}
    held = checkpointed(measured.select("_domain", F.explode("_d").alias("_word")).groupBy("_word", "_domain").agg(F.count("*").alias("n")))
    every = held.groupBy("_word").agg(F.sum("n").alias("all")).filter(F.col("all") >= LEAST_ROWS)
    for d, size in sizes.items():
        other = max(1, total - size)
        own = held.filter(F.col("_domain") == d).join(every, "_word")
        share = F.col("all").cast("double") / total
        z = (F.col("n").cast("double") / size - (F.col("all") - F.col("n")).cast("double") / other) / F.sqrt(share * (1 - share) * (1 / size + 1 / other) + 1e-12)
        best = own.select("_word", z.alias("z")).filter("z > 5").orderBy(F.desc("z"), "_word").limit(WORDS)
        words[d] = [r["_word"] for r in best.collect()]
    model = Classifier(domains, words, cuts)
    binned = model.binned(measured)
    names = list(model.bins())
    stacked = ", ".join(f"{quoted(n)}, _b_{n}" for n in names)
    counts = binned.select("_domain", F.expr(f"stack({len(names)}, {stacked}) AS (_feature, _bin)")).groupBy("_feature", "_bin", "_domain").count().collect()
    by = {(r["_feature"], r["_bin"], r["_domain"]): r["count"] for r in counts}
    model.prior = [(sizes.get(d, 0) + 1) / (total + len(domains)) for d in domains]
    for n in names:
        bins = len(cuts[n[2:]]) + 1 if n.startswith("m_") else 4
        model.tables[n] = [[(by.get((n, b, d), 0) + 1) / (sizes.get(d, 0) + bins) for d in domains] for b in range(bins)]
    return model


class Rates:
    """What the fit ends with: a number per domain, and the totals that it gives."""

    def __init__(self, lean: list[float], totals: list[float], targets: list[float], steps: int):
        self.lean, self.totals, self.targets, self.steps = lean, totals, targets, steps

    def rate(self) -> Column:
        """A document's rate from its ``posterior``."""
        return F.expr(_rate(self.lean))


def _rate(lean: Sequence[float]) -> str:
    moved = " + ".join(f"posterior[{k}] * {float(x)!r}D" for k, x in enumerate(lean))
    return f"greatest(0D, 1D + {moved})"


def fit_rates(df: DataFrame, shares: Sequence[float], budget: float | None = None) -> Rates:
    """Rates for rows with ``n_tokens`` and ``posterior``; ``df`` is read once per step.

    ``shares`` are the targets' parts of ``budget`` tokens, in the order of the posterior; without a
    budget it is the number of tokens there are. Gradients are added up and projected to
    nonnegative rates together, so the plan does not grow with the steps. A domain that no document
    belongs to stays short of its target, and a share of 0 is approached as far as nonnegative rates
    allow: documents belong to all domains a little. Without tokens all rates stay 1.
    """
    if min(shares) < 0 or sum(shares) <= 0:
        raise ValueError("shares must not be negative, nor all 0")
    k = len(shares)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def sums(leans):
        """Tokens, and per lean the totals, their derivative and half the squares of the rates."""
        rows = df.select("n_tokens", "posterior", *[F.expr(_rate(lean)).alias(f"_r{c}") for c, lean in enumerate(leans)])
        out = ["coalesce(sum(n_tokens), 0) AS n"]
        for c in range(len(leans)):
            out += [f"coalesce(sum(n_tokens * _r{c} * posterior[{i}]), 0D) AS s{c}_{i}" for i in range(k)]
            out += [f"coalesce(sum(if(_r{c} > 0, n_tokens, 0) * posterior[{i}] * posterior[{j}]), 0D) AS g{c}_{i}_{j}" for i, j in pairs]
            out.append(f"coalesce(sum(n_tokens * _r{c} * _r{c}), 0D) / 2 AS h{c}")
        row = rows.agg(*map(F.expr, out)).first()
        found = []
        for c in range(len(leans)):
            g = np.zeros((k, k))
            for i, j in pairs:
                g[i, j] = g[j, i] = row[f"g{c}_{i}_{j}"]
            found.append((np.array([row[f"s{c}_{i}"] for i in range(k)]), g, row[f"h{c}"]))
        return float(row["n"]), found

    lean, steps = np.zeros(k), 0
    tokens, [(now, gram, half)] = sums([lean])
    total = tokens if budget is None else float(budget)
    targets = np.array(shares, float) / sum(shares) * total
    scale = max(total, 1.0)
    # Domains without documents have nothing to turn to.
    goal = np.where(now > 1e-9 * scale, targets, now)

    def dual(lean, half):
        return (half - goal @ lean) / scale + RIDGE / 2 * lean @ lean

    while tokens and steps < STEPS:
        gradient = (now - goal) / scale + RIDGE * lean
        if np.abs(gradient).max() <= TOLERANCE:
            break
        step = -np.linalg.solve(gram / scale + RIDGE * np.eye(k), gradient)
        tried = [lean + part * step for part in PARTS]
        values = [(dual(to, found[2]), to, found) for to, found in zip(tried, sums(tried)[1])]
        value, to, found = min(values, key=lambda v: v[0])
        if value >= dual(lean, half):
            break
        lean, (now, gram, half) = to, found
        steps += 1
    return Rates(lean.tolist(), now.tolist(), targets.tolist(), steps)


def with_copies(df: DataFrame, key: str, rate: Column) -> DataFrame:
    """All rows with ``rate`` and ``copies``: its whole part, and one more for the rest of it by a hash of the key."""
    unit = F.pmod(F.xxhash64(F.lit("copies"), F.col(f"`{key}`")), F.lit(1 << 30)) / float(1 << 30)
    out = without(df, "rate", "copies").withColumn("rate", rate)
    whole = F.floor("rate")
    return out.withColumn("copies", (whole + F.when(unit < F.col("rate") - whole, 1).otherwise(0)).cast("bigint"))


def mixed(df: DataFrame, key: str, text: str, model: Classifier, shares: Sequence[float], budget: float | None = None) -> DataFrame:
    """All rows and columns with ``n_tokens``, ``posterior``, ``rate`` and ``copies``.

    Null and empty texts have no tokens; they get a posterior and a rate like others. Repeated rows
    count as often as they are there. Columns of ``df`` with a result's name are replaced. Texts are
    read twice, and never shuffled: for the fit, which sees two columns, and for the result.
    """
    judged = model.posteriors(df, text)
    rates = fit_rates(checkpointed(judged.select("n_tokens", "posterior")), shares, budget)
    return with_copies(judged, key, rates.rate())
