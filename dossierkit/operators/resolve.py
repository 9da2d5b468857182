"""Keys, aliases, first available source, last record per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierkit.functions.sqltext import col, cols, name as quoted
from dossierkit.functions.text import entities
from dossierkit.sources.sinks import staged

# Parts over which rows without a key are dealt.
NULL_PARTS = 1024
# Candidate keys up to this number are sent to every task to cut sources with.
REDUCE_KEYS = 200_000


def last_wins(df: DataFrame, keys: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """The record with the greatest ordinal of each key, without the ordinal.

    An aggregate, not a window: each task first cuts a key to one record, so a hot key costs no
    more than any other.
    """
    rest = [c for c in df.columns if c not in [*keys, *ordinal]]
    order = col(ordinal[0]) if len(ordinal) == 1 else F.struct(*cols(ordinal))
    if len(rest) == 1:
        return df.groupBy(*cols(keys)).agg(F.max_by(col(rest[0]), order).alias(rest[0]))
    last = F.max_by(F.struct(*cols(rest)), order).alias("last")
    return df.groupBy(*cols(keys)).agg(last).select(*cols(keys), "last.*")


def first_available(df: DataFrame, keys: Sequence[str], priority: Sequence[str], ok: Column) -> DataFrame:
    """Per key the first candidate that is ``ok``; a key without one keeps its row, with nulls.

    Misses come out of the same aggregate (their order is null), so there is no join back; what
    they brought is dropped before it is sorted or shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    found = F.when(ok, F.struct(*cols(rest))).alias("_found")
    tried = df.select(*cols(keys), found, F.when(ok, F.struct(*cols(priority))).alias("_order"))
    first = F.min_by("_found", "_order").alias("first")
    return tried.groupBy(*cols(keys)).agg(first).select(*cols(keys), "first.*")


def candidates(df: DataFrame, *dims: tuple[str, Sequence[str]]) -> DataFrame:
    """Every combination of a row with fixed lists, e.g. type x extension, in list order.

    ``(name, values)`` adds the columns ``name`` and ``name_no``. Row-local: lists are literals.
    """
    for name, values in dims:
        df = df.select("*", F.posexplode(F.array(*[F.lit(v) for v in values])).alias(f"{name}_no", name))
    return df


def candidate_urls(df: DataFrame, template: str, *parts: str, name: str = "url") -> DataFrame:
    """URL column from a printf template and the columns that fill it."""
    return df.withColumn(name, F.format_string(template, *cols(parts)))


def explode_entities(df: DataFrame, c: str, name: str = "entity") -> DataFrame:
    """One row per name in a shared cell, with ``<name>_no`` and the join key ``<name>_key``."""
    rest = [x for x in df.columns if x != c]
    out = df.select(*cols(rest), F.posexplode(F.expr(entities(quoted(c)))).alias(f"{name}_no", name))
    return out.withColumn(f"{name}_key", F.lower(col(name)))


def distinct_codes(df: DataFrame, codes: str, name: str = "code") -> DataFrame:
    """Distinct union of code lists."""
    return df.select(F.explode(col(codes)).alias(name)).distinct()


def alias_join(
    df: DataFrame, key: str, aliases: DataFrame, alias: str, target: str, row_id: Sequence[str]
) -> DataFrame:
    """Replace ``key`` by its target in an alias table; unknown keys stay."""
    pairs = aliases.groupBy(col(alias).alias(key)).agg(F.max(col(target)).alias("_target"))
    joined = skew_left_join(df, pairs, key, row_id)
    return joined.select(*[F.coalesce("_target", col(c)).alias(c) if c == key else col(c) for c in df.columns])


def skew_left_join(left: DataFrame, right: DataFrame, key: str, row_id: Sequence[str]) -> DataFrame:
    """Left join to a table with unique keys that stays even when one key, or none, holds much of the left.

    Rows without a key find nothing; they are dealt over ``NULL_PARTS`` parts by the hash of
    ``row_id``, which is the same when a task runs again. A partition with a hot key is split by the
    adaptive skew join, which copies the one right row to each piece. The left side is read once.
    """
    part = F.when(col(key).isNull(), F.pmod(F.xxhash64(*cols(row_id)), F.lit(NULL_PARTS)) + 1).otherwise(F.lit(0))
    dealt = left.withColumn("_part", part.cast("int"))
    # Always 0, but no literal: the planner would turn that into a filter and deal rows by the key alone.
    known = right.filter(col(key).isNotNull()).withColumn("_part", F.pmod(F.xxhash64(col(key)), F.lit(1)).cast("int"))
    return dealt.join(known, [key, "_part"], "left").drop("_part")


@dataclass(frozen=True)
class Source:
    """A table with one row per key; ``depth`` is how many leading candidate keys it may use."""

    df: DataFrame
    key: str
    depth: int


def enrich(spine: DataFrame, keys: Sequence[Column], sources: dict[str, Source], reduce: bool = False) -> DataFrame:
    """Spine rows with, for each source, the struct found by the first candidate key that hits.

    The candidates of all sources are exploded once to ``(row, ord, key)``; the sources are merged
    to one table by key first (one aggregate), so there is one join, and one aggregate back to
    rows. An ``or`` over keys in a join condition would be a nested loop instead. Equal spine rows
    have equal candidates, so their number is that of the joined rows over that of the candidates.

    ``reduce`` is for sources that are much larger than the spine: its candidate keys are staged
    and, if there are ``REDUCE_KEYS`` at most, cut every source before it is aggregated, so a source
    is not shuffled whole. With more keys the sources stay as they are.
    """
    options = []
    for i, key in enumerate(keys):
        new = key.isNotNull()
        for earlier in keys[:i]:
            new = new & ~F.coalesce(key == earlier, F.lit(False))
        options.append(F.when(new, F.struct(F.lit(i).alias("_ord"), key.alias("_key"))))
    tried = F.filter(F.array(*options), lambda o: o.isNotNull())
    numbered = spine.withColumn("_tried", tried)
    keyed = numbered.select(*cols(spine.columns), F.greatest(F.size("_tried"), F.lit(1)).alias("_of"), F.explode_outer("_tried").alias("_c"))
    keyed = keyed.select(*cols(spine.columns), "_of", "_c._ord", "_c._key")
    if reduce:
        wanted = staged(keyed.select("_key").filter("_key IS NOT NULL").distinct(), "keys")
        if wanted.count() <= REDUCE_KEYS:
            sources = {n: replace(s, df=_reduced(s, wanted)) for n, s in sources.items()}
    joined = skew_left_join(keyed, _merged(sources), "_key", spine.columns)
    # a candidate equal to an earlier one was dropped, and the earlier one lies within any depth it has
    hit = [
        F.min_by(name, F.when(F.col(name).isNotNull() & (F.col("_ord") < s.depth), F.col("_ord"))).alias(name)
        for name, s in sources.items()
    ]
    rows = F.expr("count(*) div max(_of)").alias("_rows")
    found = joined.groupBy(*cols(spine.columns)).agg(rows, *hit)
    each = found.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), "_rows")))
    return each.drop("_rows", "_row")


def _reduced(source: Source, wanted: DataFrame) -> DataFrame:
    """Rows of a source with a wanted key. The filter goes below an aggregate by that key."""
    return source.df.join(F.broadcast(wanted.select(F.col("_key").alias(source.key))), source.key, "left_semi")


def _merged(sources: dict[str, Source]) -> DataFrame:
    """All sources by key, each as one struct column."""
    wide = None
    for name, s in sources.items():
        one = s.df.filter(col(s.key).isNotNull()).select(
            col(s.key).alias("_key"), F.struct(*cols(c for c in s.df.columns if c != s.key)).alias(name)
        )
        wide = one if wide is None else wide.unionByName(one, allowMissingColumns=True)
    return wide.groupBy("_key").agg(*[F.any_value(name, True).alias(name) for name in sources])
