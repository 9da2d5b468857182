"""Preference pairs from conversations: one prompt, and a masked completion for each side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierkit.llm.shared import quoted

# What stands around a turn, in the common chat markup.
OPEN, AFTER_ROLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
# Turns of this role are learned.
LEARNED = "assistant"

TURN = "struct<role: string, text: string>"
SPAN = "struct<start: bigint, end: bigint>"


def _head(turn: str) -> str:
    return f"{quoted(OPEN)} || coalesce({turn}.role, '') || {quoted(AFTER_ROLE)}"


def _rendered(turns: str) -> str:
    """SQL: the turns as text."""
    return f"array_join(transform({turns}, t -> {_head('t')} || coalesce(t.text, '') || {quoted(CLOSE)}), '')"


def _mask(turns: str) -> str:
    """SQL: spans of characters, end outside, of learned texts with their closing marks."""
    body = f"cast(length(coalesce(t.text, '') || {quoted(CLOSE)}) as bigint)"
    head = f"cast(length({_head('t')}) as bigint)"
    start = f"struct(0L AS at, cast(array() as array<{SPAN}>) AS spans)"
    span = f"array(struct(a.at + {head} AS start, a.at + {head} + {body} AS end))"
    spans = f"if(t.role <=> {quoted(LEARNED)}, concat(a.spans, {span}), a.spans)"
    return f"aggregate({turns}, {start}, (a, t) -> struct(a.at + {head} + {body} AS at, {spans} AS spans), a -> a.spans)"


def conversations(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """``_key, _turns``: one row per key, turns by number, then role, then text (nulls first)."""
    row = F.struct(F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text"))
    gathered = df.filter(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("_key")).agg(F.sort_array(F.collect_list(row)).alias("_turns"))
    return gathered.select("_key", F.expr(f"transform(_turns, t -> cast(struct(t.role, t.text) as {TURN}))").alias("_turns"))


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per key that both tables of turns hold.

    ``key, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask``. The prompt is the
    longest run of turns, from the first on, that are the same on both sides in role and text (null
    is the same as null); it is rendered once. The completions are the turns behind it. A mask lists
    the spans of characters of a completion that are learned: texts of ``assistant`` turns with their
    closing marks.

    A side that ends with the prompt has an empty completion and mask; equal sides have both. Null
    roles and texts are rendered as empty. Turns that repeat a number are ordered by role and text.
    Rows with a null key and keys of one table only give no pair. Other columns are not looked at.
    A conversation is one row of the result, so one task gathers it; a join by key spreads the pairs.
    """
    sides = [conversations(df, key, turn, role, text) for df in (chosen, rejected)]
    pairs = sides[0].withColumnRenamed("_turns", "_c").join(sides[1].withColumnRenamed("_turns", "_r"), "_key")
    shorter = "least(size(_c), size(_r))"
    same = f"zip_with(slice(_c, 1, {shorter}), slice(_r, 1, {shorter}), (x, y) -> x.role <=> y.role AND x.text <=> y.text)"
    pairs = pairs.withColumn("_same", F.expr(same))
    pairs = pairs.withColumn("_n", F.expr("cast(if(array_contains(_same, false), array_position(_same, false) - 1, size(_same)) as int)"))

    def rest(side: str) -> Column:
        return F.expr(f"slice({side}, _n + 1, size({side}))")

    pairs = pairs.withColumn("_p", F.expr("slice(_c, 1, _n)")).withColumn("_c", rest("_c")).withColumn("_r", rest("_r"))
    return pairs.select(
        F.col("_key").alias(key),
        F.col("_n").cast("bigint").alias("n_prompt_turns"),
        F.expr(_rendered("_p")).alias("prompt"),
        F.expr(_rendered("_c")).alias("chosen"),
        F.expr(_rendered("_r")).alias("rejected"),
        F.expr(_mask("_c")).alias("chosen_mask"),
        F.expr(_mask("_r")).alias("rejected_mask"),
    )


def with_reply_of_next(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """The turns with the last reply of each conversation replaced by that of the next key.

    A rejected side for tables that hold only one answer. ``key`` is an integer. The last reply is the
    last ``assistant`` turn by number (the greatest text, if a number repeats); the last conversation
    in a row of keys has an empty one instead. Conversations without a reply stay as they are.
    """
    rows = df.select(*[F.col(f"`{c}`") for c in (key, turn, role, text)]).filter(F.col(f"`{key}`").isNotNull())
    replies = rows.filter(F.col(f"`{role}`") == LEARNED).groupBy(F.col(f"`{key}`").alias("_key")).agg(F.max(F.struct(F.col(f"`{turn}`").alias("turn"), F.col(f"`{text}`").alias("text"))).alias("_last"))
    after = replies.select((F.col("_key") - 1).alias("_before"), F.col("_last.text").alias("_other"))
    joined = rows.join(replies, rows[key] == replies["_key"], "left").join(after, rows[key] == after["_before"], "left")
    last = (F.col(f"`{role}`") == LEARNED) & F.col("_last.turn").eqNullSafe(F.col(f"`{turn}`")) & F.col("_last.text").eqNullSafe(F.col(f"`{text}`"))
    replaced = F.when(F.coalesce(last, F.lit(False)), F.coalesce("_other", F.lit(""))).otherwise(F.col(f"`{text}`"))
    return joined.select(F.col(f"`{key}`"), F.col(f"`{turn}`"), F.col(f"`{role}`"), replaced.alias(text))
