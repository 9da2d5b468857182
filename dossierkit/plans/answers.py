"""Questions to their nearest chunks: the context and the sources of an answer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierkit.operators.retrieve import CONTEXT_SEPARATOR, NO_LINK, NO_TITLE, TOP_K, knn


def answers(chunks: DataFrame, questions: DataFrame, k: int = TOP_K) -> DataFrame:
    """``chunks(chunk_id, link, title, chunk, vector)`` and ``questions(question_id, vector)``.

    One row per question with hits: ``context`` (chunks in rank order) and ``sources`` (``idx, title,
    url``). Texts are looked up for the hits only; a hit without one stands as an empty text.
    """
    hits = knn(
        chunks, questions, k, corpus_id="chunk_id", corpus_vector="vector", query_id="question_id", query_vector="vector"
    )
    wanted = chunks.select("chunk_id", "link", "title", "chunk").join(hits.select("chunk_id"), "chunk_id", "left_semi")
    found = hits.join(wanted, "chunk_id", "left").withColumn("chunk", F.coalesce("chunk", F.lit("")))
    # a group holds at most k rows
    ordered = F.array_sort(F.collect_list(F.struct("rank", "chunk", "title", "link")))
    lists = found.groupBy("question_id").agg(ordered.alias("hits"))
    source = f"struct(h.rank AS idx, coalesce(h.title, '{NO_TITLE}') AS title, coalesce(h.link, '{NO_LINK}') AS url)"
    return lists.select(
        "question_id",
        F.array_join(F.transform("hits", lambda h: h["chunk"]), CONTEXT_SEPARATOR).alias("context"),
        F.expr(f"transform(hits, h -> {source})").alias("sources"),
    )
