"""One query per operator over the driver tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dossierkit.llm import contamination, embeddings, licenses, minhash, mixing, negatives, packing, preferences, sharding, spelling, substrings, tokens, toxicity
from dossierkit.llm import oracles
from dossierkit.llm.shared import checkpointed

SHARDS = 16
TOKEN_LIMIT = 2048
TOXIC = 0.7

# Domains of documents, and the share of all tokens that each is to have.
DOMAINS = ("good", "poor", "toxic")
SHARES = (0.7, 0.2, 0.1)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sharding_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen equal shards for all documents, and where each would be with a seventeenth."""
    text = F.coalesce("text", F.lit(""))
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return sharding.assign_shards(docs, "doc_id", [1.0] * SHARDS, 1.0, order=("size", "text_crc32"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 50-word windows that an earlier document holds."""
    cleaned = substrings.remove_repeats(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with the next one's last reply."""
    turns = _table(spark, sf_dir, "conversations")
    other = preferences.with_reply_of_next(turns, "conv_id", "turn", "role", "text")
    pairs = preferences.preference_pairs(turns, other, "conv_id", "turn", "role", "text")

    def spans(name: str) -> Column:
        return F.array_join(F.transform(name, lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias(name)

    columns = ("conv_id", "n_prompt_turns", "prompt", "chosen", "rejected")
    return pairs.select(*columns, spans("chosen_mask"), spans("rejected_mask"))


def domain_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains of labelled documents."""
    domain = F.expr("CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'poor' END")
    return _table(spark, sf_dir, "labels").select("doc_id", domain.alias("domain"))


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors, rates and copies of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = mixing.fit_classifier(docs, "doc_id", "text", domain_labels(spark, sf_dir), "domain", DOMAINS)
    judged = checkpointed(model.posteriors(docs, "text").drop("text"))
    rates = mixing.fit_rates(judged, SHARES)
    out = mixing.with_copies(judged, "doc_id", rates.rate())
    posteriors = [F.get("posterior", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(DOMAINS)]
    return out.select("doc_id", "n_tokens", *posteriors, "rate", "copies")


def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all vectors among those with the same label."""
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity labels of documents that are not held out."""
    return _table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~_held_out())


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    return toxicity.fit(_table(spark, sf_dir, "documents"), training_labels(spark, sf_dir), "doc_id", "text", "toxic")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    model = toxicity_model(spark, sf_dir)
    scored = _table(spark, sf_dir, "documents").select("doc_id", _held_out().alias("held_out"), toxicity.score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= TOXIC).cast("int"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the benchmark items they hold."""
    docs, items = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark")
    found = contamination.with_items(docs, "text", items, "item_id", "text").select("doc_id", F.explode("found").alias("f"))
    return found.select("doc_id", F.col("f.item").alias("item_id"), F.col("f.n_words"), F.col("f.errors"), F.col("f.end").alias("end_word"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole document."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    counted = tokens.count_tokens(_table(spark, sf_dir, "documents"), "text", path, ["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by two-word shingles."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), "doc_id", "text", shingle=2)


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document; ``score`` is the best containment of a notice."""
    # Rows that repeat an id are told apart by their text; rows alike in both have the same notices.
    row = F.struct("doc_id", F.xxhash64("text").alias("text"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", row.alias("_row"))
    base = licenses.phrase_places(docs, "text").drop("text")
    notices = licenses.license_notices(docs, "_row", "text").select("_row.*", "template", "containment").toDF("_id", "_text", "template", "containment")
    found = notices.groupBy("_id", "_text").agg(F.collect_set(licenses.label_of(F.col("template"))).alias("_more"), F.max("containment").alias("_best"))
    same = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_row.text") == F.col("_text"))
    all_rows = base.join(found, same, "left")
    own = F.transform("places", lambda p: p["label"])
    none = F.array().cast("array<string>")
    return all_rows.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places")["start"].alias("first_word"),
        F.array_max("places")["start"].alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(own, F.coalesce("_more", none))), ",").alias("labels"),
        F.coalesce("_best", F.lit(0.0)).alias("score"),
    )


# What stands behind every document of a packed sequence.
END_OF_DOCUMENT = 2


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 1,024 tokens."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.token_pieces(_table(spark, sf_dir, "documents"), "text", path, ["doc_id"], end=END_OF_DOCUMENT)
    order = ["doc_id", "piece", "start", "length", "ids_crc32"]
    digests = checkpointed(pieces.select(*order[:4], F.crc32("ids").alias("ids_crc32")))
    return packing.pack(digests, order=order)


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, where labels of every seventh are moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    rows = checkpointed(negatives.integer_vectors(vectors, "vec_id", "embedding", "label"))
    return negatives.hard_negatives(rows, rows.filter("_id % 50 = 0"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long words of all documents with the words they may be a variant of."""
    return spelling.spelling_forms(spelling.word_counts(_table(spark, sf_dir, "documents"), "doc_id", "text"))


QUERIES = {
    "op1_rendezvous_sharding": sharding_rendezvous,
    "op2_substring_dedup": substring_dedup,
    "op3_preference_pairs": preference_pairs,
    "op4_source_mixing": source_mixing,
    "op5_embedding_near_dedup": embedding_dedup,
    "op6_toxicity": toxicity_scores,
    "op7_token_counts": token_counts,
    "op8_minhash_near_dedup": minhash_dedup,
    "op9_license_scan": license_scan,
    "op10_decontamination": decontamination,
    "op11_best_fit_packing": best_fit_packing,
    "op12_hard_negatives": hard_negatives,
    "op13_spelling_variants": spelling_variants,
}
ORACLE = {
    "op1_rendezvous_sharding": oracles.SHARDING,
    "op3_preference_pairs": oracles.PREFERENCES,
    "op5_embedding_near_dedup": oracles.EMBEDDINGS,
    "op9_license_scan": oracles.LICENSES,
    "op12_hard_negatives": oracles.NEGATIVES,
    "op13_spelling_variants": oracles.SPELLING,
}
