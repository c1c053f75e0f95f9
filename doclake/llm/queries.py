"""The registered queries of the corpus operators, with their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.llm import bpe, jaccard, langid, lm, mixing, permutation, quality, resample, simhash, spelling, token_counts, topk, urls
from doclake.llm.common import held_out, table
from doclake.llm.sql import IMPORTANCE_RESAMPLING, JACCARD_JOIN, MIX_SOURCES, SPELLING_VARIANTS, URL_FILTER


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash.group(table(spark, sf_dir, "documents"))
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 7, 2))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.sparse_rows(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 1024)
    return topk.top_k(rows.where("id % 100 = 0"), rows, 10)


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, keep=["doc_id"])
    decoded = bpe.decode(encoded, ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: the quality label with the page's id; the tables have no labels of pages."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    judged = urls.judge(table(spark, sf_dir, "pages"), outcomes, URL_RULES)
    return judged.withColumns({c: F.round(c, 9) for c in ("share", "bound")})


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(documents, public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document, range-sorted by the position of its first copy; documents left out come last."""
    slim = mixing.sizes(table(spark, sf_dir, "documents"))
    planned = mixing.plan(slim, mixing.targets(slim))
    first = F.get("copies", F.lit(0))["position"]
    mixed = planned.select("doc_id", "size", "source_size", "target", "taken", F.size("copies").cast("long").alias("n_copies"), first.alias("position"))
    return mixed.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def op8_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = held_out(F.col("doc_id"), 3, 1)
    positives = table(spark, sf_dir, "labels").where((F.col("quality") == 1) & ~held)
    model = quality.learn(documents.where(~held), positives)
    scored = quality.score(documents, model, keep=["doc_id"])
    result = F.col("quality_score")
    return scored.select("doc_id", held.alias("held_out"), result.alias("score"), (result >= 0.5).cast("int").alias("predicted"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = held_out(F.col("doc_id"), 4, 2)
    judged = langid.identify(documents, langid.learn(documents.where(~held)), keep=["doc_id"])
    return judged.select("doc_id", held.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op10_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = permutation.vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    indexed = permutation.index(rows, permutation.choose_pivots(rows))
    return permutation.search(indexed.where("id % 50 = 0"), indexed, 5)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.group(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_simhash_dedup": op1_simhash_dedup,
    "op2_lm_scores": op2_lm_scores,
    "op3_exact_topk": op3_exact_topk,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_url_filter": op5_url_filter,
    "op6_token_counts": op6_token_counts,
    "op7_mix_sources": op7_mix_sources,
    "op8_quality_scores": op8_quality_scores,
    "op9_language_id": op9_language_id,
    "op10_permutation_index": op10_permutation_index,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_importance_resampling": op13_importance_resampling,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op5_url_filter": URL_FILTER,
    "op7_mix_sources": MIX_SOURCES,
    "op11_spelling_variants": SPELLING_VARIANTS,
    "op12_jaccard_join": JACCARD_JOIN,
    "op13_importance_resampling": IMPORTANCE_RESAMPLING,
}
