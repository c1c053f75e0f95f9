"""A training corpus from raw documents, in stages that each read what the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclake.llm import bpe, langid, mixing, quality, simhash
from doclake.llm.common import held_out, table
from doclake.sources.workspace import TEXTS, materialize

# Documents whose score is below this go; the model's prior makes 0.5 the even chance.
LEAST_QUALITY = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin; those of one fold are not learned from."""
    dictionaries = langid.learn(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    return langid.identify(docs, dictionaries).where("not lang_narrow").select(*docs.columns)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; those of one fold are not learned from."""
    held = held_out(F.col("doc_id"), 3, 1)
    positives = table(spark, sf_dir, "labels").where((F.col("quality") == 1) & ~held)
    model = quality.learn(docs.where(~held), positives)
    return quality.score(docs, model).where(F.col("quality_score") >= LEAST_QUALITY).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked, by the operator's own rule."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents in training order, as the target weights of their sources ask."""
    return mixing.mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the copies, and whether decoding them gives the text back."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    decoded = bpe.decode(bpe.encode(docs, ranks), ranks)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return decoded.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("language id", identify_language),
    ("quality classifier", classify_quality),
    ("simhash near-dedup", remove_near_duplicates),
    ("mixing", mix_sources),
    ("byte-level bpe", encode_tokens),
]

# The stages learn models and hash shingles: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"), TEXTS)
    return STAGES[-1][1](spark, docs, sf_dir)
