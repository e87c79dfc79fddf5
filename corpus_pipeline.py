"""Five stages from raw documents to token ids; each stage is a Spark job over all its predecessor kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.llm import bpe, langid, minhash, mixing, secrets, simple8b

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: No SQL: learned models, seeded sketches and byte-level merges are tested against brute force instead.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a known language; those without a letter or with an unsure prediction go.

    The model learns from the rows that name their language. Where none does, nothing can be rejected
    by it, and only texts without a letter go. Null and empty texts go; null ids and repeated rows stay; an empty table stays empty.
    Texts of any length are scored in windows.
    """
    model = langid.fit(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    judged = langid.predict(docs, model, keep=COLUMNS)
    return judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= 0.5)).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five-word shingles, similarity 0.8 or more).

    Texts without a word and rows without an id are linked with nothing and stay; rows of one id become one.
    """
    return minhash.keep_first(docs.select(*COLUMNS), percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; texts without one stay as they are.

    Every row stays, whatever is null in it; a null text becomes empty. ``n_chars`` is counted again.
    """
    found = secrets.scan(docs, keep=("lang", "source"))
    return found.select("doc_id", secrets.redacted(F.col("text"), F.col("spans")).alias("text"), "lang", "source").withColumn(
        "n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources to their target weights: one row per taken pass or part of a document.

    A null source is a source of its own. Documents that the mixture does not take, those without a word among them, give no row.
    """
    mixed = mixing.mix(docs, keep=("text", "lang", "source"))
    return mixing.mixture(mixed).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text of the mixture, and the digest of their decoding; a null text is empty."""
    return bpe.digests(docs, bpe.ship(spark, public_tokenizers.path("byte_bpe_50k.tiktoken")))


STAGES = [("language_id", language), ("near_dedup", near_dedup), ("secrets", secret_scan), ("mixing", mixture), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared folder and read again.

    Only the columns of documents are read, so further ones may have any name; an empty table gives an empty result.
    The folders of the stages stay below the checkpoint folder.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = simple8b.shared_folder(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        if name == STAGES[-1][0]:
            return made
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
