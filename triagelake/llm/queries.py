"""Registered queries of the text operators, and SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from triagelake.llm import bpe, importance, langid, minhash, mixing, quality, secrets, sharding, simhash, simple8b, toxicity, urls, whitening
from triagelake.llm.common import table


def op1_secrets(spark, d):
    """Secrets in every whole document text."""
    found = secrets.scan(table(spark, d, "documents", "doc_id", "text"))
    count = lambda n: F.size(F.filter("base", lambda x: x["kind"] == n)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.shown(F.col("base")), 256).alias("base_sha256"), secrets.shown(F.col("spans")).alias("spans"))


def op2_bpe(spark, d):
    """Byte-level BPE ids of every whole document text, and their decoding."""
    path = bpe.ship(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(table(spark, d, "documents", "doc_id", "text"), path)


def op3_toxicity(spark, d):
    """Toxicity of every whole document text by its nearest labelled examples."""
    labels = table(spark, d, "labels", "doc_id", "toxic")
    return toxicity.classify(table(spark, d, "documents", "doc_id", "text"), labels)


def simhash_columns(found):
    """The fingerprints of ``simhash.with_edits`` as text."""
    return found.select(
        "doc_id", "n_chars", "edited_sha256", simhash.shown(F.col("a"), F.col("b")).alias("fingerprint"),
        simhash.shown(F.col("edited_a"), F.col("edited_b")).alias("edited_fingerprint"), "near_edited", "near_next")


def op4_simhash(spark, d):
    """Fingerprints of every whole document text and of its edited text."""
    return simhash_columns(simhash.with_edits(table(spark, d, "documents", "doc_id", "text")))


def op5_simple8b(spark, d):
    """Word-BPE ids of every whole document text, written to Simple-8b files and read back."""
    path = bpe.ship(spark, public_tokenizers.path("word_bpe_49k.json"))
    folder = simple8b.write_ids(table(spark, d, "documents", "doc_id", "text"), simple8b.shared_folder(spark, "ids"), path, added=True)
    return simple8b.read_ids(spark, folder, digest=True)


def op6_mixing(spark, d):
    """All documents mixed to the targets of their sources."""
    return mixing.mix(table(spark, d, "documents", "doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op7_minhash(spark, d):
    """Near-duplicate groups of all whole document texts."""
    return minhash.near_duplicates(table(spark, d, "documents", "doc_id", "text"))


def op8_quality(spark, d):
    """Quality rules over every whole document text."""
    return quality.judge(table(spark, d, "documents", "doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_urls(spark, d):
    """Every page url by rules, else by the language-model ratio."""
    return urls.judge(table(spark, d, "pages", "page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "ratio")


def op10_langid(spark, d):
    """Language of every whole document text, learned from the other folds."""
    return langid.identify(table(spark, d, "documents", "doc_id", "text", "lang"))


def op11_whitening(spark, d):
    """Whitened principal coordinates of every usable embedding."""
    return whitening.whiten(table(spark, d, "embeddings", "vec_id", "embedding"))


def op12_importance(spark, d):
    """All documents scored and a tenth of them drawn to look like the benchmark texts."""
    return importance.resample(table(spark, d, "documents", "doc_id", "text"), table(spark, d, "benchmark", "text"))


def op13_sharding(spark, d):
    """All documents in eight shards of near-equal bytes."""
    return sharding.assign(table(spark, d, "documents", "doc_id", "text"))


QUERIES = {
    "op1_secrets": op1_secrets, "op2_bpe": op2_bpe, "op3_toxicity": op3_toxicity, "op4_simhash": op4_simhash,
    "op5_simple8b": op5_simple8b, "op6_mixing": op6_mixing, "op7_minhash": op7_minhash, "op8_quality": op8_quality,
    "op9_urls": op9_urls, "op10_langid": op10_langid, "op11_whitening": op11_whitening, "op12_importance": op12_importance,
    "op13_sharding": op13_sharding,
}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLE: dict[str, str] = {}
