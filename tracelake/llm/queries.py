"""The registered queries of this package: thin, each gets its rows through its operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.llm import (binpack, chat, decontaminate, infill, langid, lmscore, merkle, mixing, quality, simhash,
                           tokencount, topk, toxicity)
from tracelake.llm.common import read


def tokenizer_path(name: str) -> str:
    """A vocabulary file of the public tokenizers, as the driver sees it."""
    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = langid.fit(docs, ~langid.held_out())
    return langid.with_language(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = tokencount.read_vocabulary(tokenizer_path("piece_bpe_32k.model"))
    return tokencount.with_token_counts(docs, vocabulary).select("doc_id", "n_tokens")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), ~toxicity.held_out())
    scored = toxicity.with_score(docs.select("doc_id", "text"), model, out="score")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", "n_items",
                       F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=2)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(read(spark, sf_dir, "conversations"))


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binpack.write_and_index(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=2)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score(read(spark, sf_dir, "documents"), lmscore.learned())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    leaves = merkle.leaves(docs, merkle.tampered_third(), {"text": merkle.lowered(F.col("text"))})
    return merkle.manifest(leaves).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", "").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = infill.fill_in_middle(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(infill.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(topk.whole_vectors(read(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0, k=5)


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_language_id, op3_token_counts, op4_toxicity, op5_decontamination, op6_simhash, op7_chat_format,
    op8_token_ids, op9_lm_score, op10_quality, op11_merkle_manifest, op12_fill_in_middle, op13_exact_top_k)}
