"""The corpus pipeline: toxicity, near-duplicates, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor
kept and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` applies them to ``documents``, each stage's result
written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracelake.llm import binpack, decontaminate, mixing, simhash, toxicity
from tracelake.llm.common import new_table, read
from tracelake.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at 0.3 or more go. The labelled rows that op4 holds out teach nothing here either."""
    return toxicity.reject_toxic(docs, read(spark, sf_dir, "labels"), ~toxicity.held_out())


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_first(docs, shingle=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mixture takes it."""
    return mixing.mix(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids in the packed file format; the file's index comes back."""
    return binpack.write_and_index(docs, tokenizer_path("word_bpe_49k.json"), end_id=2)


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_duplicates),
          ("benchmark_decontamination", drop_contaminated), ("mixing", mix_sources), ("token_ids", write_token_ids)]

#: The classifier and the fingerprints have no SQL form; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_table(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
