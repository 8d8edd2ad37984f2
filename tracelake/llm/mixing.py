"""Operator 1: mixing sources to target weights by systematic sampling.

Every source gets a target, a number of words; each of its documents is
expected ``target / source size`` times. Within a source the expected copies
are added up in order, one random offset is added, and a document is emitted
once per integer that its stretch of the running sum crosses. Documents are
taken in order of size, so the words taken stay within about one document of
the target. The running sum is in whole units of 2^-24 copies: it neither
drifts nor rounds, and no document exceeds the expected copies rounded up.

Targets: sources in code-point order (null last) weigh ``weights`` in turn
and share ``share`` times all words; a source's target stops at ``most``
times its size and the excess goes to the others by weight.

Defined results: null and empty texts have size 0 and take no words (they
are emitted like others); the null source is one of its own; a source without
words has target 0 and emits nothing; an empty table gives an empty result.
The offset is a hash of seed and source, so reruns agree. Rows that are equal
in id, source and text share their copies in any order. Very long texts are
sized whole. Other columns, whatever their names, come back from ``mix`` as they
were; ``mix_counts`` does not look at them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import cut, running_total, whole_rows

UNIT_BITS = 24
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size); checkpointed.

    Only totals reach the driver: each round caps the sources whose part
    exceeds their limit and shares what is left, until none is above.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_total(sources.withColumn("_one", F.lit(1)), [], ["source"], "_one", "_rank")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = cut(ranked.withColumn("weight", F.get(turn, F.pmod(F.col("_rank") - 1, F.lit(len(weights))).cast("int")))
                 .select("source", "source_size", "weight", (F.col("source_size") * F.lit(float(most))).alias("cap")))
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, last = 0.0, None
    while level != last:
        capped = F.col("weight") * level > F.col("cap")
        taken, free = ranked.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0.0)),
                                 F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        last, level = level, (total - taken) / free if free else level
    return ranked.select("source", "source_size", F.least(F.col("weight") * F.lit(level), "cap").alias("target"))


def with_copies(docs: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """``docs`` (doc_id, source, size, any others) with source_size, target and copies."""
    ranked = running_total(docs.withColumn("_one", F.lit(1)), ["source"], ["size", "doc_id"], "_one", "_k")
    unit = 1 << UNIT_BITS
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    offset = F.conv(F.substring(F.md5(name), 1, 6), 16, 10).cast("long")
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * F.lit(float(unit)))).otherwise(F.lit(0))
    per = targets.select(F.col("source").alias("_s"), "source_size", "target", rate.cast("long").alias("_rate"))
    crossed = (F.shiftright(offset + F.col("_rate") * F.col("_k"), UNIT_BITS)
               - F.shiftright(offset + F.col("_rate") * (F.col("_k") - 1), UNIT_BITS))
    return (ranked.join(per, F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("copies", crossed).drop("_s", "_rate", "_k", "_one"))


def mix_counts(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = 0,
               **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"))
    sized = cut(sized)
    return with_copies(sized, source_targets(sized, **options), seed).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _key() -> Column:
    """128-bit identity of a row's id, source and text, nulls told apart."""
    parts = [x for c in ("doc_id", "source", "text") for x in (F.col(f"row.{c}"), F.isnull(f"row.{c}"))]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(7), *parts).alias("b")).alias("key")


def mix(docs: DataFrame, seed: int = 0, **options) -> DataFrame:
    """The mixture itself: each document as many times as it is taken, with its own columns."""
    rows = whole_rows(docs)
    slim = cut(rows.select("row.doc_id", "row.source", n_words(F.col("row.text")).alias("size"), _key()))
    copies = (with_copies(slim, source_targets(slim, **options), seed).groupBy("key")
              .agg(F.sum("copies").alias("copies")).where("copies > 0"))
    once = rows.withColumn("key", _key()).dropDuplicates(["key"])
    return (once.join(copies, "key").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("row.*"))
