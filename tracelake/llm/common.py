"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import reduce
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Byte table that lower-cases A-Z and nothing else.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Text handled at once inside a task (bytes).
SLICE_BYTES = 8 << 20
#: Setting of the session, made where nobody has: bytes of whole texts that go to a Python worker at once.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20)
#: Documents scanned in one slice.
SLICE_ROWS = 4096


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, if it lies in a folder of the driver's, and bound Arrow batches.

    Functions of a module are sent by name, and a worker can only import what
    it has. Spark serves the archive itself; nothing is shared by path.
    """
    if spark.conf.get(BATCH_BYTES[0], None) is None:
        spark.conf.set(*BATCH_BYTES)
    sc, root = spark.sparkContext, Path(__file__).resolve().parents[1]
    if getattr(sc, "_tracelake_shipped", False) or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="tracelake-")) / "tracelake.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._tracelake_shipped = True


_HELD: dict = {}
#: Objects that a worker keeps from one task to the next.
HELD = 2


def held(key, make: Callable):
    """This worker's object of that key, made once; the one made longest ago goes when there are too many.

    Workers outlive the stage they were started for, so what they keep is
    bounded: an operator's tables do not stay while another operator works.
    """
    if key not in _HELD:
        while len(_HELD) >= HELD:
            del _HELD[next(iter(_HELD))]
        _HELD[key] = make()
    return _HELD[key]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local-mode session that names none (tests) gets a scratch folder;
    a cluster session must name one, because a machine-local folder does not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tracelake-", dir=os.environ.get("TMPDIR"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and go on from a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def new_table(spark: SparkSession, stem: str) -> str:
    """A fresh path for a written table in the shared folder."""
    run = spark.sparkContext._jvm.java.util.UUID.randomUUID().toString()
    return f"{shared_dir(spark).rstrip('/')}/{stem}-{run}"


def whole_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as one struct column ``row``, so that no column of the caller's meets one of an operator's."""
    return docs.select(F.struct("*").alias("row"))


def crc32_of_id(doc_id: str = "doc_id") -> Column:
    """crc32 of the id written as text (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def as_bytes(text: str | Column) -> Column:
    """UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def slices(values: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """Runs of consecutive byte strings holding about ``limit`` bytes (one text at least)."""
    n, start = len(values), 0
    while start < n:
        stop, size, run = start, 0, []
        while stop < n and (not run or (size < limit and stop - start < SLICE_ROWS)):
            b = values[stop].as_py() or b""
            run.append(b)
            size += len(b)
            stop += 1
        yield start, stop, run
        start = stop


def running_total(df: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows and this one, within ``group``, in ``order``.

    Distributed: rows are dealt out by range of (group, order), so a group
    that holds most rows is spread over many tasks; sums within a range come
    from a window over (range, group), and the sums of whole ranges, a table
    of one row per range and group, are added in front. ``order`` should be
    unique within a group, else ties are ordered arbitrarily.
    """
    ranged = df.repartitionByRange(*[F.col(c).asc_nulls_last() for c in [*group, *order]])
    ranged = cut(ranged.withColumn("_range", F.spark_partition_id()))
    inner = Window.partitionBy("_range", *group).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    here = ranged.withColumn("_here", F.sum(value).over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (ranged.groupBy("_range", *group).agg(F.sum(value).alias("_sum"))
              .withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
              .select(F.col("_range").alias("_r"), *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], "_before"))
    same = reduce(lambda a, b: a & b,
                  [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)], F.col("_range") == F.col("_r"))
    return (here.join(ranges, same)
            .withColumn(out, F.col("_here") + F.col("_before"))
            .drop("_r", "_here", "_before", "_range", *[f"_g{i}" for i in range(len(group))]))


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b: long) as rows (node, root), root the smallest node.

    Alternating large-star and small-star rounds until the links stop
    changing; every round is checkpointed, so a lost executor repeats at most
    one. Each emits one row per link, whatever the degree of a node.
    """
    def mark(e: DataFrame) -> tuple:
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while (now := mark(edges)) != seen:
        seen = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Cut, so that both sides of the join arrive by an exchange that adaptive execution can split at the centre of a star.
        low = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m")))
        large = cut(both.where("b > a").join(low, F.col("a") == F.col("k"))
                    .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        low = cut(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k"))
        small = large.join(low, F.col("a") == F.col("k")).select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        edges = cut(small.where("a <> b").distinct())
    return edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
