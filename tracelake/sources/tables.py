"""Key-ordered Parquet tables: the stand-in for the original key-value store.

``write_table`` writes plain Parquet, range-partitioned on the key and sorted
by it, so Parquet min/max statistics let a key-range predicate skip row groups
and files — the same pruning a row-key range scan gives.

``replace_table`` keeps a table that can be replaced at any time. Each write
makes a fresh version beside the ones before and then publishes it by adding
one small file that names it, so a job that fails or is killed leaves the
table as it was, and readers see the old rows or the new ones and nothing
between. A version is ordered by its keys, or bucketed by one of them: then a
join on that key reads it without a shuffle.

    <path>/versions/<version>/   the Parquet files of a version
    <path>/published/            one small file per published version
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_PUBLISHED = "seq long, version string, keys array<string>, buckets int, schema string"


def _ordered(df: DataFrame, keys: Sequence[str], num_partitions: int | None) -> DataFrame:
    # The range partitioning samples the keys to cut balanced ranges; without a
    # number adaptive execution sizes the ranges from the data. Sampling reads all
    # rows: moved once before, they are read twice but computed only once.
    df = df.hint("rebalance", *keys)
    dealt = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys)


def _writer(df: DataFrame, max_records_per_file: int, row_group_bytes: int | None):
    out = df.write.option("maxRecordsPerFile", max_records_per_file)
    return out.option("parquet.block.size", row_group_bytes) if row_group_bytes else out


def write_table(df: DataFrame, path: str, keys: Sequence[str],
                num_partitions: int | None = None, mode: str = "overwrite",
                max_records_per_file: int = 5_000_000, row_group_bytes: int | None = None) -> None:
    """Write ``df`` as plain Parquet ordered by ``keys``.

    An overwrite removes the files before it writes: if its job fails, the old
    rows are gone. ``replace_table`` keeps them.
    """
    _writer(_ordered(df, list(keys), num_partitions), max_records_per_file, row_group_bytes).mode(mode).parquet(path)


def replace_table(df: DataFrame, path: str, keys: Sequence[str], buckets: int | None = None,
                  num_partitions: int | None = None, max_records_per_file: int = 5_000_000,
                  row_group_bytes: int | None = None) -> str:
    """Write a fresh version of the table at ``path`` and publish it; returns the version's name.

    With ``buckets`` the rows are dealt by hash of the first key into so many
    buckets, each sorted by all keys; otherwise they are ordered by the keys.
    The last one to publish wins. ``df`` may read the table itself.
    """
    spark, keys, version = df.sparkSession, list(keys), uuid4().hex
    folder = f"{path.rstrip('/')}/versions/{version}"
    if buckets:
        rows = df.repartition(buckets, keys[0])
        (_writer(rows, 0, row_group_bytes).bucketBy(buckets, keys[0]).sortBy(*keys)
         .option("path", folder).format("parquet").saveAsTable(_catalogue_name(version)))
    else:
        _writer(_ordered(df, keys, num_partitions), max_records_per_file, row_group_bytes).parquet(folder)
    # Columns come back nullable from Parquet, whatever they were.
    schema = spark.read.parquet(folder).schema.json()
    now = published(spark, path)
    row = Row(seq=(now.seq if now else 0) + 1, version=version, keys=keys, buckets=buckets, schema=schema)
    # One row in one file: the writer's commit makes it appear whole.
    spark.createDataFrame([row], _PUBLISHED).coalesce(1).write.mode("append").json(f"{path.rstrip('/')}/published")
    return version


def published(spark: SparkSession, path: str) -> Row | None:
    """The version that readers see: the last one published. None where the path holds no such table."""
    pointers = f"{path.rstrip('/')}/published"
    if not _folder(spark, pointers)[1]:
        return None
    rows = spark.read.schema(_PUBLISHED).json(pointers)
    return rows.orderBy(F.desc("seq"), F.desc("version")).first()


def _folder(spark: SparkSession, path: str) -> tuple:
    """A path's file system and folder, and whether it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return (files, folder), files.exists(folder)


def _catalogue_name(version: str) -> str:
    return f"tracelake_{version}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a stored table: the published version, or plain Parquet where nothing was published.

    A bucketed version is read through the session's catalogue, which is told
    of it if another session wrote it, so that joins on its key use the buckets.
    """
    now = published(spark, path)
    if now is None:
        return spark.read.parquet(path)
    schema, folder = StructType.fromJson(json.loads(now.schema)), table_folder(path, now)
    if not now.buckets:
        return spark.read.schema(schema).parquet(folder)
    name = _catalogue_name(now.version)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        order = ", ".join(f"`{k}`" for k in now["keys"])
        quoted = folder.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (`{now['keys'][0]}`) "
                  f"SORTED BY ({order}) INTO {now.buckets} BUCKETS LOCATION '{quoted}'")
    return spark.table(name)


def table_folder(path: str, version: Row) -> str:
    """Where a published version's Parquet files lie, for other tools."""
    return f"{path.rstrip('/')}/versions/{version.version}"


def drop_old_versions(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove all versions but the last ``keep`` published ones, those of failed writes included.

    Not while a write or a long read of the table runs: it cannot tell a
    version that is being written from one that was left behind.
    """
    if keep < 1:
        raise ValueError(f"keep must be 1 or more, got {keep}")
    rows = spark.read.schema(_PUBLISHED).json(f"{path.rstrip('/')}/published")
    kept = {r.version for r in rows.orderBy(F.desc("seq"), F.desc("version")).limit(keep).collect()}
    (files, folder), _ = _folder(spark, f"{path.rstrip('/')}/versions")
    gone = []
    for status in files.listStatus(folder):
        version = status.getPath().getName()
        if version not in kept:
            spark.sql(f"DROP TABLE IF EXISTS {_catalogue_name(version)}")
            files.delete(status.getPath(), True)
            gone.append(version)
    return sorted(gone)


def key_range(table: DataFrame, phone: str, start: str, end: str,
              phone_col: str = "phone", day_col: str = "day") -> DataFrame:
    """Rows of one phone with ``start <= day <= end`` (text order, inclusive).

    Both predicates are simple comparisons on columns, so they reach the
    Parquet scan as pushed filters.
    """
    return table.where((F.col(phone_col) == F.lit(phone))
                       & (F.col(day_col) >= F.lit(start))
                       & (F.col(day_col) <= F.lit(end)))
