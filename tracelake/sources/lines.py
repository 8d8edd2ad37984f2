"""Raw line readers for the positional text inputs.

A path may be a file, a directory or a glob; Spark splits large files across
tasks, and no line passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER_MODES = ("none", "per_file", "first_value")
#: Where a line stands: ascending in order of path, split and line.
PLACE = "struct<file: string, block: bigint, row: bigint>"


def _mark_first(batches: Iterator[pa.RecordBatch], skip_blank: bool) -> Iterator[pa.RecordBatch]:
    """Adds ``first``: the line at offset 0 of its file (or the first that is not blank).

    Columns: value, file (any type), block. A task reads its splits one after
    the other and the lines of a split in order, so a row whose (file, block)
    differs from the row before begins a split. No built-in function sees that
    order without a shuffle of all lines; here whole columns are compared with
    themselves shifted by one.
    """
    last, seen = None, False  # the split of the row before, and whether its first line is behind us
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        file, block = batch.column(1), batch.column(2).to_numpy()
        begins = np.empty(n, bool)
        begins[1:] = pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False) | (block[1:] != block[:-1])
        begins[0] = (file[0].as_py(), block[0]) != last
        if skip_blank:
            filled = pc.greater(pc.utf8_length(pc.utf8_trim_whitespace(batch.column(0))), 0).to_numpy(zero_copy_only=False)
            upto = np.cumsum(filled)
            start = np.maximum.accumulate(np.where(begins, np.arange(n), -1))
            # Filled lines of the split before this one; the split of the batch before may have had some.
            before = np.where(start >= 0, upto[start] - filled[start], -int(seen and not begins[0]))
            first = filled & (upto - before == 1)
            seen = bool(upto[-1] - before[-1] >= 1)
        else:
            first = begins
        last = (file[-1].as_py(), block[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first & (block == 0))], names=[*batch.schema.names, "first"])


def _scan(spark: SparkSession, path: str | list[str], file: Column) -> DataFrame:
    return spark.read.text(path).select("value", file.alias("file"), F.col("_metadata.file_block_start").alias("block"))


def marked_lines(spark: SparkSession, path: str | list[str], skip_blank: bool = False,
                 file_names: bool = True) -> DataFrame:
    """``(value, file, block, first)``: lines with the split they stand in and whether they begin their file.

    ``skip_blank``: the first line that is not blank instead (within the
    file's first split). ``file_names=False`` gives a hash of the path, which
    costs less to carry. A path that is listed twice is read twice, but as one
    file to this mark.
    """
    path_of = F.col("_metadata.file_path")
    rows = _scan(spark, path, path_of if file_names else F.xxhash64(path_of))
    kind = "string" if file_names else "bigint"
    return rows.mapInArrow(partial(_mark_first, skip_blank=skip_blank),
                           f"value string, file {kind}, block bigint, first boolean")


def _place() -> Column:
    # Rows of a split come in order and from one task, so the running row number of the task orders them.
    return F.struct("file", "block", F.monotonically_increasing_id().alias("row")).alias("place")


def first_line(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row ``value``: the first line of the first file, in order of path, that has one (null without any)."""
    lines = _scan(spark, path, F.col("_metadata.file_path")).select("value", _place())
    return lines.agg(F.min_by("value", "place").alias("value"))


def read_lines(spark: SparkSession, path: str | list[str], header: str = "none", place: bool = False) -> DataFrame:
    """Read text lines as ``DataFrame[value: string]``, with ``place`` also where each line stands.

    ``header``:
      * ``"none"``: every line is data (log files).
      * ``"per_file"``: the line at offset 0 of *each* file is dropped,
        whatever it says, blank or not (the rule of the MapReduce cell job).
      * ``"first_value"``: every line, in any file, equal to the first line
        of the first file that has one, in order of path, is dropped (the
        rule of the RDD cell job). The line is found by an aggregate of the
        same plan: the driver opens no file.
    """
    if header not in HEADER_MODES:
        raise ValueError(f"header must be one of {HEADER_MODES}, got {header!r}")
    if header == "per_file":
        lines = marked_lines(spark, path, file_names=place)
        lines = lines.select("value", "first", *([_place()] if place else [])).where(~F.col("first")).drop("first")
    elif place:
        lines = _scan(spark, path, F.col("_metadata.file_path")).select("value", _place())
    else:
        lines = spark.read.text(path)
    if header == "first_value":
        lines = lines.where(F.col("value") != first_line(spark, path).scalar())
    return lines
