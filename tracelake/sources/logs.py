"""Location logs: one line per sighting of a phone at a tower."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake import schemas
from tracelake.functions.text import day_of, field, split_lines
from tracelake.sources.lines import read_lines

MODES = ("drop", "fail")


def parse_logs(lines: DataFrame, min_fields: int = schemas.LOG_MIN_FIELDS,
               mode: str = "drop", value_col: str = "value") -> DataFrame:
    """Lines → ``(lac, cell, phone, ts)``.

    Fields are read by position after a Java-style split. A line with fewer
    than ``min_fields`` fields is dropped (``mode="drop"``) or fails the job
    (``mode="fail"``). A line with an empty phone is always dropped: it has
    no key to be stored under.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    df = split_lines(lines, value_col, min_fields, mode, "log")
    out = df.select(*[field("parts", i).alias(name) for name, i in schemas.LOG_FIELDS.items()])
    return out.where(F.col("phone").isNotNull() & (F.col("phone") != ""))


def with_day(logs: DataFrame, mode: str = "drop") -> DataFrame:
    """Add ``day`` = first ten characters of ``ts``.

    A timestamp text shorter than ten characters is dropped, or fails the job
    with ``mode="fail"`` (Spark's ``substring`` would silently return it).
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if mode == "drop":
        return logs.withColumn("day", day_of("ts")).where(F.col("day").isNotNull())
    day = F.when(F.length("ts") >= 10, F.substring("ts", 1, 10)).otherwise(
        F.raise_error(F.concat(F.lit("timestamp text too short: "),
                               F.coalesce(F.col("ts"), F.lit("null")))))
    return logs.withColumn("day", day)


def read_logs(spark: SparkSession, path: str | list[str], **kwargs) -> DataFrame:
    """Read log text files (no header) and parse them."""
    return parse_logs(read_lines(spark, path, header="none"), **kwargs)
