"""Places: headed, quote-aware CSV with LNG, LAT, REGION, COUNTRY."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.sources.lines import marked_lines

# Header names of the places file and the names used here.
PLACE_COLUMNS = {"LNG": "lng", "LAT": "lat", "REGION": "region", "COUNTRY": "country"}
HEADERS = ("first_file", "per_file")


def read_headed_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str], sep: str = ",") -> DataFrame:
    """The named columns of headed, quote-aware CSV files, each read by its own header.

    Spark's CSV reader lays the header of one file over all of them, so a file
    with another order of columns is read wrongly. Here every file's first line
    that is not blank names that file's columns; lines meet their file's
    positions in a join (one small row per file) and are parsed once, with the
    CSV rules of Spark's reader. A file that lacks a column fails the job; a
    line with fewer fields has nulls there; blank lines are no rows; an empty
    unquoted field is null, as in Spark's reader. Quoted line breaks are not
    supported. The driver learns one number: the fields of the widest header.
    """
    options = {"sep": sep, "mode": "PERMISSIVE"}
    lines = marked_lines(spark, path, skip_blank=True).where(F.trim("value") != "")
    # More separators than fields cannot be: an upper bound of the width that needs no parse.
    bound = F.length("value") - F.length(F.replace("value", F.lit(sep), F.lit(""))) + F.lit(1)
    width = lines.where("first").agg(F.max(bound)).first()[0] or 1
    row = F.from_csv("value", ", ".join(f"f{i} string" for i in range(width)), options)
    fields = F.array(*[row[f"f{i}"] for i in range(width)])
    # No parse of a header's own names is shared with the data lines: one row per file.
    headers = lines.where("first").select(F.col("file").alias("_file"), fields.alias("_names"))
    places = [F.array_position("_names", F.lit(c)).cast("int").alias(f"_at{i}") for i, c in enumerate(columns)]
    headers = headers.select("_file", *places)
    lacking = lambda i, c: F.when(F.col(f"_at{i}") > 0, F.col(f"_at{i}")).otherwise(
        F.raise_error(F.concat(F.lit(f"no column {c} in the header of "), F.col("file"))).cast("int"))
    data = lines.where(~F.col("first")).select("file", fields.alias("_fields"))
    joined = data.join(headers, F.col("file") == F.col("_file"))
    return joined.select(*[F.get("_fields", lacking(i, c) - 1).alias(c) for i, c in enumerate(columns)])


def read_places(spark: SparkSession, path: str | list[str], sep: str = ",", header: str = "first_file") -> DataFrame:
    """Read places as text columns ``lng, lat, region, country``.

    All values stay strings here (no inference); ``prepare_places`` casts.
    Other columns of the file are pruned away. ``header="first_file"`` is
    Spark's reader, which takes one file's order of columns for all files;
    ``"per_file"`` reads each file by its own header.
    """
    if header not in HEADERS:
        raise ValueError(f"header must be one of {HEADERS}, got {header!r}")
    if header == "per_file":
        raw = read_headed_csv(spark, path, list(PLACE_COLUMNS), sep)
    else:
        raw = spark.read.option("header", True).option("sep", sep).csv(path)
        missing = [c for c in PLACE_COLUMNS if c not in raw.columns]
        if missing:
            raise ValueError(f"places file lacks columns {missing}")
    return raw.select(*[F.col(src).alias(dst) for src, dst in PLACE_COLUMNS.items()])
