"""Cell-tower directory: headed comma text, read by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake import schemas
from tracelake.functions.text import field, split_lines
from tracelake.sources.lines import read_lines

MODES = ("drop", "fail")


def parse_cells(lines: DataFrame, min_fields: int = schemas.CELL_MIN_FIELDS,
                mode: str = "drop", value_col: str = "value") -> DataFrame:
    """Lines → ``(lac, cell, city)`` from fields 2, 3 and 12.

    Quotes are not interpreted (a quoted comma shifts later fields), exactly
    as the positional reader of the original jobs; use ``read_cells_csv`` for
    a quote-aware read. Lines with too few fields — counted after trailing
    empty fields are removed — are dropped or, with ``mode="fail"``, fail the
    job. Lines read with their ``place`` keep it.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    keep = [c for c in ("place",) if c in lines.columns]
    df = split_lines(lines, value_col, min_fields, mode, "cell", keep)
    return df.select(*[field("parts", i).alias(name) for name, i in schemas.CELL_FIELDS.items()], *keep)


def read_cells(spark: SparkSession, path: str | list[str], header: str = "per_file",
               place: bool = False, **kwargs) -> DataFrame:
    """Read the tower directory text and parse it by position; with ``place`` keep where each line stands."""
    return parse_cells(read_lines(spark, path, header=header, place=place), **kwargs)


def read_cells_csv(spark: SparkSession, path: str | list[str], header: str = "per_file",
                   mode: str = "drop", place: bool = False) -> DataFrame:
    """Quote-aware read of the same directory: fields 2, 3 and 12 by position.

    ``header`` and ``place`` as in ``read_lines``; a line without a city is dropped or,
    with ``mode="fail"``, fails the job.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    width = max(schemas.CELL_FIELDS.values()) + 1
    row = F.from_csv("value", ", ".join(f"f{i} string" for i in range(width)), {"mode": "PERMISSIVE"})
    city = schemas.CELL_FIELDS["city"]
    if mode == "fail":
        short = F.raise_error(F.concat(F.lit("cell line without a city: "), F.col("value")))
        kept = F.transform(F.array(row), lambda r: F.when(r[f"f{city}"].isNotNull(), r).otherwise(short))
    else:
        kept = F.filter(F.array(row), lambda r: r[f"f{city}"].isNotNull())
    lines = read_lines(spark, path, header=header, place=place)
    keep = ["place"] if place else []
    return (lines.select(*keep, F.explode(kept).alias("r"))
            .select(*[F.col(f"r.f{i}").alias(name) for name, i in schemas.CELL_FIELDS.items()], *keep))
