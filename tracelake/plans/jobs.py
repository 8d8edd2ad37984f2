"""End-to-end jobs: text inputs → operators → key-ordered Parquet tables.

These are the runnable counterparts of the original programs: the two
itinerary jobs (MapReduce and RDD flavours), the daily itinerary job, the
range lookup, and the region classifier. Each is one lazy Spark plan per
output; the tower directory is an input of the itinerary plan rather than a
table filled by a separate job, so there is no ordering race between them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake import schemas
from tracelake.operators import (
    accuracy_of_counts,
    cell_dimension,
    confusion_counts,
    daily_itineraries,
    fit_regions,
    itineraries,
    lookup_batch,
    lookup_by_range,
    lookup_one,
    matrix_of_counts,
    prepare_places,
    province_labels,
)
from tracelake.sources.places import PLACE_COLUMNS
from tracelake.sources import (
    parse_cells,
    parse_logs,
    published,
    read_cells_csv,
    read_headed_csv,
    read_lines,
    read_places,
    read_table,
    replace_table,
)

# Named option sets. "default" is this library's choice; "mapreduce" and
# "rdd" reproduce the two original itinerary jobs where their behaviour is
# defined (see README, "Semantics").
PRESETS: dict[str, dict] = {
    "default": {
        "header": "per_file", "mode": "drop", "log_min_fields": schemas.LOG_MIN_FIELDS,
        "key": "columns", "unmatched": "drop", "cells_mode": "all", "strip": "quotes",
        "dedupe": "cleaned",
    },
    "mapreduce": {
        "header": "per_file", "mode": "drop", "log_min_fields": schemas.LOG_MIN_FIELDS,
        "key": "columns", "unmatched": "null_text", "cells_mode": "one", "strip": "none",
        "dedupe": "cleaned",
    },
    "rdd": {
        # Only fields 1-3 of a log are read, and a short line fails the job.
        "header": "first_value", "mode": "fail", "log_min_fields": 4,
        "key": "concat", "unmatched": "drop", "cells_mode": "all", "strip": "ends",
        "dedupe": "raw",
    },
}


def _preset(variant: str, overrides: dict) -> dict:
    if variant not in PRESETS:
        raise ValueError(f"variant must be one of {sorted(PRESETS)}, got {variant!r}")
    opts = dict(PRESETS[variant])
    opts.update({k: v for k, v in overrides.items() if v is not None})
    return opts


def load_inputs(spark: SparkSession, cells_path: str | None, logs_path: str,
                opts: dict, cells_table: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Parsed logs and tower directory. With ``cells_table`` the directory is
    a stored dimension (``build_cell_dimension``'s output) instead of text;
    with the option ``quote_aware`` it is read as quoted CSV (a quoted comma
    does not shift the city) instead of by raw position."""
    place = opts["cells_mode"] == "last"
    if cells_table:
        if place:
            raise ValueError('a stored dimension holds one city per tower: cells_mode="last" belongs to the job that stores it')
        cells = read_table(spark, cells_table).select("lac", "cell", "city")
    elif opts.get("quote_aware"):
        cells = read_cells_csv(spark, cells_path, header=opts["header"], mode=opts["mode"], place=place)
    else:
        cells = parse_cells(read_lines(spark, cells_path, header=opts["header"], place=place),
                            mode=opts["mode"])
    logs = parse_logs(read_lines(spark, logs_path), min_fields=opts["log_min_fields"],
                      mode=opts["mode"])
    return cells, logs


def build_cell_dimension(spark: SparkSession, cells_path: str, out_path: str | None = None,
                         header: str = "per_file", mode: str = "drop", keep: str = "largest") -> DataFrame:
    """Tower → one city, from the directory text; written ordered by tower.

    ``keep``: the largest name of a tower's lines, or the ``"last"`` line's.
    """
    cells = parse_cells(read_lines(spark, cells_path, header=header, place=keep == "last"), mode=mode)
    result = cell_dimension(cells, keep)
    if out_path:
        replace_table(result, out_path, ["lac", "cell"])
        return read_table(spark, out_path)
    return result


def build_itineraries(spark: SparkSession, cells_path: str | None, logs_path: str,
                      out_path: str | None = None, variant: str = "default",
                      cells_table: str | None = None, **overrides) -> DataFrame:
    """Phone → itinerary from the raw texts; written when ``out_path`` is set.

    ``cells_table`` reads a stored cell dimension instead of the directory
    text (the two-step flow: dimension first, then itineraries).
    """
    opts = _preset(variant, overrides)
    cells, logs = load_inputs(spark, cells_path, logs_path, opts, cells_table)
    result = itineraries(logs, cells, key=opts["key"], unmatched=opts["unmatched"],
                         cells_mode=opts["cells_mode"], strip=opts["strip"],
                         dedupe=opts["dedupe"])
    if out_path:
        replace_table(result, out_path, ["phone"])
        return read_table(spark, out_path)
    return result


def build_daily_itineraries(spark: SparkSession, cells_path: str | None, logs_path: str,
                            out_path: str | None = None, variant: str = "mapreduce",
                            cells_table: str | None = None, buckets: int | None = None,
                            **overrides) -> DataFrame:
    """(phone, day) → itinerary from the raw texts (the daily job's
    behaviour by default); written ordered by (phone, day), or in ``buckets``
    of the phone, which large batches of requests join without moving the
    table. The ``cities`` array is kept beside the text: lookups read it, so
    a city that holds a comma stays one city."""
    opts = _preset(variant, overrides)
    cells, logs = load_inputs(spark, cells_path, logs_path, opts, cells_table)
    result = daily_itineraries(logs, cells, key=opts["key"], unmatched=opts["unmatched"],
                               cells_mode=opts["cells_mode"], strip=opts["strip"],
                               dedupe=opts["dedupe"], day_mode=opts["mode"], with_cities=True)
    if out_path:
        replace_table(result, out_path, ["phone", "day"], buckets)
        return read_table(spark, out_path)
    return result


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Requests CSV with a header ``request_id,phone,start,end``, all text
    as read."""
    return spark.read.option("header", True).csv(path).select("request_id", "phone", "start", "end")


def answer_lookups(spark: SparkSession, daily_path: str, requests: DataFrame | str,
                   out_path: str | None = None, level: str = "city",
                   strict: bool = False) -> DataFrame:
    """Answer a table of requests against a stored daily itinerary table.

    A table stored in buckets of the phone is joined where it lies.
    """
    if isinstance(requests, str):
        requests = read_requests(spark, requests)
    stored = published(spark, daily_path)
    answer = lookup_by_range if stored is not None and stored.buckets else lookup_batch
    result = answer(read_table(spark, daily_path), requests, level=level, strict=strict)
    if out_path:
        replace_table(result, out_path, ["request_id"])
        return read_table(spark, out_path)
    return result


def lookup(spark: SparkSession, daily_path: str, phone: str, start: str, end: str,
           level: str = "city") -> DataFrame:
    """One request against the stored table; filters reach the scan."""
    return lookup_one(read_table(spark, daily_path), phone, start, end, level)


# Option sets of the classifier: this library's choice, and the original's
# (a region outside the dictionary fails the job; the split is a seeded sample).
REGION_PRESETS: dict[str, dict] = {
    "default": {"unknown": "drop", "split_method": "hash"},
    "original": {"unknown": "fail", "split_method": "random"},
}


@dataclass
class RegionResult:
    model: RandomForestClassificationModel
    prepared: DataFrame
    predictions: DataFrame
    counts: DataFrame
    confusion: DataFrame
    accuracy: DataFrame


def train_regions(spark: SparkSession, places_path: str,
                  country: str = schemas.DEFAULT_COUNTRY, key: str | None = None,
                  labels: DataFrame | None = None, out_dir: str | None = None,
                  params: dict | None = None, variant: str = "default", header: str = "first_file") -> RegionResult:
    """Read places, train the forest on 80 %, score the other 20 %.

    With ``out_dir`` the predictions are written first and read back, so rows
    are scored once; matrix and accuracy both come from one count of the
    (truth, prediction) pairs. ``variant`` names one of ``REGION_PRESETS``.

    ``key`` names a column that identifies a row for the split; without one
    the split hashes the coordinates and region text together. ``header`` as
    in ``read_places``.
    """
    if key is None:
        key = "_row_key"
        places = read_places(spark, places_path, header=header)
        places = places.withColumn(key, F.concat_ws("|", "lng", "lat", "region", "country"))
    else:
        raw = (read_headed_csv(spark, places_path, [key, *PLACE_COLUMNS]) if header == "per_file"
               else spark.read.option("header", True).csv(places_path))
        places = raw.select(F.col(key), *[F.col(src).alias(dst) for src, dst in PLACE_COLUMNS.items()])
    num_classes = None
    if labels is None:
        labels = province_labels(spark)
        num_classes = len(schemas.PROVINCE_LABELS)
    if variant not in REGION_PRESETS:
        raise ValueError(f"variant must be one of {sorted(REGION_PRESETS)}, got {variant!r}")
    model, pred = fit_regions(places, labels, key=key, country=country, params=params,
                              num_classes=num_classes, **REGION_PRESETS[variant])
    counts = confusion_counts(pred)
    if out_dir:
        base = out_dir.rstrip("/")
        model.write().overwrite().save(f"{base}/model")
        pred.write.mode("overwrite").parquet(f"{base}/predictions")
        pred = spark.read.parquet(f"{base}/predictions")
        confusion_counts(pred).write.mode("overwrite").parquet(f"{base}/confusion_counts")
        counts = spark.read.parquet(f"{base}/confusion_counts")
        matrix_of_counts(counts).write.mode("overwrite").parquet(f"{base}/confusion")
        accuracy_of_counts(counts).write.mode("overwrite").parquet(f"{base}/accuracy")
    return RegionResult(model, prepare_places(places, country), pred, counts, matrix_of_counts(counts),
                        accuracy_of_counts(counts))
