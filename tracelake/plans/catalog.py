"""Named queries: each builds a DataFrame from the tables in an sf directory.

Every query reads the driver's tables (through ``fixtures``) and runs over
them whole; the matching DuckDB SQL is in ``tracelake.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.operators import (
    accuracy,
    assemble_coordinate,
    cell_dimension,
    confusion_counts,
    confusion_matrix,
    coordinate_array,
    daily_itineraries,
    distinct_pairs,
    encode_regions,
    itineraries,
    lookup_batch,
    lookup_by_range,
    lookup_itineraries,
    lookup_one,
    prepare_places,
    rejected_requests,
    fit_regions,
    split_flag,
    validate_requests,
)
from tracelake.plans import fixtures as fx
from tracelake.plans import jobs
from tracelake.sources import (
    fresh_path,
    parse_cells,
    parse_logs,
    read_cells,
    read_headed_csv,
    read_table,
    replace_table,
)

Query = Callable[[SparkSession, str], DataFrame]


def q_parse_logs(spark: SparkSession, sf: str) -> DataFrame:
    return parse_logs(fx.log_lines(spark, sf))


def q_parse_cells(spark: SparkSession, sf: str) -> DataFrame:
    return parse_cells(fx.cell_lines(spark, sf))


def q_cell_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return cell_dimension(fx.towers(spark, sf))


def q_cell_dimension_from_text(spark: SparkSession, sf: str) -> DataFrame:
    return cell_dimension(parse_cells(fx.cell_lines(spark, sf)))


def q_clean_city_quotes(spark: SparkSession, sf: str) -> DataFrame:
    cells = parse_cells(fx.cell_lines(spark, sf))
    return itineraries(fx.trace_logs(spark, sf), cells, strip="quotes")


def q_clean_city_ends(spark: SparkSession, sf: str) -> DataFrame:
    # The RDD job end to end: glued key, ends stripped, duplicates removed
    # on the raw text.
    cells = parse_cells(fx.cell_lines(spark, sf))
    return itineraries(fx.trace_logs(spark, sf), cells, key="concat", strip="ends", dedupe="raw")


def q_itineraries(spark: SparkSession, sf: str) -> DataFrame:
    return itineraries(fx.trace_logs(spark, sf), fx.towers(spark, sf))


def q_itineraries_concat_key(spark: SparkSession, sf: str) -> DataFrame:
    return itineraries(fx.trace_logs(spark, sf), fx.towers(spark, sf), key="concat")


def q_itineraries_left(spark: SparkSession, sf: str) -> DataFrame:
    # The MapReduce job: every log kept, unknown towers as "null", one city
    # per tower.
    return itineraries(fx.trace_logs(spark, sf), fx.towers(spark, sf),
                       unmatched="null_text", cells_mode="one")


def q_itineraries_distinct_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_pairs(fx.trace_logs(spark, sf), fx.towers(spark, sf))


def q_daily_itineraries(spark: SparkSession, sf: str) -> DataFrame:
    return daily_itineraries(fx.event_logs(spark, sf), fx.towers(spark, sf))


def q_daily_itineraries_inner(spark: SparkSession, sf: str) -> DataFrame:
    return daily_itineraries(fx.event_logs(spark, sf), fx.towers(spark, sf),
                             unmatched="drop", cells_mode="all")


def _text_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return parse_logs(fx.log_lines(spark, sf)), parse_cells(fx.cell_lines(spark, sf))


def q_itineraries_from_text(spark: SparkSession, sf: str) -> DataFrame:
    # The MapReduce job from raw text: positional parse, left join, one
    # city per tower, no clean-up.
    logs, cells = _text_inputs(spark, sf)
    return itineraries(logs, cells, unmatched="null_text", cells_mode="one", strip="none")


def q_daily_itineraries_from_text(spark: SparkSession, sf: str) -> DataFrame:
    logs, cells = _text_inputs(spark, sf)
    return daily_itineraries(logs, cells, strip="none")


def _valid_requests(spark: SparkSession, sf: str) -> DataFrame:
    return (validate_requests(fx.requests(spark, sf)).where("valid")
            .select("request_id", "phone", "start", "end"))


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    """The daily table as it is stored: with the array of cities."""
    return daily_itineraries(fx.event_logs(spark, sf), fx.towers(spark, sf), with_cities=True)


def q_lookup_range(spark: SparkSession, sf: str) -> DataFrame:
    return lookup_itineraries(_daily(spark, sf), _valid_requests(spark, sf), level="city")


def q_lookup_range_day_text(spark: SparkSession, sf: str) -> DataFrame:
    return lookup_itineraries(_daily(spark, sf), _valid_requests(spark, sf), level="day_text")


def q_lookup_batch(spark: SparkSession, sf: str) -> DataFrame:
    return lookup_batch(_daily(spark, sf), fx.requests(spark, sf))


def q_lookup_batch_strict(spark: SparkSession, sf: str) -> DataFrame:
    # Requests must also name real calendar dates to be looked up.
    return lookup_batch(_daily(spark, sf), fx.requests(spark, sf), strict=True)


def q_lookup_one(spark: SparkSession, sf: str) -> DataFrame:
    # The original's one interactive query, for one phone of the event logs.
    return lookup_one(_daily(spark, sf), fx.ONE_PHONE, "2024-01-01", "2024-12-31")


def q_rejected_requests(spark: SparkSession, sf: str) -> DataFrame:
    return rejected_requests(fx.requests(spark, sf), strict=True)


def q_validate_requests(spark: SparkSession, sf: str) -> DataFrame:
    return validate_requests(fx.requests(spark, sf))


def _prepared(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_places(fx.places_text(spark, sf), country=fx.FIXTURE_COUNTRY)


def q_prepare_places(spark: SparkSession, sf: str) -> DataFrame:
    return _prepared(spark, sf)


def q_encode_regions(spark: SparkSession, sf: str) -> DataFrame:
    return encode_regions(_prepared(spark, sf), fx.region_labels(spark, sf))


def q_split_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return _prepared(spark, sf).select("c_custkey", split_flag("c_custkey").alias("train"))


def q_assemble_coordinate(spark: SparkSession, sf: str) -> DataFrame:
    # The assembled vector's two elements, read back from the vector, as
    # scalar columns (array values compare unreliably across engines).
    v = coordinate_array(assemble_coordinate(_prepared(spark, sf)))
    return v.select("c_custkey", F.col("coordinate")[0].alias("coord_lng"),
                    F.col("coordinate")[1].alias("coord_lat"))


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    _, pred = fit_regions(fx.places_text(spark, sf), fx.region_labels(spark, sf),
                          key="c_custkey", country=fx.FIXTURE_COUNTRY)
    return pred


def q_predict_region(spark: SparkSession, sf: str) -> DataFrame:
    # What SQL can say of a trained model: which rows are scored, their truth,
    # and that every prediction is a class of the dictionary.
    labels = fx.region_labels(spark, sf).select(F.col("label").alias("prediction"), F.lit(True).alias("known"))
    return (_predictions(spark, sf).join(labels, "prediction", "left")
            .select("c_custkey", "label", F.coalesce("known", F.lit(False)).alias("in_dictionary")))


def q_predict_band(spark: SparkSession, sf: str) -> DataFrame:
    # Classes that the forest can tell apart without error: every row's
    # prediction is compared.
    _, pred = fit_regions(fx.places_text(spark, sf), fx.band_labels(spark, sf), key="c_custkey", country=fx.FIXTURE_COUNTRY)
    return pred.select("c_custkey", "label", "prediction", (F.col("prediction") == F.col("label")).alias("agrees"))


def q_region_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return accuracy(_predictions(spark, sf)).select("n", (F.col("accuracy") >= 0.9).alias("accurate"))


def q_confusion_counts(spark: SparkSession, sf: str) -> DataFrame:
    return confusion_counts(fx.pairs(spark, sf))


def q_confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return confusion_matrix(fx.pairs(spark, sf))


def q_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return accuracy(fx.pairs(spark, sf))


# From files and stored tables, as the original programs ran: these queries
# write text files or tables of the test tables' rows to the shared folder
# first and work on those.

def q_cells_from_files(spark: SparkSession, sf: str) -> DataFrame:
    return read_cells(spark, fx.write_cell_files(spark, sf), header="per_file")


def q_cell_dimension_last(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.build_cell_dimension(spark, fx.write_cell_files(spark, sf), fresh_path(spark, "dimension"), keep="last")


def q_itineraries_from_files(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.build_itineraries(spark, fx.write_cell_files(spark, sf), fx.write_log_files(spark, sf),
                                  fresh_path(spark, "itineraries"), variant="mapreduce")


def q_itineraries_last_city(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.build_itineraries(spark, fx.write_cell_files(spark, sf), fx.write_log_files(spark, sf),
                                  fresh_path(spark, "itineraries"), variant="mapreduce", cells_mode="last")


def q_itineraries_rdd_from_files(spark: SparkSession, sf: str) -> DataFrame:
    # A short line fails this job, so the files hold none.
    return jobs.build_itineraries(spark, fx.write_cell_files(spark, sf, whole_only=True),
                                  fx.write_log_files(spark, sf, whole_only=True),
                                  fresh_path(spark, "itineraries"), variant="rdd")


def q_itineraries_two_step(spark: SparkSession, sf: str) -> DataFrame:
    # The first job stores the dimension, the second joins what is stored.
    path = fresh_path(spark, "dimension")
    replace_table(cell_dimension(fx.towers(spark, sf)), path, ["lac", "cell"])
    return itineraries(fx.trace_logs(spark, sf), read_table(spark, path), unmatched="null_text")


def q_daily_replaced(spark: SparkSession, sf: str) -> DataFrame:
    # A table replaced by a job that reads it: the inner-join rows first, then all.
    path, keys = fresh_path(spark, "daily"), ["phone", "day"]
    replace_table(q_daily_itineraries_inner(spark, sf), path, keys)
    old = read_table(spark, path)
    replace_table(_daily(spark, sf).join(old.select(*keys), keys, "left").select(*keys, "itinerary"), path, keys)
    return read_table(spark, path)


def q_lookup_stored(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "daily")
    replace_table(_daily(spark, sf), path, ["phone", "day"])
    return jobs.lookup(spark, path, fx.ONE_PHONE, "2024-01-01", "2024-12-31")


# Buckets of the stored table that batches are answered from.
BUCKETS = 16


def q_lookup_stored_batch(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "daily")
    replace_table(_daily(spark, sf), path, ["phone", "day"], BUCKETS)
    return jobs.answer_lookups(spark, path, fx.requests(spark, sf))


def q_prepare_places_from_files(spark: SparkSession, sf: str) -> DataFrame:
    raw = read_headed_csv(spark, fx.write_place_files(spark, sf), ["ID", "LNG", "LAT", "REGION", "COUNTRY"])
    places = raw.select(F.col("ID").cast("bigint").alias("c_custkey"), F.col("LNG").alias("lng"), F.col("LAT").alias("lat"),
                        F.col("REGION").alias("region"), F.col("COUNTRY").alias("country"))
    return prepare_places(places, country=fx.FIXTURE_COUNTRY)


QUERIES: dict[str, Query] = {
    "parse_logs": q_parse_logs,
    "parse_cells": q_parse_cells,
    "cell_dimension": q_cell_dimension,
    "cell_dimension_from_text": q_cell_dimension_from_text,
    "clean_city_quotes": q_clean_city_quotes,
    "clean_city_ends": q_clean_city_ends,
    "itineraries": q_itineraries,
    "itineraries_concat_key": q_itineraries_concat_key,
    "itineraries_left": q_itineraries_left,
    "itineraries_distinct_pairs": q_itineraries_distinct_pairs,
    "daily_itineraries": q_daily_itineraries,
    "daily_itineraries_inner": q_daily_itineraries_inner,
    "itineraries_from_text": q_itineraries_from_text,
    "daily_itineraries_from_text": q_daily_itineraries_from_text,
    "lookup_range": q_lookup_range,
    "lookup_range_day_text": q_lookup_range_day_text,
    "lookup_batch": q_lookup_batch,
    "lookup_batch_strict": q_lookup_batch_strict,
    "lookup_one": q_lookup_one,
    "rejected_requests": q_rejected_requests,
    "validate_requests": q_validate_requests,
    "prepare_places": q_prepare_places,
    "encode_regions": q_encode_regions,
    "split_by_key": q_split_by_key,
    "assemble_coordinate": q_assemble_coordinate,
    "predict_region": q_predict_region,
    "predict_band": q_predict_band,
    "region_accuracy": q_region_accuracy,
    "confusion_counts": q_confusion_counts,
    "confusion_matrix": q_confusion_matrix,
    "accuracy": q_accuracy,
    "cells_from_files": q_cells_from_files,
    "cell_dimension_last": q_cell_dimension_last,
    "itineraries_from_files": q_itineraries_from_files,
    "itineraries_last_city": q_itineraries_last_city,
    "itineraries_rdd_from_files": q_itineraries_rdd_from_files,
    "itineraries_two_step": q_itineraries_two_step,
    "daily_replaced": q_daily_replaced,
    "lookup_stored": q_lookup_stored,
    "lookup_stored_batch": q_lookup_stored_batch,
    "prepare_places_from_files": q_prepare_places_from_files,
}

# Queries that write files or tables while they are built.
STORED_QUERIES = ("cells_from_files", "cell_dimension_last", "itineraries_from_files", "itineraries_last_city",
                  "itineraries_rdd_from_files", "itineraries_two_step", "daily_replaced", "lookup_stored",
                  "lookup_stored_batch", "prepare_places_from_files")
# Queries that train a model while they are built.
MODEL_QUERIES = ("predict_region", "predict_band", "region_accuracy")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return q_itineraries(spark, sf)


__all__ = ["QUERIES", "MODEL_QUERIES", "STORED_QUERIES", "flagship"]
