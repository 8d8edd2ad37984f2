"""Region classifier: predict a region from longitude and latitude.

Data preparation is plain DataFrame code (filters before any vector is
built, safe casts, a broadcast join to the fixed label dictionary, a
hash-based train/test split that does not depend on partitioning); training
and scoring use ``pyspark.ml``'s distributed random forest.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake import schemas

UNKNOWN_MODES = ("drop", "fail")


def province_labels(spark: SparkSession) -> DataFrame:
    """The fixed 31-region dictionary as ``(region, label)``."""
    return spark.createDataFrame(schemas.PROVINCE_LABELS, schema=schemas.LABELS)


def prepare_places(places: DataFrame, country: str = schemas.DEFAULT_COUNTRY) -> DataFrame:
    """Keep rows of ``country`` that have a region and two valid numbers.

    Filters run before the coordinates are used, so a malformed number in a
    row of another country cannot fail the job; numbers are cast with
    ``try_cast`` (null when malformed) and rows without both are dropped.
    Other columns pass through; ``country`` is removed.
    """
    kept = places.where((F.col("country") == F.lit(country)) & F.col("region").isNotNull())
    others = [c for c in kept.columns if c not in ("lng", "lat", "region", "country")]
    typed = kept.select(*others, "region",
                        F.col("lng").try_cast("double").alias("lng"),
                        F.col("lat").try_cast("double").alias("lat"))
    return typed.where(F.col("lng").isNotNull() & F.col("lat").isNotNull())


def encode_regions(places: DataFrame, labels: DataFrame, unknown: str = "drop") -> DataFrame:
    """Attach the class number of each region from a fixed dictionary.

    Not ``StringIndexer``: that numbers by frequency, while the classes here
    are fixed. The dictionary has one row per class; the join to it is left to
    Spark, which broadcasts it if it is as small as it should be.
    ``unknown="drop"`` removes regions missing from the dictionary,
    ``"fail"`` fails the job on the first one.
    """
    if unknown not in UNKNOWN_MODES:
        raise ValueError(f"unknown must be one of {UNKNOWN_MODES}, got {unknown!r}")
    lab = labels.select("region", "label")
    if unknown == "drop":
        return places.join(lab, "region", "inner")
    joined = places.join(lab, "region", "left")
    return joined.withColumn(
        "label",
        F.when(F.col("label").isNotNull(), F.col("label"))
         .otherwise(F.raise_error(F.concat(F.lit("region not in the dictionary: "), F.col("region"))))
         .cast("double"))


def split_flag(key: str | Column, train_fraction: float = 0.8) -> Column:
    """True for the training part: a stable hash of the key, not a sample.

    The first 32 bits of the key's MD5, below ``train_fraction`` of their
    range; reproducible in any engine and unchanged by repartitioning or
    retries. A row without a key belongs to the training part.
    """
    k = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(h < math.floor(train_fraction * 2**32), F.lit(True))


SPLIT_METHODS = ("hash", "random")


def split_by_key(df: DataFrame, key: str | None, train_fraction: float = 0.8,
                 method: str = "hash", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test parts.

    ``method="hash"`` (default) uses ``split_flag`` on ``key``: the same rows
    land in the same part on every run and engine. ``"random"`` is Spark's
    seeded ``randomSplit`` (the original's method); its parts depend on how
    the rows are partitioned.
    """
    if method not in SPLIT_METHODS:
        raise ValueError(f"method must be one of {SPLIT_METHODS}, got {method!r}")
    if method == "random":
        train, test = df.randomSplit([train_fraction, 1.0 - train_fraction], seed)
        return train, test
    flag = split_flag(key, train_fraction)
    return df.where(flag), df.where(~flag)


def assemble_coordinate(df: DataFrame, output_col: str = "coordinate") -> DataFrame:
    """``(lng, lat)`` → dense vector column."""
    return VectorAssembler(inputCols=["lng", "lat"], outputCol=output_col,
                           handleInvalid="error").transform(df)


def coordinate_array(df: DataFrame, col: str = "coordinate") -> DataFrame:
    return df.withColumn(col, vector_to_array(col))


def _label_with_classes(df: DataFrame, num_classes: int) -> DataFrame:
    # Nominal metadata fixes the number of classes to the dictionary size,
    # whatever labels the training part happens to contain.
    meta = {"ml_attr": {"type": "nominal", "num_vals": int(num_classes),
                        "name": "label"}}
    return df.withColumn("label", F.col("label").alias("label", metadata=meta))


def forest_partitions(rows: int) -> int:
    """Parts for so many training rows: a power of two, so it changes seldom and with the data alone."""
    parts = schemas.FOREST_PARTITIONS
    while parts * schemas.FOREST_ROWS_PER_PARTITION < rows:
        parts *= 2
    return parts


def train_region_model(train: DataFrame, num_classes: int, params: dict | None = None,
                       partitions: int | None = None, key: str | None = None) -> RandomForestClassificationModel:
    """Fit the forest on ``(label, coordinate)`` rows.

    The trees' samples follow the partitions, so the rows are dealt by hash
    into parts whose number comes from the counted rows (``forest_partitions``,
    not a property of the cluster) and sorted within them: the same rows give
    the same forest on any number of cores. The deal is by label, place and
    ``key``, a column that tells rows apart: without one, rows of one place all
    go to one part. Every tree level scans the rows, so they are cached for the
    fit; a lost executor recomputes its blocks from the plan.
    """
    p = dict(schemas.FOREST_PARAMS)
    p.update(params or {})
    by = ["label", "at", *([key] if key else [])]
    place = train.select(*by[2:], "label", "coordinate", vector_to_array("coordinate").alias("at"))
    parts = partitions or forest_partitions(train.count())
    # Rows of one label and place are the same to the forest, whatever their key.
    rows_ = place.repartition(parts, *by).sortWithinPartitions("label", "at").select("label", "coordinate")
    data = _label_with_classes(rows_, num_classes).cache()
    try:
        forest = RandomForestClassifier(labelCol="label", featuresCol="coordinate", **p)
        return forest.fit(data)
    finally:
        data.unpersist()


def predict(model: RandomForestClassificationModel, df: DataFrame,
            keep: Sequence[str] = ()) -> DataFrame:
    """``(*keep, label, prediction)`` for the rows of ``df`` (without
    ``label`` when ``df`` has none). Scoring is a narrow map: no shuffle."""
    label = ["label"] if "label" in df.columns else []
    return model.transform(df).select(*keep, *label, "prediction")


def fit_regions(places_text: DataFrame, labels: DataFrame, key: str,
                    country: str = schemas.DEFAULT_COUNTRY, train_fraction: float = 0.8,
                    params: dict | None = None, num_classes: int | None = None,
                    split_method: str = "hash", unknown: str = "drop"
                    ) -> tuple[RandomForestClassificationModel, DataFrame]:
    """Prepare, encode, split, train and score: returns the model and the
    test predictions ``(key, label, prediction)``.

    ``num_classes`` defaults to the dictionary's highest class number + 1.
    ``unknown`` as in ``encode_regions``, ``split_method`` as in
    ``split_by_key``.
    """
    if num_classes is None:
        num_classes = int(labels.agg(F.max("label")).first()[0]) + 1
    encoded = assemble_coordinate(encode_regions(prepare_places(places_text, country), labels, unknown))
    train, test = split_by_key(encoded, key, train_fraction, method=split_method)
    model = train_region_model(train, num_classes, params, key=key)
    return model, predict(model, test, keep=[key])
