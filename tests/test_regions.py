"""Region classifier: preparation, encoding, split, forest quality, metrics."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL, rows
from tracelake.operators import (
    accuracy,
    accuracy_of_counts,
    assemble_coordinate,
    confusion_counts,
    confusion_matrix,
    encode_regions,
    prepare_places,
    province_labels,
    fit_regions,
    split_by_key,
    split_flag,
)
from tracelake.plans import fixtures as fx
from tracelake.schemas import PROVINCE_LABELS


def places(spark, data):
    return spark.createDataFrame(data, "id long, lng string, lat string, region string, country string")


def test_prepare_filters_before_casting(spark):
    df = places(spark, [
        (1, "116.4", "39.9", "北京市", "中国"),
        (2, "not a number", "39.9", "北京市", "other"),   # malformed, other country: no failure
        (3, "117.2", "39.1", None, "中国"),               # no region
        (4, "1e2", "x", "天津市", "中国"),                # malformed latitude
        (5, "121.5", "31.2", "上海市", "中国"),
    ])
    got = rows(prepare_places(df), "id", "region", "lng", "lat")
    assert got == [(1, "北京市", 116.4, 39.9), (5, "上海市", 121.5, 31.2)]
    v = assemble_coordinate(prepare_places(df)).collect()
    assert [list(r.coordinate) for r in sorted(v, key=lambda r: r.id)] == [[116.4, 39.9], [121.5, 31.2]]


def test_province_dictionary(spark):
    labels = province_labels(spark)
    assert labels.count() == 31
    assert sorted(r.label for r in labels.collect()) == [float(i) for i in range(31)]
    assert len({name for name, _ in PROVINCE_LABELS}) == 31


def test_encode_unknown_region(spark):
    df = prepare_places(places(spark, [(1, "116.4", "39.9", "北京市", "中国"),
                                       (2, "116.4", "39.9", "Atlantis", "中国")]))
    got = rows(encode_regions(df, province_labels(spark)), "id", "label")
    assert got == [(1, 0.0)]
    with pytest.raises(Exception):
        encode_regions(df, province_labels(spark), unknown="fail").collect()


def test_split_is_stable_under_repartitioning(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    a = rows(df.select("k", split_flag("k").alias("t")))
    b = rows(df.repartition(13).select("k", split_flag("k").alias("t")))
    assert a == b
    train, test = split_by_key(df, "k")
    n_train, n_test = train.count(), test.count()
    assert n_train + n_test == 2000
    assert 0.75 < n_train / 2000 < 0.85


def test_forest_quality_on_learnable_fixture(spark):
    model, pred = fit_regions(fx.places_text(spark, SF_MID), fx.region_labels(spark, SF_MID),
                                  key="c_custkey", country=fx.FIXTURE_COUNTRY)
    assert model.getNumTrees == 100
    assert model.numClasses == 25
    acc = accuracy(pred).collect()[0]
    assert acc.n > 200
    assert acc.accuracy >= 0.9


def test_forest_small_settings_run(spark):
    _, pred = fit_regions(fx.places_text(spark, SF_SMALL), fx.region_labels(spark, SF_SMALL),
                              key="c_custkey", country=fx.FIXTURE_COUNTRY,
                              params={"numTrees": 5}, num_classes=31)
    assert set(pred.columns) == {"c_custkey", "label", "prediction"}
    assert pred.count() > 0


def test_metrics_match_mllib(spark):
    from pyspark.mllib.evaluation import MulticlassMetrics

    pairs = fx.pairs(spark, SF_SMALL)
    metrics = MulticlassMetrics(pairs.select("prediction", "label").rdd.map(tuple))
    dense = metrics.confusionMatrix().toArray()
    labels = sorted({r.label for r in pairs.collect()})
    ours = {(r.label, r.prediction): r.n for r in confusion_matrix(pairs).collect()}
    assert len(ours) == len(labels) ** 2
    for i, a in enumerate(labels):
        for j, b in enumerate(labels):
            assert ours[(a, b)] == dense[i][j]
    acc = accuracy(pairs).collect()[0]
    assert acc.accuracy == pytest.approx(metrics.accuracy)
    # The unseen predicted class 9.0 has no column but still counts as wrong.
    assert 9.0 not in {b for _, b in ours}
    assert acc.n == pairs.count() > 25
    assert 0.0 < acc.accuracy < 1.0


def test_confusion_matrix_zero_cells(spark):
    pairs = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)], "label double, prediction double")
    got = rows(confusion_matrix(pairs))
    assert got == [(0.0, 0.0, 1), (0.0, 1.0, 0), (1.0, 0.0, 1), (1.0, 1.0, 1)]
    assert accuracy(pairs.where(F.lit(False))).collect()[0].n == 0


def test_split_fractions_and_null_keys(spark):
    df = spark.range(0, 20000).selectExpr("case when id % 1000 = 7 then null else id end k")
    for fraction in (0.0, 0.04, 0.75, 0.85, 0.95, 1.0):
        train, test = split_by_key(df, "k", fraction)
        n = train.count()
        assert n + test.count() == 20000
        assert test.where("k is null").count() == 0
        assert abs(n - 20 - fraction * 19980) < 250


def test_confusion_matrix_drops_pairs_without_a_truth(spark):
    pairs = spark.createDataFrame([(0.0, 0.0), (None, 0.0), (1.0, None)], "label double, prediction double")
    assert rows(confusion_matrix(pairs)) == [(0.0, 0.0, 1), (0.0, 1.0, 0), (1.0, 0.0, 0), (1.0, 1.0, 0)]
    counts = confusion_counts(pairs)
    assert counts.agg(F.sum("n")).first()[0] == 3
    a, b = accuracy(pairs).first(), accuracy_of_counts(counts).first()
    assert (a.n, a.accuracy) == (b.n, pytest.approx(b.accuracy))


def test_forest_does_not_depend_on_how_the_rows_arrive(spark):
    from tracelake.operators import predict, train_region_model

    df = assemble_coordinate(encode_regions(
        prepare_places(fx.places_text(spark, SF_SMALL), "home"), fx.region_labels(spark, SF_SMALL)))
    first = train_region_model(df.repartition(2), 25, {"numTrees": 5})
    second = train_region_model(df.repartition(7), 25, {"numTrees": 5})
    assert first.toDebugString.split("\n", 1)[1] == second.toDebugString.split("\n", 1)[1]
    assert rows(predict(first, df, ["c_custkey"])) == rows(predict(second, df, ["c_custkey"]))


def test_random_split_option(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    train, test = split_by_key(df, "k", method="random", seed=42)
    assert train.count() + test.count() == 1000
    assert set(r.k for r in train.collect()).isdisjoint(r.k for r in test.collect())
    with pytest.raises(ValueError):
        split_by_key(df, "k", method="bogus")


def test_predict_unlabeled_rows(spark):
    from tracelake.operators import predict, train_region_model

    df = assemble_coordinate(encode_regions(
        prepare_places(fx.places_text(spark, SF_SMALL), "home"), fx.region_labels(spark, SF_SMALL)))
    model = train_region_model(df, 25, {"numTrees": 3})
    out = predict(model, df.drop("label"), keep=["c_custkey"])
    assert out.columns == ["c_custkey", "prediction"]
    assert out.count() == df.count()


def test_confusion_matrix_cells_are_made_by_label(spark):
    pairs = spark.createDataFrame([(float(i), float(i)) for i in range(40)], "label double, prediction double")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        cells = confusion_matrix(pairs).select("n", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert (len(cells), sum(r["n"] for r in cells)) == (1600, 40)
    assert len({r["task"] for r in cells}) > 1


def test_parts_of_the_forest_grow_with_the_rows():
    from tracelake.operators import forest_partitions

    assert [forest_partitions(n) for n in (0, 1000, 1 << 24, (1 << 24) + 1, 1 << 30)] == [16, 16, 16, 32, 1024]


def test_equal_places_are_dealt_by_key(spark, monkeypatch):
    """Rows of one place do not all go to one part, and the forest does not depend on how they arrive."""
    from pyspark.ml.classification import RandomForestClassifier

    from tracelake.operators import train_region_model

    sizes, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, data: sizes.append(
        [r[0] for r in data.groupBy(F.spark_partition_id()).count().select("count").collect()]) or fit(self, data))
    df = spark.range(4000).selectExpr("id k", "cast(id % 4 = 0 as double) label",
                                      "if(id % 4 = 0, cast(id as double), 1.0d) lng", "2.0d lat")
    places = assemble_coordinate(df)
    first = train_region_model(places.repartition(3), 2, {"numTrees": 3}, key="k")
    second = train_region_model(places.repartition(9), 2, {"numTrees": 3}, key="k")
    assert max(sizes[0]) < 500 and sorted(sizes[0]) == sorted(sizes[1])
    assert first.toDebugString.split("\n", 1)[1] == second.toDebugString.split("\n", 1)[1]
