"""Physical-plan properties the operators are designed for."""

import contextlib
import io
import re

import pytest

from conftest import SF_SMALL, no_broadcast
from tracelake.operators import itineraries, lookup_batch, lookup_one
from tracelake.plans import fixtures as fx
from tracelake.plans.catalog import MODEL_QUERIES, QUERIES, STORED_QUERIES
from tracelake.sources import read_table, write_table


def plan(df, mode=None):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode) if mode else df.explain()
    return buf.getvalue()


def test_small_directory_is_broadcast_once_its_size_is_known(spark):
    df = itineraries(fx.trace_logs(spark, SF_SMALL), fx.towers(spark, SF_SMALL))
    df.collect()
    p = plan(df).split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in p
    assert "BroadcastHashJoin [lac" in p and "SortMergeJoin [lac" not in p
    p = plan(itineraries(fx.trace_logs(spark, SF_SMALL), fx.towers(spark, SF_SMALL)))
    # Distinct (phone, city) with a partial aggregate before the exchange,
    # then the gather on phone.
    assert re.search(r"HashAggregate\(keys=\[phone#\d+, city#\d+\], functions=\[\]\)\s*\n.*"
                     r"Exchange hashpartitioning\(phone#\d+, city#\d+", p)
    assert "partial_collect_list" in p
    # Only the needed columns are read.
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in p


def test_logs_are_deduplicated_before_the_join(spark):
    with no_broadcast(spark):
        p = plan(itineraries(fx.trace_logs(spark, SF_SMALL), fx.towers(spark, SF_SMALL)))
    assert "BroadcastHashJoin" not in p
    assert "SortMergeJoin" in p
    assert re.search(r"HashAggregate\(keys=\[phone#\d+, lac#\d+, cell#\d+\], functions=\[\]\)", p)


def test_cities_become_rows_where_their_keys_are(spark):
    # The join adds a tower's cities as one array: a log moves once, however
    # many cities its towers have.
    for name, dealt in {"itineraries": r"deal#\d+L, \d+\), REBALANCE_PARTITIONS_BY_COL",
                        "itineraries_distinct_pairs": r"deal#\d+L, \d+\), REBALANCE_PARTITIONS_BY_COL",
                        "itineraries_concat_key": r"deal#\d+L, \d+\), REBALANCE_PARTITIONS_BY_COL",
                        "clean_city_quotes": r"deal#\d+L, \d+\), REBALANCE_PARTITIONS_BY_COL",
                        "clean_city_ends": r"deal#\d+L, \d+\), REBALANCE_PARTITIONS_BY_COL",
                        "daily_itineraries_inner": r"phone#\d+, day#\d+, 200\), REPARTITION_BY_NUM"}.items():
        p = plan(QUERIES[name](spark, SF_SMALL))
        found = re.search(r"Generate explode\(cities#\d+\)[^\n]*\n(?:[^\n]*Project[^\n]*\n)?[^\n]*Exchange hashpartitioning\(" + dealt, p)
        assert found, (name, p)
    # The parts of daily rows are gathered where they are.
    assert "Exchange" not in p[:found.start()]


def test_line_items_meet_their_orders_in_parts_of_their_own(spark):
    # The task that joins them holds the first reduction of the logs too:
    # parts are not merged by what they read.
    for name in ("itineraries", "itineraries_distinct_pairs", "clean_city_quotes", "clean_city_ends",
                 "itineraries_concat_key", "itineraries_left"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        for key in ("l_orderkey", "o_orderkey"):
            assert re.search(rf"Exchange hashpartitioning\({key}#\d+L, 200\), REPARTITION_BY_NUM", p), (name, key)


def test_no_python_in_any_plan(spark):
    for name, fn in QUERIES.items():
        if name in MODEL_QUERIES:
            continue
        p = plan(fn(spark, SF_SMALL))
        assert "EvalPython" not in p and "PythonUDF" not in p, name
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_lookup_joins_on_phone_with_range_residual(spark):
    daily = spark.createDataFrame([("13800000001", "2024-01-05", "A")],
                                  "phone string, day string, itinerary string")
    req = spark.createDataFrame([(1, "13800000001", "2024-01-01", "2024-01-09")],
                                "request_id long, phone string, start string, end string")
    p = plan(lookup_batch(daily, req))
    assert re.search(r"Join \[_day_phone#\d+\], \[phone#\d+\], Inner, (BuildRight, )?"
                     r"\(\(day#\d+ >= start#\d+\) AND \(day#\d+ <= end#\d+\)\)", p)
    # Requests without a hit come from the same aggregate: no join back.
    assert p.count("Join") == 1


def test_lookup_plan_does_not_depend_on_the_number_of_requests(spark, tmp_path):
    daily = spark.createDataFrame([("13800000001", "2024-01-05", "A")],
                                  "phone string, day string, itinerary string")
    shapes = []
    for n in (10, 1000):
        path = str(tmp_path / f"requests{n}")
        spark.range(n).selectExpr("id request_id", "'13800000001' phone", "'2024-01-01' start", "'2024-01-09' end").write.parquet(path)
        p = plan(lookup_batch(daily, spark.read.parquet(path)))
        shapes.append(re.sub(r"requests\d+|#\d+L?|plan_id=\d+|\d+", "", p))
    assert shapes[0] == shapes[1]


def test_building_a_query_starts_no_job(spark):
    sc = spark.sparkContext
    for name, fn in QUERIES.items():
        if name in MODEL_QUERIES + STORED_QUERIES:
            continue
        sc.setJobGroup(f"build {name}", name)
        fn(spark, SF_SMALL)
        # Reading a Parquet file's schema is Spark's own one-task job.
        jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(f"build {name}")]
        stages = [sc.statusTracker().getStageInfo(s) for j in jobs if j for s in j.stageIds]
        assert all(s.numTasks == 1 and "parquet" in s.name for s in stages if s), (name, stages)
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_each_line_is_split_once(spark):
    p = plan(QUERIES["parse_logs"](spark, SF_SMALL), "extended").split("== Physical Plan ==")[1]
    assert p.count("split(") == 1 and "regexp_replace" not in p


def test_single_lookup_pushes_key_range_to_scan(spark, tmp_path):
    daily = spark.createDataFrame([("13800000001", "2024-01-05", "A"), ("13800000002", "2024-01-06", "B")],
                                  "phone string, day string, itinerary string")
    path = str(tmp_path / "daily")
    write_table(daily, path, ["phone", "day"])
    p = plan(lookup_one(read_table(spark, path), "13800000001", "2024-01-01", "2024-01-31"), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*?)\]", p).group(1)
    for f in ("EqualTo(phone,13800000001)", "GreaterThanOrEqual(day,2024-01-01)",
              "LessThanOrEqual(day,2024-01-31)"):
        assert f in pushed


@pytest.mark.parametrize("cells_mode", ["all", "one"])
@pytest.mark.parametrize("unmatched", ["drop", "null_text"])
def test_hot_tower_is_split_by_adaptive_skew_join(spark, cells_mode, unmatched):
    from pyspark.sql import functions as F

    from conftest import rows

    # One tower holds a third of all (distinct) logs.
    logs = spark.range(0, 60000).select(
        F.when(F.col("id") % 3 == 0, F.lit("0")).otherwise((F.col("id") % 997).cast("string")).alias("lac"),
        F.lit("1").alias("cell"),
        F.format_string("1%010d", F.col("id")).alias("phone"),
        F.lit("2024-01-05 10:00:00").alias("ts"))
    cells = spark.range(0, 997).select(F.col("id").cast("string").alias("lac"), F.lit("1").alias("cell"),
                                       F.concat(F.lit("C"), (F.col("id") % 50).cast("string")).alias("city"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = itineraries(logs, cells, cells_mode=cells_mode, unmatched=unmatched)
        got = rows(df)
        final = plan(df)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "isFinalPlan=true" in final
    assert "SortMergeJoin(skew=true)" in final
    assert got == rows(itineraries(logs, cells, cells_mode=cells_mode, unmatched=unmatched))

