"""Range lookups and request checks."""

import contextlib
import io

import pytest

from conftest import no_broadcast, rows
from tracelake.operators import (
    lookup_batch,
    lookup_itineraries,
    lookup_one,
    rejected_requests,
    validate_requests,
)
from tracelake.sources import key_range, read_table, write_table

DAILY = [
    ("13800000001", "2024-01-04", "Alpha"),
    ("13800000001", "2024-01-05", "Alpha,Beta"),
    ("13800000001", "2024-01-06", "null"),
    ("13800000001", "2024-01-07", "Gamma"),
    ("13800000002", "2024-01-05", "Beta"),
]


@pytest.fixture()
def daily(spark):
    return spark.createDataFrame(DAILY, "phone string, day string, itinerary string")


def req(spark, data):
    return spark.createDataFrame(data, "request_id long, phone string, start string, end string")


def by_id(df):
    return {r.request_id: r for r in df.collect()}


def test_validate_shapes(spark):
    got = by_id(validate_requests(req(spark, [
        (1, "13800000001", "2024-01-05", "2024-01-06"),
        (2, "138000000011", "2024-01-05", "2024-01-06"),    # 12 digits
        (3, "13800000001", "2024-1-5", "2024-01-06"),       # short date
        (4, "13800000001", "2022-99-99", "2024-01-06"),     # shape ok, not a date
        (5, " 13800000001\t", " 2024-01-05", "2024-01-06 "),  # blanks around
        (6, "13800000001\n", "2024-01-05", "2024-01-06"),   # trailing newline is trimmed
        (7, "1380000000a", "2024-01-05", "2024-01-06"),
        (8, None, "2024-01-05", "2024-01-06"),
        (9, "13800000001", "2024-01-07", "2024-01-05"),     # start after end
    ])))
    assert got[1].valid and got[1].calendar_ok and got[1].ordered
    assert not got[2].phone_ok and not got[2].valid
    assert not got[3].start_ok and not got[3].valid
    assert got[4].start_ok and got[4].valid and not got[4].calendar_ok
    assert got[5].valid and got[5].phone == "13800000001" and got[5].start == "2024-01-05"
    assert got[6].valid
    assert not got[7].valid and not got[8].valid
    assert got[9].valid and not got[9].ordered


def test_newline_inside_is_rejected(spark):
    got = by_id(validate_requests(req(spark, [(1, "13800000001\n1", "2024-01-05", "2024-01-06")])))
    assert not got[1].phone_ok


def test_lookup_city_level_inclusive(spark, daily):
    got = by_id(lookup_itineraries(daily, req(spark, [
        (1, "13800000001", "2024-01-05", "2024-01-06"),
        (2, "13800000001", "2024-01-04", "2024-01-07"),
        (3, "13800000001", "2024-01-08", "2024-01-09"),   # nothing there
        (4, "13800000001", "2024-01-07", "2024-01-05"),   # start after end
        (5, "13900000000", "2024-01-01", "2024-12-31"),   # unknown phone
    ])))
    assert got[1].visited == "Alpha,Beta,null" and got[1].n_visited == 3 and got[1].found
    assert got[2].visited == "Alpha,Beta,Gamma,null"
    for i in (3, 4, 5):
        assert got[i].visited == "" and got[i].n_visited == 0 and not got[i].found


def test_lookup_day_text_level(spark, daily):
    got = by_id(lookup_itineraries(daily, req(spark, [(1, "13800000001", "2024-01-04", "2024-01-05")]),
                                   level="day_text"))
    # The set is over whole daily texts: "Alpha" and "Alpha,Beta".
    assert got[1].visited == "Alpha,Alpha,Beta" and got[1].n_visited == 2


def test_batch_rejects_without_lookup(spark, daily):
    r = req(spark, [
        (1, "13800000001", "2024-01-05", "2024-01-05"),
        (2, "1380000000", "2024-01-05", "2024-01-05"),
        (3, "13800000001", "2024-99-99", "2024-99-99"),
    ])
    got = by_id(lookup_batch(daily, r))
    assert got[1].found and got[1].visited == "Alpha,Beta"
    assert not got[2].valid and not got[2].found and got[2].visited == ""
    assert got[3].valid and not got[3].found
    strict = by_id(lookup_batch(daily, r, strict=True))
    assert strict[3].valid and not strict[3].found
    assert sorted(x.request_id for x in rejected_requests(r, strict=True).collect()) == [2, 3]


def test_batch_broadcast_and_shuffled_agree(spark, daily):
    r = req(spark, [(i, "13800000001", f"2024-01-0{i}", "2024-01-07") for i in range(1, 8)])
    base = rows(lookup_batch(daily, r))
    with no_broadcast(spark):
        assert rows(lookup_batch(daily, r)) == base


def test_city_with_a_comma_is_one_city(spark):
    daily = spark.createDataFrame([("13800000001", "2024-01-05", "Oslo,Paris, FR", ["Oslo", "Paris, FR"])],
                                  "phone string, day string, itinerary string, cities array<string>")
    one = by_id(lookup_batch(daily, req(spark, [(1, "13800000001", "2024-01-01", "2024-01-09")])))[1]
    assert (one.visited, one.n_visited) == ("Oslo,Paris, FR", 2)
    single = lookup_one(daily, "13800000001", "2024-01-01", "2024-01-09").first()
    assert (single.visited, single.n_visited) == ("Oslo,Paris, FR", 2)
    text = by_id(lookup_batch(daily, req(spark, [(1, "13800000001", "2024-01-01", "2024-01-09")]), level="day_text"))[1]
    assert (text.visited, text.n_visited) == ("Oslo,Paris, FR", 1)


def test_text_request_ids_stay_apart(spark, daily):
    r = spark.createDataFrame([("A1", "13800000001", "2024-01-05", "2024-01-05"), ("A2", "13800000001", "2024-01-05", "2024-01-05")],
                              "request_id string, phone string, start string, end string")
    assert sorted(x.request_id for x in lookup_batch(daily, r).collect()) == ["A1", "A2"]


def test_lookup_one_matches_batch(spark, daily):
    one = lookup_one(daily, "13800000001", "2024-01-05", "2024-01-07").collect()[0]
    assert (one.visited, one.n_visited, one.found) == ("Alpha,Beta,Gamma,null", 4, True)
    none = lookup_one(daily, "13800000001", "2024-02-01", "2024-02-02").collect()[0]
    assert (none.visited, none.found) == ("", False)


def test_table_round_trip_and_pushdown(spark, daily, tmp_path):
    path = str(tmp_path / "daily")
    write_table(daily, path, ["phone", "day"], num_partitions=2)
    back = read_table(spark, path)
    assert rows(back) == rows(daily)
    # Overwrite replaces the table in one step.
    write_table(daily.where("phone = '13800000002'"), path, ["phone", "day"])
    assert read_table(spark, path).count() == 1
    write_table(daily, path, ["phone", "day"])
    q = key_range(read_table(spark, path), "13800000001", "2024-01-05", "2024-01-06")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    plan = buf.getvalue()
    assert "PushedFilters" in plan and "EqualTo(phone,13800000001)" in plan
    assert rows(q, "day") == [("2024-01-05",), ("2024-01-06",)]
    # Each file is sorted by the key.
    files = spark.read.parquet(path).inputFiles()
    for f in files:
        keys = [(r.phone, r.day) for r in spark.read.parquet(f).collect()]
        assert keys == sorted(keys)
