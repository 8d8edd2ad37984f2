"""Itinerary operators: one golden case per decision, plus metamorphic checks."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, no_broadcast, rows
from tracelake.operators import (
    cell_dimension,
    daily_itineraries,
    distinct_pairs,
    itineraries,
)
from tracelake.plans import fixtures as fx

LOGS = [
    # lac, cell, phone, ts
    ("1", "17", "p1", "2024-01-05 10:00:00"),
    ("11", "7", "p1", "2024-01-05 11:00:00"),
    ("5", "5", "p1", "2024-01-06 09:00:00"),   # unknown tower
    ("2", "2", "p2", "2024-01-05 08:00:00"),   # tower with two cities
    ("9", "9", "p3", "2024-01-07 08:00:00"),   # only an unknown tower
    ("3", "3", "p4", "2024-01-07 08:00:00"),
    ("4", "4", "p4", "2024-01-07 09:00:00"),
    ("6", "6", "p4", "2024-01-08 09:00:00"),
]
CELLS = [
    ("1", "17", "Alpha"),
    ("11", "7", "Beta"),
    ("2", "2", "Gamma"),
    ("2", "2", "Delta"),
    ("3", "3", '"Quoted"'),
    ("4", "4", '"Quoted'),
    ("6", "6", "x"),
]


@pytest.fixture()
def logs(spark):
    return spark.createDataFrame(LOGS, "lac string, cell string, phone string, ts string")


@pytest.fixture()
def cells(spark):
    return spark.createDataFrame(CELLS, "lac string, cell string, city string")


def as_dict(df, *keys):
    return {tuple(getattr(r, k) for k in keys) if len(keys) > 1 else getattr(r, keys[0]): r.itinerary
            for r in df.collect()}


def test_default_inner_all_cities_sorted(logs, cells):
    got = as_dict(itineraries(logs, cells), "phone")
    assert got == {"p1": "Alpha,Beta", "p2": "Delta,Gamma", "p4": '"Quoted,Quoted,x'}


def test_unknown_tower_as_null_text(logs, cells):
    got = as_dict(itineraries(logs, cells, unmatched="null_text"), "phone")
    assert got["p1"] == "Alpha,Beta,null"
    assert got["p3"] == "null"


def test_one_city_per_tower_is_deterministic(logs, cells):
    got = as_dict(itineraries(logs, cells, cells_mode="one"), "phone")
    assert got["p2"] == "Gamma"
    dim = dict(((r.lac, r.cell), r.city) for r in cell_dimension(cells).collect())
    assert dim[("2", "2")] == "Gamma"


def test_concat_key_collides(logs, cells):
    got = as_dict(itineraries(logs, cells, key="concat"), "phone")
    # (1,17) and (11,7) are both "117": each log gets both cities.
    assert got["p1"] == "Alpha,Beta"
    pairs = rows(distinct_pairs(logs, cells, key="concat").where("phone = 'p1'"))
    assert pairs == [("p1", "Alpha"), ("p1", "Beta")]
    # Column key: the same logs see one city each.
    one = logs.where("phone = 'p1' and lac = '1'")
    assert as_dict(itineraries(one, cells), "phone") == {"p1": "Alpha"}
    assert as_dict(itineraries(one, cells, key="concat"), "phone") == {"p1": "Alpha,Beta"}


def test_strip_modes(logs, cells):
    none = as_dict(itineraries(logs, cells, strip="none"), "phone")
    assert none["p4"] == '"Quoted,"Quoted",x'
    ends = as_dict(itineraries(logs, cells, strip="ends"), "phone")
    # x (length 1) becomes "", "Quoted" and "Quoted lose their ends.
    assert ends["p4"] == ",Quote,Quoted"
    with pytest.raises(ValueError):
        itineraries(logs, cells, strip="bogus")


def test_dedupe_raw_keeps_texts_that_clean_alike(spark):
    logs = spark.createDataFrame([("1", "1", "p", "t"), ("2", "2", "p", "t")],
                                 "lac string, cell string, phone string, ts string")
    cells = spark.createDataFrame([("1", "1", "[Ab]"), ("2", "2", "(Ab)")],
                                  "lac string, cell string, city string")
    raw = as_dict(itineraries(logs, cells, strip="ends", dedupe="raw"), "phone")
    cleaned = as_dict(itineraries(logs, cells, strip="ends"), "phone")
    assert raw == {"p": "Ab,Ab"}
    assert cleaned == {"p": "Ab"}


def test_city_of_length_0_1_2(spark):
    logs = spark.createDataFrame([(str(i), "0", "p", "t") for i in range(4)],
                                 "lac string, cell string, phone string, ts string")
    cells = spark.createDataFrame([("0", "0", '"ab"'), ("1", "0", "ab"), ("2", "0", "a"), ("3", "0", "")],
                                  "lac string, cell string, city string")
    got = rows(distinct_pairs(logs, cells, strip="quotes"), "city")
    assert got == [("",), ("a",), ("ab",)]
    # '"ab"' (4 characters) loses its quotes; "ab", "a" and "" all become "".
    got = rows(distinct_pairs(logs, cells, strip="ends"), "city")
    assert got == [("",), ("ab",)]


def test_daily(logs, cells):
    got = as_dict(daily_itineraries(logs, cells), "phone", "day")
    assert got[("p1", "2024-01-05")] == "Alpha,Beta"
    assert got[("p1", "2024-01-06")] == "null"
    assert got[("p2", "2024-01-05")] == "Gamma"
    assert got[("p4", "2024-01-07")] == '"Quoted,Quoted'


def test_shuffled_join_equals_broadcast_join(spark, logs, cells):
    a, b = rows(itineraries(logs, cells)), rows(daily_itineraries(logs, cells))
    with no_broadcast(spark):
        assert rows(itineraries(logs, cells)) == a
        assert rows(daily_itineraries(logs, cells)) == b


# Metamorphic checks on the derived fixtures.

@pytest.fixture(scope="module")
def trace(spark):
    return fx.trace_logs(spark, SF_SMALL), fx.towers(spark, SF_SMALL)


def test_concat_equals_columns_without_collisions(trace):
    logs, towers = trace
    # sf0.001 has no colliding tower keys.
    assert rows(itineraries(logs, towers, key="concat")) == rows(itineraries(logs, towers))


def test_null_text_minus_null_equals_drop(trace):
    logs, towers = trace
    left = itineraries(logs, towers, unmatched="null_text", cells_mode="one")
    inner = itineraries(logs, towers, cells_mode="one")
    stripped = (left.select("phone", F.array_join(F.array_remove(F.split("itinerary", ","), "null"), ",")
                            .alias("itinerary"))
                .where("itinerary <> ''"))
    assert rows(stripped) == rows(inner)


def test_union_of_daily_sets_equals_overall(trace):
    logs, towers = trace
    daily = daily_itineraries(logs, towers, unmatched="drop", cells_mode="all")
    union = (daily.select("phone", F.explode(F.split("itinerary", ",")).alias("c")).distinct()
             .groupBy("phone").agg(F.array_join(F.array_sort(F.collect_list("c")), ",").alias("itinerary")))
    assert rows(union) == rows(itineraries(logs, towers))


def test_repartitioning_changes_nothing(trace):
    logs, towers = trace
    base = rows(itineraries(logs, towers))
    assert rows(itineraries(logs.repartition(7, "ts"), towers.repartition(3))) == base
    assert rows(itineraries(logs.coalesce(1), towers)) == base


def test_text_keys(spark):
    from tracelake.functions import phone_day_key, tower_key
    df = spark.createDataFrame([("1", "17", "13800000001", "2024-01-05")],
                               "lac string, cell string, phone string, day string")
    r = df.select(tower_key().alias("t"), phone_day_key().alias("k")).first()
    assert (r.t, r.k) == ("1:17", "13800000001_2024-01-05")


def test_with_cities_array(logs, cells):
    df = itineraries(logs, cells, unmatched="null_text", with_cities=True)
    assert df.columns == ["phone", "itinerary", "cities"]
    got = {r.phone: (r.itinerary, list(r.cities)) for r in df.collect()}
    assert got["p1"] == ("Alpha,Beta,null", ["Alpha", "Beta", "null"])
    daily = daily_itineraries(logs, cells, with_cities=True)
    assert all(r.itinerary == ",".join(r.cities) for r in daily.collect())


@pytest.mark.parametrize("key", ["columns", "concat"])
@pytest.mark.parametrize("unmatched", ["drop", "null_text"])
@pytest.mark.parametrize("daily", [False, True])
def test_towers_with_many_cities(spark, key, unmatched, daily):
    # Nulls, repeated rows, unknown towers and up to nine cities per tower.
    seen = [(None if i % 19 == 0 else str(i % 7), str(i % 5), None if i % 23 == 0 else f"p{i % 11}", f"2024-01-0{i % 3 + 1} 10:00:00")
            for i in range(300)] * 2
    towers = [(str(i % 6), None if i % 13 == 0 else str(i % 4), None if i % 17 == 0 else f"C{i % 9}") for i in range(200)] * 2
    glued = (lambda lac, cell: lac + cell) if key == "concat" else (lambda lac, cell: (lac, cell))
    cities, want = {}, {}
    for lac, cell, city in towers:
        if None not in (lac, cell, city):
            cities.setdefault(glued(lac, cell), set()).add(city)
    for lac, cell, phone, ts in seen:
        found = cities.get(glued(lac, cell), set()) if lac else set()
        if not found and unmatched == "null_text":
            found = {"null"}
        if found:
            want.setdefault((phone, ts[:10]) if daily else (phone,), set()).update(found)
    logs = spark.createDataFrame(seen, "lac string, cell string, phone string, ts string")
    cells = spark.createDataFrame(towers, "lac string, cell string, city string")
    make = daily_itineraries if daily else itineraries
    got = make(logs, cells, key=key, unmatched=unmatched, cells_mode="all")
    assert {tuple(r)[:-1]: r.itinerary for r in got.collect()} == {k: ",".join(sorted(v)) for k, v in want.items()}
    assert got.count() == len(want)
