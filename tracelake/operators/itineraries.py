"""Itineraries: the set of cities each phone (or phone and day) was seen in.

Plan shape, the same at every size:

* the logs are reduced to distinct (keys, tower) rows first, by a map-side
  partial aggregate; the tower side is deduplicated;
* the join is left to Spark: a small tower side is broadcast, by its file
  size when planned or by its real size once it is computed (the logs' own
  reduction takes longer, so that is known before they move); a larger one
  is shuffled, and adaptive execution splits a hot tower;
* where a tower may have many cities, the join adds them to a log as one
  array; the rows are dealt by their keys and only then is a row made of each
  city. The duplicates of a key so meet in one task before they are moved, and
  a task's share does not grow with the number of cities of its towers:
  overall itineraries are cut by the size of the arrays, a hot phone too; daily
  ones go to a fixed number of parts, where they are gathered without being
  moved again (a key has one row per tower there, wherever its logs were);
* duplicates are removed by a distinct on (keys, city) and only then are the
  cities of a key gathered, so a phone seen a billion times gathers one row
  per distinct city, wherever its logs were.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.text import ITINERARY_SEP, NULL_CITY, clean_city, sorted_join
from tracelake.operators.cells import tower_cities
from tracelake.sources.logs import with_day

KEYS = ("columns", "concat")
UNMATCHED = ("drop", "null_text")
DEDUPE = ("cleaned", "raw")
# Parts at least that the rows of daily itineraries are dealt into by their
# keys: a row becomes as many as its tower has cities only after that, so
# adaptive execution, which sees the rows before, must not merge them.
PARTS = 200


def _check(name: str, value: str, allowed: Sequence[str]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {tuple(allowed)}, got {value!r}")


def _city_sets(dim: DataFrame, on: list[str]) -> DataFrame:
    """Rows ``(*on, city)`` → one row per tower with the array ``cities``."""
    # Grouped by the key as one value, as in tower_cities.
    return (dim.groupBy(F.struct(*on).alias("at")).agg(F.collect_set("city").alias("cities"))
            .select(*[F.col(f"at.{c}").alias(c) for c in on], "cities"))


def city_visits(logs: DataFrame, cells: DataFrame, group_keys: Sequence[str] = ("phone",),
                key: str = "columns", unmatched: str = "drop", cells_mode: str = "all",
                strip: str = "quotes", clean: bool = True, spread: bool = True) -> DataFrame:
    """Logs joined to the tower directory → ``(*group_keys, city)`` rows.

    ``key``: ``"columns"`` matches towers on (lac, cell); ``"concat"``
    matches on the two texts glued together, so (1, 17) and (11, 7) are the
    same tower — the behaviour of the RDD job.
    ``unmatched``: ``"drop"`` (inner join) or ``"null_text"`` (left join; a
    tower missing from the directory counts as the city ``null``).
    ``spread``: with all cities of a tower, rows are dealt by a hash of the
    keys that adaptive execution may cut; otherwise by the keys, for a caller
    that groups by them.
    ``cells_mode``: ``"all"`` cities of a tower or ``"one"`` (see
    ``tower_cities``). With ``clean=False`` cities are returned raw and
    ``strip`` is left to the caller.
    """
    _check("key", key, KEYS)
    _check("unmatched", unmatched, UNMATCHED)
    group_keys = list(group_keys)
    dim = tower_cities(cells, cells_mode, strip, clean=clean)
    if key == "concat":
        dim = dim.select(F.concat("lac", "cell").alias("tower"), "city").distinct()
        facts = logs.select(*group_keys, F.concat("lac", "cell").alias("tower"))
        on = ["tower"]
    else:
        facts = logs.select(*group_keys, "lac", "cell")
        on = ["lac", "cell"]
    how = "inner" if unmatched == "drop" else "left"
    if cells_mode == "all":
        sets = facts.distinct().join(_city_sets(dim, on), on, how).select(*group_keys, "cities")
        if spread:
            sets = sets.withColumn("deal", F.xxhash64(*group_keys)).hint("rebalance", "deal")
        else:
            sets = sets.repartition(max(PARTS, int(logs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *group_keys)
        each = F.explode if how == "inner" else F.explode_outer
        joined = sets.select(*group_keys, each("cities").alias("city"))
    else:
        joined = facts.distinct().join(dim, on, how)
    city = F.col("city")
    if unmatched == "null_text" and clean:
        city = F.coalesce(city, F.lit(NULL_CITY))
    return joined.select(*group_keys, city.alias("city"))


def _itineraries(visits: DataFrame, group_keys: list[str], unmatched: str, strip: str,
                 dedupe: str, with_cities: bool = False) -> DataFrame:
    # Distinct (keys, city) first: a codegen'd hash aggregate with a map-side
    # partial step. The per-key list is then built from distinct rows only,
    # so even a key holding a third of all logs reaches its final task as at
    # most one row per distinct city.
    pairs = visits.distinct()
    if dedupe == "raw":
        # Distinct on the raw text, then clean: two raw texts that clean to
        # the same name both stay (RDD job order).
        city = F.when(F.col("city").isNotNull(), clean_city("city", strip))
        if unmatched == "null_text":
            city = F.coalesce(city, F.lit(NULL_CITY))
        pairs = pairs.select(*group_keys, city.alias("city")).where(F.col("city").isNotNull())
    if not with_cities:
        return pairs.groupBy(*group_keys).agg(sorted_join(F.collect_list("city")).alias("itinerary"))
    out = pairs.groupBy(*group_keys).agg(F.sort_array(F.collect_list("city")).alias("cities"))
    return out.select(*group_keys, F.array_join("cities", ITINERARY_SEP).alias("itinerary"), "cities")


def itineraries(logs: DataFrame, cells: DataFrame, key: str = "columns",
                unmatched: str = "drop", cells_mode: str = "all", strip: str = "quotes",
                dedupe: str = "cleaned", with_cities: bool = False) -> DataFrame:
    """``(phone, itinerary)``: the distinct cities of each phone, sorted and
    joined with commas; with ``with_cities`` also the sorted ``cities`` array.

    ``dedupe="cleaned"`` removes duplicates after the city clean-up;
    ``"raw"`` removes them before, as the RDD job did.
    """
    _check("dedupe", dedupe, DEDUPE)
    visits = city_visits(logs, cells, ["phone"], key, unmatched, cells_mode, strip,
                         clean=dedupe == "cleaned")
    return _itineraries(visits, ["phone"], unmatched, strip, dedupe, with_cities)


def daily_itineraries(logs: DataFrame, cells: DataFrame, key: str = "columns",
                      unmatched: str = "null_text", cells_mode: str = "one",
                      strip: str = "quotes", dedupe: str = "cleaned",
                      day_mode: str = "drop", with_cities: bool = False) -> DataFrame:
    """``(phone, day, itinerary)``: cities per phone and calendar day.

    The day is the first ten characters of the timestamp text. Defaults
    follow the daily MapReduce job: unknown towers kept as ``null``, one
    city per tower.
    """
    _check("dedupe", dedupe, DEDUPE)
    dated = with_day(logs, mode=day_mode)
    keys = ["phone", "day"]
    visits = city_visits(dated, cells, keys, key, unmatched, cells_mode, strip,
                         clean=dedupe == "cleaned", spread=False)
    return _itineraries(visits, keys, unmatched, strip, dedupe, with_cities)


def distinct_pairs(logs: DataFrame, cells: DataFrame, key: str = "columns",
                   unmatched: str = "drop", cells_mode: str = "all",
                   strip: str = "quotes") -> DataFrame:
    """Distinct ``(phone, city)`` rows: the itinerary before concatenation."""
    return city_visits(logs, cells, ["phone"], key, unmatched, cells_mode, strip).distinct()
