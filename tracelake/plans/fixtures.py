"""Derived inputs built from the driver's parquet tables.

The original jobs read phone logs, a tower directory and a places file; the
test data are TPC-H-like tables. These functions derive inputs of the same
shapes — with the same awkward cases (unknown towers, towers with two
cities, colliding concatenated keys, short lines, quoted fields, spoilt
requests) — from those tables with DataFrame code, so every query reads the
given tables and its work grows with them. The oracle SQL derives the same
tables independently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake import schemas
from tracelake.functions.text import java_split
from tracelake.sources.shared import fresh_path

# The columns of the test tables that the fixtures read, with their types.
# An explicit schema means no inference job per read, and only these
# columns are ever read.
TABLE_SCHEMAS = {
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


# Fixed values of the fixture rules (shared with the oracle SQL).
LAC_MOD = 31
CELL_MUL = 3
CELL_MOD = 53
UNKNOWN_SUPPLIER_MOD = 17
SECOND_CITY_MOD = 13
EVENT_TOWER_MOD = 103


def _lac(k: Column) -> Column:
    return (k % LAC_MOD).cast("string")


def _cell(k: Column) -> Column:
    return ((k * CELL_MUL) % CELL_MOD).cast("string")


def _phone(custkey: Column) -> Column:
    return F.concat(F.lit("1"), F.lpad(custkey.cast("string"), 10, "0"))


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
            .where(F.col("s_suppkey") % UNKNOWN_SUPPLIER_MOD != 0)
            .select(F.col("s_suppkey").alias("k"), F.col("n_nationkey").alias("nk"),
                    F.col("n_name").alias("city")))


def towers_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tower directory rows with the supplier key ``k`` and ``second`` flag."""
    sup = _suppliers(spark, sf_dir)
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nk2"),
                                                   F.col("n_name").alias("city2"))
    first = sup.select("k", F.lit(False).alias("second"), _lac(F.col("k")).alias("lac"),
                       _cell(F.col("k")).alias("cell"), "city")
    second = (sup.where(F.col("k") % SECOND_CITY_MOD == 0)
              .join(nation, (F.col("nk") + 1) % 25 == F.col("nk2"))
              .select("k", F.lit(True).alias("second"), _lac(F.col("k")).alias("lac"),
                      _cell(F.col("k")).alias("cell"), F.col("city2").alias("city")))
    return first.unionByName(second)


def towers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed tower directory ``(lac, cell, city)``."""
    return towers_keyed(spark, sf_dir).select("lac", "cell", "city")


# Parts at least that line items and orders are dealt into by the order: a task
# that joins them also holds the first reduction of the logs, several times what
# it reads, so adaptive execution, which sees what is read, must not merge parts.
PARTS = 200


def trace_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log per line item: the order's customer seen at the supplier's tower."""
    parts = max(PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate").repartition(parts, "l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").repartition(parts, "o_orderkey")
    return (lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
            .select(_lac(F.col("l_suppkey")).alias("lac"), _cell(F.col("l_suppkey")).alias("cell"),
                    _phone(F.col("o_custkey")).alias("phone"),
                    F.col("l_shipdate").cast("string").alias("ts")))


def _event_towers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    k = F.col("event_id") % EVENT_TOWER_MOD
    return ev.select("event_id", "user_id", "event_type", _lac(k).alias("lac"),
                     _cell(k).alias("cell"), _phone(F.col("user_id")).alias("phone"),
                     F.col("ts").cast("string").alias("ts"))


def event_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs from the event stream: many sightings per phone and day."""
    return _event_towers(spark, sf_dir).select("lac", "cell", "phone", "ts")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log text, one line per event, with rule-based spoilt lines.

    event_id % 11 == 0: only four fields; % 13 == 0: timestamp and type
    empty (trailing empties, so four fields); % 17 == 0: empty phone;
    % 19 == 0: three fields; % 23 == 0: empty timestamp followed by a type.
    """
    e = _event_towers(spark, sf_dir)
    i = F.col("event_id")
    id_ = i.cast("string")
    value = (F.when(i % 11 == 0, F.concat_ws(",", id_, "lac", "cell", "phone"))
             .when(i % 13 == 0, F.concat_ws(",", id_, "lac", "cell", "phone", F.lit(""), F.lit("")))
             .when(i % 17 == 0, F.concat_ws(",", id_, "lac", "cell", F.lit(""), "ts", "event_type"))
             .when(i % 19 == 0, F.concat_ws(",", id_, "lac", "cell"))
             .when(i % 23 == 0, F.concat_ws(",", id_, "lac", "cell", "phone", F.lit(""), "event_type"))
             .otherwise(F.concat_ws(",", id_, "lac", "cell", "phone", "ts", "event_type")))
    return e.select(value.alias("value"))


def cell_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tower directory text (no header line): see ``cell_lines_keyed``."""
    return cell_lines_keyed(spark, sf_dir).select("value")


def cell_lines_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(k, second, value)``: raw tower directory lines, 14 fields when whole.

    k % 7 == 0: city empty and last (trailing empties: 12 fields, dropped);
    k % 11 == 0: a quoted comma in field 5 shifts the city position;
    k % 5 == 0: city in double quotes; second-city rows get a blank field 13.
    """
    t = towers_keyed(spark, sf_dir)
    k = F.col("k")
    ks = k.cast("string")
    fill = [F.concat(F.lit("f"), F.lit(str(j))) for j in range(4, 12)]
    fill_quoted = [fill[0], F.lit('"x,y"')] + fill[2:]
    city = F.when(k % 5 == 0, F.concat(F.lit('"'), "city", F.lit('"'))).otherwise(F.col("city"))
    tail = F.when(F.col("second"), F.lit("")).otherwise(F.lit("z"))
    value = (F.when(k % 7 == 0, F.concat_ws(",", ks, F.lit("t"), "lac", "cell", *fill, F.lit("")))
             .when(k % 11 == 0, F.concat_ws(",", ks, F.lit("t"), "lac", "cell", *fill_quoted, city, tail))
             .otherwise(F.concat_ws(",", ks, F.lit("t"), "lac", "cell", *fill, city, tail)))
    return t.select("k", "second", value.alias("value"))


# Fixed value: the header line of the tower directory files.
CELL_HEADER = "id,t,LAC,CELL,f4,f5,f6,f7,f8,f9,f10,f11,CITY,extra"
# Files that a fixture directory has at most.
FILES = 4


def _in_files(df: DataFrame, *order: str) -> DataFrame:
    """Rows in ``order``, over several files whose names ascend with it."""
    return df.repartitionByRange(FILES, *order).sortWithinPartitions(*order)


def write_cell_files(spark: SparkSession, sf_dir: str, whole_only: bool = False) -> str:
    """A directory of tower files, each with its header line, lines in order of (k, second).

    ``whole_only``: without the lines that have too few fields.
    """
    path = fresh_path(spark, "cell-files")
    lines = cell_lines_keyed(spark, sf_dir)
    if whole_only:
        lines = lines.where(F.size(java_split("value")) > max(schemas.CELL_FIELDS.values()))
    # A CSV of one column, never quoted, whose name is the header line.
    (_in_files(lines, "k", "second").select(F.col("value").alias(CELL_HEADER))
     .write.option("header", True).option("sep", "\x01").option("quote", "").option("emptyValue", "").csv(path))
    return path


def write_log_files(spark: SparkSession, sf_dir: str, whole_only: bool = False) -> str:
    """A directory of log files; ``whole_only``: without the lines of three fields."""
    path = fresh_path(spark, "log-files")
    lines = log_lines(spark, sf_dir)
    if whole_only:
        lines = lines.where(F.size(java_split("value")) > schemas.LOG_FIELDS["phone"])
    lines.repartition(FILES).write.text(path)
    return path


def write_place_files(spark: SparkSession, sf_dir: str) -> list[str]:
    """Two directories of places CSV files whose columns stand in different orders; a note holds commas and quotes."""
    note = F.concat(F.lit('see "'), "c_custkey", F.lit('", west, 2nd floor'))
    rows = places_text(spark, sf_dir).select(F.col("c_custkey").alias("ID"), F.col("lng").alias("LNG"), F.col("lat").alias("LAT"),
                                             F.col("region").alias("REGION"), F.col("country").alias("COUNTRY"), note.alias("NOTE"))
    orders = [["ID", "LNG", "LAT", "REGION", "COUNTRY", "NOTE"], ["NOTE", "COUNTRY", "REGION", "LAT", "ID", "LNG"]]
    paths = []
    for i, columns in enumerate(orders):
        paths.append(fresh_path(spark, f"place-files-{i}"))
        rows.where(F.col("ID") % len(orders) == i).select(*columns).repartition(FILES // 2).write.option("header", True).csv(paths[-1])
    return paths


def places_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places as text, keyed by ``c_custkey``: 25 learnable regions.

    c_custkey % 11 == 0: malformed longitude; % 13 == 0: no region;
    % 10 == 0: another country.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    lng = (F.lit(73.0) + (F.col("c_nationkey") % 5) * F.lit(12.0) + F.col("c_acctbal") / F.lit(2000.0))
    lat = (F.lit(18.0) + F.floor(F.col("c_nationkey") / F.lit(5.0)) * F.lit(7.0)
           + (F.col("c_custkey") % 7).cast("double"))
    lng_text = lng.cast("double").cast("string")
    key = F.col("c_custkey")
    return j.select(
        "c_custkey",
        F.when(key % 11 == 0, F.concat(F.lit("~"), lng_text)).otherwise(lng_text).alias("lng"),
        lat.cast("double").cast("string").alias("lat"),
        F.when(key % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("region"),
        F.when(key % 10 == 0, F.lit("other")).otherwise(F.lit("home")).alias("country"),
    )


# Fixed value: the phone of the single lookup (user 7 of the event logs).
ONE_PHONE = "10000000007"
# Fixed value: the country the places fixture keeps.
FIXTURE_COUNTRY = "home"


def region_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture's label dictionary: nation name → nation key as double."""
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("region"),
                                                 F.col("n_nationkey").cast("double").alias("label"))


def band_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary whose classes are bands of latitude that do not overlap, so a forest can learn them without error."""
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("region"),
                                                 F.floor(F.col("n_nationkey") / 5).cast("double").alias("label"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lookup request per event phone, some of them spoilt.

    user_id % 7: 1 twelve-digit phone, 2 start ``yyyy-M-d``, 3 end
    ``2024-99-99``, 4 start after end, 5 blanks around the phone, 6 a phone
    that is not in the logs; 0 is clean. Ranges vary with the user id.
    """
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    u = F.col("user_id")
    phone = _phone(u)
    d0 = (u % 15) + 1
    d1 = d0 + 3 + (u % 11)
    start = F.concat(F.lit("2024-01-"), F.lpad(d0.cast("string"), 2, "0"))
    end = F.concat(F.lit("2024-01-"), F.lpad(d1.cast("string"), 2, "0"))
    r = u % 7
    return users.select(
        u.alias("request_id"),
        F.when(r == 1, F.concat(phone, F.lit("0")))
         .when(r == 5, F.concat(F.lit(" "), phone, F.lit(" ")))
         .when(r == 6, F.concat(F.lit("2"), F.lpad(u.cast("string"), 10, "0")))
         .otherwise(phone).alias("phone"),
        F.when(r == 2, F.concat(F.lit("2024-1-"), d0.cast("string")))
         .when(r == 4, F.lit("2024-01-20"))
         .otherwise(start).alias("start"),
        F.when(r == 3, F.lit("2024-99-99"))
         .when(r == 4, F.lit("2024-01-10"))
         .otherwise(end).alias("end"),
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(prediction, label) pairs, one per customer, with a predicted class
    (9) that never occurs as a truth. Classes 0-4 from the nation key; the
    prediction is right for about a third of the rows."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return c.select(
        (F.col("c_nationkey") % 5).cast("double").alias("label"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit(9.0))
         .otherwise(((F.col("c_nationkey") + F.col("c_custkey") % 3) % 5).cast("double"))
         .alias("prediction"),
    )
