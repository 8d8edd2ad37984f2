"""DuckDB SQL for each catalogue query, written independently of the Spark
code, over the same parquet tables (views ``supplier``, ``nation``,
``lineitem``, ``orders``, ``events``, ``customer``).
"""

from __future__ import annotations

# Fixture tables (same rules as tracelake.plans.fixtures).
_SUP = """
sup as (
  select s_suppkey k, n_nationkey nk, n_name city
  from supplier join nation on s_nationkey = n_nationkey
  where s_suppkey % 17 <> 0),
towers_k as (
  select k, false as second, cast(k % 31 as string) lac, cast((k * 3) % 53 as string) cell, city
  from sup
  union all
  select k, true, cast(k % 31 as string), cast((k * 3) % 53 as string), n2.n_name
  from sup join nation n2 on n2.n_nationkey = (nk + 1) % 25
  where k % 13 = 0),
towers as (select lac, cell, city from towers_k)"""

_TRACE = """
trace_logs as (
  select cast(l_suppkey % 31 as string) lac, cast((l_suppkey * 3) % 53 as string) cell,
         concat('1', lpad(cast(o_custkey as string), 10, '0')) phone,
         cast(l_shipdate as string) ts
  from lineitem join orders on l_orderkey = o_orderkey)"""

_EVENTS = """
event_t as (
  select event_id, user_id, event_type,
         cast((event_id % 103) % 31 as string) lac,
         cast(((event_id % 103) * 3) % 53 as string) cell,
         concat('1', lpad(cast(user_id as string), 10, '0')) phone,
         cast(ts as string) ts
  from events),
event_logs as (select lac, cell, phone, ts from event_t)"""

_LOG_LINES = """
log_lines as (
  select case
    when event_id % 11 = 0 then concat_ws(',', cast(event_id as string), lac, cell, phone)
    when event_id % 13 = 0 then concat_ws(',', cast(event_id as string), lac, cell, phone, '', '')
    when event_id % 17 = 0 then concat_ws(',', cast(event_id as string), lac, cell, '', ts, event_type)
    when event_id % 19 = 0 then concat_ws(',', cast(event_id as string), lac, cell)
    when event_id % 23 = 0 then concat_ws(',', cast(event_id as string), lac, cell, phone, '', event_type)
    else concat_ws(',', cast(event_id as string), lac, cell, phone, ts, event_type) end as value
  from event_t)"""

_CELL_LINES = """
cell_src as (
  select k, lac, cell,
         case when k % 5 = 0 then '"' || city || '"' else city end c,
         case when second then '' else 'z' end tail
  from towers_k),
cell_lines as (
  select case
    when k % 7 = 0 then concat_ws(',', cast(k as string), 't', lac, cell,
                                  'f4', 'f5', 'f6', 'f7', 'f8', 'f9', 'f10', 'f11', '')
    when k % 11 = 0 then concat_ws(',', cast(k as string), 't', lac, cell,
                                   'f4', '"x,y"', 'f6', 'f7', 'f8', 'f9', 'f10', 'f11', c, tail)
    else concat_ws(',', cast(k as string), 't', lac, cell,
                   'f4', 'f5', 'f6', 'f7', 'f8', 'f9', 'f10', 'f11', c, tail) end as value
  from cell_src),
cell_parts as (select string_split(regexp_replace(value, ',+$', ''), ',') p from cell_lines),
parsed_cells as (select p[3] lac, p[4] cell, p[13] city from cell_parts where len(p) >= 13)"""

_CELL_LINES_ORDERED = """
ordered_src as (
  select k, second, lac, cell, case when k % 5 = 0 then '"' || city || '"' else city end c,
         case when second then '' else 'z' end tail
  from towers_k),
ordered_lines as (
  select k * 2 + cast(second as int) line_no, case
    when k % 7 = 0 then concat_ws(',', cast(k as string), 't', lac, cell,
                                  'f4', 'f5', 'f6', 'f7', 'f8', 'f9', 'f10', 'f11', '')
    when k % 11 = 0 then concat_ws(',', cast(k as string), 't', lac, cell,
                                   'f4', '"x,y"', 'f6', 'f7', 'f8', 'f9', 'f10', 'f11', c, tail)
    else concat_ws(',', cast(k as string), 't', lac, cell,
                   'f4', 'f5', 'f6', 'f7', 'f8', 'f9', 'f10', 'f11', c, tail) end as value
  from ordered_src),
ordered_cells as (
  select line_no, p[3] lac, p[4] cell, p[13] city
  from (select line_no, string_split(regexp_replace(value, ',+$', ''), ',') p from ordered_lines) where len(p) >= 13)"""

_REQUESTS = """
users as (select distinct user_id from events),
requests as (
  select user_id request_id,
    case user_id % 7
      when 1 then concat('1', lpad(cast(user_id as string), 10, '0'), '0')
      when 5 then concat(' ', '1', lpad(cast(user_id as string), 10, '0'), ' ')
      when 6 then concat('2', lpad(cast(user_id as string), 10, '0'))
      else concat('1', lpad(cast(user_id as string), 10, '0')) end phone,
    case user_id % 7
      when 2 then concat('2024-1-', cast(user_id % 15 + 1 as string))
      when 4 then '2024-01-20'
      else concat('2024-01-', lpad(cast(user_id % 15 + 1 as string), 2, '0')) end start,
    case user_id % 7
      when 3 then '2024-99-99'
      when 4 then '2024-01-10'
      else concat('2024-01-', lpad(cast(user_id % 15 + 1 + 3 + user_id % 11 as string), 2, '0'))
    end "end"
  from users),
trimmed as (
  select request_id,
    regexp_replace(phone, '\\A[\\x00-\\x20]+|[\\x00-\\x20]+\\z', '', 'g') phone,
    regexp_replace(start, '\\A[\\x00-\\x20]+|[\\x00-\\x20]+\\z', '', 'g') start,
    regexp_replace("end", '\\A[\\x00-\\x20]+|[\\x00-\\x20]+\\z', '', 'g') "end"
  from requests),
flags as (
  select *,
    coalesce(regexp_full_match(phone, '\\d{11}'), false) phone_ok,
    coalesce(regexp_full_match(start, '\\d{4}-\\d{2}-\\d{2}'), false) start_ok,
    coalesce(regexp_full_match("end", '\\d{4}-\\d{2}-\\d{2}'), false) end_ok
  from trimmed),
checked as (
  select *, phone_ok and start_ok and end_ok valid,
    coalesce(try_strptime(start, '%Y-%m-%d') is not null
             and try_strptime("end", '%Y-%m-%d') is not null
             and start_ok and end_ok, false) calendar_ok,
    coalesce(start <= "end", false) ordered
  from flags)"""

_PLACES = """
places_text as (
  select c_custkey,
    case when c_custkey % 11 = 0 then '~' || cast(lng as string) else cast(lng as string) end lng,
    cast(lat as string) lat,
    case when c_custkey % 13 = 0 then null else n_name end region,
    case when c_custkey % 10 = 0 then 'other' else 'home' end country
  from (
    select c_custkey, n_name,
      cast(73.0::double + (c_nationkey % 5) * 12.0::double + c_acctbal / 2000.0::double as double) lng,
      cast(18.0::double + floor(c_nationkey / 5.0::double) * 7.0::double
           + cast(c_custkey % 7 as double) as double) lat
    from customer join nation on c_nationkey = n_nationkey)),
prepared as (
  select c_custkey, region, try_cast(lng as double) lng, try_cast(lat as double) lat
  from places_text
  where country = 'home' and region is not null
    and try_cast(lng as double) is not null and try_cast(lat as double) is not null)"""

_PAIRS = """
pairs as (
  select cast(c_nationkey % 5 as double) label,
         case when c_custkey % 4 = 0 then 9.0::double
              else cast((c_nationkey + c_custkey % 3) % 5 as double) end prediction
  from customer)"""


def _quotes(c: str) -> str:
    return (f"case when length({c}) >= 2 and starts_with({c}, '\"') and ends_with({c}, '\"') "
            f"then substr({c}, 2, length({c}) - 2) else {c} end")


def _ends(c: str) -> str:
    return f"case when length({c}) <= 2 then '' else substr({c}, 2, length({c}) - 2) end"


def _with(*parts: str) -> str:
    return "with " + ",".join(parts)


def _dim_all(src: str = "towers") -> str:
    return f"""
dim as (select distinct lac, cell, {_quotes('city')} city from {src} where city is not null)"""


def _dim_one(src: str = "towers") -> str:
    return f"""
dim as (select lac, cell, {_quotes('max(city)')} city from {src}
        where city is not null group by lac, cell)"""


_TEXT = """
log_parts as (select string_split(regexp_replace(value, ',+$', ''), ',') p from log_lines),
text_logs as (select p[2] lac, p[3] cell, p[4] phone, p[5] ts
              from log_parts where len(p) >= 5 and p[4] is not null and p[4] <> ''),
text_dim as (select lac, cell, max(city) city from parsed_cells
             where city is not null group by lac, cell)"""

_DAILY = """
daily as (
  select phone, day, string_agg(city, ',' order by city) itinerary
  from (select distinct l.phone, substr(l.ts, 1, 10) as day, coalesce(d.city, 'null') city
        from event_logs l left join dim d on l.lac = d.lac and l.cell = d.cell
        where length(l.ts) >= 10) v
  group by phone, day)"""


def _lookup(level: str, accepted: str, cols: str) -> str:
    element = "unnest(string_split(d.itinerary, ','))" if level == "city" else "d.itinerary"
    return f"""
acc as (select * from checked where {accepted}),
hits as (
  select r.request_id, {element} element
  from acc r join daily d on d.phone = r.phone and d.day between r.start and r."end"),
sets as (
  select request_id, string_agg(element, ',' order by element) visited, count(*) n
  from (select distinct request_id, element from hits) h group by request_id)
select {cols}, coalesce(s.visited, '') visited, coalesce(s.n, 0) n_visited,
       coalesce(s.n, 0) > 0 found
from checked_out r left join sets s on s.request_id = r.request_id"""


ORACLE: dict[str, str] = {
    "parse_logs": _with(_EVENTS, _LOG_LINES, """
log_parts as (select string_split(regexp_replace(value, ',+$', ''), ',') p from log_lines)""") + """
select p[2] lac, p[3] cell, p[4] phone, p[5] ts
from log_parts where len(p) >= 5 and p[4] is not null and p[4] <> ''""",

    "parse_cells": _with(_SUP, _CELL_LINES) + """
select lac, cell, city from parsed_cells""",

    "cell_dimension": _with(_SUP) + """
select lac, cell, max(city) city from towers where city is not null group by lac, cell""",

    "cell_dimension_from_text": _with(_SUP, _CELL_LINES) + """
select lac, cell, max(city) city from parsed_cells where city is not null group by lac, cell""",

    "clean_city_quotes": _with(_SUP, _TRACE, _CELL_LINES, _dim_all("parsed_cells")) + """
select phone, string_agg(city, ',' order by city) itinerary
from (select distinct l.phone, d.city from trace_logs l
      join dim d on l.lac = d.lac and l.cell = d.cell) v
group by phone""",

    "clean_city_ends": _with(_SUP, _TRACE, _CELL_LINES, """
dim as (select distinct lac || cell tower, city from parsed_cells where city is not null),
raw_pairs as (select distinct l.phone, d.city from trace_logs l join dim d on l.lac || l.cell = d.tower)""")
    + f"""
select phone, string_agg(c, ',' order by c) itinerary
from (select phone, {_ends('city')} c from raw_pairs) v
group by phone""",

    "itineraries": _with(_SUP, _TRACE, _dim_all()) + """
select phone, string_agg(city, ',' order by city) itinerary
from (select distinct l.phone, d.city from trace_logs l
      join dim d on l.lac = d.lac and l.cell = d.cell) v
group by phone""",

    "itineraries_concat_key": _with(_SUP, _TRACE, _dim_all()) + """
select phone, string_agg(city, ',' order by city) itinerary
from (select distinct l.phone, d.city from trace_logs l
      join (select distinct lac || cell tower, city from dim) d on l.lac || l.cell = d.tower) v
group by phone""",

    "itineraries_left": _with(_SUP, _TRACE, _dim_one()) + """
select phone, string_agg(city, ',' order by city) itinerary
from (select distinct l.phone, coalesce(d.city, 'null') city from trace_logs l
      left join dim d on l.lac = d.lac and l.cell = d.cell) v
group by phone""",

    "itineraries_distinct_pairs": _with(_SUP, _TRACE, _dim_all()) + """
select distinct l.phone, d.city from trace_logs l join dim d on l.lac = d.lac and l.cell = d.cell""",

    "daily_itineraries": _with(_SUP, _EVENTS, _dim_one(), _DAILY) + """
select phone, day, itinerary from daily""",

    "daily_itineraries_inner": _with(_SUP, _EVENTS, _dim_all()) + """
select phone, day, string_agg(city, ',' order by city) itinerary
from (select distinct l.phone, substr(l.ts, 1, 10) as day, d.city
      from event_logs l join dim d on l.lac = d.lac and l.cell = d.cell
      where length(l.ts) >= 10) v
group by phone, day""",

    "itineraries_from_text": _with(_SUP, _EVENTS, _LOG_LINES, _CELL_LINES, _TEXT) + """
select phone, string_agg(city, ',' order by city) itinerary
from (select distinct l.phone, coalesce(d.city, 'null') city from text_logs l
      left join text_dim d on l.lac = d.lac and l.cell = d.cell) v
group by phone""",

    "daily_itineraries_from_text": _with(_SUP, _EVENTS, _LOG_LINES, _CELL_LINES, _TEXT) + """
select phone, day, string_agg(city, ',' order by city) itinerary
from (select distinct l.phone, substr(l.ts, 1, 10) as day, coalesce(d.city, 'null') city
      from text_logs l left join text_dim d on l.lac = d.lac and l.cell = d.cell
      where length(l.ts) >= 10) v
group by phone, day""",

    "lookup_range": _with(_SUP, _EVENTS, _dim_one(), _DAILY, _REQUESTS,
                          "\nchecked_out as (select * from checked where valid)",
                          _lookup("city", "valid", "r.request_id, r.phone, r.start, r.\"end\"")),

    "lookup_range_day_text": _with(_SUP, _EVENTS, _dim_one(), _DAILY, _REQUESTS,
                                   "\nchecked_out as (select * from checked where valid)",
                                   _lookup("day_text", "valid",
                                           "r.request_id, r.phone, r.start, r.\"end\"")),

    "lookup_batch": _with(_SUP, _EVENTS, _dim_one(), _DAILY, _REQUESTS,
                          "\nchecked_out as (select * from checked)",
                          _lookup("city", "valid",
                                  "r.request_id, r.phone, r.start, r.\"end\", r.valid")),

    "lookup_batch_strict": _with(_SUP, _EVENTS, _dim_one(), _DAILY, _REQUESTS,
                                 "\nchecked_out as (select * from checked)",
                                 _lookup("city", "valid and calendar_ok",
                                         "r.request_id, r.phone, r.start, r.\"end\", r.valid")),

    "validate_requests": _with(_REQUESTS) + """
select request_id, phone, start, "end", phone_ok, start_ok, end_ok, valid, calendar_ok, ordered
from checked""",

    "prepare_places": _with(_PLACES) + """
select c_custkey, region, lng, lat from prepared""",

    "encode_regions": _with(_PLACES) + """
select p.c_custkey, p.region, p.lng, p.lat, cast(n.n_nationkey as double) label
from prepared p join nation n on n.n_name = p.region""",

    "split_by_key": _with(_PLACES) + """
select c_custkey,
       cast('0x' || substr(md5(cast(c_custkey as string)), 1, 8) as bigint) < floor(0.8::double * 4294967296.0::double) train
from prepared""",

    "lookup_one": _with(_SUP, _EVENTS, _dim_one(), _DAILY, """
elements as (
  select distinct unnest(string_split(itinerary, ',')) element
  from daily where phone = '10000000007' and day between '2024-01-01' and '2024-12-31')""") + """
select coalesce(string_agg(element, ',' order by element), '') visited, count(*) n_visited, count(*) > 0 found
from elements""",

    "rejected_requests": _with(_REQUESTS) + """
select request_id, phone, start, "end", phone_ok, start_ok, end_ok, valid, calendar_ok, ordered
from checked where not (valid and calendar_ok)""",

    "predict_region": _with(_PLACES) + """
select p.c_custkey, cast(n.n_nationkey as double) as label, true in_dictionary
from prepared p join nation n on n.n_name = p.region
where cast('0x' || substr(md5(cast(c_custkey as string)), 1, 8) as bigint) >= floor(0.8::double * 4294967296.0::double)""",

    "predict_band": _with(_PLACES) + """
select p.c_custkey, floor(n.n_nationkey / 5) as label, floor(n.n_nationkey / 5) as prediction, true agrees
from prepared p join nation n on n.n_name = p.region
where cast('0x' || substr(md5(cast(c_custkey as string)), 1, 8) as bigint) >= floor(0.8::double * 4294967296.0::double)""",

    "region_accuracy": _with(_PLACES) + """
select count(*) n, true accurate
from prepared p join nation n on n.n_name = p.region
where cast('0x' || substr(md5(cast(c_custkey as string)), 1, 8) as bigint) >= floor(0.8::double * 4294967296.0::double)""",

    "confusion_counts": _with(_PAIRS) + """
select label, prediction, count(*) n from pairs group by label, prediction""",

    "assemble_coordinate": _with(_PLACES) + """
select c_custkey, lng coord_lng, lat coord_lat from prepared""",

    "confusion_matrix": _with(_PAIRS, """
truth as (select distinct label from pairs),
counts as (select label, prediction, count(*) n from pairs group by label, prediction)""") + """
select t1.label, t2.label prediction, coalesce(c.n, 0) n
from truth t1 cross join truth t2
left join counts c on c.label = t1.label and c.prediction = t2.label""",

    # The directory's lines stand in the files in order of (k, second).
    "cell_dimension_last": _with(_SUP, _CELL_LINES_ORDERED) + """
select lac, cell, arg_max(city, line_no) city from ordered_cells where city is not null group by lac, cell""",

    "itineraries_last_city": _with(_SUP, _EVENTS, _LOG_LINES, _CELL_LINES, _CELL_LINES_ORDERED, _TEXT, """
last_dim as (select lac, cell, arg_max(city, line_no) city from ordered_cells where city is not null group by lac, cell)""") + """
select phone, string_agg(city, ',' order by city) itinerary
from (select distinct l.phone, coalesce(d.city, 'null') city from text_logs l
      left join last_dim d on l.lac = d.lac and l.cell = d.cell) v
group by phone""",

    # The glued key, inner join, duplicates removed on the raw text, ends stripped; logs of four fields count.
    "itineraries_rdd_from_files": _with(_SUP, _EVENTS, _LOG_LINES, _CELL_LINES, """
rdd_logs as (
  select p[2] || p[3] tower, p[4] phone from (select string_split(regexp_replace(value, ',+$', ''), ',') p from log_lines)
  where len(p) >= 4 and p[4] <> ''),
rdd_dim as (select distinct lac || cell tower, city from parsed_cells where city is not null),
raw_pairs as (select distinct l.phone, d.city from rdd_logs l join rdd_dim d on l.tower = d.tower)""") + f"""
select phone, string_agg(c, ',' order by c) itinerary
from (select phone, {_ends('city')} c from raw_pairs) v
group by phone""",

    "accuracy": _with(_PAIRS) + """
select avg(case when label = prediction then 1.0::double else 0.0::double end) accuracy,
       count(*) n
from pairs""",
}

# The same rows as the queries that read no files.
ORACLE |= {
    "cells_from_files": ORACLE["parse_cells"],
    "itineraries_from_files": ORACLE["itineraries_from_text"],
    "itineraries_two_step": ORACLE["itineraries_left"],
    "daily_replaced": ORACLE["daily_itineraries"],
    "lookup_stored": ORACLE["lookup_one"],
    "lookup_stored_batch": ORACLE["lookup_batch"],
    "prepare_places_from_files": ORACLE["prepare_places"],
}
