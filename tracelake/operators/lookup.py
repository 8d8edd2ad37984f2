"""Range lookups over the daily itinerary table.

The original answered one (phone, start, end) request per click with a
row-key range scan. Here a whole table of requests is answered at once: one
equi-join on the phone with the day range as a residual predicate, then one
set per request. ``lookup_one`` is the single-request form, a filter that
reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.functions.text import ITINERARY_SEP, full_match, java_trim, sorted_join
from tracelake.sources.tables import key_range

# The input patterns of the query form (phone of 11 digits,
# dates shaped yyyy-MM-dd; shape only, so 2022-99-99 passes).
PHONE_PATTERN = r"\d{11}"
DATE_PATTERN = r"\d{4}-\d{2}-\d{2}"
DATE_FORMAT = "yyyy-MM-dd"

LEVELS = ("city", "day_text")


def validate_requests(requests: DataFrame) -> DataFrame:
    """Trim the inputs and add check flags.

    ``phone_ok``, ``start_ok``, ``end_ok``: the shape checks of the form;
    ``valid``: all three. ``calendar_ok``: both dates are real dates, and
    ``ordered``: start is not after end — information only, a request that
    fails them is still looked up (it simply finds nothing or what the text
    range covers).
    """
    t = requests.select(
        *[c for c in requests.columns if c not in ("phone", "start", "end")],
        java_trim("phone").alias("phone"),
        java_trim("start").alias("start"),
        java_trim("end").alias("end"),
    )
    phone_ok = full_match("phone", PHONE_PATTERN)
    start_ok = full_match("start", DATE_PATTERN)
    end_ok = full_match("end", DATE_PATTERN)
    calendar_ok = (F.try_to_date(F.col("start"), DATE_FORMAT).isNotNull()
                   & F.try_to_date(F.col("end"), DATE_FORMAT).isNotNull())
    return t.select(
        "*",
        F.coalesce(phone_ok, F.lit(False)).alias("phone_ok"),
        F.coalesce(start_ok, F.lit(False)).alias("start_ok"),
        F.coalesce(end_ok, F.lit(False)).alias("end_ok"),
    ).select(
        "*",
        (F.col("phone_ok") & F.col("start_ok") & F.col("end_ok")).alias("valid"),
        F.coalesce(calendar_ok & F.col("start_ok") & F.col("end_ok"), F.lit(False)).alias("calendar_ok"),
        F.coalesce(F.col("start") <= F.col("end"), F.lit(False)).alias("ordered"),
    )


def _elements(daily: DataFrame, level: str) -> Column:
    """The elements of a daily row: its cities, or its whole text.

    A table stored with its ``cities`` array gives them as they are; one
    without has only the text, whose commas separate them.
    """
    if level not in LEVELS:
        raise ValueError(f"level must be one of {LEVELS}, got {level!r}")
    if level == "day_text":
        return F.array("itinerary")
    return F.col("cities") if "cities" in daily.columns else F.split("itinerary", ITINERARY_SEP)


def answer_requests(daily: DataFrame, requests: DataFrame, cols: list[str],
                    accepted: str | None = None, level: str = "city") -> DataFrame:
    """One row per request: ``(*cols, visited, n_visited, found)``.

    ``requests`` must have ``request_id, phone, start, end`` among ``cols``
    and one row per ``request_id`` (two identical rows are answered once);
    only rows where the boolean column ``accepted`` is true (all rows when it
    is None) are looked up. One plan at every size: Spark broadcasts the
    requests when they are small; otherwise both sides shuffle on the phone
    and adaptive execution splits a hot phone.

    Instead of joining the per-request sets back to the requests, every
    request contributes one row with a null element and every hit one row
    with its element; a single distinct + gather then yields all requests,
    including those without a hit, with one shuffle fewer.
    """
    req = requests.select(*cols)
    side = req.where(F.col(accepted)) if accepted else req
    days = daily.select(F.col("phone").alias("_day_phone"), "day", _elements(daily, level).alias("_elements"))
    hits = days.join(side, (days["_day_phone"] == side["phone"])
                     & days["day"].between(side["start"], side["end"]))
    hit_rows = hits.select(*[side[c] for c in cols], F.explode("_elements").alias("element"))
    base = req.select(*cols, F.lit(None).cast("string").alias("element"))
    # Distinct first (map-side partial aggregate), then gather: a request's
    # list is bounded by its distinct elements, however many days matched.
    pairs = base.unionByName(hit_rows).distinct()
    sets = pairs.groupBy(*cols).agg(F.collect_list("element").alias("elements"))
    n = F.size("elements").cast("bigint")
    return sets.select(*cols, sorted_join(F.col("elements")).alias("visited"),
                       n.alias("n_visited"), (n > 0).alias("found"))


def lookup_itineraries(daily: DataFrame, requests: DataFrame, level: str = "city") -> DataFrame:
    """Answer every request: ``(request_id, phone, start, end, visited,
    n_visited, found)``.

    ``daily``: ``(phone, day, itinerary)`` and, where stored, the ``cities``
    array (without it a city that holds a comma would count as two).
    ``requests``: ``(request_id,
    phone, start, end)``, already valid, one row per ``request_id``. Both
    ends of the range are inclusive and compared as text. ``level="city"``
    gives the set of cities over the range; ``"day_text"`` the set of whole
    daily itinerary texts, as the original form printed. A request with no
    match gets ``visited = ''`` and ``found = false``.
    """
    return answer_requests(daily, requests, ["request_id", "phone", "start", "end"], level=level)


def lookup_batch(daily: DataFrame, requests: DataFrame, level: str = "city",
                 strict: bool = False) -> DataFrame:
    """Validate, look up the accepted requests, and return one row per request.

    Requests that fail the shape checks are not looked up (``valid =
    false``, ``found = false``). With ``strict=True`` a request must also
    have real dates.
    """
    checked = validate_requests(requests)
    ok = F.col("valid") & (F.col("calendar_ok") if strict else F.lit(True))
    checked = checked.select("request_id", "phone", "start", "end", "valid", ok.alias("_accepted"))
    out = answer_requests(daily, checked,
                          ["request_id", "phone", "start", "end", "valid", "_accepted"],
                          accepted="_accepted", level=level)
    return out.drop("_accepted")


def lookup_by_range(daily: DataFrame, requests: DataFrame, level: str = "city",
                    strict: bool = False) -> DataFrame:
    """``lookup_batch`` for a daily table stored in buckets of the phone: the same rows, and the table is not moved.

    The distinct (phone, start, end) of the accepted requests go to the
    buckets; the join and the set of each range happen there, because the
    table's rows of a phone lie in one bucket (one per day, so a hot phone has
    no more rows than there are days). Only the answers, one row per distinct
    range, then go back to the requests that asked for them, by a join that
    adaptive execution splits where a range was asked very often.
    """
    checked = validate_requests(requests)
    ok = F.col("valid") & (F.col("calendar_ok") if strict else F.lit(True))
    cols = ["request_id", "phone", "start", "end", "valid"]
    asked = checked.select(*cols, ok.alias("_accepted")).distinct()
    ranges = checked.where(ok).select(F.col("phone").alias("_phone"), F.col("start").alias("_start"),
                                      F.col("end").alias("_end")).distinct()
    days = daily.select(F.col("phone").alias("_day_phone"), "day", _elements(daily, level).alias("_elements"))
    hits = days.join(ranges, (F.col("_day_phone") == F.col("_phone")) & F.col("day").between(F.col("_start"), F.col("_end")))
    answers = (hits.select("_day_phone", "_start", "_end", F.explode("_elements").alias("element"))
               .groupBy("_day_phone", "_start", "_end").agg(F.collect_set("element").alias("elements")))
    found = F.coalesce("elements", F.array().cast("array<string>"))
    n = F.size(found).cast("bigint")
    same = (F.col("_accepted") & (F.col("phone") == F.col("_day_phone")) & (F.col("start") == F.col("_start"))
            & (F.col("end") == F.col("_end")))
    return asked.join(answers, same, "left").select(*cols, sorted_join(found).alias("visited"),
                                                    n.alias("n_visited"), (n > 0).alias("found"))


def rejected_requests(requests: DataFrame, strict: bool = False) -> DataFrame:
    """The requests that fail a check, with their flags."""
    checked = validate_requests(requests)
    ok = F.col("valid") & (F.col("calendar_ok") if strict else F.lit(True))
    return checked.where(~ok)


def lookup_one(daily: DataFrame, phone: str, start: str, end: str,
               level: str = "city") -> DataFrame:
    """One request: ``(visited, n_visited, found)`` for a phone and range."""
    rows = key_range(daily, phone, start, end)
    agg = rows.select(F.explode(_elements(daily, level)).alias("element")).distinct().agg(
        F.collect_list("element").alias("elements"))
    n = F.size("elements").cast("bigint")
    return agg.select(sorted_join(F.col("elements")).alias("visited"),
                      n.alias("n_visited"), (n > 0).alias("found"))
