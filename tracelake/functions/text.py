"""Column expressions for raw comma-separated text.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``, so
it stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The field separator of both inputs and the separator of the
# itinerary text.
FIELD_SEP = ","
ITINERARY_SEP = ","
# Fixed value: how a tower that is missing from the directory is printed when
# it is kept (Java prints a null String as this text).
NULL_CITY = "null"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(line: Column | str, sep: str = FIELD_SEP) -> Column:
    """Split like ``String.split(sep)`` in Java: trailing empty fields go.

    Spark's ``split`` keeps trailing empties, so the run of separators at the
    end of the line is trimmed first. ``sep`` is a literal single character.
    """
    quoted = "\\" + sep if sep in ".$^|?*+()[]{}\\" else sep
    return F.split(F.rtrim(_col(line), F.lit(sep)), quoted)


def split_lines(lines: DataFrame, value_col: str, min_fields: int, mode: str, what: str,
                keep: Sequence[str] = ()) -> DataFrame:
    """Lines as rows with the columns ``keep`` and an array ``parts``, each line split once.

    Lines with fewer than ``min_fields`` fields are dropped, or fail the job
    with ``mode="fail"``. The check sits inside a generator over the split
    line: a filter above the split would be pushed below it by the optimizer
    and split every line again.
    """
    split = F.array(java_split(value_col))
    if mode == "fail":
        # No filter placed before it can skip the check: the fields come from it.
        text = F.concat(F.lit(f"{what} line with too few fields: "), F.col(value_col))
        kept = F.transform(split, lambda p: F.when(F.size(p) >= min_fields, p).otherwise(F.raise_error(text)))
    else:
        kept = F.filter(split, lambda p: F.size(p) >= min_fields)
    return lines.select(*keep, F.explode(kept).alias("parts"))


def field(parts: Column | str, index: int) -> Column:
    """Field ``index`` (0-based) of a split line, null when out of range."""
    return F.get(_col(parts), F.lit(index))


def field_count(parts: Column | str) -> Column:
    return F.size(_col(parts))


def java_trim(c: Column | str) -> Column:
    """``String.trim()``: drops every character up to U+0020 at both ends.

    Spark's ``trim`` only removes spaces, so tabs and newlines would survive.
    """
    return F.regexp_replace(_col(c), r"\A[\x00-\x20]+|[\x00-\x20]+\z", "")


def full_match(c: Column | str, pattern: str) -> Column:
    """True when the whole text matches ``pattern`` (Java ``matches``).

    Anchored with ``\\A`` and ``\\z``: ``$`` would let a final newline pass.
    """
    return _col(c).rlike(r"\A(?:" + pattern + r")\z")


def strip_quotes(c: Column | str) -> Column:
    """Remove one surrounding pair of double quotes, if there is one."""
    c = _col(c)
    quoted = (F.length(c) >= 2) & c.startswith('"') & c.endswith('"')
    return F.when(quoted, c.substr(F.lit(2), F.length(c) - 2)).otherwise(c)


def strip_ends(c: Column | str) -> Column:
    """Remove the first and the last character, quoted or not.

    Texts of length 0 to 2 become the empty text.
    """
    c = _col(c)
    return F.when(F.length(c) <= 2, F.lit("")).otherwise(c.substr(F.lit(2), F.length(c) - 2))


CITY_STRIP = {
    "quotes": strip_quotes,
    "ends": strip_ends,
    "none": _col,
}


def clean_city(c: Column | str, strip: str = "quotes") -> Column:
    """City clean-up: ``"quotes"`` (default), ``"ends"`` or ``"none"``."""
    try:
        return CITY_STRIP[strip](c)
    except KeyError:
        raise ValueError(f"strip must be one of {sorted(CITY_STRIP)}, got {strip!r}") from None


def tower_key(lac: Column | str = "lac", cell: Column | str = "cell", sep: str = ":") -> Column:
    """Text key of a tower, ``lac:cell`` (unambiguous as long as neither
    part contains ``sep``). The operators join on the two columns instead."""
    return F.concat_ws(sep, _col(lac), _col(cell))


def phone_day_key(phone: Column | str = "phone", day: Column | str = "day",
                  sep: str = "_") -> Column:
    """Text key ``phone_day`` of a daily itinerary row. Because every phone
    has the same length, text order of this key is (phone, day) order."""
    return F.concat_ws(sep, _col(phone), _col(day))


def day_of(ts: Column | str) -> Column:
    """First ten characters of the timestamp text, null when it is shorter."""
    ts = _col(ts)
    return F.when(F.length(ts) >= 10, F.substring(ts, 1, 10))


def sorted_join(values: Column, sep: str = ITINERARY_SEP) -> Column:
    """Join an array of texts in ascending order, so results are stable."""
    return F.array_join(F.sort_array(values), sep)
