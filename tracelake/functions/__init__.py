"""Column-level helpers (built-in Spark functions only)."""

from tracelake.functions.text import (  # noqa: F401
    ITINERARY_SEP,
    NULL_CITY,
    clean_city,
    day_of,
    field,
    field_count,
    full_match,
    java_split,
    java_trim,
    phone_day_key,
    sorted_join,
    strip_ends,
    strip_quotes,
    tower_key,
)
