"""Column expressions. Everything here is built from Spark's own functions, so it stays inside generated code."""

from tallyframe.functions.casts import safe_double, safe_int, safe_timestamp
from tallyframe.functions.dates import calendar_columns, days_crossed, hours_crossed, iso_text
from tallyframe.functions.numbers import distance_from_origin, ordinal, round_half_away, signed_percent
from tallyframe.functions.text import blank_to_null, cased, clean, part_before, strip_marks, strip_space, words

__all__ = [
    "blank_to_null", "calendar_columns", "cased", "clean", "days_crossed", "distance_from_origin", "hours_crossed",
    "iso_text", "ordinal", "part_before", "round_half_away", "safe_double", "safe_int", "safe_timestamp", "signed_percent",
    "strip_marks", "strip_space", "words",
]
