"""Text to typed value, NULL when the text does not fit.

Spark's own try_cast differs from the semantics wanted here in both directions: it refuses '1.5' and '1e3' for an
integer, and it accepts '2023' as a timestamp and '1.5d' as a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"
_NUMBER_OR_SPECIAL = _NUMBER + r"|^\s*[+-]?(?i:nan|inf|infinity)\s*$"
_FULL_DATE = r"^\s*[0-9]{1,6}-[0-9]{1,2}-[0-9]{1,2}(?:[ T]|$)"


def safe_double(text: Column) -> Column:
    # text ending in a digit can only go wrong by being hexadecimal, so most values need no pattern match
    plain = F.right(F.rtrim(text), F.lit(1)).between("0", "9") & ~text.contains("x") & ~text.contains("X")
    return F.when(plain | text.rlike(_NUMBER_OR_SPECIAL), text.try_cast("double"))


def safe_int(text: Column) -> Column:
    """Whole numbers directly; decimal and exponent forms are rounded half away from zero and range-checked."""
    rounded = F.round(F.when(text.rlike(_NUMBER), text.try_cast("double")), 0)
    return F.coalesce(text.try_cast("int"), rounded.try_cast("int"))


def safe_timestamp(text: Column) -> Column:
    """A zone-free timestamp; the text must carry at least a full date."""
    return F.when(text.rlike(_FULL_DATE), text.try_cast("timestamp_ntz"))
