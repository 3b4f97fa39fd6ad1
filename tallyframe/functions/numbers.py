from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHOLE_DOUBLES = float(2**52)  # from here on a double has no fraction left to round


def round_half_away(value: Column, digits: int) -> Column:
    """Round a double in binary, halves away from zero (Spark's own round works on the shortest decimal text)."""
    scale = float(10**digits)
    x = value.cast("double")
    scaled = F.abs(x) * F.lit(scale)
    rounded = F.signum(x) * F.floor(scaled + F.lit(0.5)) / F.lit(scale)
    return F.when(scaled < F.lit(_WHOLE_DOUBLES), rounded).otherwise(x)


def signed_percent(new: Column, old: Column) -> Column:
    """Change from old to new in percent, one decimal; NULL when old is zero."""
    old, new = old.cast("double"), new.cast("double")
    return round_half_away(F.lit(100.0) * (new - old) / F.nullif(old, F.lit(0.0)), 1)


def ordinal(n: Column) -> Column:
    """1st, 2nd, 3rd, 4th, ... with 11th to 13th."""
    ones = F.pmod(n, F.lit(10))
    suffix = (
        F.when(F.pmod(n, F.lit(100)).between(11, 13), "th")
        .when(ones == 1, "st")
        .when(ones == 2, "nd")
        .when(ones == 3, "rd")
        .otherwise("th")
    )
    return F.concat(n.cast("string"), suffix)


def distance_from_origin(x: Column, y: Column) -> Column:
    x, y = x.cast("double"), y.cast("double")
    return F.sqrt(x * x + y * y)
