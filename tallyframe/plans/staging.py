"""Raw all-text request records to typed, tidied ones.

The column list is data: for each staged column its raw name and how it is treated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions import blank_to_null, cased, clean, safe_double, safe_int, safe_timestamp

# The raw record's columns in order, the staged name and the treatment.
STAGED_COLUMNS = [
    ("sr_number", "sr_id", "key"),
    ("sr_type", "service_request_type", "text"),
    ("sr_short_code", "sr_short_code", "upper"),
    ("owner_department", "owner_department", "text"),
    ("status", "status", "status"),
    ("origin", "origin", "text"),
    ("created_date", "created_date", "timestamp"),
    ("last_modified_date", "last_modified_date", "timestamp"),
    ("closed_date", "closed_date", "timestamp"),
    ("street_address", "street_address", "text"),
    ("city", "city", "upper_key"),
    ("state", "state", "state"),
    ("zip_code", "zip_code", "text"),
    ("street_number", "street_number", "text"),
    ("street_direction", "street_direction", "text"),
    ("street_name", "street_name", "text"),
    ("street_type", "street_type", "text"),
    ("duplicate", "duplicate", "as_is"),
    ("legacy_record", "legacy_record", "as_is"),
    ("community_area", "community_area", "int"),
    ("ward", "ward", "int"),
    ("police_sector", "police_sector", "text"),
    ("police_district", "police_district", "int"),
    ("police_beat", "police_beat", "int"),
    ("precinct", "precinct", "int"),
    ("created_hour", "created_hour", "int"),
    ("created_day_of_week", "created_day_of_week", "int"),
    ("created_month", "created_month", "int"),
    ("x_coordinate", "x_coordinate", "double"),
    ("y_coordinate", "y_coordinate", "double"),
    ("latitude", "latitude", "double"),
    ("longitude", "longitude", "double"),
    ("electrical_district", "electrical_district", "int"),
    ("parent_sr_number", "parent_sr_number", "key"),
    ("electricity_grid", "electricity_grid", "text"),
    ("created_department", "created_department", "text"),
]
RAW_COLUMNS = [raw for raw, _, _ in STAGED_COLUMNS]
STATUS_NAMES = {"closed": "completed"}
STATE_NAMES = {"ILLINOIS": "IL"}

_TREATMENTS = {
    "as_is": lambda c: c,
    "text": clean,
    "key": lambda c: blank_to_null(clean(c)),
    "upper": lambda c: F.upper(clean(c)),
    "upper_key": lambda c: blank_to_null(F.upper(clean(c))),
    "status": lambda c: cased(F.lower(clean(c)), STATUS_NAMES),
    "state": lambda c: cased(blank_to_null(F.upper(clean(c))), STATE_NAMES),
    "timestamp": safe_timestamp,
    "int": safe_int,
    "double": safe_double,
}


def staged_column(raw: str, name: str, treatment: str) -> Column:
    return _TREATMENTS[treatment](F.col(raw)).alias(name)


def stage(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The typed view of the raw table; a column the raw table lacks is NULL. `keep` names columns to carry along as they are."""
    for name in set(RAW_COLUMNS) - set(raw.columns):
        raw = raw.withColumn(name, F.lit(None).cast("string"))
    return raw.select(*[staged_column(*spec) for spec in STAGED_COLUMNS], *keep)
