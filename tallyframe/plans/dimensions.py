from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import calendar_columns
from tallyframe.operators.positions import dense_ids
from tallyframe.sources.partials import grouped, with_part
from tallyframe.sources.seeds import DEFAULT_CITY, DEFAULT_STATE

# The calendar covers these days, both included, and an address has these parts.
FIRST_DAY, LAST_DAY = date(2015, 1, 1), date(2030, 12, 31)
ADDRESS = ["street_number", "street_direction", "street_name", "street_type"]
_ADDRESS_ORDER = ["street_name", "street_number", "street_direction", "street_type"]


def calendar(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    return calendar_of(spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last")))


def calendar_of(bounds: DataFrame) -> DataFrame:
    """One row per day between the two dates of a one-row table (`first`, `last`)."""
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("day"))
    return days.select(*calendar_columns(F.col("day")))


def addresses(staged: DataFrame) -> DataFrame:
    """Distinct addresses with their greatest city and state, per slot where the rows name one; mergeable."""
    return grouped(staged.where(F.col("street_name").isNotNull()), *ADDRESS).agg(F.max("city").alias("city"), F.max("state").alias("state"))


def locations(
    found: DataFrame, known: DataFrame | None = None, city: str = DEFAULT_CITY, state: str = DEFAULT_STATE
) -> DataFrame:
    """Distinct addresses, of staged requests or of `addresses`, with a number each, in address order; NULL parts sort last.

    Addresses found in the `known` table keep their number and new ones are numbered after the greatest, since facts
    already stored refer to those numbers.
    """
    found = addresses(found).withColumns({"city": F.coalesce("city", F.lit(city)), "state": F.coalesce("state", F.lit(state))})
    columns = ["location_id", *ADDRESS, "city", "state"]
    order = [F.col(c).asc_nulls_last() for c in _ADDRESS_ORDER]
    if known is None:
        return dense_ids(found, order, "location_id").select(*columns)
    left, right = found.alias("f"), known.alias("k")
    same = [F.col(f"f.{c}").eqNullSafe(F.col(f"k.{c}")) for c in ADDRESS]
    matched = left.join(right, same, "left").select("f.*", "k.location_id")
    kept = matched.where(F.col("location_id").isNotNull())
    added = dense_ids(matched.where(F.col("location_id").isNull()).drop("location_id"), order, "location_id")
    greatest = known.agg(F.coalesce(F.max("location_id"), F.lit(0)).alias("n")).scalar()
    return kept.unionByName(added.withColumn("location_id", F.col("location_id") + greatest)).select(*columns)


def newest_names(staged: DataFrame) -> DataFrame:
    """Each code's most recently modified name with its time, per slot where the rows name one; mergeable."""
    named = staged.where(F.col("sr_short_code").isNotNull())
    newest = F.max(F.struct("last_modified_date", "service_request_type"))
    return grouped(named, "sr_short_code").agg(newest.alias("newest")).select(*with_part(staged), "sr_short_code", "newest.*")


def request_types(staged: DataFrame, one_name: bool = True) -> DataFrame:
    """Type codes with their name, of staged requests or of `newest_names`.

    A code found under two names would double its requests in every join, so the most recently modified name is kept;
    `one_name=False` keeps all pairs.
    """
    if not one_name:
        return staged.where(F.col("sr_short_code").isNotNull()).select("sr_short_code", "service_request_type").distinct()
    return newest_names(staged).select("sr_short_code", "service_request_type")


def areas(seed: DataFrame) -> DataFrame:
    return seed.select("community_area", "community_area_name")


def wards(staged: DataFrame) -> DataFrame:
    """Distinct wards, per slot where the rows name one; mergeable."""
    return staged.where(F.col("ward").isNotNull()).select(*with_part(staged), "ward").distinct()
