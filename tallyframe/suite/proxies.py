"""Service requests derived from the order tables, in Spark and as SQL text.

`requests` are orders seen as requests, already typed. `raw requests` are the same orders as untidy all-text records,
to exercise staging. Both cover every order.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators.history import VALID_FROM, VALID_TO, scd2_backfill
from tallyframe.operators.joins import asof_join
from tallyframe.plans.staging import STAGED_COLUMNS
from tallyframe.sources.shared import settle
from tallyframe.suite.registry import table

VERSIONS = [("old_map", datetime(1900, 1, 1)), ("new_map", datetime(1998, 5, 15))]


def ward_versions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(VERSIONS, "map_version string, effective_from timestamp_ntz")


# -- typed requests ---------------------------------------------------------------------------------------------------


def requests(spark: SparkSession, sf: str, with_area: bool = False) -> DataFrame:
    orders = table(spark, sf, "orders")
    key = F.col("o_orderkey")
    opened = F.col("o_orderdate") + F.make_dt_interval(secs=F.pmod(key * 7919, F.lit(86400)))
    took = F.make_dt_interval(secs=F.pmod(key * 104729, F.lit(8640000)))
    status = F.col("o_orderstatus")
    out = orders.select(
        key.alias("sr_id"),
        F.substring("o_orderpriority", 1, 1).alias("sr_short_code"),
        F.col("o_orderpriority").alias("service_request_type"),
        F.when(status == "F", "completed").when(status == "O", "open").otherwise("canceled").alias("status"),
        opened.alias("created_date"),
        F.when(status == "F", opened + took).alias("closed_date"),
        F.when(key % 97 != 0, F.col("o_custkey") % 50 + 1).alias("ward"),
        (F.col("o_custkey") % 100).alias("location_id"),
        *([F.col("o_custkey")] if with_area else []),
    )
    if not with_area:
        return out
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("community_area"))
    return out.join(customer, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")


def ward_history(spark: SparkSession, sf: str) -> DataFrame:
    """Every ward under both maps, stored, so that its size is known when it is joined."""
    wards = requests(spark, sf).where(F.col("ward").isNotNull()).select("ward").distinct()
    return settle(scd2_backfill(wards, "ward", ward_versions(spark), "map_version", "effective_from"), "ward-history")


def fact(spark: SparkSession, sf: str, with_area: bool = False) -> DataFrame:
    history = ward_history(spark, sf)
    rows = requests(spark, sf, with_area)
    return asof_join(rows, history, "ward", "created_date", VALID_FROM, VALID_TO, ["map_version"]).withColumnRenamed(
        "map_version", "ward_map_version_at_request"
    )


def types(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "orders").select(
        F.substring("o_orderpriority", 1, 1).alias("sr_short_code"), F.col("o_orderpriority").alias("service_request_type")
    )
    return settle(found.distinct(), "types")


def areas(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("community_area"), F.col("n_name").alias("community_area_name")
    )


REQUESTS_SQL = """
requests as (
  select o_orderkey as sr_id, substr(o_orderpriority, 1, 1) as sr_short_code, o_orderpriority as service_request_type,
         case o_orderstatus when 'F' then 'completed' when 'O' then 'open' else 'canceled' end as status,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400) as created_date,
         case when o_orderstatus = 'F'
              then o_orderdate + to_seconds((o_orderkey * 7919) % 86400 + (o_orderkey * 104729) % 8640000)
         end as closed_date,
         case when o_orderkey % 97 = 0 then null else o_custkey % 50 + 1 end as ward,
         o_custkey % 100 as location_id, c_nationkey as community_area
  from orders left join customer on o_custkey = c_custkey
)"""

FACT_SQL = REQUESTS_SQL + """,
fact as (
  select r.*, v.map_version as ward_map_version_at_request
  from requests r
  left join (values ('old_map', timestamp '1900-01-01', timestamp '1998-05-15'),
                    ('new_map', timestamp '1998-05-15', null)) v(map_version, since, until)
    on r.ward is not null and v.since <= r.created_date and (v.until is null or r.created_date < v.until)
)"""


# -- untidy all-text requests -----------------------------------------------------------------------------------------

# name -> SQL both engines read; {ts:...} marks the one thing they write differently, a timestamp as ISO text
_RAW = {
    "sr_number": "case when k % 199 = 198 then '   ' when k % 211 = 210 then null else '  SR' || k || ' ' end",
    "sr_type": "' ' || o_orderpriority || '  '",
    "sr_short_code": "case when k % 103 = 102 then null else ' p' || substr(o_orderpriority, 1, 1) end",
    "owner_department": "' Dept ' || c % 7",
    "status": "case o_orderstatus when 'F' then case when k % 2 = 0 then ' Closed ' else 'COMPLETED' end "
              "when 'O' then 'Open' else ' canceled' end",
    "origin": "case when k % 3 = 0 then ' phone' else 'web ' end",
    "created_date": "case when k % 53 = 52 then '2023-02-30' when k % 59 = 58 then '2023' when k % 61 = 60 then "
                    "'2023-01' when k % 67 = 66 then '' else {created} end",
    "last_modified_date": "{modified}",
    "closed_date": "case when o_orderstatus = 'F' then {closed} end",
    "street_address": "' ' || c % 300 || ' Street ' || c % 40",
    "city": "case c % 5 when 0 then ' chicago ' when 1 then '' when 2 then null else 'Chicago' end",
    "state": "case c % 4 when 0 then 'Illinois' when 1 then ' il ' when 2 then '' else null end",
    "zip_code": "'606' || lpad(cast(c % 100 as string), 2, '0')",
    "street_number": "case when c % 37 = 0 then null when c % 41 = 0 then '' else ' ' || c % 300 end",
    "street_direction": "case c % 11 when 0 then null when 1 then 'S ' when 2 then ' E' when 3 then 'W' else 'N' end",
    "street_name": "case when c % 43 = 0 then null else 'Street ' || c % 40 end",
    "street_type": "case c % 3 when 0 then 'AVE' when 1 then ' ST' else 'BLVD ' end",
    "duplicate": "case when k % 10 = 0 then 'true' else 'false' end",
    "legacy_record": "'false'",
    "community_area": "case when k % 101 = 1 then '1.5' when k % 103 = 2 then '1e1' when k % 107 = 3 then 'abc' "
                      "when k % 109 = 4 then '' when k % 113 = 5 then '99999999999' when k % 127 = 6 then '-2.5' "
                      "else ' ' || c % 25 || ' ' end",
    "ward": "case when k % 97 = 0 then null else cast(c % 50 + 1 as string) end",
    "police_sector": "' ' || c % 3",
    "police_district": "cast(c % 25 as string)",
    "police_beat": "case when k % 31 = 0 then '12a' else cast(k % 3000 as string) end",
    "precinct": "' ' || k % 60",
    "created_hour": "cast(k % 24 as string)",
    "created_day_of_week": "cast(k % 7 + 1 as string)",
    "created_month": "cast(k % 12 + 1 as string)",
    "x_coordinate": "case when k % 89 = 7 then '1.5d' when k % 83 = 8 then '1e6' else '11' || k % 100000 || '.25' end",
    "y_coordinate": "case when k % 79 = 9 then '' else '18' || k % 100000 || '.5' end",
    "latitude": "case when k % 1009 = 10 then '43.25' when k % 13 = 0 then null else '41.' || (600 + k % 400) end",
    "longitude": "case when k % 17 = 0 then 'west' else '-87.' || (500 + k % 450) end",
    "electrical_district": "case when k % 5 = 0 then cast(c % 90 as string) end",
    "parent_sr_number": "case k % 20 when 0 then ' SR' || (k - 1) when 1 then ' ' else null end",
    "electricity_grid": "' G' || k % 12",
    "created_department": "case when k % 6 = 0 then null else 'Dept ' || c % 9 end",
}
_MOMENTS = {  # seconds after the order date
    "created": "k * 7919 % 86400",
    "modified": "k * 7919 % 86400 + k * 31 % 864000",
    "closed": "k * 7919 % 86400 + k * 104729 % 8640000",
}


def _raw_columns(plus_seconds: str, as_text: str) -> list[str]:
    texts = {n: as_text.format(at=plus_seconds.format(secs=s)) for n, s in _MOMENTS.items()}
    return [f"{sql.format(**texts)} as {name}" for name, sql in _RAW.items()]


def raw_requests(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    columns = _raw_columns(
        "(o_orderdate + make_dt_interval(0, 0, 0, {secs}))", "date_format({at}, \"yyyy-MM-dd'T'HH:mm:ss.SSS\")"
    )
    orders = table(spark, sf, "orders").withColumns({"k": F.col("o_orderkey"), "c": F.col("o_custkey")})
    return orders.selectExpr(*columns, *extra)


RAW_SELECT = ",\n    ".join(_raw_columns("(o_orderdate + to_seconds({secs}))", "strftime({at}, '%Y-%m-%dT%H:%M:%S.%g')"))
_TREATED = {
    "as_is": "{c}",
    "text": "trim({c})",
    "key": "nullif(trim({c}), '')",
    "upper": "upper(trim({c}))",
    "upper_key": "nullif(upper(trim({c})), '')",
    "status": "replace(lower(trim({c})), 'closed', 'completed')",
    "state": "replace(nullif(upper(trim({c})), ''), 'ILLINOIS', 'IL')",
    "timestamp": "try_cast({c} as timestamp)",
    "int": "cast(try_cast({c} as integer) as bigint)",
    "double": "try_cast({c} as double)",
}
_STAGED_SELECT = ",\n    ".join(f"{_TREATED[how].format(c='raw.' + raw)} as {name}" for raw, name, how in STAGED_COLUMNS)

STAGED_SQL = f"""
raw as (
  select {RAW_SELECT}
  from (select *, o_orderkey as k, o_custkey as c from orders)
),
staged as (
  select {_STAGED_SELECT}
  from raw
)"""

TYPES_SQL = """
types as (
  select sr_short_code, arg_max(service_request_type, last_modified_date) as service_request_type
  from staged where sr_short_code is not null group by sr_short_code
)"""

LOCATIONS_SQL = """
addresses as (
  select street_number, street_direction, street_name, street_type,
         coalesce(max(city), 'CHICAGO') as city, coalesce(max(state), 'IL') as state
  from staged where street_name is not null
  group by all
),
locations as (
  select row_number() over (
           order by street_name nulls last, street_number nulls last, street_direction nulls last, street_type nulls last
         ) as location_id, *
  from addresses
)"""

BUILT_FACT_SQL = f"""{STAGED_SQL},{TYPES_SQL},{LOCATIONS_SQL},
built as (
  select s.sr_id, s.sr_short_code, t.service_request_type, s.status, s.origin, s.created_date,
         cast(s.created_date as date) as created_date_day, s.last_modified_date,
         cast(s.last_modified_date as date) as last_modified_date_day, s.closed_date,
         cast(s.closed_date as date) as closed_date_day, l.location_id, s.duplicate, s.legacy_record,
         s.community_area, s.ward, s.parent_sr_number,
         case when s.ward is null or s.created_date is null then null
              when s.created_date < timestamp '1998-05-15' then 'old_map' else 'new_map' end
           as ward_map_version_at_request
  from staged s
  left join types t using (sr_short_code)
  left join locations l using (street_number, street_direction, street_name, street_type)
)"""
