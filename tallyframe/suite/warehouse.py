"""The request warehouse: reports, staging, dimensions, history, upserts, ingest, checks and the daily run."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import hours_crossed, iso_text, round_half_away, safe_double, safe_int, safe_timestamp
from tallyframe.functions.dates import days_crossed
from tallyframe.operators import quality
from tallyframe.operators.history import VALID_FROM, VALID_TO, latest_version, opened, scd2_backfill, scd2_snapshot
from tallyframe.operators.joins import asof_join, asof_merge
from tallyframe.operators.repeats import flag_repeats
from tallyframe.operators.upsert import latest_per_key, upsert
from tallyframe.plans import dimensions, marts
from tallyframe.plans.daily import Warehouse, daily_run, refresh_status_history
from tallyframe.plans.fact import build_fact, not_held
from tallyframe.plans.staging import stage
from tallyframe.plans.validation import closed_before_created, outside_the_city, staging_checks
from tallyframe.sources.delimited import read_seed, write_seed
from tallyframe.sources.landed import as_text_columns, keyset_page, land, rows_after, scan_landed
from tallyframe.sources.shared import settle, shared_path
from tallyframe.sources.versioned import VersionedTable
from tallyframe.streaming.ingest import ingest_landed
from tallyframe.suite import proxies
from tallyframe.suite.proxies import BUILT_FACT_SQL, FACT_SQL, LOCATIONS_SQL, RAW_SELECT, REQUESTS_SQL, STAGED_SQL, TYPES_SQL
from tallyframe.suite.registry import query, table

# -- reports ----------------------------------------------------------------------------------------------------------

_YEARS = range(1995, 2002)


@query("mart_resolution_time", f"""
with {REQUESTS_SQL},
resolved as (
  select community_area, n_name as community_area_name, year(created_date) as y,
         date_diff('hour', created_date, closed_date) / 24.0 as days
  from requests join nation on n_nationkey = community_area
  where closed_date is not null
    and (lower(service_request_type) like '%high%' or lower(service_request_type) like '%urgent%')
),
yearly as (select community_area, community_area_name, y, round(median(days), 1) as d from resolved group by all),
overall as (select community_area, round(median(days), 1) as d from resolved group by all)
select cast(y.community_area as bigint) as community_area, community_area_name,
       {", ".join(f'sum(y.d) filter (y = {y}) as "{y}"' for y in _YEARS)},
       any_value(o.d) as overall_median_days
from yearly y join overall o on o.community_area = y.community_area
group by y.community_area, community_area_name
""")
def mart_resolution_time(spark: SparkSession, sf: str) -> DataFrame:
    rows = proxies.requests(spark, sf, with_area=True)
    return marts.resolution_time(rows, proxies.types(spark, sf), proxies.areas(spark, sf), ("high", "urgent"))


@query("mart_duplicate_ratio", f"""
with {REQUESTS_SQL},
seen as (
  select *, lag(created_date) over (partition by location_id, sr_short_code order by created_date, sr_id) as before
  from requests where location_id is not null and sr_short_code not in ('5')
)
select service_request_type, count(*) as total_requests,
       cast(sum(case when created_date <= before + interval 14 day then 1 else 0 end) as bigint) as duplicate_requests,
       round(100.0 * sum(case when created_date <= before + interval 14 day then 1 else 0 end) / count(*), 2)
         as duplicate_pct
from seen group by service_request_type having count(*) >= 100
order by duplicate_pct desc, service_request_type limit 15
""")
def mart_duplicate_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return marts.duplicate_ratio(proxies.requests(spark, sf), proxies.types(spark, sf), ("5",))


@query("mart_volume_by_era", f"""
with {FACT_SQL},
eras as (
  select ward_map_version_at_request as era, min(created_date) as s, max(created_date) as e
  from fact where ward is not null group by 1
),
counted as (
  select ward, ward_map_version_at_request as era, count(*) as n
  from fact where ward is not null and sr_short_code not in ('5') group by 1, 2
),
ward_rate as (select ward, era, round(n / (date_diff('day', s, e) + 1), 3) as r from counted join eras using (era)),
city_rate as (
  select era, round(sum(n) / (date_diff('day', min(s), min(e)) + 1), 3) as r from counted join eras using (era) group by 1
),
city as (
  select round(100.0 * (max(r) filter (era = 'new_map') - max(r) filter (era = 'old_map'))
               / nullif(max(r) filter (era = 'old_map'), 0), 1) as pct from city_rate
),
wide as (
  select ward, sum(r) filter (era = 'old_map') as o, sum(r) filter (era = 'new_map') as n from ward_rate group by 1
),
changed as (select *, round(100.0 * (n - o) / nullif(o, 0), 1) as pct from wide)
select ward, o as avg_daily_old_map, n as avg_daily_new_map, c.pct as pct_change_old_to_new,
       city.pct as citywide_pct_change, round(c.pct - city.pct, 1) as excess_pct_change_vs_citywide
from changed c, city
""")
def mart_volume_by_era(spark: SparkSession, sf: str) -> DataFrame:
    return marts.volume_by_era(proxies.fact(spark, sf), ("5",))


# -- staging and functions --------------------------------------------------------------------------------------------


@query("stage_requests", f"with {STAGED_SQL} select * from staged")
def stage_requests(spark: SparkSession, sf: str) -> DataFrame:
    return stage(proxies.raw_requests(spark, sf))


@query("boundary_diffs", f"""
with {REQUESTS_SQL}
select sr_id, cast(date_diff('hour', created_date, closed_date) as bigint) as hours,
       cast(date_diff('day', created_date, closed_date) as bigint) as days,
       strftime(created_date, '%Y-%m-%dT%H:%M:%S') as created_text,
       closed_date + interval 14 day as recheck_at
from requests
""")
def boundary_diffs(spark: SparkSession, sf: str) -> DataFrame:
    created, closed = F.col("created_date"), F.col("closed_date")
    return proxies.requests(spark, sf).select(
        "sr_id", hours_crossed(created, closed).alias("hours"), days_crossed(created, closed).alias("days"),
        iso_text(created).alias("created_text"), (closed + F.make_dt_interval(F.lit(14))).alias("recheck_at"),
    )


@query("round_helper", """
select o_orderkey, round(o_totalprice / 7, 1) as one, round(o_totalprice / 7, 2) as two,
       round(-o_totalprice / 1000, 3) as three
from orders
""")
def round_helper(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey", round_half_away(price / 7, 1).alias("one"), round_half_away(price / 7, 2).alias("two"),
        round_half_away(-price / 1000, 3).alias("three"),
    )


_MESSY = """case o_orderkey % 12 when 0 then ' 12 ' when 1 then '1.5' when 2 then '-2.5' when 3 then '1e3' when 4 then ''
 when 5 then 'abc' when 6 then '99999999999' when 7 then '1.5d' when 8 then '2023' when 9 then '2023-01'
 when 10 then '2023-02-30' else cast(o_orderkey as string) end"""


@query("safe_casts", f"""
with messy as (select o_orderkey, {_MESSY} as txt, cast(o_orderdate as string) as day_text from orders)
select o_orderkey, txt, cast(try_cast(txt as integer) as bigint) as as_int, try_cast(txt as double) as as_double,
       try_cast(txt as timestamp) as as_time, try_cast(day_text as timestamp) as as_day
from messy
""")
def safe_casts(spark: SparkSession, sf: str) -> DataFrame:
    messy = table(spark, sf, "orders").selectExpr(
        "o_orderkey", f"{_MESSY} as txt", "cast(o_orderdate as string) as day_text"
    )
    text = F.col("txt")
    return messy.select(
        "o_orderkey", "txt", safe_int(text).alias("as_int"), safe_double(text).alias("as_double"),
        safe_timestamp(text).alias("as_time"), safe_timestamp(F.col("day_text")).alias("as_day"),
    )


# -- dimensions -------------------------------------------------------------------------------------------------------


@query("dim_date", """
with span as (select date_trunc('year', min(o_orderdate)) as a, date_trunc('year', max(o_orderdate)) as z from orders),
days as (
  select cast(unnest(generate_series(a, z + interval 1 year - interval 1 day, interval 1 day)) as date) as d from span
),
seen as (select cast(o_orderdate as date) as d, count(*) as n from orders group by 1)
select d as date_day, year(d) as year, quarter(d) as quarter, month(d) as month, strftime(d, '%B') as month_name,
       strftime(d, '%A') as day_of_week, dayofweek(d) as day_of_week_num,
       strftime(d, '%A') in ('Saturday', 'Sunday') as is_weekend, dayofyear(d) as day_of_year,
       coalesce(n, 0) as orders_placed
from days left join seen using (d)
""")
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """The calendar over the whole years the orders span, with the orders of each day."""
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date_day"))
    placed = days.groupBy("date_day").agg(F.count(F.lit(1)).alias("orders_placed"))
    bounds = days.agg(
        F.make_date(F.year(F.min("date_day")), F.lit(1), F.lit(1)).alias("first"),
        F.make_date(F.year(F.max("date_day")), F.lit(12), F.lit(31)).alias("last"),
    )
    joined = dimensions.calendar_of(bounds).join(placed, "date_day", "left")
    return joined.withColumn("orders_placed", F.coalesce("orders_placed", F.lit(0)))


@query("dim_location", f"with {STAGED_SQL},{LOCATIONS_SQL} select * from locations")
def dim_location(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.locations(stage(proxies.raw_requests(spark, sf)))


@query("dim_type", f"with {STAGED_SQL},{TYPES_SQL} select * from types")
def dim_type(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.request_types(stage(proxies.raw_requests(spark, sf)))


@query("dim_type_all_names", f"""
with {STAGED_SQL} select distinct sr_short_code, service_request_type from staged where sr_short_code is not null
""")
def dim_type_all_names(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.request_types(stage(proxies.raw_requests(spark, sf)), one_name=False)


@query("dim_area", "select cast(n_nationkey as bigint) as community_area, n_name as community_area_name from nation")
def dim_area(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.areas(proxies.areas(spark, sf))


@query("seed_load", """
select cast(n_nationkey as bigint) as n_nationkey, n_name, cast(n_regionkey as bigint) as n_regionkey from nation
""")
def seed_load(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "seed")
    write_seed(table(spark, sf, "nation"), path)
    return read_seed(spark, path, "n_nationkey int, n_name string, n_regionkey int")


# -- fact and history -------------------------------------------------------------------------------------------------


def _built_fact(spark: SparkSession, sf: str) -> DataFrame:
    staged = stage(proxies.raw_requests(spark, sf))
    types = settle(dimensions.request_types(staged), "types")
    wards = scd2_backfill(dimensions.wards(staged), "ward", proxies.ward_versions(spark), "map_version", "effective_from")
    places = settle(dimensions.locations(staged), "locations")
    return build_fact(staged, types, settle(wards, "ward-history"), places)


@query("fact_requests", f"with {BUILT_FACT_SQL} select * from built")
def fact_requests(spark: SparkSession, sf: str) -> DataFrame:
    return _built_fact(spark, sf)


@query("asof_join_era", f"with {FACT_SQL} select sr_id, ward, created_date, ward_map_version_at_request from fact")
def asof_join_era(spark: SparkSession, sf: str) -> DataFrame:
    rows = proxies.requests(spark, sf).select("sr_id", "ward", "created_date")
    history = proxies.ward_history(spark, sf)
    joined = asof_join(rows, history, "ward", "created_date", VALID_FROM, VALID_TO, ["map_version"])
    return joined.withColumnRenamed("map_version", "ward_map_version_at_request")


@query("ward_backfill", f"""
with {REQUESTS_SQL}
select ward, map_version, md5(ward || '-' || map_version) as dbt_scd_id, since as dbt_updated_at,
       since as dbt_valid_from, until as dbt_valid_to
from (select distinct ward from requests where ward is not null),
     (values ('old_map', timestamp '1900-01-01', timestamp '1998-05-15'),
             ('new_map', timestamp '1998-05-15', null)) v(map_version, since, until)
""")
def ward_backfill(spark: SparkSession, sf: str) -> DataFrame:
    wards = dimensions.wards(proxies.requests(spark, sf))
    return scd2_backfill(wards, "ward", proxies.ward_versions(spark), "map_version", "effective_from")


_FIRST, _SECOND = datetime(2002, 1, 1), datetime(2002, 1, 2)


@query("ward_snapshot", f"""
with {REQUESTS_SQL}, wards as (select distinct ward from requests where ward is not null)
select ward, 'old_map' as map_version, timestamp '2002-01-01' as dbt_valid_from, timestamp '2002-01-02' as dbt_valid_to
from wards
union all
select ward, 'new_map', timestamp '2002-01-02', null from wards
""")
def ward_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshot the wards under the version in force, before and after the second version takes effect."""
    wards = dimensions.wards(proxies.requests(spark, sf))
    versions = proxies.ward_versions(spark)
    history = None
    for now, known in ((_FIRST, versions.where("map_version = 'old_map'")), (_SECOND, versions)):
        in_force = latest_version(known, "map_version", "effective_from").scalar()
        history = scd2_snapshot(history, wards.withColumn("map_version", in_force), "ward", ["map_version"], now)
    return history.select("ward", "map_version", VALID_FROM, VALID_TO)


_DEAR, _LATEST = 400_000, datetime(2001, 6, 1)


@query("scd2_snapshot", f"""
with first_state as (
  select o_orderkey as k, o_orderstatus as s, o_totalprice as p from orders where o_orderdate < timestamp '{_LATEST}'
),
second_state as (
  select o_orderkey as k, case when o_totalprice > {_DEAR} then 'X' else o_orderstatus end as s, o_totalprice + 1 as p
  from orders where o_orderstatus <> 'P' or o_orderpriority <> '5-LOW'
),
entries as (
  select f.k, f.s, f.p, timestamp '2002-01-01' as dbt_valid_from,
         case when n.s is distinct from f.s and n.k is not null then timestamp '2002-01-02' end as dbt_valid_to
  from first_state f left join second_state n using (k)
  union all
  select n.k, n.s, n.p, timestamp '2002-01-02', null
  from second_state n left join first_state f using (k) where f.k is null or n.s is distinct from f.s
)
select k as sr_id, s as status, p as price, md5(k || '-' || cast(dbt_valid_from as varchar)) as dbt_scd_id,
       dbt_valid_from as dbt_updated_at, dbt_valid_from, dbt_valid_to
from entries
""")
def scd2_snapshot_query(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as two daily states: the latest appear, cheap pending ones vanish, dear ones change status, and all change
    a column that is not checked."""
    orders = table(spark, sf, "orders")
    key, status, price = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_totalprice")
    before = orders.where(F.col("o_orderdate") < F.lit(_LATEST).cast("timestamp_ntz")).select(
        key.alias("sr_id"), status.alias("status"), price.alias("price")
    )
    after = orders.where((status != "P") | (F.col("o_orderpriority") != "5-LOW")).select(
        key.alias("sr_id"), F.when(price > _DEAR, "X").otherwise(status).alias("status"), (price + 1).alias("price")
    )
    return scd2_snapshot(opened(before, "sr_id", _FIRST), after, "sr_id", ["status"], _SECOND)


# -- upserts ----------------------------------------------------------------------------------------------------------

_UPSERTED = """
select o_orderkey, o_custkey, o_orderdate,
       case when o_orderdate >= timestamp '1998-01-01' then o_totalprice + 1 else o_totalprice end as o_totalprice,
       case when o_orderdate >= timestamp '1998-01-01' then o_orderpriority end as o_orderpriority
from orders
"""


def _overlapping_loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders before 1999 without their priority, then orders from 1998 on at another price and with priority."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"
    )
    first = orders.where("o_orderdate < timestamp_ntz '1999-01-01'").drop("o_orderpriority")
    second = orders.where("o_orderdate >= timestamp_ntz '1998-01-01'")
    return first, second.withColumn("o_totalprice", F.col("o_totalprice") + 1)


@query("upsert_by_key", _UPSERTED)
def upsert_by_key(spark: SparkSession, sf: str) -> DataFrame:
    first, second = _overlapping_loads(spark, sf)
    return upsert(first, second, "o_orderkey")


@query("versioned_merge", _UPSERTED)
def versioned_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The same through a stored table with yearly slots; the second load is merged twice to show that it may be."""
    stored = VersionedTable(spark, shared_path(spark, "orders"), "year(o_orderdate)")
    first, second = _overlapping_loads(spark, sf)
    stored.replace(first)
    stored.merge(second, "o_orderkey", tag=("orders", 1))
    stored.merge(second.withColumn("o_totalprice", F.lit(0.0)), "o_orderkey", tag=("orders", 1))
    return stored.read()


@query("upsert_dup_batch", """
with newest as (
  select * from lineitem qualify 1 = row_number() over (
    partition by l_orderkey order by l_shipdate desc, l_linenumber desc, l_partkey desc, l_quantity desc)
)
select l_orderkey as order_id, l_shipdate as last_seen, l_partkey as part, l_quantity as quantity from newest
union all
select o_orderkey, o_orderdate, null, 0.0 from orders where o_orderkey not in (select l_orderkey from lineitem)
""")
def upsert_dup_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A batch with many rows per key into a table of orders: the newest row of each key goes in."""
    target = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("last_seen"),
        F.lit(None).cast("bigint").alias("part"), F.lit(0.0).alias("quantity"),
    )
    batch = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("last_seen"), "l_linenumber",
        F.col("l_partkey").alias("part"), F.col("l_quantity").alias("quantity"),
    )
    newest = latest_per_key(batch, "order_id", ["last_seen", "l_linenumber", "part", "quantity"])
    return upsert(target, newest.drop("l_linenumber"), "order_id", deduplicate=False)


@query("incremental_fact", f"""
with {REQUESTS_SQL}
select sr_id, sr_short_code, status, created_date, coalesce(closed_date, created_date) as last_modified_date
from requests
""")
def incremental_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Load a fact with the state at a cut-off, without some rows that land late, then merge what it does not hold."""
    modified = F.coalesce("closed_date", "created_date")
    final = proxies.requests(spark, sf).select(
        "sr_id", "sr_short_code", "status", "created_date", modified.alias("last_modified_date")
    )
    cut = F.lit(datetime(1999, 1, 1)).cast("timestamp_ntz")
    seen = final.where((F.col("created_date") <= cut) & (F.col("sr_id") % 29 != 3))
    unfinished = F.col("last_modified_date") > cut
    earlier = seen.withColumns({
        "status": F.when(unfinished, "open").otherwise(F.col("status")),
        "last_modified_date": F.when(unfinished, F.col("created_date")).otherwise(F.col("last_modified_date")),
    })
    stored = VersionedTable(spark, shared_path(spark, "fact"), "year(created_date)")
    stored.replace(earlier)
    changed = not_held(final, stored.read(), columns=["status", "last_modified_date"])
    stored.merge(changed, "sr_id", ["last_modified_date"], stays_in_slot=True)
    return stored.read()


# -- sources and ingest -----------------------------------------------------------------------------------------------


@query("ingest_available_now", """
select cast(event_id as varchar) as event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') as created_date,
       case when ts < timestamp '2024-01-20' and ts >= timestamp '2024-01-10' then 'late ' || event_type
            else event_type end as event_type,
       case when ts >= timestamp '2024-01-10' then props end as props
from events
""")
def ingest_available_now(spark: SparkSession, sf: str) -> DataFrame:
    """Two landings with overlapping keys and a new column in the second, each picked up by its own run; then the rest under
    a new checkpoint, which reads everything again in several batches."""
    events = table(spark, sf, "events")
    text = events.select("event_id", iso_text(F.col("ts")).alias("created_date"), "event_type", "ts", "props")
    early = text.where("ts < timestamp_ntz '2024-01-20'").drop("props").withColumn("state", F.lit(1))
    late = text.where("ts >= timestamp_ntz '2024-01-10'").withColumn("state", F.lit(2))
    relabelled = F.when(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"), F.concat(F.lit("late "), "event_type"))
    late = late.withColumn("event_type", F.coalesce(relabelled, "event_type")).drop("ts")
    held = F.col("event_id") % 7 == 3
    only_early = early.where(held & (F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz"))).drop("ts")
    rest = late.where(held).unionByName(only_early, allowMissingColumns=True)
    early, late = early.where(~held).drop("ts"), late.where(~held)
    landing = shared_path(spark, "landing")
    raw = VersionedTable(spark, shared_path(spark, "raw"), "substr(created_date, 1, 10)")
    once, anew = shared_path(spark, "checkpoint"), shared_path(spark, "checkpoint")
    for run, rows, checkpoint, at_most in (
        ("first", early, once, 100), ("second", late, once, 100), ("nothing-new", None, once, 100), ("rest", rest, anew, 2)
    ):
        if rows is not None:
            land(rows, landing, run)
        ingest_landed(spark, landing, raw, None, checkpoint, "event_id", ("state",), max_files=at_most)
    return raw.read().drop("state")


@query("bronze_roundtrip", """
select cast(event_id as varchar) as event_id, cast(ts as varchar) as ts, cast(user_id as varchar) as user_id, event_type,
       '{"type":"' || event_type || '","user":' || user_id || '}' as who,
       '["' || event_type || '","' || event_id || '"]' as labels, props
from events
""")
def bronze_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Records with nested values landed as text and scanned back."""
    nested = table(spark, sf, "events").select(
        "event_id", "ts", "user_id", "event_type",
        F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user")).alias("who"),
        F.array("event_type", F.col("event_id").cast("string")).alias("labels"), "props",
    )
    landing = shared_path(spark, "landing")
    land(nested, landing, "only")
    return scan_landed(spark, landing)


@query("union_by_name", """
select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, null as o_totalprice,
       o_orderpriority
from orders where o_orderstatus = 'F'
union all
select cast(o_orderkey as varchar), null, cast(o_totalprice as varchar), o_orderpriority
from orders where o_orderstatus <> 'F'
""")
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Two landed files with different columns read as one table."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    done = F.col("o_orderstatus") == "F"
    landing = shared_path(spark, "landing")
    land(orders.where(done).drop("o_totalprice", "o_orderstatus"), landing, "a")
    land(orders.where(~done).drop("o_custkey", "o_orderstatus"), landing, "b")
    return scan_landed(spark, landing)


@query("rows_after_cursor", "select event_id, ts, user_id from events where ts > timestamp '2024-01-10 00:00:00'")
def rows_after_cursor(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts", "user_id")
    return rows_after(events, "ts", F.lit(datetime(2024, 1, 10)).cast("timestamp_ntz"))


@query("keyset_page", """
select event_id, ts, event_type from events
where ts > timestamp '2024-01-10' or (ts = timestamp '2024-01-10' and event_id > 5)
order by ts, event_id limit 200 offset 400
""")
def keyset_page_query(spark: SparkSession, sf: str) -> DataFrame:
    """The third page, each found from the last row of the one before."""
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    after = (datetime(2024, 1, 10), 5)
    for _ in range(2):
        page = keyset_page(events, "ts", "event_id", after, 200)
        after = tuple(page.agg(F.max(F.struct("ts", "event_id")).alias("last")).select("last.*").first())
    return keyset_page(events, "ts", "event_id", after, 200)


# -- checks -----------------------------------------------------------------------------------------------------------


@query("dq_report", f"""
with {STAGED_SQL}, refs as (select * from nation where n_regionkey <> 3)
select 'sr_id.unique' as check_name, 'error' as severity,
       (select count(*) from (select sr_id from staged where sr_id is not null group by 1 having count(*) > 1)) as failures
union all select 'sr_id.not_null', 'error', (select count(*) from staged where sr_id is null)
union all select 'created_date.not_null', 'error', (select count(*) from staged where created_date is null)
union all select 'status.accepted', 'error', (select count(*) from staged where status not in ('open', 'completed'))
union all select 'area.known', 'warn', (select count(*) from staged where community_area is not null
                                        and community_area not in (select n_nationkey from refs))
union all select 'closed_after_created', 'warn', (select count(*) from staged where closed_date < created_date)
union all select 'coordinates_in_city', 'error', (select count(*) from staged where latitude is not null and longitude
                  is not null and (latitude not between 41.6 and 42.05 or longitude not between -87.95 and -87.5))
union all select 'parent.unique', 'warn',
       (select count(*) from (select ward from staged where ward is not null group by 1 having count(*) > 1))
""")
def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    staged = stage(proxies.raw_requests(spark, sf))
    known = table(spark, sf, "nation").where("n_regionkey <> 3")
    return quality.report([
        quality.unique("sr_id.unique", staged, "sr_id"),
        quality.not_null("sr_id.not_null", staged, "sr_id"),
        quality.not_null("created_date.not_null", staged, "created_date"),
        quality.accepted_values("status.accepted", staged, "status", ["open", "completed"]),
        quality.relationship("area.known", staged, "community_area", known, "n_nationkey", quality.WARN),
        closed_before_created(staged),
        outside_the_city(staged),
        quality.unique("parent.unique", staged, "ward", quality.WARN),
    ])


@query("dq_offending_rows", f"""
with {STAGED_SQL}
select sr_id, latitude, longitude from staged where latitude is not null and longitude is not null
  and (latitude not between 41.6 and 42.05 or longitude not between -87.95 and -87.5)
""")
def dq_offending_rows(spark: SparkSession, sf: str) -> DataFrame:
    staged = stage(proxies.raw_requests(spark, sf))
    return outside_the_city(staged).failing.select("sr_id", "latitude", "longitude")


@query("repeat_within_window", f"""
with {REQUESTS_SQL}
select sr_id, location_id, sr_short_code, created_date, exists (
         select 1 from requests p
         where p.location_id = r.location_id and p.sr_short_code = r.sr_short_code
           and (p.created_date < r.created_date or (p.created_date = r.created_date and p.sr_id < r.sr_id))
           and r.created_date <= p.created_date + interval 14 day) as is_repeat
from requests r
""")
def repeat_within_window(spark: SparkSession, sf: str) -> DataFrame:
    rows = proxies.requests(spark, sf).select("sr_id", "location_id", "sr_short_code", "created_date")
    return flag_repeats(rows, ["location_id", "sr_short_code"], "created_date", 14, "sr_id", "is_repeat")


# -- all together -----------------------------------------------------------------------------------------------------


_CUT = "1999-06-01T00:00:00"
_DAYS = datetime(2002, 1, 1), datetime(2002, 1, 2)

#: What `_land_day` lands on either day.
_LANDED_SQL = f"""
raw as (
  select {RAW_SELECT}, k, strftime(o_orderdate, '%Y-%m-%d') as ordered, k % 29 = 3 as held
  from (select *, o_orderkey as k, o_custkey as c from orders)
),
landed as (
  select 1 as day, k, sr_number, created_date, status from raw where last_modified_date < '{_CUT}' and not held
  union all
  select 1, k, sr_number, created_date, 'Open' from raw where last_modified_date >= '{_CUT}' and ordered < '{_CUT}' and not held
  union all
  select 2, k, sr_number, created_date, status from raw where last_modified_date >= '{_CUT}' or held
),
keyless as (select * from landed where sr_number is null or trim(sr_number) = '')"""


def _land_day(spark: SparkSession, sf: str, landing: str, day: int) -> None:
    """Day 1: requests as they stood at a cut-off, without some that land late. Day 2: those, and the changed and new ones."""
    raw = proxies.raw_requests(spark, sf, "date_format(o_orderdate, 'yyyy-MM-dd') as ordered", "k % 29 = 3 as held")
    late, held = F.col("last_modified_date") >= _CUT, F.col("held")
    if day == 1:
        unfinished = raw.where(late & ~held & (F.col("ordered") < _CUT)).withColumns({
            "status": F.lit("Open"), "closed_date": F.lit(None).cast("string"),
            "last_modified_date": F.concat("ordered", F.lit("T00:00:00")),
        })
        rows = raw.where(~late & ~held).unionByName(unfinished)
    else:
        rows = raw.where(late | held)
    land(rows.drop("ordered", "held"), landing, f"day-{day}")


def _loaded(
    spark: SparkSession, sf: str, then: Callable[[Warehouse, int], None] = lambda warehouse, day: None,
) -> Warehouse:
    """A warehouse whose raw table has both days' landings, each loaded by a run of its own."""
    landing, warehouse = shared_path(spark, "landing"), Warehouse(spark, shared_path(spark, "warehouse"))
    for day in (1, 2):
        _land_day(spark, sf, landing, day)
        ingest_landed(spark, landing, warehouse.raw, warehouse.cursors, f"{warehouse.root}/bronze/checkpoint",
                      source="requests", rejected=warehouse.rejected, ledger=warehouse.ledger)
        then(warehouse, day)
    return warehouse


@query("bronze_after_merges", f"""
with {_LANDED_SQL} select raw.* exclude (k, ordered, held) from raw where trim(sr_number) <> ''
""")
def bronze_after_merges(spark: SparkSession, sf: str) -> DataFrame:
    """The raw table after two days, also the rows without a proper creation date."""
    return _loaded(spark, sf).raw.read()


@query("rejected_rows", f"""
with {_LANDED_SQL} select created_date, status, count(*) as copies from keyless group by all
""")
def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Landed rows without a key, of both days."""
    found = _loaded(spark, sf).rejected.read()
    return found.groupBy("created_date", "status").agg(F.sum("copies").alias("copies"))


@query("landed_ledger", f"""
with {_LANDED_SQL}
select day::integer as day, count(*) as records, true as has_status from landed group by day
""")
def landed_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """What the account of loaded files says of either day's landing: its rows, and whether its files have a status."""
    files = _loaded(spark, sf).ledger.read()
    day = F.regexp_extract("path", "/day-([0-9]+)/", 1).cast("int").alias("day")
    return files.groupBy(day).agg(F.sum("records").alias("records"), F.bool_and(F.array_contains("columns", "status")).alias("has_status"))


@query("cursor_after_runs", f"""
with {_LANDED_SQL}
select 0 as day, timestamp '2023-01-01' as last_run_date
union all select 1, max(try_cast(created_date as timestamp)) from landed where day = 1
union all select 2, max(try_cast(created_date as timestamp)) from landed
""")
def cursor_after_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The cursor of a source never read, and that of the requests after either day."""
    found = []

    def look(warehouse: Warehouse, day: int) -> None:
        if day == 1:
            found.append((0, warehouse.cursors.get("never read")))
        found.append((day, warehouse.cursors.get("requests")))

    _loaded(spark, sf, look)
    return spark.createDataFrame(found, "day int, last_run_date timestamp_ntz")


@query("rows_after_load", f"""
with {_LANDED_SQL}, days as (select unnest([1, 2]) as upto)
select upto as day,
       (select count(distinct sr_number) from landed where day <= upto and trim(sr_number) <> '') as stored,
       (select count(*) from keyless where day <= upto) as rejected
from days
""")
def rows_after_load(spark: SparkSession, sf: str) -> DataFrame:
    """Rows stored and rejected after either day."""
    found = []

    def look(warehouse: Warehouse, day: int) -> None:
        lost = warehouse.rejected.read().agg(F.sum("copies")).first()[0] if warehouse.rejected.exists() else 0
        found.append((day, warehouse.raw.count(), lost))

    _loaded(spark, sf, look)
    return spark.createDataFrame(found, "day int, stored bigint, rejected bigint")


@query("status_history", f"""
with {_LANDED_SQL}, states as (
  select day, trim(sr_number) as sr_id, replace(lower(trim(status)), 'closed', 'completed') as status
  from landed where trim(sr_number) <> ''
),
one as (select sr_id, status from states where day = 1),
two as (select sr_id, status from states where day = 2)
select sr_id, one.status, timestamp '2002-01-01' as dbt_valid_from,
       case when two.sr_id is not null and two.status is distinct from one.status then timestamp '2002-01-02' end
         as dbt_valid_to
from one left join two using (sr_id)
union all
select sr_id, two.status, timestamp '2002-01-02', null
from two left join one using (sr_id) where one.sr_id is null or two.status is distinct from one.status
""")
def status_history(spark: SparkSession, sf: str) -> DataFrame:
    """The statuses of every request over two days."""
    warehouse = _loaded(spark, sf, lambda warehouse, day: refresh_status_history(warehouse, _DAYS[day - 1]))
    return warehouse.status_history.read().select("sr_id", "status", VALID_FROM, VALID_TO)


@query("enforce_outcome", f"""
with {STAGED_SQL}, failed as (
  select 'staged.sr_id.unique' as check_name,
         (select count(*) from (select sr_id from staged where sr_id is not null group by 1 having count(*) > 1)) as n
  union all select 'staged.sr_id.not_null', (select count(*) from staged where sr_id is null)
  union all select 'staged.created_date.not_null', (select count(*) from staged where created_date is null)
  union all select 'staged.status.accepted',
                   (select count(*) from staged where status not in ('open', 'completed', 'canceled'))
  union all select 'coordinates_in_city',
                   (select count(*) from staged where latitude is not null and longitude is not null
                    and (latitude not between 41.6 and 42.05 or longitude not between -87.95 and -87.5))
)
select 'all' as checks, count(*) > 0 as raised,
       coalesce(string_agg(check_name || ': ' || n || ' rows', '; ' order by check_name), '') as message
from failed where n > 0
union all select 'warnings only', false, ''
""")
def enforce_outcome(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a run would stop, and why: error checks with offending rows stop it, warnings do not."""
    checks = staging_checks(stage(proxies.raw_requests(spark, sf)))
    warnings = [c for c in checks if c.severity == quality.WARN]
    found = []
    for name, some in (("all", checks), ("warnings only", warnings)):
        try:
            quality.enforce(quality.report(some))
            found.append((name, False, ""))
        except quality.CheckFailed as e:
            found.append((name, True, str(e)))
    return spark.createDataFrame(found, "checks string, raised boolean, message string")


def _two_days(spark: SparkSession, sf: str) -> Warehouse:
    """The whole warehouse after the runs of both days."""
    landing, root = shared_path(spark, "landing"), shared_path(spark, "warehouse")
    for day, now in enumerate(_DAYS, 1):
        _land_day(spark, sf, landing, day)
        daily_run(spark, root, landing, proxies.ward_versions(spark), proxies.areas(spark, sf), now, checked=False)
    return Warehouse(spark, root)


@query("daily_report", f"""
with {BUILT_FACT_SQL},
fact as (select * from built where sr_id is not null),
kept as (select * from staged where sr_id is not null),
lost as (
  select count(*) filter (last_modified_date >= '{_CUT}' or held)
       + count(*) filter (not held and (last_modified_date < '{_CUT}' or ordered < '{_CUT}')) as n
  from (select {RAW_SELECT}, strftime(o_orderdate, '%Y-%m-%d') as ordered, k % 29 = 3 as held
        from (select *, o_orderkey as k, o_custkey as c from orders))
  where sr_number is null or trim(sr_number) = ''
)
select 'landed.key.present' as check_name, 'error' as severity, n as failures from lost
union all select 'staged.created_date.not_null', 'error', count(*) from kept where created_date is null
union all select 'staged.community_area.not_null', 'warn', count(*) from kept where community_area is null
union all select 'staged.status.accepted', 'error', count(*) from kept where status not in ('open', 'completed', 'canceled')
union all select 'closed_after_created', 'warn', count(*) from kept where closed_date < created_date
union all select 'coordinates_in_city', 'error', count(*) from kept where latitude is not null and longitude is not null
  and (latitude not between 41.6 and 42.05 or longitude not between -87.95 and -87.5)
union all select 'fact.community_area.known', 'warn', count(*) from fact
  where community_area is not null and community_area not in (select n_nationkey from nation)
union all select 'fact.created_date_day.known', 'error', count(created_date) from fact
union all select 'fact.last_modified_date_day.known', 'error', count(last_modified_date) from fact
union all select 'fact.closed_date_day.known', 'error', count(closed_date) from fact
union all select unnest(['staged.sr_id.unique', 'staged.sr_id.not_null', 'fact.sr_id.unique', 'fact.sr_id.not_null',
  'fact.sr_short_code.known', 'types.sr_short_code.unique', 'types.sr_short_code.not_null',
  'areas.community_area.unique', 'areas.community_area.not_null', 'locations.location_id.unique',
  'locations.location_id.not_null', 'calendar.date_day.unique', 'calendar.date_day.not_null']), 'error', 0
union all select 'fact.location_id.known', 'warn', 0
""")
def daily_report(spark: SparkSession, sf: str) -> DataFrame:
    """The stored check report after two days; the calendar starts after the orders, so no day of theirs is known to it."""
    return _two_days(spark, sf).gold("check_report").read()


@query("daily_run", f"""
with {BUILT_FACT_SQL}
select b.* exclude (location_id), l.street_number, l.street_name, l.city
from built b left join locations l using (location_id)
where b.sr_id is not null
""")
def daily_run_query(spark: SparkSession, sf: str) -> DataFrame:
    """Two days of the whole warehouse: first the requests as they stood at a cut-off, then the changed, late and new ones.

    The stored fact must end up as if everything had been loaded at once.
    """
    warehouse = _two_days(spark, sf)
    places = warehouse.gold("locations").read().select("location_id", "street_number", "street_name", "city")
    return warehouse.fact.read().join(places, "location_id", "left").drop("location_id")


@query("daily_repeats", f"""
with {BUILT_FACT_SQL},
placed as (
  select *, cast(floor(date_diff('day', date '1970-01-01', cast(created_date as date)) / 14.0) as bigint) as time_slice
  from built where sr_id is not null and location_id is not null and sr_short_code not in ('311IOC', 'AVN')
),
seen as (
  select *, lag(created_date) over (partition by location_id, sr_short_code order by created_date nulls last, sr_id) as before
  from placed
)
select t.service_request_type, sr_short_code, time_slice, count(*) as total_requests,
       cast(sum(case when created_date <= before + interval 14 day then 1 else 0 end) as bigint) as repeats
from seen join types t using (sr_short_code) group by all
""")
def daily_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Requests and repeats of each type and two weeks as the warehouse keeps them after two days; only what the second day
    touches is made anew on it."""
    warehouse = _two_days(spark, sf)
    totals = warehouse.repeats.read().withColumnRenamed("rows", "total_requests")
    return totals.join(warehouse.gold("types").read(), "sr_short_code")


@query("asof_long_history", """
with marks as (select event_type as kind, ts as since, max(event_id) as mark from events where user_id % 10 = 0 group by all),
lasting as (select *, lead(since) over (partition by kind order by since) as until from marks)
select e.event_id, e.event_type, e.ts, m.mark as last_mark
from events e left join lasting m
  on m.kind = e.event_type and m.since <= e.ts and (m.until is null or e.ts < m.until)
""")
def asof_long_history(spark: SparkSession, sf: str) -> DataFrame:
    """Each event with the last one of its type, so far, that a user of every tenth number made: few keys, very many versions."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", "user_id")
    marks = events.where("user_id % 10 = 0").groupBy("event_type", F.col("ts").alias("since")).agg(F.max("event_id").alias("last_mark"))
    lasting = marks.withColumn("until", F.lit(None).cast("timestamp_ntz"))
    return asof_merge(events.drop("user_id"), lasting, "event_type", "ts", "since", "until", ["last_mark"])
