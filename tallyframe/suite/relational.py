"""Selections, predicates, joins, sets, counts, rankings and order."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import ordinal, round_half_away
from tallyframe.operators import aggregates, joins, positions
from tallyframe.plans import selections
from tallyframe.suite.registry import query, table

# -- books, rooms and trains ------------------------------------------------------------------------------------------

_BOOKS = """books as (
  select p_partkey as id, p_name as title, p_brand as author, cast(1975 + p_size as bigint) as year, p_type as genre
  from part
)"""
_ROOMS = """rooms as (
  select c_custkey as id, case c_custkey % 3 when 0 then 'single' when 1 then 'double' else 'suite' end as type,
         case when c_acctbal > 3000 then 'vacant' else 'taken' end as status, cast(c_nationkey as bigint) as floor,
         round(abs(c_acctbal) / 32, 0) as price_per_night
  from customer
)"""
_TRAINS = """trains as (
  select event_id as id, event_type as origin, 'Stop ' || user_id % 20 as destination,
         case when event_id % 50 = 0 then null else strftime(ts, '%H:%M') end as departure,
         round(abs(value), 0) as duration_min
  from events
)"""


def _books(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("author"),
        (F.col("p_size") + 1975).alias("year"), F.col("p_type").alias("genre"),
    )


def _rooms(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("c_custkey") % 3
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(kind == 0, "single").when(kind == 1, "double").otherwise("suite").alias("type"),
        F.when(F.col("c_acctbal") > 3000, "vacant").otherwise("taken").alias("status"),
        F.col("c_nationkey").alias("floor"),
        round_half_away(F.abs("c_acctbal") / 32, 0).alias("price_per_night"),
    )


def _trains(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("origin"),
        F.concat(F.lit("Stop "), (F.col("user_id") % 20).cast("string")).alias("destination"),
        F.when(F.col("event_id") % 50 != 0, F.date_format("ts", "HH:mm")).alias("departure"),
        round_half_away(F.abs("value"), 0).alias("duration_min"),
    )


_SELECTIONS = {
    "books_by_title": (_books, _BOOKS, selections.books_by_title, {}, "title, author from books order by title"),
    "books_after": (_books, _BOOKS, selections.books_after, {}, "* from books where year > 2000"),
    "books_of_genre": (
        _books, _BOOKS, selections.books_of_genre, {"genre": "ECONOMY"},
        "* from books where genre = 'ECONOMY' order by year desc"),
    "newest_books": (
        _books, _BOOKS, selections.newest_books, {"ties": ("id",)}, "* from books order by year desc, id limit 3"),
    "vacant_rooms": (_rooms, _ROOMS, selections.vacant_rooms, {}, "* from rooms where status = 'vacant'"),
    "rooms_priced": (
        _rooms, _ROOMS, selections.rooms_priced, {}, "* from rooms where price_per_night between 80 and 150"),
    "vacant_rooms_of": (
        _rooms, _ROOMS, selections.vacant_rooms_of, {},
        "* from rooms where (type = 'double' or type = 'suite') and status = 'vacant'"),
    "upper_rooms": (
        _rooms, _ROOMS, selections.upper_rooms, {}, "* from rooms where floor >= 3 and price_per_night >= 100"),
    "rooms_by_floor": (
        _rooms, _ROOMS, selections.rooms_by_floor, {}, "* from rooms order by floor, price_per_night desc"),
    "trains_from": (
        _trains, _TRAINS, selections.trains_from, {"origin": "error"}, "* from trains where origin = 'error'"),
    "trains_between": (
        _trains, _TRAINS, selections.trains_between, {}, "* from trains where departure between '08:00' and '12:00'"),
    "long_trains": (_trains, _TRAINS, selections.long_trains, {"minutes": 9}, "* from trains where duration_min > 9"),
    "trains_by_departure": (
        _trains, _TRAINS, selections.trains_by_departure, {}, "* from trains order by departure, destination"),
    "trains_with_period": (
        _trains, _TRAINS, selections.trains_with_period, {},
        "*, case when departure < '12:00' then 'Morning' when departure between '12:00' and '17:00' then 'Afternoon' "
        "else 'Evening' end as period from trains"),
}


def _register_selections() -> None:
    for name, (source, cte, select, arguments, sql) in _SELECTIONS.items():
        query(name, f"with {cte} select {sql}")(
            lambda spark, sf, source=source, select=select, arguments=arguments: select(source(spark, sf), **arguments)
        )


_register_selections()

# -- projections and predicates ---------------------------------------------------------------------------------------


@query("case_bucket", """
select o_orderkey, o_totalprice, case when o_totalprice < 100000 then 'junior' when o_totalprice >= 300000 then 'senior'
       else 'mid' end as bracket
from orders
""")
def case_bucket(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("o_totalprice")
    bracket = F.when(price < 100000, "junior").when(price >= 300000, "senior").otherwise("mid")
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice", bracket.alias("bracket"))


@query("conditional_update", """
select p_partkey, p_name, case when p_retailprice > 1000 then p_retailprice - p_retailprice / 10 else p_retailprice end
       as p_retailprice
from part where p_size <> 0
""")
def conditional_update(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("p_retailprice")
    reduced = F.when(price > 1000, price - price / 10).otherwise(price)
    return table(spark, sf, "part").where("p_size <> 0").select("p_partkey", "p_name", reduced.alias("p_retailprice"))


@query("predicates_mix", """
select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority,
       o_orderstatus = 'F' and o_totalprice <= 200000 as settled_small
from orders
where (o_orderstatus = 'O' or o_orderstatus = 'F') and o_totalprice between 50000 and 300000
  and o_totalprice not between 100000 and 110000 and o_orderpriority not in ('3-MEDIUM')
  and (lower(o_orderpriority) like '%high%' or starts_with(o_orderpriority, '1') or o_orderpriority in ('5-LOW'))
  and o_orderdate is not null and o_orderkey <> o_custkey
""")
def predicates_mix(spark: SparkSession, sf: str) -> DataFrame:
    status, price, priority = F.col("o_orderstatus"), F.col("o_totalprice"), F.col("o_orderpriority")
    kept = table(spark, sf, "orders").where(
        ((status == "O") | (status == "F"))
        & price.between(50000, 300000)
        & ~price.between(100000, 110000)
        & ~priority.isin("3-MEDIUM")
        & (F.lower(priority).like("%high%") | priority.startswith("1") | priority.isin("5-LOW"))
        & F.col("o_orderdate").isNotNull()
        & (F.col("o_orderkey") != F.col("o_custkey"))
    )
    small = (status == "F") & (price <= 200000)
    return kept.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", small.alias("settled_small"))


# -- joins ------------------------------------------------------------------------------------------------------------


@query("orphans_anti_join", """
select o_custkey, o_orderkey, o_totalprice from orders
where o_custkey is not null and o_custkey not in (select c_custkey from customer where c_acctbal > 0)
""")
def orphans_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    solvent = table(spark, sf, "customer").where("c_acctbal > 0").select("c_custkey")
    return joins.orphan_rows(orders, solvent, "o_custkey", "c_custkey")


@query("semi_join_keys", """
select o_custkey, o_orderkey from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')
""")
def semi_join_keys(spark: SparkSession, sf: str) -> DataFrame:
    builders = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    return joins.member_rows(table(spark, sf, "orders").select("o_custkey", "o_orderkey"), builders, "o_custkey", "c_custkey")


@query("lookup_default", """
select o_custkey, o_orderkey, coalesce(c_name, 'Not found') as c_name
from orders left join (select * from customer where c_acctbal > 0) on c_custkey = o_custkey
""")
def lookup_default(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    book = table(spark, sf, "customer").where("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey")
    return joins.lookup_or(orders, book, "o_custkey", "c_name", F.lit("Not found"))


@query("restock", """
select p_partkey, p_name, cast(p_size + coalesce(n, 0) as bigint) as qty
from part left join (select l_partkey, cast(sum(l_quantity) as bigint) as n from lineitem group by 1) on l_partkey = p_partkey
""")
def restock(spark: SparkSession, sf: str) -> DataFrame:
    stock = table(spark, sf, "part").select("p_partkey", "p_name", F.col("p_size").cast("bigint").alias("qty"))
    added = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").cast("bigint").alias("n")
    )
    return joins.add_increments(stock, added, "p_partkey", "qty", "n")


@query("stock_value", """
select cast(sum(cast(p_retailprice as decimal(18,2)) * p_size) as double) as total_value,
       count(*) filter (p_size = 1) as nearly_out, count(*) as items
from part
""")
def stock_value(spark: SparkSession, sf: str) -> DataFrame:
    worth = F.col("p_retailprice").cast("decimal(18,2)") * F.col("p_size")
    return table(spark, sf, "part").agg(
        F.sum(worth).cast("double").alias("total_value"), F.count_if(F.col("p_size") == 1).alias("nearly_out"),
        F.count(F.lit(1)).alias("items"),
    )


# -- sets -------------------------------------------------------------------------------------------------------------

_URGENT = "select o_custkey from orders where o_orderpriority = '1-URGENT' and year(o_orderdate) = {}"


def _urgent(spark: SparkSession, sf: str, year: int) -> DataFrame:
    placed = F.col("o_orderdate")
    first, end = datetime(year, 1, 1), datetime(year + 1, 1, 1)
    in_year = (placed >= F.lit(first).cast("timestamp_ntz")) & (placed < F.lit(end).cast("timestamp_ntz"))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return table(spark, sf, "orders").where(urgent & in_year).select("o_custkey")


@query("set_common", f"{_URGENT.format(1995)} intersect {_URGENT.format(1996)}")
def set_common(spark: SparkSession, sf: str) -> DataFrame:
    return _urgent(spark, sf, 1995).intersect(_urgent(spark, sf, 1996))


@query("set_only_first", f"{_URGENT.format(1995)} except {_URGENT.format(1996)}")
def set_only_first(spark: SparkSession, sf: str) -> DataFrame:
    return _urgent(spark, sf, 1995).subtract(_urgent(spark, sf, 1996))


@query("set_either", f"{_URGENT.format(1995)} union {_URGENT.format(1996)}")
def set_either(spark: SparkSession, sf: str) -> DataFrame:
    return _urgent(spark, sf, 1995).union(_urgent(spark, sf, 1996)).distinct()


# -- counts and summaries ---------------------------------------------------------------------------------------------


@query("count_buckets", """
select l_orderkey, count(*) as times, count(*) = 1 as once, count(*) = 2 as twice, count(*) >= 3 as three_or_more
from lineitem group by 1
""")
def count_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.count_classes(table(spark, sf, "lineitem"), "l_orderkey")


@query("repeated_pairs", """
select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, count(*) as times from lineitem group by 1, 2
having count(*) > 1
""")
def repeated_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.repeated(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("distinct_counts", """
select count(distinct l_orderkey) as orders, count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers
from lineitem
""")
def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Each column is made distinct by a shuffle of its own, so no combined expansion of the rows is needed."""
    lines = table(spark, sf, "lineitem")

    def distinct(column: str, name: str) -> DataFrame:
        return lines.where(F.col(column).isNotNull()).select(column).distinct().agg(F.count(F.lit(1)).alias(name))

    others = distinct("l_partkey", "parts").scalar().alias("parts"), distinct("l_suppkey", "suppliers").scalar().alias("suppliers")
    return distinct("l_orderkey", "orders").select("orders", *others)


@query("pivot_no_group", """
select count(*) filter (o_orderstatus = 'F') as "F", count(*) filter (o_orderstatus = 'O') as "O",
       count(*) filter (o_orderstatus = 'P') as "P"
from orders
""")
def pivot_no_group(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return aggregates.pivot_sum(counts, [], "o_orderstatus", ["F", "O", "P"], "n")


@query("pivot_by_priority", """
select o_orderpriority, count(*) filter (o_orderstatus = 'F') as "F", count(*) filter (o_orderstatus = 'O') as "O",
       count(*) filter (o_orderstatus = 'P') as "P"
from orders group by 1
""")
def pivot_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return aggregates.pivot_sum(counts, ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"], "n")


@query("merge_duplicates", """
select user_id, arg_min(event_id, event_id) as event_id, arg_min(event_type, event_id) as event_type,
       cast(sum(cast(round(value * 100) as bigint)) as bigint) as qty
from events group by user_id
""")
def merge_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("bigint")
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", cents.alias("qty"))
    return aggregates.merge_duplicates(events, "user_id", "event_id", "qty")


@query("last_by_key", """
select user_id, max(event_id) as event_id, arg_max(event_type, event_id) as event_type from events group by user_id
""")
def last_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.last_by_key(table(spark, sf, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id")


@query("invert_map", "select p_name as name, max(p_partkey) as id from part group by 1")
def invert_map(spark: SparkSession, sf: str) -> DataFrame:
    """Name to id; of several ids under one name the last wins."""
    parts = table(spark, sf, "part").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("id"))
    return aggregates.last_by_key(parts.withColumn("position", F.col("id")), "name", "position").drop("position")


@query("argmax_record", """
select p_brand, p_partkey, p_name, p_retailprice from part
qualify row_number() over (partition by p_brand order by p_retailprice * p_size desc, p_partkey) = 1
""")
def argmax_record(spark: SparkSession, sf: str) -> DataFrame:
    worth = F.col("p_retailprice") * F.col("p_size")
    best = aggregates.extreme_rows(table(spark, sf, "part"), worth, "p_partkey", ["p_brand"])
    return best.select("p_brand", "p_partkey", "p_name", "p_retailprice")


@query("top_and_bottom", """
(select 'highest' as place, c_custkey, c_acctbal from customer order by c_acctbal desc, c_custkey limit 1)
union all
(select 'lowest', c_custkey, c_acctbal from customer order by c_acctbal, c_custkey desc limit 1)
""")
def top_and_bottom(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.best_and_worst(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey")


@query("mean_by_group", """
select cast(c_nationkey as bigint) as c_nationkey,
       cast(sum(cast(c_acctbal as decimal(18,2))) as double) / count(*) as mean_balance
from customer group by 1
""")
def mean_by_group(spark: SparkSession, sf: str) -> DataFrame:
    total = F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double")
    return table(spark, sf, "customer").groupBy("c_nationkey").agg((total / F.count(F.lit(1))).alias("mean_balance"))


@query("median_by_group", "select c_mktsegment, median(c_acctbal) as median_balance from customer group by 1")
def median_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return positions.median_by_position(
        table(spark, sf, "customer"), ["c_mktsegment"], "c_acctbal", "c_custkey", "median_balance"
    )


@query("column_profile", """
with p as (select count(*) as n, min(l_quantity) a, max(l_quantity) b, avg(l_quantity) c, min(l_extendedprice) d,
                  max(l_extendedprice) e, avg(l_extendedprice) f, min(l_discount) g, max(l_discount) h, avg(l_discount) i
           from lineitem)
select 'l_quantity' as column_name, n as total_rows, a as min_value, b as max_value, round(c, 2) as avg_value from p
union all select 'l_extendedprice', n, d, e, round(f, 2) from p
union all select 'l_discount', n, g, h, round(i, 2) from p
""")
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.column_profile(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


# -- rankings and order -----------------------------------------------------------------------------------------------


@query("grouped_members", """
select cast(c_nationkey as bigint) as c_nationkey, c_name, c_custkey,
       row_number() over (partition by c_nationkey order by c_custkey) as place
from customer
""")
def grouped_members(spark: SparkSession, sf: str) -> DataFrame:
    """The members of every group in order, one row each, so that no group has to fit into one value."""
    customers = table(spark, sf, "customer").select("c_nationkey", "c_name", "c_custkey")
    return positions.positions_within(customers, ["c_nationkey"], [F.col("c_custkey").asc()], "place")


@query("ordinal_ranks", """
with ranked as (select c_custkey, c_acctbal, row_number() over (order by c_acctbal desc, c_custkey) as place from customer)
select *, c_acctbal >= 60 as passed,
       place || case when place % 100 in (11, 12, 13) then 'th' when place % 10 = 1 then 'st' when place % 10 = 2 then 'nd'
                     when place % 10 = 3 then 'rd' else 'th' end as label
from ranked
""")
def ordinal_ranks(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    ranked = positions.dense_ids(customers, [F.col("c_acctbal").desc_nulls_last(), F.col("c_custkey").asc()], "place")
    return ranked.withColumns({"passed": F.col("c_acctbal") >= 60, "label": ordinal(F.col("place"))})


@query("grade_summary", """
select count(*) as students, count(*) filter (c_acctbal >= 60) as passed,
       round(cast(sum(cast(c_acctbal as decimal(18,2))) as double) / count(*), 1) as average
from customer
""")
def grade_summary(spark: SparkSession, sf: str) -> DataFrame:
    total = F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double")
    return table(spark, sf, "customer").agg(
        F.count(F.lit(1)).alias("students"), F.count_if(F.col("c_acctbal") >= 60).alias("passed"),
        round_half_away(total / F.count(F.lit(1)), 1).alias("average"),
    )


@query("tail_n", "select event_id, event_type from events order by event_id desc limit 5")
def tail_n(spark: SparkSession, sf: str) -> DataFrame:
    return positions.last_rows(table(spark, sf, "events").select("event_id", "event_type"), "event_id", 5)


@query("every_nth", """
select * from (select event_id, event_type, row_number() over (order by event_id) as position from events)
where (position - 1) % 2 = 0
""")
def every_nth(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type")
    return positions.every_nth(events, [F.col("event_id").asc()], 2)


@query("reverse_order", "select event_id, event_type from events order by event_id desc")
def reverse_order(spark: SparkSession, sf: str) -> DataFrame:
    return positions.backwards(table(spark, sf, "events").select("event_id", "event_type"), "event_id")


@query("sorted_by_expression", """
select p_partkey, p_name, p_retailprice * p_size as worth from part order by worth desc, p_partkey
""")
def sorted_by_expression(spark: SparkSession, sf: str) -> DataFrame:
    worth = (F.col("p_retailprice") * F.col("p_size")).alias("worth")
    return table(spark, sf, "part").select("p_partkey", "p_name", worth).orderBy(F.desc_nulls_last("worth"), "p_partkey")
