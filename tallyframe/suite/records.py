"""Words, arrays, maps, tags, permissions, points and delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions import collections as c
from tallyframe.functions import distance_from_origin, part_before, words
from tallyframe.functions.text import MARKS
from tallyframe.operators import aggregates, tags, tokens
from tallyframe.sources.delimited import parse_delimited
from tallyframe.suite.registry import query, table

# -- words ------------------------------------------------------------------------------------------------------------

# the white space of Unicode spelled out, as the SQL engine's own class is narrower
_SPACES = (
    r"[\s\x0B\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)
_SPLIT = f"list_filter(regexp_split_to_array(text, '{_SPACES}'), lambda w: length(w) > 0)"
_WORDS = f"select unnest({_SPLIT}) as token from documents"
_CLEAN = f"select trim(lower(token), '{MARKS.replace(chr(39), chr(39) * 2)}') as token from ({_WORDS})"


@query("token_counts", f"select token, count(*) as times from ({_WORDS}) group by 1")
def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf, "documents"), "text")


@query("token_counts_clean", f"select token, count(*) as times from ({_CLEAN}) where length(token) > 0 group by 1")
def token_counts_clean(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf, "documents"), "text", normalised=True)


@query("tokens_once", f"select token, count(*) as times from ({_WORDS}) group by 1 having count(*) = 1")
def tokens_once(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.words_once(table(spark, sf, "documents"), "text")


@query("once_in_order", f"""
with found as (
  select doc_id, unnest(regexp_split_to_array(text, '{_SPACES}')) as token,
         generate_subscripts(regexp_split_to_array(text, '{_SPACES}'), 1) - 1 as word_number
  from documents
)
select token[1:1] as first_letter, token, min(doc_id) as doc_id, min(word_number) as word_number
from found where length(token) > 0 group by token having count(*) = 1
""")
def once_in_order(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.once_in_order(table(spark, sf, "documents"), "text", "doc_id")


@query("top_tokens", f"""
select token, count(*) as times from ({_CLEAN}) where length(token) > 0 group by 1 order by times desc, token limit 3
""")
def top_tokens(spark: SparkSession, sf: str) -> DataFrame:
    counts = tokens.token_counts(table(spark, sf, "documents"), "text", normalised=True)
    return counts.orderBy(F.col("times").desc(), F.col("token").asc()).limit(3)


@query("compare_tokens", f"""
with found as ({_CLEAN})
select count(*) filter (token = 'the') as first_times, count(*) filter (token = 'that') as second_times,
       count(*) filter (token = 'the') = count(*) filter (token = 'that') as same
from found
""")
def compare_tokens(spark: SparkSession, sf: str) -> DataFrame:
    counts = tokens.token_counts(table(spark, sf, "documents"), "text", normalised=True)
    return tokens.same_count(counts, "the", "that")


# -- log lines --------------------------------------------------------------------------------------------------------


@query("log_sources", "select split_part(split_part(url, '//', 2), '/', 1) as source, count(*) as lines from pages group by 1")
def log_sources(spark: SparkSession, sf: str) -> DataFrame:
    host = part_before(F.split_part("url", F.lit("//"), F.lit(2)), "/")
    return table(spark, sf, "pages").groupBy(host.alias("source")).agg(F.count(F.lit(1)).alias("lines"))


@query("log_errors", "select event_id, user_id from events where contains(lower(event_type), 'error')")
def log_errors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").where(F.lower("event_type").contains("error")).select("event_id", "user_id")


@query("prefix_lookup", "select c_custkey, c_name from customer where starts_with(c_name, 'Customer#0000001')")
def prefix_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").where(F.col("c_name").startswith("Customer#0000001")).select("c_custkey", "c_name")


# -- arrays and maps in one row ---------------------------------------------------------------------------------------


@query("array_edits", f"""
with items as (select conv_id, turn, {_SPLIT} as w from conversations),
edited as (
  select *, list_append(w, 'ending') as appended, w[:1] || ['second'] || w[2:] as inserted,
         case when len(w) > 1 then [w[-1]] || w[:len(w) - 1] else w end as moved,
         coalesce(list_position(w, 'the'), 0) as p
  from items
)
select conv_id, turn, array_to_string(appended, ' ') as appended, array_to_string(inserted, ' ') as inserted,
       array_to_string(moved, ' ') as moved,
       array_to_string(case when p > 0 then w[:p - 1] || w[p + 1:] else w end, ' ') as removed,
       case when p > 0 then cast(p - 1 as bigint) end as found_at,
       array_to_string(w[greatest(len(w) - 4, 1):], ' ') as last_five,
       array_to_string(list_filter(w, lambda x, i: i % 2 = 1), ' ') as every_second,
       array_to_string(list_reverse(w), ' ') as reversed,
       array_to_string(list_transform(w, lambda x, i: i || '.' || x), ' ') as numbered
from edited
""")
def array_edits(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "conversations").select("conv_id", "turn", words(F.col("text")).alias("w"))
    w, the = F.col("w"), F.lit("the")
    edits = {
        "appended": F.array_append(w, F.lit("ending")),
        # an insert past the end goes to the end, as in a list
        "inserted": F.when(F.size(w) > 0, c.insert_at(w, 1, F.lit("second"))).otherwise(F.array(F.lit("second"))),
        "moved": c.last_to_front(w),
        "removed": c.remove_first(w, the),
        "last_five": c.last_items(w, 5),
        "every_second": c.every_second(w),
        "reversed": F.reverse(w),
        "numbered": c.numbered(w),
    }
    return items.select(
        "conv_id", "turn", c.index_of(w, the).alias("found_at"),
        *[F.array_join(edit, " ").alias(name) for name, edit in edits.items()],
    )


@query("map_ops", """
select o_orderkey, o_orderpriority as looked_up, 'Not found' as missing, 'priority,status' as sorted_keys,
       'phone,priority,status' as after_put, 'status' as after_drop,
       case when starts_with(o_orderpriority, '1') then 'priority' else '' end as urgent_keys, 'new' as replaced
from orders
""")
def map_ops(spark: SparkSession, sf: str) -> DataFrame:
    book = F.create_map(F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority")
    rows = table(spark, sf, "orders").select("o_orderkey", book.alias("m"))
    m, none = F.col("m"), F.lit("Not found")

    def joined(keys):
        return F.array_join(keys, ",")

    return rows.select(
        "o_orderkey",
        c.get_or(m, F.lit("priority"), none).alias("looked_up"),
        c.get_or(m, F.lit("phone"), none).alias("missing"),
        joined(c.sorted_keys(m)).alias("sorted_keys"),
        joined(c.sorted_keys(c.put(m, F.lit("phone"), F.lit("555")))).alias("after_put"),
        joined(c.sorted_keys(c.without(m, F.lit("priority")))).alias("after_drop"),
        joined(c.keys_with_prefix(m, "1")).alias("urgent_keys"),
        c.get_or(c.put(m, F.lit("status"), F.lit("new")), F.lit("status"), none).alias("replaced"),
    )


# -- tags and permissions ---------------------------------------------------------------------------------------------


def _customer_parts(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("item"))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").alias("tag"))
    return orders.join(lines, "k").select("item", "tag")


@query("similar_by_tags", """
with pairs as (select distinct o_custkey as item, l_partkey as tag from orders join lineitem on l_orderkey = o_orderkey),
target as (select c_custkey as item from customer order by c_acctbal desc, c_custkey limit 1),
own as (select tag from pairs where item in (select item from target))
select item, count(*) as shared_tags from pairs
where tag in (select tag from own) and item not in (select item from target)
group by 1 having count(*) >= 2
""")
def similar_by_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Customers who bought at least two of the parts the customer with the greatest balance bought."""
    customers = table(spark, sf, "customer")
    target = aggregates.extreme_rows(customers, F.col("c_acctbal"), "c_custkey").select(F.col("c_custkey").alias("item"))
    return tags.sharing_with(_customer_parts(spark, sf), "item", "tag", target)


_NATION_TAGS = """
select distinct c_nationkey as item, p_brand || '/' || p_size as tag
from customer join orders on o_custkey = c_custkey join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey
"""


def _nation_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Brand and size of what each nation bought; pairs are made distinct as early as the joins allow."""
    nations = table(spark, sf, "customer").select(F.col("c_custkey").alias("item"), F.col("c_nationkey").alias("nation"))
    bought = _customer_parts(spark, sf).distinct().join(nations, "item").select(F.col("nation").alias("item"), "tag")
    kind = F.concat("p_brand", F.lit("/"), F.col("p_size").cast("string"))
    kinds = table(spark, sf, "part").select(F.col("p_partkey").alias("tag"), kind.alias("kind"))
    return bought.distinct().join(kinds, "tag").select("item", F.col("kind").alias("tag"))


@query("tag_union", f"select distinct tag from ({_NATION_TAGS})")
def tag_union(spark: SparkSession, sf: str) -> DataFrame:
    return tags.all_tags(_nation_tags(spark, sf), "tag")


@query("tag_common", f"""
with pairs as ({_NATION_TAGS})
select tag from pairs group by 1 having count(*) = (select count(distinct item) from pairs)
""")
def tag_common(spark: SparkSession, sf: str) -> DataFrame:
    return tags.tags_on_every_item(_nation_tags(spark, sf), "item", "tag")


@query("tag_rows", f"select distinct doc_id, unnest({_SPLIT}) as tag from documents")
def tag_rows(spark: SparkSession, sf: str) -> DataFrame:
    return tags.tag_rows(table(spark, sf, "documents"), "doc_id", words(F.col("text")))


def _roles(spark: SparkSession, sf: str) -> DataFrame:
    """Each market segment may handle the priorities it has filled more orders of than it left open. The array holds
    different priorities only, of which there are five."""
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("role"))
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderstatus", F.col("o_orderpriority").alias("permission")
    )
    counted = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("role", "permission").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("filled"), F.count_if(F.col("o_orderstatus") == "O").alias("open")
    )
    granted = counted.where("filled > open")
    return granted.groupBy("role").agg(F.array_sort(F.collect_set("permission")).alias("permissions"))


_ROLES_SQL = """
granted as (
  select c_mktsegment as role, o_orderpriority as permission
  from customer join orders on o_custkey = c_custkey group by 1, 2
  having count(*) filter (o_orderstatus = 'F') > count(*) filter (o_orderstatus = 'O')
),
users as (select c_custkey as user_id, c_mktsegment as role from customer)"""


def _users(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("role"))


@query("permission_test", f"""
with {_ROLES_SQL}
select user_id, role, role in (select role from granted where permission = '2-HIGH') as allowed from users
""")
def permission_test(spark: SparkSession, sf: str) -> DataFrame:
    return tags.has_permission(_users(spark, sf), _roles(spark, sf), "user_id", "role", "2-HIGH")


@query("permission_holders", f"""
with {_ROLES_SQL} select user_id, role from users where role in (select role from granted where permission = '2-HIGH')
""")
def permission_holders(spark: SparkSession, sf: str) -> DataFrame:
    return tags.users_with_permission(_users(spark, sf), _roles(spark, sf), "user_id", "role", "2-HIGH")


@query("permission_combined", f"""
with {_ROLES_SQL},
merged as (select u.role, permission from (select distinct role from users) u
           join granted g on g.role = u.role or g.role = 'BUILDING'),
lists as (select role, string_agg(distinct permission, ',' order by permission) as combined from merged group by 1)
select user_id, users.role, coalesce(combined, '') as combined from users left join lists using (role)
""")
def permission_combined(spark: SparkSession, sf: str) -> DataFrame:
    combined = tags.combined_permissions(_users(spark, sf), _roles(spark, sf), "role", "BUILDING")
    return combined.withColumn("combined", F.array_join("combined", ","))


@query("role_sets", f"""
with {_ROLES_SQL}, base as (select permission from granted where role = 'BUILDING')
select role, coalesce(string_agg(permission, ',' order by permission) filter (permission not in (select * from base)), '')
         as beyond,
       coalesce(string_agg(permission, ',' order by permission) filter (permission in (select * from base)), '') as shared
from granted group by 1
""")
def role_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Each role's permissions beyond those of one base role, and those shared with it."""
    roles = _roles(spark, sf)
    sets = tags.compare_with_role(roles, "role", "BUILDING")
    return sets.select("role", F.array_join("beyond", ",").alias("beyond"), F.array_join("shared", ",").alias("shared"))


# -- points -----------------------------------------------------------------------------------------------------------

_POINTS = "select p_partkey as id, cast(p_size - 25 as bigint) as x, cast(p_partkey % 41 - 20 as bigint) as y from part"


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), (F.col("p_size") - 25).cast("bigint").alias("x"),
        (F.col("p_partkey") % 41 - 20).alias("y"),
    )


@query("nearest_point", f"""
select id, x, y, sqrt(x * x + y * y) as distance from ({_POINTS}) where x <> 0 or y <> 0 order by distance, id limit 1
""")
def nearest_point(spark: SparkSession, sf: str) -> DataFrame:
    away = _points(spark, sf).withColumn("distance", distance_from_origin(F.col("x"), F.col("y"))).where("distance > 0")
    return aggregates.extreme_rows(away, F.col("distance"), "id", smallest=True)


@query("point_distances", f"""
select x, y, sqrt(x * x + y * y) as distance from ({_POINTS}) group by x, y order by distance, x, y
""")
def point_distances(spark: SparkSession, sf: str) -> DataFrame:
    distinct = _points(spark, sf).select("x", "y").distinct()
    return distinct.withColumn("distance", distance_from_origin(F.col("x"), F.col("y"))).orderBy("distance", "x", "y")


@query("first_quadrant", f"select id, x, y from ({_POINTS}) where x > 0 and y > 0")
def first_quadrant(spark: SparkSession, sf: str) -> DataFrame:
    return _points(spark, sf).where("x > 0 and y > 0")


@query("bounding_box", f"select min(x) as min_x, min(y) as min_y, max(x) as max_x, max(y) as max_y from ({_POINTS})")
def bounding_box(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.bounding_box(_points(spark, sf), "x", "y")


@query("repeat_points", f"""
select x, y, count(*) as times, min(id) as first_seen from ({_POINTS}) group by 1, 2 having count(*) > 1
""")
def repeat_points(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.repeated(_points(spark, sf), ["x", "y"], "id")


# -- delimited text ---------------------------------------------------------------------------------------------------

_ITEM = {"name": "string", "category": "string", "price": "double", "quantity": "int"}


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    """Parts rendered as lines with stray white space, then parsed back."""
    part = table(spark, sf, "part")
    line = F.concat(
        F.lit(" "), "p_name", F.lit(" ,\t"), "p_brand", F.lit(","), F.col("p_retailprice").cast("string"), F.lit(" , "),
        F.col("p_size").cast("string"), F.lit("\r"),
    )
    return parse_delimited(part.select("p_partkey", line.alias("line")), "line", _ITEM, keep=["p_partkey"])


@query("csv_parse", """
select p_partkey, p_name as name, p_brand as category, p_retailprice as price, cast(p_size as bigint) as quantity from part
""")
def csv_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf)


@query("csv_best_row", """
select p_partkey, p_name as name, p_brand as category, p_retailprice as price, cast(p_size as bigint) as quantity from part
order by p_retailprice * p_size desc, p_partkey limit 1
""")
def csv_best_row(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.extreme_rows(_parsed(spark, sf), F.col("price") * F.col("quantity"), "p_partkey")
