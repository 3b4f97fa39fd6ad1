"""Operators on small inputs with answers worked out by hand or by brute force."""

from __future__ import annotations

import random
import statistics
from datetime import datetime, timedelta

import pytest
from helpers import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe.functions import distance_from_origin, ordinal, round_half_away
from tallyframe.operators import aggregates, joins, positions, repeats, tags, tokens
from tallyframe.sources import parse_delimited

SPRINTS = [("heron", 1180), ("ibis", 2043), ("jay", 1180), ("kite", 905), ("lark", 1512), ("merlin", 1999)]
ORDERS = [("rope", 12.5, 4), ("anchor", 240.0, 1), ("buoy", 61.0, 0), ("rope", 13.0, 3), ("lamp", 75.0, 2), ("anchor", 250.0, 2), ("oar", 33.3, 0)]
HARBOUR = "low tide early then high tide late and boats wait for low water or for wind"
HARBOUR_LOUD = "Low tide, early; then HIGH tide late! And boats wait -- for low water, or for 'wind'."
CREW = [("Ona", "deck", 31, "Tor"), ("Pim", "galley", 27, "Uma"), ("Quin", "deck", 44, "Tor"), ("Ravi", "engine", 39, "Uma"),
        ("Sol", "galley", 52, "Tor"), ("Tor", "deck", 58, None), ("Uma", "engine", 49, "Tor")]
DISHES = {"soup": ["leek", "salt", "cream"], "pie": ["leek", "flour", "salt", "egg"], "bread": ["flour", "salt", "yeast"],
          "custard": ["cream", "egg", "sugar"], "broth": ["salt", "leek", "bone"]}
GRADES = {"warden": ["enter", "lock", "open", "count"], "keeper": ["enter", "open"], "guest": ["enter"]}
HOLDERS = [("v1", "keeper"), ("v2", "warden"), ("v3", "guest"), ("v4", "keeper"), ("v5", "stranger")]
STAKES = [(0, 7), (6, 8), (-5, 12), (0, 0), (6, 8), (9, -40), (-20, -21), (3, 2)]


def listed(spark, values, columns):
    """A literal list as a table with an explicit position."""
    return spark.createDataFrame([(i, *v) for i, v in enumerate(values)], f"pos bigint, {columns}")


# -- reports on short lists ---------------------------------------------------------------------------------------------


def test_ranking(spark):
    sprints = listed(spark, SPRINTS, "name string, ms int")
    ranked = positions.dense_ids(sprints, [F.col("ms").desc(), F.col("pos").asc()], "place")
    got = [tuple(r) for r in ranked.orderBy("place").select(ordinal(F.col("place")), "name").collect()]
    assert got == [("1st", "ibis"), ("2nd", "merlin"), ("3rd", "lark"), ("4th", "heron"), ("5th", "jay"), ("6th", "kite")]
    ends = aggregates.best_and_worst(sprints, "ms", "pos").select("place", "name")
    assert rows(ends) == [("highest", "ibis"), ("lowest", "kite")]
    assert sprints.agg(round_half_away(F.avg("ms"), 1)).first()[0] == round(sum(ms for _, ms in SPRINTS) / len(SPRINTS), 1)
    assert sprints.where("ms >= 1180").count() == 5


def test_order_lines(spark):
    lines = listed(spark, ORDERS, "name string, price double, qty int")
    assert lines.agg(F.sum(F.col("price") * F.col("qty"))).first()[0] == pytest.approx(sum(p * q for _, p, q in ORDERS))
    price = F.col("price")
    cut = lines.withColumn("price", F.when(price >= 100, price * 0.75).otherwise(price)).where("qty > 0")
    merged = aggregates.merge_duplicates(cut, "name", "pos", "qty").orderBy("pos")
    assert [(r["name"], r["price"], r["qty"]) for r in merged.collect()] == [("rope", 12.5, 7), ("anchor", 180.0, 3), ("lamp", 75.0, 2)]


def test_places_in_a_journal(spark):
    entries = [f"{hour:02d}: {kind}" for hour, kind in enumerate(["calm", "gust", "calm", "rain", "gust", "fog", "calm"])]
    journal = listed(spark, [(x,) for x in entries], "line string")
    assert [r["line"] for r in positions.last_rows(journal, "pos", 3).collect()] == entries[-3:]
    assert rows(positions.every_nth(journal, [F.col("pos").asc()], 3).select("line")) == sorted((x,) for x in entries[::3])
    assert [r["line"] for r in positions.backwards(journal, "pos").collect()] == entries[::-1]


def test_words(spark):
    texts = spark.createDataFrame([(HARBOUR,), (None,)], "text string")
    counts = tokens.token_counts(texts, "text")
    expected = {w: HARBOUR.split().count(w) for w in HARBOUR.split()}
    assert dict(rows(counts)) == expected
    assert [w for (w, _) in rows(tokens.words_once(texts, "text"))] == sorted(w for w, n in expected.items() if n == 1)
    loud = spark.createDataFrame([(HARBOUR_LOUD + " ... --",)], "text string")
    assert dict(rows(tokens.token_counts(loud, "text", normalised=True))) == expected
    for left, right in (("low", "tide"), ("for", "wind"), ("storm", "low")):
        a, b = expected.get(left, 0), expected.get(right, 0)
        assert rows(tokens.same_count(counts, left, right)) == [(a, b, a == b)]


def test_stock(spark):
    stock = spark.createDataFrame(
        [("s-1", "tar", 8, 4.5), ("s-2", "pitch", 0, 6.25), ("s-3", "twine", 140, 0.2), ("s-4", "cork", 0, 0.75)],
        "id string, name string, qty int, price double")
    added = spark.createDataFrame([("s-2", 3), ("s-3", 10), ("s-3", 25), ("s-9", 2), ("s-2", 9)], "id string, n int")
    after = joins.add_increments(stock, added, "id", "qty", "n")
    assert rows(after.select("id", "qty")) == [("s-1", 8), ("s-2", 12), ("s-3", 175), ("s-4", 0)]
    assert after.agg(F.sum(F.col("price") * F.col("qty"))).first()[0] == pytest.approx(8 * 4.5 + 12 * 6.25 + 175 * 0.2)
    dearest = aggregates.extreme_rows(stock.where("qty > 0").withColumn("pos", F.monotonically_increasing_id()), F.col("price"), "pos")
    assert dearest.first()["name"] == "tar"


def test_crew(spark):
    crew = listed(spark, CREW, "name string, post string, age int, chief string")
    members = positions.positions_within(crew, ["post"], [F.col("age").desc()], "place")
    assert rows(members.select("post", "place", "name")) == [
        ("deck", 1, "Tor"), ("deck", 2, "Quin"), ("deck", 3, "Ona"), ("engine", 1, "Uma"), ("engine", 2, "Ravi"),
        ("galley", 1, "Sol"), ("galley", 2, "Pim")]
    moved = spark.createDataFrame([(50, "Pim", "deck", 28, "Tor"), (51, "Pim", "engine", 28, "Uma")], crew.schema)
    latest = aggregates.last_by_key(crew.union(moved), "name", "pos")
    assert latest.where("name = 'Pim'").first()["post"] == "engine" and latest.count() == len(CREW)


def test_repeated_values(spark):
    seen = ["gull", "tern", "gull", "auk", "tern", "gull", "skua", "auk", "gull"]
    df = listed(spark, [(n,) for n in seen], "name string")
    assert [r[0] for r in rows(aggregates.repeated(df, ["name"]))] == ["auk", "gull", "tern"]
    classes = aggregates.count_classes(df, "name")
    assert rows(classes.where("twice").select("name")) == [("auk",), ("tern",)]
    assert rows(classes.where("three_or_more").select("name")) == [("gull",)]
    asked = spark.createDataFrame([("skua",), ("crane",), ("tern",)], "who string")
    assert rows(joins.member_rows(asked, df, "who", "name")) == [("skua",), ("tern",)]


def test_tags(spark):
    dishes = spark.createDataFrame(list(DISHES.items()), "dish string, parts array<string>")
    pairs = tags.tag_rows(dishes, "dish", F.col("parts"))
    for name in DISHES:
        shared = {d: len({*p} & {*DISHES[name]}) for d, p in DISHES.items() if d != name}
        target = spark.createDataFrame([(name,)], "dish string")
        assert rows(tags.sharing_with(pairs, "dish", "tag", target)) == sorted((d, n) for d, n in shared.items() if n > 1)
    assert tags.all_tags(pairs, "tag").count() == len(set().union(*DISHES.values()))
    assert rows(tags.tags_on_every_item(pairs, "dish", "tag")) == []
    assert rows(tags.tags_on_every_item(pairs.where("dish in ('soup', 'pie', 'broth')"), "dish", "tag")) == [("leek",), ("salt",)]


def test_permissions(spark):
    users = spark.createDataFrame(HOLDERS, "user string, role string")
    roles = spark.createDataFrame(list(GRADES.items()), "role string, permissions array<string>")
    for right in ("open", "count", "sail"):
        expected = {u: right in GRADES.get(r, []) for u, r in HOLDERS}
        assert dict((u, a) for u, _, a in rows(tags.has_permission(users, roles, "user", "role", right))) == expected
        holders = rows(tags.users_with_permission(users, roles, "user", "role", right).select("user"))
        assert holders == sorted((u,) for u, yes in expected.items() if yes)
    for granted in ("warden", "guest", "nobody"):
        combined = {r["user"]: r["combined"] for r in tags.combined_permissions(users, roles, "role", granted).collect()}
        assert combined == {u: sorted({*GRADES.get(r, []), *GRADES.get(granted, [])}) for u, r in HOLDERS}
    sets = {r["role"]: (r["beyond"], r["shared"]) for r in tags.compare_with_role(roles, "role", "keeper").collect()}
    assert sets["warden"] == (["count", "lock"], ["enter", "open"]) and sets["guest"] == ([], ["enter"])


def test_points(spark):
    stakes = listed(spark, STAKES, "x int, y int")
    away = stakes.withColumn("d", distance_from_origin(F.col("x"), F.col("y"))).where("d > 0")
    near = aggregates.extreme_rows(away, F.col("d"), "pos", smallest=True).first()
    assert (near["x"], near["y"]) == (3, 2)
    assert rows(away.where("x = -20 or x = -5").select("d")) == [(13.0,), (29.0,)]
    assert rows(aggregates.bounding_box(stakes, "x", "y")) == [(-20, -40, 9, 12)]
    assert rows(aggregates.repeated(stakes, ["x", "y"], "pos")) == [(6, 8, 2, 1)]
    assert stakes.where("x > 0 and y > 0").count() == 3


def test_delimited(spark):
    lines = spark.createDataFrame(
        [("ledger,paper,14.5,9",), ("\tquill , paper ,2.25, 400\r",), ("seal,metal,88.0,0",), (" wax,other,1.75,60 ",)], "line string")
    kinds = {"name": "string", "kind": "string", "price": "double", "quantity": "int"}
    items = parse_delimited(lines, "line", kinds)
    assert rows(items) == [("ledger", "paper", 14.5, 9), ("quill", "paper", 2.25, 400), ("seal", "metal", 88.0, 0), ("wax", "other", 1.75, 60)]
    profile = aggregates.column_profile(items, ["price", "quantity"])
    assert rows(profile) == [("price", 4, 1.75, 88.0, 26.63), ("quantity", 4, 0.0, 400.0, 117.25)]
    worth = aggregates.extreme_rows(items.withColumn("pos", F.monotonically_increasing_id()), F.col("price") * F.col("quantity"), "pos")
    assert worth.first()["name"] == "quill"
    bad = parse_delimited(spark.createDataFrame([("a,b,x,1",)], "line string"), "line", kinds)
    with pytest.raises(Exception):
        bad.collect()


# -- positions ----------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def lopsided(spark):
    """3000 rows; a third share one group, some have none."""
    draw = random.Random(7)
    data = [(i, None if i % 50 == 0 else ("hot" if i % 3 == 0 else f"g{draw.randrange(40)}"), draw.choice([None, *range(9)]))
            for i in range(3000)]
    return spark.createDataFrame(data, "id int, grp string, v int").repartition(16)


def test_dense_ids_equal_row_number(spark, lopsided):
    order = [F.col("v").desc_nulls_last(), F.col("grp").asc_nulls_last(), F.col("id").asc()]
    expected = lopsided.withColumn("n", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert rows(positions.dense_ids(lopsided, order, "n")) == rows(expected)


def test_positions_within_equal_row_number(spark, lopsided):
    order = [F.col("v").asc_nulls_last(), F.col("id").desc()]
    expected = lopsided.withColumn("n", F.row_number().over(Window.partitionBy("grp").orderBy(*order)).cast("bigint"))
    assert rows(positions.positions_within(lopsided, ["grp"], order, "n")) == rows(expected)


def test_dense_ids_of_nothing(spark, lopsided):
    assert positions.dense_ids(lopsided.where("false"), [F.col("id").asc()], "n").count() == 0


def test_medians(spark, lopsided):
    by_group = {}
    for r in lopsided.collect():
        if r["v"] is not None:
            by_group.setdefault(r["grp"], []).append(r["v"])
    expected = {g: float(statistics.median(vs)) for g, vs in by_group.items()}
    assert dict(positions.median_by_position(lopsided, ["grp"], "v", "id", "m").collect()) == expected
    counts = lopsided.where("v is not null").groupBy("grp", "v").count()
    assert dict(aggregates.median_of_counts(counts, ["grp"], "v", "count", "m").collect()) == expected


# -- repeats ------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def visits(spark):
    """Requests with ties, long gaps, exact 14-day gaps, missing times, and one key holding a third of the rows."""
    draw = random.Random(11)
    start = datetime(2020, 1, 1)
    data = []
    for i in range(1500):
        key = ("hot", 0) if i % 3 == 0 else (f"k{draw.randrange(120)}", draw.randrange(2))
        days = draw.choice([0, 14, 28, draw.randrange(900)])
        at = None if i % 70 == 1 else start + timedelta(days=days, seconds=draw.choice([0, 0, 1, draw.randrange(86400)]))
        data.append((i, *key, at))
    return spark.createDataFrame(data, "id int, place string, code int, at timestamp_ntz").repartition(12)


def brute_force(visits, days):
    """Compare every pair of a key's rows: the definition itself, fit for small data only."""
    all_rows = [tuple(r) for r in visits.collect()]
    flags = {}
    for i, place, code, at in all_rows:
        flags[i] = at is not None and any(
            p == place and c == code and t is not None and (t, j) < (at, i) and at <= t + timedelta(days=days)
            for j, p, c, t in all_rows)
    return flags


@pytest.mark.parametrize("days", [14, 3])
def test_repeats_against_pairs(visits, days):
    expected = brute_force(visits, days)
    flagged = repeats.flag_repeats(visits, ["place", "code"], "at", days, "id", "again")
    assert {r["id"]: r["again"] for r in flagged.collect()} == expected
    totals = repeats.repeat_totals(visits, ["place", "code"], "at", days, ["code"])
    for code, n, again in totals.collect():
        of_code = [r["id"] for r in visits.where(F.col("code") == code).collect()]
        assert n == len(of_code) and again == sum(expected[i] for i in of_code)


def test_repeats_against_lag(visits):
    """A single window over each whole key gives the same totals."""
    window = Window.partitionBy("place", "code").orderBy(F.col("at").asc_nulls_last(), "id")
    again = F.coalesce(F.col("at") <= F.lag("at").over(window) + F.make_dt_interval(F.lit(14)), F.lit(False))
    expected = visits.withColumn("again", again).groupBy("code").agg(F.count("*"), F.sum(F.col("again").cast("int")))
    assert rows(repeats.repeat_totals(visits, ["place", "code"], "at", 14, ["code"])) == rows(expected)


# -- joins --------------------------------------------------------------------------------------------------------------


def test_asof_join(spark):
    history = spark.createDataFrame(
        [(1, "old", datetime(2015, 1, 1), datetime(2023, 5, 15)), (1, "new", datetime(2023, 5, 15), None)],
        "ward int, map string, since timestamp_ntz, until timestamp_ntz")
    seen = spark.createDataFrame(
        [(1, 1, datetime(2014, 12, 31)), (2, 1, datetime(2015, 1, 1)), (3, 1, datetime(2023, 5, 14, 23, 59, 59)),
         (4, 1, datetime(2023, 5, 15)), (5, 2, datetime(2020, 1, 1)), (6, None, datetime(2020, 1, 1)), (7, 1, None)],
        "id int, ward int, at timestamp_ntz")
    got = {r["id"]: r["map"] for r in joins.asof_join(seen, history, "ward", "at", "since", "until", ["map"]).collect()}
    assert got == {1: None, 2: "old", 3: "old", 4: "new", 5: None, 6: None, 7: None}


def test_lookup_on_several_columns(spark):
    places = spark.createDataFrame([(1, "5", "N"), (2, "5", None), (3, None, None)], "n bigint, a string, b string")
    data = [(i, *pair) for i, pair in enumerate([("5", "N"), ("5", None), (None, None), ("6", "N")] * 50)]
    found = joins.lookup_columns(spark.createDataFrame(data, "id int, a string, b string"), places, ["a", "b"], ["n"], "id")
    assert found.count() == 200 and found.columns == ["id", "a", "b", "n"]
    assert found.where("n is not null").select("a", "b", "n").distinct().collect() == [("5", "N", 1)]


def test_orphans_and_defaults(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(10, "ten")], "pk int, name string")
    assert rows(joins.orphan_rows(child, parent, "fk", "pk").select("id")) == [(2,)]
    named = joins.lookup_or(child, parent.withColumnRenamed("pk", "fk"), "fk", "name", F.lit("Not found"))
    assert rows(named.select("id", "name")) == [(1, "ten"), (2, "Not found"), (3, "Not found")]
