"""History, upserts, stored tables, checks, ingest and the daily run."""

from __future__ import annotations

import os
from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import rows
from pyspark.sql import functions as F

from tallyframe.operators import history, quality, upsert
from tallyframe.plans import dimensions
from tallyframe.plans.daily import Warehouse, daily_run
from tallyframe.plans.fact import FACT_COLUMNS, changed_since, not_held
from tallyframe.plans.staging import RAW_COLUMNS, STAGED_COLUMNS, stage
from tallyframe.plans.validation import closed_before_created, outside_the_city
from tallyframe.sources import CursorStore, VersionedTable, as_text_columns, keyset_page, land, scan_landed, settle
from tallyframe.sources.seeds import community_areas, ward_versions
from tallyframe.sources.shared import settled_scope, shared_root
from tallyframe.streaming.ingest import LEDGER_SLOT, ingest_landed

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)


def state(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, status string, note string")


# -- history ------------------------------------------------------------------------------------------------------------


def test_snapshot_opens_closes_and_keeps(spark):
    first = history.scd2_snapshot(None, state(spark, (1, "open", "a"), (2, "open", "a"), (3, None, "a")), "k", ["status"], T1)
    second = history.scd2_snapshot(
        first, state(spark, (1, "done", "b"), (2, "open", "b"), (3, "open", "b"), (4, "open", "b"), (None, "x", "b")),
        "k", ["status"], T2)
    got = rows(second.select("k", "status", "note", history.VALID_FROM, history.VALID_TO))
    assert got == [(1, "done", "b", T2, None), (1, "open", "a", T1, T2), (2, "open", "a", T1, None),
                   (3, "open", "b", T2, None), (3, None, "a", T1, T2), (4, "open", "b", T2, None)]
    assert second.select(history.SCD_ID).distinct().count() == second.count()


def test_snapshot_rerun_changes_nothing(spark):
    now = state(spark, (1, "open", "a"), (2, None, "a"))
    once = history.scd2_snapshot(None, now, "k", ["status"], T1)
    assert rows(history.scd2_snapshot(once, now, "k", ["status"], T2)) == rows(once)


def test_vanished_key_stays_open_and_may_return(spark):
    one = history.scd2_snapshot(None, state(spark, (1, "open", "a")), "k", ["status"], T1)
    two = history.scd2_snapshot(one, state(spark), "k", ["status"], T2)
    assert rows(two) == rows(one)
    three = history.scd2_snapshot(two, state(spark, (1, "done", "a")), "k", ["status"], T3)
    assert rows(three.select("status", history.VALID_TO)) == [("done", None), ("open", T3)]


def test_change_at_the_same_moment_replaces(spark):
    one = history.scd2_snapshot(None, state(spark, (1, "open", "a")), "k", ["status"], T1)
    two = history.scd2_snapshot(one, state(spark, (1, "done", "a")), "k", ["status"], T1)
    assert rows(two.select("status", history.VALID_FROM, history.VALID_TO)) == [("done", T1, None)]


def test_intervals_never_overlap(spark):
    known = None
    for day, at in enumerate((T1, T2, T3, datetime(2024, 1, 4))):
        now = spark.range(60).selectExpr("cast(id as int) as k", f"cast((id * {day + 1}) % 3 as string) as status", "'' as note")
        known = history.scd2_snapshot(known, now, "k", ["status"], at)
    by_key = {}
    for r in known.collect():
        by_key.setdefault(r["k"], []).append((r[history.VALID_FROM], r[history.VALID_TO]))
    for spans in by_key.values():
        spans.sort()
        assert sum(end is None for _, end in spans) == 1
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_backfill(spark):
    keys = spark.createDataFrame([(1,), (2,), (1,), (None,)], "ward int")
    got = rows(history.scd2_backfill(keys, "ward", ward_versions(spark), "map_version", "effective_from").drop(history.SCD_ID))
    a, b = datetime(2015, 1, 1), datetime(2023, 5, 15)
    assert got == sorted([(w, *v) for w in (1, 2) for v in (("new_map", b, b, None), ("old_map", a, a, b))])
    ids = history.scd2_backfill(keys, "ward", ward_versions(spark), "map_version", "effective_from")
    assert ids.where("ward = 1 and map_version = 'old_map'").first()[history.SCD_ID] == __import__("hashlib").md5(b"1-old_map").hexdigest()


# -- upserts and stored tables --------------------------------------------------------------------------------------------


def batch(spark, *values):
    return spark.createDataFrame(list(values), "k string, at string, v int")


def test_upsert_is_idempotent_and_keeps_keys_unique(spark):
    target = batch(spark, ("a", "1", 1), ("b", "1", 1))
    new = batch(spark, ("b", "2", 2), ("c", "2", 2), ("c", "3", 3), (None, "1", 9))
    once = upsert.upsert(target, new, "k", ["at"])
    assert rows(once) == [("a", "1", 1), ("b", "2", 2), ("c", "3", 3)]
    assert rows(upsert.upsert(once, new, "k", ["at"])) == rows(once)
    assert rows(upsert.keyless(new, "k")) == [(None, "1", 9)]


def test_plain_delete_then_insert_keeps_repeats(spark):
    got = upsert.upsert(batch(spark, ("a", "1", 1)), batch(spark, ("c", "2", 2), ("c", "3", 3)), "k", deduplicate=False)
    assert rows(got) == [("a", "1", 1), ("c", "2", 2), ("c", "3", 3)]


def test_versioned_table(spark, folder):
    table = VersionedTable(spark, f"{folder}/t", "substr(at, 1, 7)")
    assert not table.exists()
    assert not table.merge(batch(spark, (None, "2024-01-05", 1)), "k", ["at"])
    assert not table.exists()
    assert table.merge(batch(spark, ("a", "2024-01-05", 1), ("b", "2024-02-01", 1)), "k", ["at"], tag=("s", 0))
    assert table.slots() == ["2024-01", "2024-02"]
    # a batch numbered before or like the last one is ignored
    assert not table.merge(batch(spark, ("a", "2024-01-06", 9)), "k", ["at"], tag=("s", 0))
    # key b moves to another month and leaves its old one empty
    table.merge(batch(spark, ("b", "2024-01-09", 2), ("c", None, 3)), "k", ["at"], tag=("s", 1))
    assert rows(table.read()) == [("a", "2024-01-05", 1), ("b", "2024-01-09", 2), ("c", None, 3)]
    assert table.slots() == ["2024-01", "none"]
    assert table.slots_since(-1) == ["2024-01", "none"] == table.slots_since(1) and table.slots_since(2) == []
    # a new column appears, older rows lack it; nothing to do for an empty batch
    table.merge(batch(spark, ("d", "2024-03-01", 4)).withColumn("extra", F.lit("x")), "k", ["at"])
    assert not table.merge(batch(spark), "k", ["at"])
    assert {r["k"]: r["extra"] for r in table.read().collect()} == {"a": None, "b": None, "c": None, "d": "x"}
    assert table.count() == 4 and table.version() == 3


def test_versioned_table_reads_old_until_published(spark, folder, monkeypatch):
    table = VersionedTable(spark, f"{folder}/t")
    table.replace(batch(spark, ("a", "1", 1)))
    monkeypatch.setattr(table, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.replace(batch(spark, ("z", "9", 9)))
    monkeypatch.undo()
    assert rows(table.read()) == [("a", "1", 1)]
    table.replace(table.read().withColumn("v", F.col("v") + 1))
    assert rows(table.read()) == [("a", "1", 2)]


def test_vacuum_keeps_what_is_used(spark, folder):
    table = VersionedTable(spark, f"{folder}/t", "at")
    for v in range(4):
        table.merge(batch(spark, ("a", "x", v), (f"k{v}", f"y{v}", v)), "k")
    before = rows(table.read())
    table.vacuum(keep=1)
    assert rows(table.read()) == before and table.version() == 4
    assert len([n for n in os.listdir(f"{folder}/t/manifests") if n.endswith(".json")]) == 1


class FakeSession:
    """Only what the choice of the shared folder looks at."""

    def __init__(self, master, named):
        self.conf, self.sparkContext, self.master = self, self, master
        self.get = lambda key, default: {"spark.checkpoint.dir": named}.get(key) or default


def test_shared_folder_is_the_named_one():
    assert shared_root(FakeSession("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    assert os.path.isdir(shared_root(FakeSession("local[2]", None)))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(FakeSession("yarn", None))


def test_settled_tables_go_with_their_scope(spark):
    def present():
        return [n for n in os.listdir(shared_root(spark)) if n.startswith("three-")]

    before = present()
    with settled_scope(spark):
        assert settle(spark.range(3), "three").count() == 3
        assert len(present()) == len(before) + 1
    assert present() == before


def test_cursor(spark, folder):
    cursors = CursorStore(spark, folder)
    assert cursors.get("feed") == datetime(2023, 1, 1)
    cursors.advance("feed", T2)
    cursors.advance("feed", T1)
    cursors.advance("feed", None)
    assert cursors.get("feed") == T2 and cursors.get("other") == datetime(2023, 1, 1)
    assert cursors.read().count() == 2


def test_text_records(spark, folder):
    nested = spark.createDataFrame([(1, {"a": 1}, ["x"], None)], "id int, m map<string,int>, l array<string>, n double")
    assert rows(as_text_columns(nested)) == [("1", '{"a":1}', '["x"]', None)]
    land(nested.select("id"), folder, "r1")
    land(nested.select("id", "l"), folder, "r2")
    assert rows(scan_landed(spark, folder).select("id", "l")) == [("1", '["x"]'), ("1", None)]


def test_pages_lose_no_ties(spark):
    feed = spark.createDataFrame([(i, T1 if i < 7 else T2) for i in range(10)], "id int, at timestamp_ntz")
    seen, after = [], None
    while page := keyset_page(feed, "at", "id", after, 3).collect():
        seen += [r["id"] for r in page]
        after = (page[-1]["at"], page[-1]["id"])
    assert seen == list(range(10))


# -- checks -------------------------------------------------------------------------------------------------------------


def counted(check):
    return quality.report([check]).first()["failures"]


@pytest.mark.parametrize("check, good, bad", [
    (lambda t: quality.unique("c", t, "id"), [("1",), ("2",), (None,), (None,)], [("1",), ("1",), ("1",)]),
    (lambda t: quality.not_null("c", t, "id"), [("1",)], [("1",), (None,)]),
    (lambda t: quality.accepted_values("c", t, "id", ["1"]), [("1",), (None,)], [("2",)]),
    (lambda t: quality.relationship("c", t, "id", t.sparkSession.createDataFrame([("1",)], "p string"), "p"),
     [("1",), ("1",), (None,)], [("1",), ("5",)]),
    (lambda t: quality.rule("c", t, F.col("id") == "x"), [("1",), (None,)], [("x",)]),
])
def test_each_check_passes_and_fails(spark, check, good, bad):
    passing, failing = (check(spark.createDataFrame(data, "id string")) for data in (good, bad))
    assert counted(passing) == 0 == passing.failing.count()
    assert counted(failing) == 1 == failing.failing.count()


def test_request_rules(spark):
    staged = spark.createDataFrame(
        [(1, T2, T1, 41.7, -87.6), (2, T1, T2, 43.0, -87.6), (3, T1, None, 41.7, None), (4, T1, T1, 41.6, -87.95)],
        "id int, created_date timestamp_ntz, closed_date timestamp_ntz, latitude double, longitude double")
    assert rows(closed_before_created(staged).failing.select("id")) == [(1,)]
    assert rows(outside_the_city(staged).failing.select("id")) == [(2,)]


def test_enforce(spark):
    bad = spark.createDataFrame([(None,)], "id string")
    quality.enforce(quality.report([quality.not_null("soft", bad, "id", quality.WARN)]))
    with pytest.raises(quality.CheckFailed, match="hard: 1 rows"):
        quality.enforce(quality.report([quality.not_null("hard", bad, "id"), quality.not_null("soft", bad, "id", quality.WARN)]))


# -- staging, dimensions, fact --------------------------------------------------------------------------------------------


def record(**given):
    """A raw record, all text; only what a test cares about is given."""
    base = dict.fromkeys(RAW_COLUMNS)
    base.update(sr_number="SR1", sr_type=" Pothole ", sr_short_code="phf", status=" Closed ",
                created_date="2023-05-14T10:00:00.000", last_modified_date="2023-05-20T10:00:00.000",
                closed_date="2023-05-16T11:30:00.000", community_area="1", ward="5", street_number="10",
                street_direction="N", street_name="STATE", street_type="ST", state="Illinois", latitude="41.8", longitude="-87.6")
    return base | given


def raw(spark, *records):
    return spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in records], ", ".join(f"{c} string" for c in RAW_COLUMNS))


def test_staging(spark):
    staged = stage(raw(spark, record(sr_number="  ", city=" ", community_area="1.5", created_date="2023", x_coordinate="1.5d")))
    assert staged.columns == [name for _, name, _ in STAGED_COLUMNS] and len(staged.columns) == 36
    row = staged.first()
    assert (row["sr_id"], row["service_request_type"], row["sr_short_code"], row["status"]) == (None, "Pothole", "PHF", "completed")
    assert (row["city"], row["state"], row["community_area"], row["created_date"], row["x_coordinate"]) == (None, "IL", 2, None, None)
    # a raw table without some column yields NULLs
    assert stage(raw(spark, record()).drop("electricity_grid")).first()["electricity_grid"] is None


def test_calendar(spark):
    days = dimensions.calendar(spark)
    assert days.count() == 5844
    assert days.agg(F.min("date_day"), F.max("date_day")).first() == (date(2015, 1, 1), date(2030, 12, 31))


def test_seeds(spark):
    areas = dimensions.areas(community_areas(spark))
    assert areas.count() == 77 and areas.where("community_area = 76").first()[1] == "O'Hare"


def test_locations(spark):
    staged = stage(raw(spark, record(city=None, state=None), record(city="a"), record(street_name="ADAMS"), record(street_type=None),
                       record(street_name=None)))
    got = rows(dimensions.locations(staged))
    assert got == [(1, "10", "N", "ADAMS", "ST", "CHICAGO", "IL"), (2, "10", "N", "STATE", "ST", "A", "IL"),
                   (3, "10", "N", "STATE", None, "CHICAGO", "IL")]
    # with the table known, old addresses keep their number and a new one comes last although it sorts first
    known = dimensions.locations(staged)
    more = staged.unionByName(stage(raw(spark, record(street_name="AAA"))))
    assert [(r[0], r[3]) for r in rows(dimensions.locations(more, known))] == [(1, "ADAMS"), (2, "STATE"), (3, "STATE"), (4, "AAA")]


def test_one_name_per_code(spark):
    staged = stage(raw(spark, record(), record(sr_type="Pothole in Street", last_modified_date="2024-01-01")))
    assert rows(dimensions.request_types(staged)) == [("PHF", "Pothole in Street")]
    assert dimensions.request_types(staged, one_name=False).count() == 2


def test_changed_since(spark):
    rows_in = spark.createDataFrame([(1, T1), (2, T2), (3, T3), (4, None)], "id int, last_modified_date timestamp_ntz")
    fact = rows_in.where("id <= 2")
    assert rows(changed_since(rows_in, fact).select("id")) == [(2,), (3,), (4,)]
    assert rows(changed_since(rows_in, fact, strictly=True).select("id")) == [(3,)]
    assert changed_since(rows_in, fact.where("false")).count() == 4


# -- ingest and daily run ---------------------------------------------------------------------------------------------------


def test_ingest_runs_once_per_file(spark, folder):
    table = VersionedTable(spark, f"{folder}/raw", "substr(created_date, 1, 7)")
    cursors, landing = CursorStore(spark, f"{folder}/cursors"), f"{folder}/landing"

    def run():
        ingest_landed(spark, landing, table, cursors, f"{folder}/checkpoint", source="feed")

    run()
    os.makedirs(landing)
    run()
    assert not table.exists()
    land(raw(spark, record(), record(sr_number="SR2"), record(sr_number="SR2", last_modified_date="2023-06-01", status="Open"),
             record(sr_number=None)).drop("ward"), landing, "1")
    run()
    assert rows(table.read().select("sr_number", "status")) == [("SR1", " Closed "), ("SR2", "Open")]
    version = table.version()
    run()
    assert table.version() == version
    assert cursors.get("feed") == datetime(2023, 5, 14, 10)
    land(raw(spark, record(sr_number="SR3", created_date="2024-01-01T00:00:00")).withColumn("added", F.lit("x")), landing, "2")
    run()
    got = {r["sr_number"]: (r["added"], r["ward"]) for r in table.read().collect()}
    assert got == {"SR1": (None, None), "SR2": (None, None), "SR3": ("x", "5")}
    assert cursors.get("feed") == datetime(2024, 1, 1)


def test_backlog_in_several_batches(spark, folder):
    table, landing = VersionedTable(spark, f"{folder}/raw"), f"{folder}/landing"
    for run in range(3):
        land(raw(spark, record(sr_number=f"SR{run}"), record(sr_number="SR9", last_modified_date=f"2023-06-0{run + 1}")).coalesce(1), landing, str(run))
    ingest_landed(spark, landing, table, None, f"{folder}/checkpoint", source="feed", max_files=1)
    assert table.version() == 3 and list(table._manifest()["applied"].values()) == [2]
    assert rows(table.read().select("sr_number")) == [("SR0",), ("SR1",), ("SR2",), ("SR9",)]


def test_daily_run(spark, folder):
    landing, root = f"{folder}/landing", f"{folder}/warehouse"

    def run(now, **options):
        return daily_run(spark, root, landing, ward_versions(spark), community_areas(spark), now, **options)

    land(raw(spark, record(), record(sr_number="SR2", status="Open", closed_date=None, created_date="2023-05-15T00:00:00")), landing, "1")
    report = run(T1)
    assert report.where("severity = 'error' and failures > 0").count() == 0
    warehouse = Warehouse(spark, root)
    fact = warehouse.fact.read()
    assert fact.columns == FACT_COLUMNS
    assert rows(fact.select("sr_id", "status", "location_id", "ward_map_version_at_request")) == [
        ("SR1", "completed", 1, "old_map"), ("SR2", "open", 1, "new_map")]
    slow = warehouse.gold("resolution_time").read()
    assert rows(slow) == [(1, "Rogers Park", 2.0, 2.0)] and slow.columns[2] == "2023"

    land(raw(spark, record(sr_number="SR2", created_date="2023-05-15T00:00:00", last_modified_date="2023-06-01T00:00:00"),
             record(sr_number="SR3", street_name="ADAMS", last_modified_date="2023-06-02T00:00:00")), landing, "2")
    run(T2, keep_versions=1)
    assert rows(warehouse.fact.read().select("sr_id", "status", "location_id")) == [
        ("SR1", "completed", 1), ("SR2", "completed", 1), ("SR3", "completed", 2)]
    states = warehouse.status_history.read().select("sr_id", "status", history.VALID_FROM, history.VALID_TO)
    assert rows(states) == [("SR1", "completed", T1, None), ("SR2", "completed", T2, None), ("SR2", "open", T1, T2),
                            ("SR3", "completed", T2, None)]
    assert warehouse.ward_history.count() == 2

    merged = rows(warehouse.fact.read().drop("location_id"))
    run(T3, full_refresh=True)
    assert rows(warehouse.fact.read().drop("location_id")) == merged

    land(raw(spark, record(sr_number="SR4", status="lost")), landing, "3")
    with pytest.raises(quality.CheckFailed, match="status"):
        run(datetime(2024, 1, 4))


def test_blank_and_odd_slots_keep_their_rows(spark, folder):
    """Rows whose slot value is blank, missing or odd outlive merges into the same slots."""
    stored = VersionedTable(spark, f"{folder}/slots", "substr(at, 1, 7)")
    batches = [[("a", ""), ("b", None), ("c", "2024-01-05"), ("d", "a/b=c d")], [("e", ""), ("f", "a/b=c x")], [("g", None), ("h", "")]]
    for batch in batches:
        stored.merge(spark.createDataFrame(batch, "id string, at string"), "id")
    assert rows(stored.read()) == sorted((r for b in batches for r in b), key=lambda r: r[0])


def test_split_into_batches_changes_nothing(spark, folder):
    landed = [("k", "closed", "2024-06-03"), ("k", "open", "2024-06-01"), ("m", "open", "2024-06-02")]
    whole, single = VersionedTable(spark, f"{folder}/whole"), VersionedTable(spark, f"{folder}/single")
    whole.merge(spark.createDataFrame(landed, "id string, state string, at string"), "id", ["at"])
    for row in landed:
        single.merge(spark.createDataFrame([row], "id string, state string, at string"), "id", ["at"], keep_newer=True)
    assert rows(single.read()) == rows(whole.read()) == [("k", "closed", "2024-06-03"), ("m", "open", "2024-06-02")]


def test_old_files_and_their_columns_are_loaded(spark, folder):
    import time
    from pathlib import Path

    target = VersionedTable(spark, f"{folder}/raw")
    spark.createDataFrame([("1", "2024-01-01")], "sr_number string, last_modified_date string").write.parquet(f"{folder}/in/a")
    ingest_landed(spark, f"{folder}/in", target, None, f"{folder}/check")
    spark.createDataFrame([("2", "2024-01-02", "x")], "sr_number string, last_modified_date string, extra string").write.parquet(f"{folder}/in/b")
    month_ago = time.time() - 30 * 86400
    for file in Path(f"{folder}/in/b").iterdir():
        os.utime(file, (month_ago, month_ago))
    ingest_landed(spark, f"{folder}/in", target, None, f"{folder}/check")
    assert rows(target.read().select("sr_number", "extra")) == [("1", None), ("2", "x")]


def test_backfill_without_a_limit_on_versions(spark):
    versions = spark.range(10_050).selectExpr("concat('v', id) as name", "date_add(date'1990-01-01', cast(id as int)) as since")
    versions = versions.unionAll(spark.createDataFrame([("first", None)], "name string, since date"))
    entries = history.scd2_backfill(spark.createDataFrame([(3,), (3,), (None,)], "ward int"), "ward", versions, "name", "since")
    assert entries.count() == 10_051 and entries.where("dbt_valid_to is null").count() == 1
    first = entries.where("name = 'first'").head()
    assert first["dbt_valid_from"] is None and str(first["dbt_valid_to"]) == "1990-01-01 00:00:00"


def test_a_new_checkpoint_loads_what_landed_since(spark, folder):
    table, landing = VersionedTable(spark, f"{folder}/raw"), f"{folder}/landing"
    for day, checkpoint in (("1", "old"), ("2", "new"), ("3", "new")):
        land(raw(spark, record(sr_number=f"SR{day}")), landing, day)
        ingest_landed(spark, landing, table, None, f"{folder}/{checkpoint}", source="feed")
    assert rows(table.read().select("sr_number")) == [("SR1",), ("SR2",), ("SR3",)]


def test_rows_without_a_key_are_kept_aside_once(spark, folder):
    table, lost, landing = VersionedTable(spark, f"{folder}/raw"), VersionedTable(spark, f"{folder}/lost"), f"{folder}/landing"
    land(raw(spark, record(sr_number=None), record(sr_number=None), record(sr_number="  "), record()).coalesce(1), landing, "1")
    for checkpoint in ("old", "old", "new"):  # a new checkpoint reads the file again
        ingest_landed(spark, landing, table, None, f"{folder}/{checkpoint}", source="feed", rejected=lost)
    assert rows(lost.read().select("sr_number", "copies")) == [("  ", 1), (None, 2)]
    assert table.count() == 1


def test_overlapping_writers_lose_no_update(spark, folder):
    first, second = VersionedTable(spark, f"{folder}/t"), VersionedTable(spark, f"{folder}/t")
    first.replace(batch(spark, ("a", "1", 1)))
    base = second.version()
    derived = second.read(version=base).withColumn("v", F.col("v") + 10)
    first.merge(batch(spark, ("b", "1", 1)), "k")
    with pytest.raises(RuntimeError, match="another writer"):
        second.replace(derived, base=base)
    with pytest.raises(RuntimeError, match="another writer"):
        second.merge(derived, "k", base=base)
    assert rows(first.read()) == [("a", "1", 1), ("b", "1", 1)]
    first.vacuum(1)
    assert rows(first.read()) == [("a", "1", 1), ("b", "1", 1)]


def test_scopes_keep_to_themselves(spark):
    from concurrent.futures import ThreadPoolExecutor
    from contextvars import copy_context

    with ThreadPoolExecutor(1) as pool:
        with settled_scope(spark):
            other = pool.submit(settle, spark.range(3), "other").result()
            own = pool.submit(copy_context().run, settle, spark.range(4), "own").result()
            with settled_scope(spark):
                inner = settle(spark.range(5), "inner")
            assert own.count() == 4
            with pytest.raises(Exception, match="(?i)exist"):
                inner.count()
        assert other.count() == 3
        with pytest.raises(Exception, match="(?i)exist"):
            own.count()


def test_late_and_corrected_rows_reach_the_fact(spark, folder):
    landing, root = f"{folder}/landing", f"{folder}/warehouse"

    def run(now, **options):
        return daily_run(spark, root, landing, ward_versions(spark), community_areas(spark), now, checked=False, **options)

    land(raw(spark, record(last_modified_date="2023-06-10T00:00:00"), record(sr_number="SR3", last_modified_date=None)), landing, "1")
    run(T1)
    # older than the newest row of the fact; corrected at the same time; and without a key
    land(raw(spark, record(sr_number="SR2", last_modified_date="2023-05-01T00:00:00"),
             record(status="Open", last_modified_date="2023-06-10T00:00:00"), record(sr_number=None)), landing, "2")
    report = run(T2)
    warehouse = Warehouse(spark, root)
    merged = rows(warehouse.fact.read())
    assert [(r[0], r[3]) for r in merged] == [("SR1", "open"), ("SR2", "completed"), ("SR3", "completed")]
    assert report.where("check_name = 'landed.key.present'").first()["failures"] == 1
    run(T3, full_refresh=True)
    assert rows(warehouse.fact.read()) == merged


def test_nothing_without_a_key_is_missing_from_the_fact(spark):
    staged = spark.createDataFrame([("a", 1, None), ("b", 2, 5), (None, 3, 5), ("c", None, None)], "sr_id string, x int, y int")
    fact = spark.createDataFrame([("a", 1, None), ("b", 2, 6)], "sr_id string, x int, y int")
    assert rows(not_held(staged, fact, columns=["x", "y"]).select("sr_id")) == [("b",), ("c",)]


def test_only_what_is_new_is_opened(spark, folder):
    """A thousand loaded files are spoilt, so opening one would stop the load; a new one with a further column still loads."""
    from pathlib import Path

    target, ledger, landing = VersionedTable(spark, f"{folder}/raw"), VersionedTable(spark, f"{folder}/ledger", LEDGER_SLOT), Path(folder, "in")
    first = pa.table({"sr_number": ["1"], "last_modified_date": ["2024-01-01"]})
    for i in range(1000):
        os.makedirs(landing / f"run {i // 100}", exist_ok=True)
        pq.write_table(first.set_column(0, "sr_number", [[str(i)]]), landing / f"run {i // 100}" / f"{i}.parquet")

    def run():
        ingest_landed(spark, str(landing), target, None, f"{folder}/check", ledger=ledger)

    run()
    assert target.count() == 1000 == ledger.count()
    for i in range(1000):
        (landing / f"run {i // 100}" / f"{i}.parquet").write_bytes(b"no parquet any more")
    os.makedirs(landing / "x=1 [late] {a*}?")
    pq.write_table(pa.table({"sr_number": ["7", "new", None], "last_modified_date": ["2024-01-02"] * 3, "extra": [1, 2, 3]}),
                   landing / "x=1 [late] {a*}?" / "%41 b.parquet")
    run()
    run()
    assert rows(target.read().where("extra is not null").select("sr_number", "extra")) == [("7", "1"), ("new", "2")]
    added = ledger.read().where("records = 3").collect()
    assert len(added) == 1 and added[0]["columns"] == ["sr_number", "last_modified_date", "extra"] and ledger.count() == 1001
    assert added[0]["size"] > 0 and added[0]["path"].endswith("b.parquet")


def test_a_batch_may_lack_columns_of_the_table(spark, folder):
    target, lost = VersionedTable(spark, f"{folder}/raw"), VersionedTable(spark, f"{folder}/lost")
    for run, text in enumerate(["sr_number string, last_modified_date string, a string", "sr_number string, last_modified_date string, b int",
                                "last_modified_date string, c string"]):
        spark.createDataFrame([("1" if "sr_" in text else "2024-01-09", f"2024-01-0{run + 1}", run)[-text.count(",") - 1:]
                               if "sr_" in text else ("2024-01-09", "x")], text).write.parquet(f"{folder}/in/{run}")
        ingest_landed(spark, f"{folder}/in", target, None, f"{folder}/check", rejected=lost)
    assert rows(target.read().select("sr_number", "last_modified_date", "a", "b")) == [("1", "2024-01-02", None, "1")]
    assert rows(lost.read().select("last_modified_date", "c")) == [("2024-01-09", "x")]
