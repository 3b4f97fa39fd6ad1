"""Every registered query against its SQL, and the shape of the plans."""

from __future__ import annotations

import re
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as contract
from compare import difference, duck

from tallyframe.operators import joins, repeats, upsert
from tallyframe.suite import ORACLES as LIBRARY_ORACLES
from tallyframe.suite import QUERIES as LIBRARY_QUERIES

SF = "/root/testdata/sf0.001"
# the training-data queries have tests of their own
QUERIES, ORACLES = LIBRARY_QUERIES, LIBRARY_ORACLES
STORED = {"daily_run", "ingest_available_now"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, SF, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "service_request_type", "total_requests", "duplicate_requests", "duplicate_pct"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED))
def test_no_pairs_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|EvalPython|MapInPandas", text)


def test_filter_and_columns_reach_the_scan(spark):
    text = QUERIES["rows_after_cursor"](spark, SF)._jdf.queryExecution().toString()
    assert "GreaterThan(ts," in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint>" in text


@pytest.fixture
def nothing_is_small(spark):
    """As if every table were too large to broadcast and every partition large."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "5KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark, n=60_000):
    """A third of the rows under one key and, of these, many at one instant."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997)
    at = F.timestamp_seconds(F.when(F.col("id") % 6 == 0, 0).otherwise(F.col("id") * 50)).cast("timestamp_ntz")
    return spark.range(0, n, 1, 16).select("id", key.alias("k"), at.alias("at"), F.md5(F.col("id").cast("string")).alias("pad"))


def test_hot_key_is_split_in_joins(spark, nothing_is_small):
    table = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    joined = joins.lookup_or(hot_rows(spark), table, "k", "name", F.lit("none"))
    assert joined.count() == 60_000
    joined.collect()
    assert "skew=true" in plan(joined)


def test_hot_key_of_a_target_is_split_in_upserts(spark, nothing_is_small):
    target = hot_rows(spark)
    merged = upsert.upsert(target, target.where("id % 500 = 1"), "k", ["id"])
    merged.collect()
    assert "skew=true" in plan(merged)


def test_hot_instant_is_split_when_flagging(spark, nothing_is_small):
    flagged = repeats.flag_repeats(hot_rows(spark), ["k"], "at", 14, "id", "again")
    assert len(flagged.collect()) == 60_000
    assert "skew=true" in plan(flagged)
