"""The mix by its SQL, by plain Python on planted rows, and by what it promises."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import mixing, queries

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
from compare import difference, duck  # noqa: E402

SCHEMA = "doc_id long, text string, source string"


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_sql(spark, sf):
    assert difference(spark, duck(sf), sf, queries.QUERIES["op11_exponential_mix"], queries.ORACLES["op11_exponential_mix"]) is None


def targets(sizes, weights=(1, 2, 3), most=3):
    """Reshared by hand until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    share = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        open_share = sum(share[s] for s in order if s not in full)
        left = total - sum(most * sizes[s] for s in full)
        rate = left / open_share if open_share else 0
        over = {s for s in order if s not in full and rate * share[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else rate * share[s] for s in order}
        full |= over


def expected(rows, quality=None):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = defaultdict(list)
    for key, text, source in rows:
        digest = hashlib.md5(f"mix:{'' if key is None else key}:{text or ''}".encode()).hexdigest()
        u = (int(digest[:13], 16) + 0.5) / 2**52
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        weight = 0.05
        if words:
            prosaic = sum(c not in mixing.UNPROSAIC for c in text) / len(text)
            weight = max(0.05, prosaic * (math.log(len(set(words)) + 1.0) / math.log(len(words) + 1.0)))
        by[source].append((-math.log(u) / weight, int(digest[13:28], 16), key, size(text)))
    sizes = {s: sum(d[3] for d in docs) for s, docs in by.items()}
    made = []
    for source, target in targets(sizes).items():
        epochs = int(target // sizes[source]) if sizes[source] else 0
        budget = math.floor(target - epochs * sizes[source] + 0.5)
        for _, _, key, n in sorted(by[source], key=lambda d: d[:2]):
            part = max(0, min(n, budget))
            budget -= part
            made.append((key, source, n, sizes[source], target, epochs, epochs * n + part))
    return made


def plain(made):
    return sorted(((str(a), str(b), *c, round(t, 6), *d) for a, b, *c, t, e, k in made for d in [(e, k)]))


def planted(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg#3é") for _ in range(rng.randint(1, 7)))
    rows = []
    for i in range(400):
        source = rng.choice(["hot"] * 4 + ["a", "b", "Z", "é", "\U0001f600", "￿", None, ""])
        rows.append((i if rng.random() < 0.95 else None, rng.choice(" \t\n\x0b\x0c\r").join(word() for _ in range(rng.choice([0, 1, 3, 50, 200]))), source))
    rows += [(5000, "whole " * 30_000, "hot"), (5001, None, "hot"), (5002, "", "none"), (5003, "   　x", "b")]
    rows += [(5004, "a row that comes several times", "tiny")] * 5 + [(5004, "and the same id with another text", "tiny")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_against_plain_python(spark, seed):
    rows = planted(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(9)
    docs = docs.selectExpr("*", "1 as size", "'t' as turn", "2.0 as target", "text as words", "3 as _mark", "'x' as _range", "4 as doc", "5 as taken")
    got = [tuple(r) for r in mixing.mix(docs).collect()]
    assert plain(got) == plain(expected(rows))
    again = [tuple(r) for r in mixing.mix(docs.repartition(3)).collect()]
    assert plain(again) == plain(got)
    taken, target = defaultdict(int), {}
    for _, source, size, source_size, wanted, _, words in got:
        taken[source] += words
        target[source] = wanted
        assert 0 <= words <= 3 * size and wanted <= 3 * source_size
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)


def test_targets_share_what_is_over(spark):
    for sizes in ({"a": 100, "b": 100, "c": 1}, {"a": 1, "b": 1, "c": 1, "d": 1000, "e": 30, None: 2}, {"a": 5}, {"a": 0, "b": 7}, {"a": 0}):
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
        assert got == pytest.approx(targets(sizes)) and sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_quality_decides_who_is_taken_first(spark):
    """Of many documents of one size, those of four times the weight fill about four times the places at the start."""
    docs = spark.range(6000).selectExpr(
        "id as doc_id", "'one two' as text", "if(id < 4000, 'a', 'b') as source", "if(id % 2 = 0, 4.0, 1.0) as good").withColumn("text", F.lit("one two"))
    rows = mixing.measured(docs, "doc_id", "text", "source", "mix", F.col("good")).orderBy("turn").limit(400).collect()
    better = sum(r["doc"] % 2 == 0 for r in rows)
    assert 0.74 < better / len(rows) < 0.86
    odd = docs.withColumn("good", F.expr("case when doc_id < 3 then null when doc_id < 6 then -1 when doc_id < 9 then double('nan') else 1 end"))
    got = mixing.mix(odd, weight=F.col("good")).agg(F.sum("taken"), F.count("*")).first()
    assert tuple(got) == (12_000, 6000)


def test_nothing_to_mix(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).collect() == []
    blank = spark.createDataFrame([(1, None, None), (2, " ", "a")], SCHEMA)
    assert [tuple(r)[2:] for r in mixing.mix(blank).collect()] == [(0, 0, 0.0, 0, 0)] * 2


def test_plan_has_no_python(spark):
    plan = mixing.mix(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_a_source_is_summed_up_in_ranges(spark):
    """One source of many rows is dealt to several ranges; the sums go on across them."""
    rows = spark.range(50_000).selectExpr("if(id < 100, null, 'one') as source", "xxhash64(id) as turn", "id % 7 as size")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        summed = mixing.settle(mixing.sums_before(rows, "source", [F.col("turn")], "size", "before"), "summed")
        ranges = rows.repartitionByRange("source", "turn").groupBy(F.spark_partition_id()).count()
        assert ranges.count() >= 6 and ranges.agg(F.max("count")).first()[0] < 15_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total = {}
    for r in summed.orderBy("turn").collect():
        assert r["before"] == total.get(r["source"], 0)
        total[r["source"]] = r["before"] + r["size"]
