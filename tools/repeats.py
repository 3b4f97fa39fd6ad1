"""Repeats by time slices against one lag over each key, on 7 million rows: python tools/repeats.py [SF_DIR]

The rows are those of `lineitem`, twelve copies a year apart, with a third of them under one key. Both ways are run to
completion into a sink that drops the rows, once to warm up and then timed; their totals must agree.
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tallyframe.operators.repeats import repeat_totals  # noqa: E402
from tallyframe.session import local_session  # noqa: E402
from tallyframe.sources.shared import settle  # noqa: E402

DAYS = 14


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    copies = lines.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(11))))
    hot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == 0
    return copies.select(
        F.when(hot, 0).otherwise(F.col("l_partkey")).alias("place"), F.when(hot, 0).otherwise(F.col("l_suppkey") % 12).alias("code"),
        (F.add_months(F.to_date("l_shipdate"), F.col("copy") * 12).cast("timestamp_ntz") + F.make_dt_interval(
            hours=F.pmod(F.xxhash64("l_orderkey", "copy"), F.lit(24)).cast("int"))).alias("at"))


def by_lag(df: DataFrame) -> DataFrame:
    before = F.lag("at").over(Window.partitionBy("place", "code").orderBy("at"))
    again = F.col("at") <= before + F.make_dt_interval(F.lit(DAYS))
    return df.withColumn("again", F.coalesce(again, F.lit(False))).groupBy("code").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("again").alias("repeats"))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, "repeats")
    df = settle(rows(spark, sf_dir), "repeat-rows")
    ways = {"slices": repeat_totals(df, ["place", "code"], "at", DAYS, ["code"]), "lag": by_lag(df)}
    seconds, totals = {}, {}
    for name, way in ways.items():
        totals[name] = sorted(map(tuple, way.collect()))
        began = time.perf_counter()
        way.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 2)
    print(json.dumps({"rows": df.count(), "seconds": seconds, "agree": totals["slices"] == totals["lag"]}))


if __name__ == "__main__":
    main()
