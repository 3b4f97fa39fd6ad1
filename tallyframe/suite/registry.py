from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query. Its whole numbers come out as BIGINT, which is what the SQL side casts to."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def widened(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = run(spark, sf_dir)
            narrow = (T.IntegerType, T.ShortType, T.ByteType)
            columns = {f.name: F.col(f"`{f.name}`").cast("bigint") for f in df.schema if isinstance(f.dataType, narrow)}
            return df.withColumns(columns) if columns else df

        QUERIES[name] = widened
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
