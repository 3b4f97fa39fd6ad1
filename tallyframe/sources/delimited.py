"""Comma-separated text: small seed files, and lines held in a string column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.text import strip_space


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_seed(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def parse_delimited(lines: DataFrame, line: str, columns: dict[str, str], keep: list[str] = ()) -> DataFrame:
    """Split each line at its commas (no quoting), trim every value and cast it to the type given for its column; a bad
    value raises."""
    parts = F.transform(F.split(strip_space(F.col(line)), ","), strip_space)
    split = lines.select(*keep, parts.alias("parts"))
    return split.select(
        *keep, *[F.col("parts")[i].cast(kind).alias(name) for i, (name, kind) in enumerate(columns.items())]
    )
