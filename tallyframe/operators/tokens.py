"""Word counts over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.text import split_words, strip_marks


def token_counts(df: DataFrame, text: str, normalised: bool = False) -> DataFrame:
    """How often each word occurs; normalised means lower case with the marks off both ends."""
    source = F.lower(text) if normalised else F.col(text)
    token = F.col("token")
    found = df.select(F.explode(split_words(source)).alias("token"))
    if normalised:
        found = found.select(strip_marks(token).alias("token"))
    return found.where(F.length("token") > 0).groupBy("token").agg(F.count(F.lit(1)).alias("times"))


def words_once(df: DataFrame, text: str) -> DataFrame:
    return token_counts(df, text).where(F.col("times") == 1)


def once_in_order(df: DataFrame, text: str, order: str) -> DataFrame:
    """Words found exactly once, by first letter; words sharing it keep their order in the texts."""
    placed = df.select(F.col(order).alias("_text"), F.posexplode(split_words(F.col(text))).alias("_at", "token"))
    found = placed.where(F.length("token") > 0).groupBy("token").agg(
        F.count(F.lit(1)).alias("times"), F.min("_text").alias(order), F.min("_at").alias("word_number")
    )
    first = F.substring("token", 1, 1)
    once = found.where(F.col("times") == 1).select(first.alias("first_letter"), "token", order, "word_number")
    return once.orderBy("first_letter", order, "word_number")


def same_count(counts: DataFrame, first: str, second: str) -> DataFrame:
    """One row: how often two words occur and whether that is equally often; an unseen word occurs 0 times."""
    seen = counts.where(F.col("token").isin(first, second)).agg(
        F.coalesce(F.max(F.when(F.col("token") == first, F.col("times"))), F.lit(0)).alias("first_times"),
        F.coalesce(F.max(F.when(F.col("token") == second, F.col("times"))), F.lit(0)).alias("second_times"),
    )
    return seen.withColumn("same", F.col("first_times") == F.col("second_times"))
