"""Grouped summaries. All of them reduce in the map tasks first, so a large group shrinks before it is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.numbers import round_half_away


def median_of_counts(counts: DataFrame, group: list[str], value: str, times: str, name: str) -> DataFrame:
    """Exact median per group of values given with the number of times each occurs.

    The final step holds one entry per different value of a group, so use it for values of bounded variety, such as
    whole hours; `positions.median_by_position` has no such bound.
    """
    return counts.groupBy(*group).agg(F.percentile(value, F.lit(0.5), F.col(times)).alias(name))


def pivot_sum(df: DataFrame, group: list[str], across: str, values: list, measure: str) -> DataFrame:
    """One column per listed value of `across`, holding the sum of the measure; no group columns means one row."""
    return df.groupBy(*group).pivot(across, values).agg(F.sum(measure))


def merge_duplicates(df: DataFrame, key: str, position: str, total: str) -> DataFrame:
    """One row per key: every column of its first row, with `total` summed over all its rows."""
    others = [c for c in df.columns if c not in (key, total)]
    merged = df.groupBy(key).agg(
        F.min_by(F.struct(*others), F.col(position)).alias("first"), F.sum(total).alias(total)
    )
    return merged.select(key, *[F.col(f"first.`{c}`").alias(c) for c in others], total)


def last_by_key(df: DataFrame, key: str, position: str) -> DataFrame:
    """One row per key, the last by position: later entries replace earlier ones."""
    others = [c for c in df.columns if c != key]
    last = df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(position)).alias("last"))
    return last.select(key, *[F.col(f"last.`{c}`").alias(c) for c in others])


def extreme_rows(df: DataFrame, by: Column, position: str, group: list[str] = (), smallest: bool = False) -> DataFrame:
    """The whole row with the greatest (or smallest) value, per group or overall; ties go to the first by position.

    Rows without a value never win.
    """
    rank = F.struct(by.alias("v"), (F.col(position) if smallest else -F.col(position)).alias("p"))
    pick = F.min_by if smallest else F.max_by
    best = df.where(by.isNotNull()).groupBy(*group).agg(pick(F.struct(*df.columns), rank).alias("best"))
    return best.where(F.col("best").isNotNull()).select("best.*")


def best_and_worst(df: DataFrame, by: str, position: str) -> DataFrame:
    """Both ends of a ranking in one pass, as two rows marked 'highest' and 'lowest'.

    The ranking is descending and stable: among equal values the first by position leads and the last by position ends.
    """
    rank = F.struct(F.col(by).alias("v"), (-F.col(position)).alias("p"))
    row = F.struct(*df.columns)
    ends = df.where(F.col(by).isNotNull()).agg(F.max_by(row, rank).alias("hi"), F.min_by(row, rank).alias("lo"))
    pairs = F.array(
        F.struct(F.lit("highest").alias("place"), F.col("hi").alias("r")),
        F.struct(F.lit("lowest").alias("place"), F.col("lo").alias("r")),
    )
    return ends.select(F.inline(pairs)).where(F.col("r").isNotNull()).select("place", "r.*")


def repeated(df: DataFrame, columns: list[str], position: str | None = None) -> DataFrame:
    """Values, single or combined, found more than once, with how often and, given a position, where first."""
    measures = [F.count(F.lit(1)).alias("times")]
    if position is not None:
        measures.append(F.min(position).alias("first_seen"))
    return df.groupBy(*columns).agg(*measures).where(F.col("times") > 1)


def count_classes(df: DataFrame, column: str) -> DataFrame:
    """Per value: how often it occurs and whether that is once, exactly twice, or three times and more."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("times"))
    times = F.col("times")
    return counts.select(
        column, "times", (times == 1).alias("once"), (times == 2).alias("twice"), (times >= 3).alias("three_or_more")
    )


def column_profile(df: DataFrame, numeric: list[str]) -> DataFrame:
    """Row count and, per numeric column, least, greatest and mean value (two decimals), from one pass."""
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(numeric):
        value = F.col(c).cast("double")
        aggregates += [F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}"), F.avg(value).alias(f"av{i}")]
    lines = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.col("n").alias("total_rows"), F.col(f"lo{i}").alias("min_value"),
            F.col(f"hi{i}").alias("max_value"), round_half_away(F.col(f"av{i}"), 2).alias("avg_value"),
        )
        for i, c in enumerate(numeric)
    ])
    return df.agg(*aggregates).select(F.inline(lines))


def bounding_box(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.min(x).alias("min_x"), F.min(y).alias("min_y"), F.max(x).alias("max_x"), F.max(y).alias("max_y"))
