"""Row positions in a total order, without ever gathering the rows in one task.

A window without partition keys sorts the whole table in a single task. Here the rows are range-partitioned on the
order columns, numbered inside each range, and written out, which freezes the ranges; the number of rows in earlier
ranges is then added. The order columns must identify a row, which also lets every range be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.sources.shared import settle

_MARK, _RANGE, _OFFSET, _START = "position_mark", "position_range", "position_offset", "position_start"
ROW_BITS = 33  # monotonically_increasing_id keeps the row count of a partition in the lower 33 bits


def dense_ids(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number the rows 1, 2, 3, ... by the order, which must be unique. Equals row_number() over (order by ...)."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    frozen = settle(ranged.withColumn(_MARK, F.monotonically_increasing_id()), "positions")
    placed = frozen.select(
        *df.columns,
        F.shiftright(_MARK, ROW_BITS).alias(_RANGE),
        F.col(_MARK).bitwiseAND(F.lit(2**ROW_BITS - 1)).alias(_OFFSET),
    )
    # one row per range, that is per shuffle partition: small enough to sort in one task and to broadcast
    sizes = placed.groupBy(_RANGE).agg((F.max(_OFFSET) + 1).alias("rows"))
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(_RANGE, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(_START))
    return placed.join(F.broadcast(starts), _RANGE).select(
        *df.columns, (F.col(_START) + F.col(_OFFSET) + 1).alias(name)
    )


def positions_within(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """Number the rows of each group 1, 2, 3, ...; a group may be larger than any one task could sort.

    A row's place in its group is its place in the whole table, ordered by group first, less that of the group's first
    row. NULL is a group of its own. The groups' first rows are stored, so that the rows stay where they are if these are few.
    """
    numbered = dense_ids(df, [F.col(g).asc_nulls_last() for g in group] + order, name)
    firsts = settle(numbered.groupBy(*group).agg(F.min(name).alias(_START)), "group-heads")
    rows, heads = numbered.alias("r"), firsts.alias("h")
    same = [F.col(f"r.`{g}`").eqNullSafe(F.col(f"h.`{g}`")) for g in group]
    return rows.join(heads, same).select(
        *[F.col(f"r.`{c}`") for c in df.columns],
        (F.col(f"r.`{name}`") - F.col(f"h.`{_START}`") + 1).alias(name),
    )


def every_nth(df: DataFrame, order: list[Column], n: int, name: str = "position") -> DataFrame:
    """The first row of the order and every n-th after it."""
    return dense_ids(df, order, name).where(F.pmod(F.col(name) - 1, F.lit(n)) == 0)


def last_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """The last n rows by a position column, back in order."""
    return df.orderBy(F.col(order).desc_nulls_last()).limit(n).orderBy(F.col(order).asc_nulls_last())


def backwards(df: DataFrame, order: str) -> DataFrame:
    return df.orderBy(F.col(order).desc_nulls_last())


def median_by_position(df: DataFrame, group: list[str], value: str, row_id: str, name: str) -> DataFrame:
    """Exact median of any number of different values per group: number the rows, average the one or two in the middle.

    The middle rows are fetched by their number in the whole table, so no join is made on the groups themselves. See
    `aggregates.median_of_counts` for the cheaper form when the values repeat a lot.
    """
    rows = df.where(F.col(value).isNotNull()).select(*group, value, row_id)
    order = [*[F.col(g).asc_nulls_last() for g in group], F.col(value).asc(), F.col(row_id).asc()]
    numbered = dense_ids(rows, order, "_n")
    ends = numbered.groupBy(*group).agg(F.min("_n").alias("lo"), F.max("_n").alias("hi"))
    half = (F.col("hi") - F.col("lo")) / 2
    middle = F.array_distinct(F.array(F.col("lo") + F.floor(half), F.col("lo") + F.ceil(half)))
    wanted = ends.select(*group, F.explode(middle).alias("_n"))
    found = wanted.join(numbered.select("_n", value), "_n")
    return found.groupBy(*group).agg(((F.min(value) + F.max(value)) / 2).alias(name))
