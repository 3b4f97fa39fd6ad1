"""Edits of one row's array or map. Positions count from zero; "first" means the first match only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def insert_at(items: Column, position: int, value: Column) -> Column:
    return F.array_insert(items, position + 1, value)


def last_to_front(items: Column) -> Column:
    """Take the last item off and put it first; an empty array stays empty."""
    moved = F.concat(F.slice(items, -1, 1), F.slice(items, F.lit(1), F.size(items) - 1))
    return F.when(F.size(items) > 1, moved).otherwise(items)


def remove_first(items: Column, value: Column) -> Column:
    at = F.array_position(items, value).cast("int")
    rest = F.concat(F.slice(items, F.lit(1), at - 1), F.slice(items, at + 1, F.size(items)))
    return F.when(at > 0, rest).otherwise(items)


def index_of(items: Column, value: Column) -> Column:
    """Zero-based position of the first match, NULL when there is none."""
    at = F.array_position(items, value)
    return F.when(at > 0, at - 1)


def last_items(items: Column, n: int) -> Column:
    return F.slice(items, F.greatest(F.size(items) - n + 1, F.lit(1)), F.lit(n))


def every_second(items: Column) -> Column:
    return F.filter(items, lambda _, i: F.pmod(i, F.lit(2)) == 0)


def numbered(items: Column) -> Column:
    """'1.first', '2.second', ..."""
    return F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit("."), x))


def get_or(mapping: Column, key: Column, default: Column) -> Column:
    return F.coalesce(F.try_element_at(mapping, key), default)


def put(mapping: Column, key: Column, value: Column) -> Column:
    return F.map_concat(without(mapping, key), F.map_from_arrays(F.array(key), F.array(value)))


def without(mapping: Column, key: Column) -> Column:
    return F.map_filter(mapping, lambda k, _: k != key)


def sorted_keys(mapping: Column) -> Column:
    return F.array_sort(F.map_keys(mapping))


def keys_with_prefix(mapping: Column, prefix: str) -> Column:
    """Sorted keys whose value starts with the prefix."""
    return sorted_keys(F.map_filter(mapping, lambda _, v: v.startswith(prefix)))
