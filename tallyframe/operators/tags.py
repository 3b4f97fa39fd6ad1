"""Items with tags, one row per (item, tag), and permissions reached over roles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.sources.shared import settle


def tag_rows(df: DataFrame, item: str, tags: Column) -> DataFrame:
    """Array column to distinct (item, tag) rows."""
    return df.select(item, F.explode(tags).alias("tag")).distinct()


def sharing_with(pairs: DataFrame, item: str, tag: str, target: DataFrame, at_least: int = 2) -> DataFrame:
    """Other items sharing at least that many tags with the target item, and how many they share.

    `target` has the one target item in its `item` column. Work grows with the rows carrying one of the target's tags;
    items are never compared with each other. The target's tags come first and are stored; of the other rows only those with
    one of them are made distinct.
    """
    pairs, target = pairs.select(item, tag), target.select(item)
    own = settle(pairs.join(target, item, "left_semi").select(tag).distinct(), "target-tags")
    others = pairs.join(own, tag, "left_semi").join(target, item, "left_anti").distinct()
    shared = others.groupBy(item).agg(F.count(F.lit(1)).alias("shared_tags"))
    return shared.where(F.col("shared_tags") >= at_least)


def all_tags(pairs: DataFrame, tag: str) -> DataFrame:
    return pairs.select(tag).distinct()


def tags_on_every_item(pairs: DataFrame, item: str, tag: str) -> DataFrame:
    """Tags that no item lacks. The distinct pairs are stored, as they are counted twice."""
    distinct = settle(pairs.select(item, tag).distinct(), "tag-pairs")
    items = distinct.agg(F.count_distinct(item).alias("n"))
    per_tag = distinct.groupBy(tag).agg(F.count(F.lit(1)).alias("n_items"))
    return per_tag.where(F.col("n_items") == items.scalar()).select(tag)


def users_with_permission(users: DataFrame, roles: DataFrame, user: str, role: str, permission: str) -> DataFrame:
    """Users whose role grants the permission. `roles` has one row per role with a `permissions` array; what is needed of it
    is stored, so that Catalyst knows its size and moves no users where it is small."""
    granting = settle(roles.where(F.array_contains("permissions", permission)).select(role), "roles")
    return users.join(granting, role, "left_semi").select(user, role)


def has_permission(users: DataFrame, roles: DataFrame, user: str, role: str, permission: str) -> DataFrame:
    """Every user with the answer; a role nobody defined grants nothing."""
    joined = users.join(settle(roles.select(role, "permissions"), "roles"), role, "left")
    answer = F.coalesce(F.array_contains("permissions", permission), F.lit(False))
    return joined.select(user, role, answer.alias("allowed"))


def _permissions_of(roles: DataFrame, role: str, name: str) -> Column:
    """One role's permissions as a scalar subquery; a role nobody defined has none."""
    own = roles.where(F.col(role) == name).agg(F.max("permissions").alias("p"))
    return F.coalesce(own.scalar(), F.array().cast("array<string>"))


def combined_permissions(users: DataFrame, roles: DataFrame, role: str, extra: str) -> DataFrame:
    """Every user's permissions once the extra role is added, as a sorted array; unknown roles grant nothing."""
    roles = settle(roles.select(role, "permissions"), "roles")
    joined = users.join(roles, role, "left")
    own = F.coalesce("permissions", F.array().cast("array<string>"))
    both = F.array_union(own, _permissions_of(roles, role, extra))
    return joined.select(*users.columns, F.sort_array(both).alias("combined"))


def compare_with_role(roles: DataFrame, role: str, base: str) -> DataFrame:
    """Every role with its permissions beyond those of a base role and those it shares with it, as sorted arrays."""
    reference = _permissions_of(roles, role, base)
    return roles.select(
        role,
        F.sort_array(F.array_except("permissions", reference)).alias("beyond"),
        F.sort_array(F.array_intersect("permissions", reference)).alias("shared"),
    )
