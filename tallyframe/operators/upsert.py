"""Keyed upsert and the clean-up a batch needs before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, newest: list[str] | None = None) -> DataFrame:
    """One row per key: the greatest by the `newest` columns, then by the remaining columns so that reruns agree.

    An aggregate rather than a window: map tasks reduce a key's copies before the shuffle, so a key holding a large
    share of the rows never reaches one task whole.
    """
    newest = newest or []
    rest = [c for c in df.columns if c != key and c not in newest]
    if not newest and not rest:
        return df.distinct()
    best = df.groupBy(key).agg(F.max(F.struct(*newest, *rest)).alias("best"))
    return best.select(*[F.col(key) if c == key else F.col(f"best.`{c}`").alias(c) for c in df.columns])


def keyless(df: DataFrame, key: str) -> DataFrame:
    """Rows an upsert cannot place, as their key is NULL or, where it is text, blank."""
    return df.where(F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == ""))


def keyed(df: DataFrame, key: str) -> DataFrame:
    """All other rows."""
    return df.where(F.trim(F.col(key).cast("string")) != "")


def upsert(
    target: DataFrame | None,
    batch: DataFrame,
    key: str,
    newest: list[str] | None = None,
    deduplicate: bool = True,
) -> DataFrame:
    """Target rows whose key the batch lacks, plus the batch, matched by column name.

    With `deduplicate` the batch is reduced to its latest row per key and rows without a key are left out. Without it
    the batch goes in as it is, repeated keys and all, which is what a plain delete-then-insert does.
    """
    if deduplicate:
        batch = latest_per_key(batch.where(F.col(key).isNotNull()), key, newest)
    if target is None:
        return batch
    # Null-safe equality makes no difference to the rows, as NULL keys are left out, but keeps the join's shuffle apart
    # from the one that reduced the batch; only then can adaptive execution split a key the target holds too often.
    keys = batch.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"))
    kept = target.join(keys, target[key].eqNullSafe(keys["_key"]), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)
