"""The cluster's shared folder, and small or frozen intermediate tables written into it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
#: Tables settled in the innermost open scope of this thread of work; None outside of any.
_scope: ContextVar[list[str] | None] = ContextVar("settled", default=None)


def shared_root(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only for a local session that names none."""
    named = spark.conf.get(_SETTING, None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master  # local-cluster has executors of its own
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tallyframe-")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write the rows as a table and read them back.

    Three uses: a derived dimension gets a true file size, so Catalyst broadcasts it only when it is small; an
    aggregate used several times is computed once; and row positions that depend on the physical layout are frozen
    before anything relies on them. The table outlives lost executors, unlike a cache.
    """
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    held = _scope.get()
    if held is not None:
        held.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def settled_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the tables settled inside the block when it ends; for a job that has stored its results by then.

    Only the block's own work counts: other threads keep theirs, unless they run in a copy of the block's context.
    """
    held: list[str] = []
    outer = _scope.set(held)
    try:
        yield
    finally:
        _scope.reset(outer)
        for path in held:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
