"""A bounded sample of labelled rows, the same for the same data in any order and partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.rowwise import in_training


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """key, text and label of at most `per_class` rows of each label, from the training part of the ids only.

    Ids are taken in the order of a hash. Rows with a NULL id, text or label are left out; of an id with several labels the
    smallest counts. A sampled id that repeats in `docs` has all its rows here: see `one_per_id` for the bound on rows.
    """
    known = (
        labels.where(in_training(F.col(key)) & F.col(label).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("k")).agg(F.min(F.col(label).cast("int")).alias("label")))
    picked = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64(F.col("k").cast("string")), "k").limit(per_class)
        picked = part if picked is None else picked.unionAll(part)
    rows = docs.where(in_training(F.col(key)) & F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("text"))
    # the sample has at most 2 * per_class rows of two numbers, a bound that does not depend on the data
    return rows.join(F.broadcast(picked), "k").select(F.col("k").alias(key), F.col("text").alias(text), "label")


def one_per_id(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """label and the columns of one row for each id, the smallest by them; for what is left of the texts, which is small."""
    least = rows.groupBy(key, "label").agg(F.min(F.struct(*columns)).alias("least"))
    return least.select("label", "least.*")
