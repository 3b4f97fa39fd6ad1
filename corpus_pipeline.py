"""From documents to token ids: toxic, near-duplicate and contaminated documents go, secrets are masked, the rest encoded.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept, and returns a DataFrame; `run` writes
each result as Parquet in the shared folder and reads it again. All but the last keep the columns of `documents`, also
columns of the same names as the stages' own, which travel inside one struct.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import byte_bpe, decontaminate, jaccard, secrets, toxicity
from tallyframe.sources.shared import settle, settled_scope, shared_path

#: Words of a shingle and per cent of similarity from which two documents are near duplicates.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
#: Rows of two numbers that are sent to every task at most.
BROADCAST_ROWS = 1_000_000
#: Parts of words whose ids a task of the encoding remembers. Its worker serves later stages too and keeps most of that memory.
REMEMBERED_PARTS = 50_000


def _whole(docs: DataFrame) -> DataFrame:
    """doc_id, text and the whole row as one struct."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more go. Empty and NULL texts are scored too; rows without an id are scored and not learnt from."""
    machine = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score_toxicity(_whole(docs), machine, carry=("__row",))
    return scored.where("predicted = 0").select("__row.*")


def _stored(spark: SparkSession, made: Callable[[], DataFrame], label: str) -> DataFrame:
    """The rows that a function makes, stored; what it stored on the way goes."""
    path = shared_path(spark, label)
    with settled_scope(spark):
        made().write.parquet(path)
    return spark.read.parquet(path)


def _without(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of `docs` whose doc_id and __h are not (left_anti) or are (left_semi) listed. Up to BROADCAST_ROWS listed rows, of two numbers
    each, go to the documents; beyond that both sides move."""
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, ["doc_id", "__h"], how)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents that with the smallest id stays, once if its row repeats.

    Documents without words are linked with nothing and stay, as do rows without an id.
    """
    marked = docs.withColumn("__h", F.xxhash64("text"))
    classes = _stored(spark, lambda: jaccard.similar_components(
        marked, size=SHINGLE_WORDS, percent=SIMILAR_PERCENT, carry=("__h",)), "classes")
    linked = classes.where("n_shingles > 0 and doc_id is not null")
    gone = settle(linked.where("doc_id <> component_id").select("doc_id", "__h").distinct(), "gone")
    again = settle(linked.groupBy("doc_id", "__h").count().where("count > 1").drop("count"), "again")
    kept = _without(marked, gone, "left_anti")
    single = _without(kept, again, "left_anti")
    repeated = _without(kept, again, "left_semi").dropDuplicates(["doc_id", "__h"])
    return single.select(docs.columns).unionByName(repeated.select(docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; empty and NULL texts hold none."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_leaks(_whole(docs), benchmark, key="__row")
    return found.where(F.size("leaks") == 0).select("__row.*")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Confirmed secrets are masked and n_chars counted anew where the text changed; every document stays."""
    clean = secrets.redact(docs.withColumn("__text", F.col("text")))
    changed = ~F.col("text").eqNullSafe(F.col("__text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return clean.select(*(F.col(f"`{c}`") for c in docs.columns))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of the ids and of the bytes decoded from them."""
    return byte_bpe.encode_documents(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, remembered=REMEMBERED_PARTS)


STAGES = [
    ("toxicity", toxicity_stage), ("near duplicates", near_duplicate_stage), ("decontamination", decontamination_stage),
    ("secrets", secrets_stage), ("encoding", encoding_stage)]

#: A trained forest, a trained machine, SimHash and BPE merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
