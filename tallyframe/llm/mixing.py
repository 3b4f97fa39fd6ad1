"""Mixing sources to target weights: whole epochs first, then a weighted sample without replacement up to the word budget.

A document's key is an exponential variate divided by its quality weight (Efraimidis and Spirakis), so the documents of a
source in key order are a weighted sample of any length. Words are summed up along that order and taken until the budget is
spent. Variates come from a digest of the document, so reruns agree. Only DataFrame functions are used.

No source is gathered in one task: rows are dealt by ranges of (source, key), summed up inside each range, and shifted by the
words of the source's earlier ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.operators.positions import dense_ids
from tallyframe.sources.shared import settle

#: Weights of the sources in order, repeating, and how many epochs of a source a mix takes at most.
WEIGHTS, EPOCHS = (1, 2, 3), 3
LEAST_QUALITY = 0.05
#: Characters that running prose holds few of.
UNPROSAIC = "0123456789#*$%&|<>{}[]_=+/\\^~`@"
_SPACES = "\t\n\x0b\x0c\r"
_RANGE_BITS = 33  # monotonically_increasing_id keeps the place in a partition in the lower 33 bits


def quality_weight(text: Column, words: Column) -> Column:
    """Between LEAST_QUALITY and 1: the share of prosaic characters times the variety of the words, ln(1 + different) /
    ln(1 + all), which unlike a plain share does not fall with the length of a natural text. LEAST_QUALITY without words."""
    prosaic = F.length(F.translate(text, UNPROSAIC, "")) / F.length(text)
    variety = F.log(F.size(F.array_distinct(words)) + F.lit(1.0)) / F.log(F.size(words) + F.lit(1.0))
    return F.when(F.size(words) == 0, F.lit(LEAST_QUALITY)).otherwise(F.greatest(F.lit(LEAST_QUALITY), prosaic * variety))


def measured(docs: DataFrame, key: str, text: str, source: str, seed: str, weight: Column | None) -> DataFrame:
    """`doc`, `source`, `size`, and the order in which the documents of a source are taken: `turn`, then `tie`, equal only for equal
    documents."""
    held = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    name = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    given = F.lit(None).cast("double") if weight is None else weight.cast("double")
    # a single blank as pattern needs no regular expression
    words = F.array_remove(F.split(F.translate(held, _SPACES, " " * len(_SPACES)), " "), "")
    read = docs.select(
        F.col(f"`{key}`").alias("doc"), F.col(f"`{source}`").cast("string").alias("source"), held.alias("text"), words.alias("words"),
        F.md5(F.concat_ws(":", F.lit(seed), name, held)).alias("digest"), given.alias("given"))
    number = lambda start, n: F.conv(F.substring("digest", start, n), 16, 10).cast("bigint")
    uniform = (number(1, 13) + F.lit(0.5)) / F.lit(float(1 << 52))
    usable = quality_weight(F.col("text"), F.col("words")) if weight is None else (
        F.when(F.col("given") > LEAST_QUALITY, F.least(F.col("given"), F.lit(1e300))).otherwise(F.lit(LEAST_QUALITY)))
    return read.select(
        "doc", "source", F.size("words").cast("bigint").alias("size"), (-F.log(uniform) / usable).alias("turn"),
        number(14, 15).alias("tie"))


def sums_before(rows: DataFrame, group: str, order: list[Column], value: str, name: str) -> DataFrame:
    """Every row with the sum of `value` over the rows of its group before it. The order need not be unique; NULL is a group."""
    by = [F.col(group).asc_nulls_last(), *order]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    # written, so that ranges and places stay what they are when an executor is lost
    placed = settle(ranged.withColumn("_mark", F.monotonically_increasing_id()), "ranges")
    placed = placed.withColumn("_range", F.shiftright("_mark", _RANGE_BITS))
    inside = Window.partitionBy(group, "_range").orderBy("_mark").rowsBetween(Window.unboundedPreceding, -1)
    # a row per range and group: a group has as many as there are ranges, whatever its rows
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(group, "_range").agg(F.sum(value).alias("_sum")).select(
        F.col(group).alias("_group"), F.col("_range").alias("_at"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    summed = placed.withColumn("_before", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = summed.join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_at")))
    return joined.select(*rows.columns, (F.col("_start") + F.col("_before")).alias(name))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """`source`, `source_size` and `target` for a table of (`source`, `source_size`), one row each.

    Sources by code point, NULL last, share the sum of all sizes by the weights, which repeat; a target stops at `epochs` times
    its source, and what is over goes to the others by weight, until none is above. Each round is one aggregate over the sources.
    """
    placed = dense_ids(sources, [F.col("source").asc_nulls_last()], "_place")
    share = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("_place") - 1, F.lit(len(weights))) + 1).cast("int"))
    placed = settle(placed.select("source", "source_size", (F.col("source_size") * epochs).alias("_most"), share.alias("_share")), "sources")
    rate, full = 0.0, -1
    while True:
        above = F.lit(rate) * F.col("_share") > F.col("_most")
        r = placed.agg(
            F.sum("source_size").alias("total"), F.count_if(above).alias("full"),
            F.sum(F.when(above, F.col("_most")).otherwise(0)).alias("held"),
            F.sum(F.when(above, 0).otherwise(F.col("_share"))).alias("shares")).first()
        if r["full"] == full or not r["shares"]:
            break
        rate, full = (r["total"] - r["held"]) / r["shares"], r["full"]
    target = F.least(F.lit(rate) * F.col("_share"), F.col("_most").cast("double"))
    return placed.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix",
    weight: Column | None = None, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS,
) -> DataFrame:
    """The key, `source`, `size`, `source_size`, `target`, `epochs` and `taken`, one row per row of `docs`.

    `size` is the number of words (runs without ASCII white space), `target` the words the mix wants of the document's
    source, `epochs` how often the whole source goes in, and `taken` the words taken of this document, repeats counted. What
    is left of a target after whole epochs goes to documents in key order; the one on the edge gives its first words, so a
    source's words differ from its target by rounding only, and no document gives more than `epochs` times its size.

    `weight` is a column of `docs`, `quality_weight` of the text by default; NULL and weights under LEAST_QUALITY count as that. NULL
    and empty texts have no words and give none. Rows that repeat a key are documents of their own; for wholly equal rows it
    is undefined which of them is on the edge. A NULL source is a source, NULL keys pass through, and an empty table gives no
    rows. Only the named columns are read.
    """
    rows = settle(measured(docs, key, text, source, seed, weight), "measured")
    sources = settle(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    targets = settle(source_targets(sources, weights, epochs).select(
        F.col("source").alias("_source"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("epochs")), "targets")
    before = sums_before(rows, "source", [F.col("turn").asc(), F.col("tie").asc()], "size", "before")
    left = F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + 0.5)
    part = F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("before")))
    joined = before.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    return joined.select(
        F.col("doc").alias(key), "source", "size", "source_size", "target", "epochs",
        (F.col("epochs") * F.col("size") + part).cast("bigint").alias("taken"))
