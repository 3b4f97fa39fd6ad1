"""Toxicity by a factorization machine over hashed terms, which learns which pairs of terms mark a text."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.labelled import labelled_sample, one_per_id
from tallyframe.llm.rowwise import in_training, per_text
from tallyframe.sources.shared import settle

_WORD = re.compile(r"[^\W\d_]+")
_PREFIXES = (4, 5, 6)
_REMEMBERED = 100_000  #: words a task remembers the buckets of, about 350 bytes each


class Terms(dict):
    """The buckets of a word: of itself and of its first four, five and six letters."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= _REMEMBERED:
            self.clear()
        parts = [word] + [f"{word[:n]}*" for n in _PREFIXES if len(word) > n]
        value = self[word] = tuple(xxhash.xxh3_64_intdigest(p.encode()) % self.buckets for p in parts)
        return value

    def of(self, text: str) -> np.ndarray:
        """The different buckets of a text, in order."""
        found: set[int] = set()
        for word in set(_WORD.findall(text.lower())):
            found.update(self[word])
        return np.fromiter(sorted(found), np.int32, len(found))


@dataclass
class Machine:
    """Chosen buckets (ascending), bias, weight and factors of each."""

    buckets: int
    chosen: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, found: np.ndarray) -> float:
        """sigmoid(bias + sum of weights + sum over pairs of their factors' product)."""
        place = np.searchsorted(self.chosen, found)
        place = place[self.chosen[np.minimum(place, len(self.chosen) - 1)] == found] if len(self.chosen) else place[:0]
        v = self.factors[place]
        z = self.bias + self.weights[place].sum() + 0.5 * float((v.sum(0) ** 2 - (v ** 2).sum(0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def choose(names: np.ndarray, pos: np.ndarray, neg: np.ndarray, n1: int, n0: int, size: int, least: int) -> np.ndarray:
    """The `size` buckets that tell most about the label (log-likelihood ratio), in at least `least` rows; ascending.

    `pos` and `neg` count the rows of either label, of `n1` and `n0`, that hold each bucket."""
    n1, n0 = max(1, n1), max(1, n0)

    def part(a, total_a, b, total_b):
        share = (a + b) / (total_a + total_b)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.nan_to_num(a * np.log(a / (total_a * share))) + np.nan_to_num(b * np.log(b / (total_b * share)))

    ratio = part(pos, n1, neg, n0) + part(n1 - pos, n1, n0 - neg, n0)
    ratio[pos + neg < least] = -1
    best = np.lexsort((names, -ratio))[:size]
    return np.sort(names[best[ratio[best] > 0]]).astype(np.int32)


def fit(
    rows: list[np.ndarray], y: np.ndarray, buckets: int, chosen: np.ndarray, factors: int = 8, rounds: int = 500,
    rate: float = 0.05, decay: float = 1e-5, seed: int = 7,
) -> Machine:
    """Logistic loss, both classes weighted alike, Adam over all rows; the same rows give the same machine."""
    if not len(chosen) or len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Machine(buckets, chosen[:0], float(np.log(share / (1 - share))), np.zeros(0), np.zeros((0, factors)))
    x = np.zeros((len(rows), len(chosen)), np.float32)
    for i, found in enumerate(rows):
        x[i, np.searchsorted(chosen, found[np.isin(found, chosen)])] = 1
    order = np.random.default_rng(seed)
    state = [np.zeros(1, np.float32), np.zeros(len(chosen), np.float32),
             order.normal(0, 0.05, (len(chosen), factors)).astype(np.float32)]
    first, second = [np.zeros_like(s) for s in state], [np.zeros_like(s) for s in state]
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()).astype(np.float32)
    squares = x  # entries are 0 or 1
    for step in range(1, rounds + 1):
        b, w, v = state
        sums = x @ v
        z = b[0] + x @ w + 0.5 * ((sums ** 2).sum(1) - squares @ (v ** 2).sum(1))
        g = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        through = g @ x
        grads = [np.array([g.sum()]), through + decay * w, x.T @ (g[:, None] * sums) - v * through[:, None] + decay * v]
        for i, grad in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.999 * second[i] + 0.001 * grad ** 2
            state[i] = state[i] - rate * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    return Machine(buckets, chosen, float(state[0][0]), state[1], state[2])


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text", per_class: int = 4000,
    buckets: int = 1 << 20, size: int = 256, least: int = 3, **options,
) -> Machine:
    """Fit on at most `per_class` rows of each label of the training part, by the `size` buckets that tell most.

    Which those are is found from counts made where the rows are. The driver gets three numbers for a bucket in at least `least` rows,
    of `buckets` at most, and then the chosen buckets of one row for each id.
    """
    sample = labelled_sample(docs, labels, label, per_class, key, text)

    def setup():
        terms = Terms(buckets)
        return lambda texts: [[terms.of(t or "").tobytes() for t in texts]]

    found = settle(per_text(sample, [key, "label"], text, [T.StructField("found", T.BinaryType())], setup), "toxic-terms")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, buckets), np.int32)
        for batch in batches:
            for y, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):  # label, found
                held[y, np.frombuffer(content, np.int32)] += 1
        names = np.flatnonzero(held.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), *(pa.array(held[y, names].astype(np.int64)) for y in (1, 0))], ["name", "pos", "neg"])

    counted = found.select("label", "found").mapInArrow(count, "name int, pos long, neg long").groupBy("name").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    counted = counted.where(F.col("pos") + F.col("neg") >= least).toArrow()
    buckets_held, pos, neg = (counted.column(i).to_numpy() for i in range(3))
    order = np.argsort(buckets_held)
    totals = dict(found.groupBy("label").count().collect())
    chosen = choose(buckets_held[order], pos[order].astype(float), neg[order].astype(float), totals.get(1, 0), totals.get(0, 0), size, least)

    names = found.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.intersect1d(np.frombuffer(c, np.int32), chosen).tobytes() for c in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names)

    kept = one_per_id(found.mapInArrow(keep, found.schema), key, "found")
    rows = sorted((r["label"], bytes(r["found"])) for r in kept.collect())
    return fit([np.frombuffer(f, np.int32) for _, f in rows], np.array([y for y, _ in rows], np.float32), buckets, chosen, **options)


def score_toxicity(
    df: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text", threshold: float = 0.7, carry: Sequence[str] = (),
) -> DataFrame:
    """key, held_out, score, predicted and the columns to carry, one row per row of `df`.

    Whole texts, lower-cased, as the set of their hashed words and word beginnings. NULL and empty texts get the score of
    no terms; so does a text without letters. Equal texts score alike; an empty table gives no rows; other columns are not
    read. The machine has a fixed number of buckets and is sent with the task. No shuffle.
    """

    def setup():
        terms = Terms(machine.buckets)
        return lambda texts: [[machine.score(terms.of(t or "")) for t in texts]]

    scored = per_text(df, [key, *carry], text, [T.StructField("score", T.DoubleType())], setup)
    held_out = F.coalesce(~in_training(F.col(key)), F.lit(False))
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select(key, held_out.alias("held_out"), "score", predicted.alias("predicted"), *carry)
