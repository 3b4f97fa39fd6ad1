"""Quality by votes of the nearest labelled documents in a latent-semantic space."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain
from operator import eq

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.labelled import labelled_sample, one_per_id
from tallyframe.llm.rowwise import REMEMBERED, in_training, per_text

_PIECE = re.compile(r"\w+|[^\w\s]+")
_SHARES = (0.1, 0.2, 0.4)
_ROWS = 256  #: documents per block of cosine products


class Terms(dict):
    """The buckets of a token: its lower-cased words, runs of other characters, and its shape."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def bucket(self, term: str) -> int:
        return xxhash.xxh3_64_intdigest(term.encode()) % self.buckets

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        parts = _PIECE.findall(token)
        terms = [p.lower() for p in parts]
        letters = [c for c in token if c.isalpha()]
        if len(letters) > 1 and all(map(str.isupper, letters)):
            terms.append("/upper")
        if not letters:
            terms.append("/no letter")
        value = self[token] = tuple(map(self.bucket, terms))
        return value

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Different buckets of a text and 1 + log of how often each occurs.

        A token equal to the one before it is a term too; where many are, so is every token.
        """
        tokens = text.split()
        flat = list(chain.from_iterable(map(self.__getitem__, tokens)))
        again = sum(map(eq, tokens, tokens[1:]))
        flat += [self.bucket("/again")] * again
        for share in _SHARES:
            if again > share * len(tokens):
                flat += [self.bucket(f"/again over {share}")] * len(tokens)
        names, n = np.unique(np.array(flat, np.int64), return_counts=True)
        return names, 1 + np.log(n.astype(np.float32))


@dataclass
class Space:
    """Weight of each bucket, projection to the latent dimensions, and the labelled vectors with their labels."""

    buckets: int
    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    share: float

    def place(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Unit vectors of documents in the latent space; zero where a document has no known term."""
        out = np.zeros((len(rows), self.projection.shape[1]), np.float32)
        for i, (names, values) in enumerate(rows):
            if len(names):
                out[i] = (values * self.weights[names]) @ self.projection[names]
        size = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, size, out=np.zeros_like(out), where=size > 1e-12)

    def vote(self, rows: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
        """Share of label 1 among the k nearest, each weighted by its similarity; the overall share without neighbours.

        Cosines with every labelled vector are computed block by block; ties go to the smaller place in the sample.
        """
        scores = np.full(len(rows), self.share, np.float64)
        k = min(k, len(self.labels))
        for start in range(0, len(rows) if k else 0, _ROWS):
            block = self.place(rows[start:start + _ROWS])
            cosines = block @ self.vectors.T
            least = np.partition(cosines, -k, axis=1)[:, -k, None]
            above, equal = cosines > least, cosines == least
            room = k - above.sum(1, keepdims=True)
            weights = np.where(above | equal & (np.cumsum(equal, 1) <= room), np.maximum(cosines, 0), 0).astype(np.float64)
            total = weights.sum(1)
            some = total > 1e-12
            scores[start:start + _ROWS][some] = np.clip((weights @ self.labels)[some] / total[some], 0, 1)
        return scores


def fit(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, buckets: int, dimensions: int = 48, passes: int = 4, seed: int = 11,
) -> Space:
    """Term weights, the leading right singular vectors of the weighted rows by subspace iteration, and their places."""
    share = float((labels.sum() + 1) / (len(labels) + 2))
    seen = np.bincount(np.concatenate([n for n, _ in rows]), minlength=buckets) if rows else np.zeros(buckets)
    weights = np.log((1 + len(rows)) / (1 + seen)).astype(np.float32) + 1
    x = np.zeros((len(rows), buckets), np.float32)
    for i, (names, values) in enumerate(rows):
        if len(names):
            row = values * weights[names]
            x[i, names] = row / np.linalg.norm(row)
    dimensions = min(dimensions, len(rows))
    basis = np.random.default_rng(seed).normal(size=(buckets, dimensions)).astype(np.float32)
    for _ in range(passes if len(rows) else 0):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    space = Space(buckets, weights, basis, np.zeros((0, dimensions), np.float32), labels.astype(np.float64), share)
    space.vectors = space.place(rows)
    return space


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", per_class: int = 1500,
    buckets: int = 1 << 13, **options,
) -> Space:
    """Place at most `per_class` labelled rows of each label of the training part.

    The driver gets each row's term counts, `buckets` of them at most: 2 * per_class * buckets * 8 bytes bound it.
    """
    sample = labelled_sample(docs, labels, label, per_class, key, text)

    def setup():
        terms = Terms(buckets)

        def work(texts):
            found = [terms.counts(t or "") for t in texts]
            return [[n.astype(np.int32).tobytes() for n, _ in found], [v.tobytes() for _, v in found]]

        return work

    fields = [T.StructField("names", T.BinaryType()), T.StructField("counts", T.BinaryType())]
    found = one_per_id(per_text(sample, [key, "label"], text, fields, setup), key, "names", "counts").collect()
    found = sorted((r["label"], bytes(r["names"]), bytes(r["counts"])) for r in found)
    rows = [(np.frombuffer(n, np.int32).astype(np.int64), np.frombuffer(c, np.float32)) for _, n, c in found]
    return fit(rows, np.array([y for y, _, _ in found], np.float64), buckets, **options)


def score_quality(
    df: DataFrame, space: Space, key: str = "doc_id", text: str = "text", neighbours: int = 15, threshold: float = 0.5,
) -> DataFrame:
    """key, held_out, score and predicted, one row per row of `df`.

    Whole texts. The labelled vectors, bounded by the sample's size, are broadcast; every document is compared with all
    of them. NULL, empty and blank texts get the share of label 1 in the sample; equal texts score alike; an empty table
    gives no rows; other columns are not read. No shuffle.
    """
    sent = df.sparkSession.sparkContext.broadcast(space)

    def setup():
        terms = Terms(space_of().buckets)
        return lambda texts: [space_of().vote([terms.counts(t or "") for t in texts], neighbours).tolist()]

    def space_of() -> Space:
        return sent.value

    scored = per_text(df, key, text, [T.StructField("score", T.DoubleType())], setup)
    held_out = F.coalesce(~in_training(F.col(key)), F.lit(False))
    return scored.select(key, held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
