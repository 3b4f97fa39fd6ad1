"""Running a function over one text column in bounded slices, and the word helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

SLICE_ROWS = 512
#: Distinct words a task remembers before it starts afresh; bounds a Python worker's memory.
REMEMBERED = 400_000
#: Bytes of texts that go to Python at once. Spark's own limit is of 10,000 rows, which is a whole file of documents: the JVM and the
#: worker each hold all of that, for every task.
BATCH_BYTES = 1 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"

Columns = Sequence[Sequence]


def bounded_batches(df: DataFrame) -> DataFrame:
    """`df`; its session's Arrow batches end at BATCH_BYTES from now on, or with the row that passes them. A limit somebody has set stays.

    The limit cuts batches, not rows, so results are the same. It is the session's, as a frame has no settings of its own.
    """
    conf = df.sparkSession.conf
    if conf.get(_LIMIT, None) is None:
        conf.set(_LIMIT, str(BATCH_BYTES))
    return df


def per_text(
    df: DataFrame, key: str | Sequence[str], text: str, fields: Sequence[T.StructField],
    setup: Callable[[], Callable[[list[str | None]], Columns]],
) -> DataFrame:
    """The key columns and `fields`, one row per row of `df`.

    `setup()` runs once in each task and gives a function from a slice of texts to one list per field. Only the named
    columns are read, keys pass through untouched (NULL or repeated), and a task holds one slice at a time, of a batch of BATCH_BYTES.
    """
    keys = [key] if isinstance(key, str) else list(key)
    schema = T.StructType([df.schema[k] for k in keys] + list(fields))
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = setup()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                made = work(part.column(len(keys)).to_pylist())
                columns = [part.column(i) for i in range(len(keys))]
                columns += [pa.array(c, kind) for c, kind in zip(made, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    source = df.select(*(F.col(f"`{k}`") for k in keys), F.col(f"`{text}`").cast("string").alias("__text"))
    return bounded_batches(source).mapInArrow(run, schema)


def ascii_words(text: str | None) -> list[bytes]:
    """Words separated by ASCII white space (0x20, 0x09-0x0D), A-Z lower-cased, as UTF-8; none for NULL."""
    return text.encode().lower().split() if text else []


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), "<u8")


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64, a public constant set)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash for each run of `size` words; of the whole sequence if it is shorter; none for no words."""
    n = len(words)
    if not n:
        return words
    width = min(size, n)
    total = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        total = mixed(total + words[i:n - width + 1 + i] * np.uint64(2 * i + 0x9E3779B97F4A7C15))
    return total


def in_training(doc_id: Column) -> Column:
    """The rows labels may be learnt from: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(doc_id.cast("string")) % 3 != 1
