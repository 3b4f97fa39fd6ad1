"""Words that are one edit apart, and the commoner spelling each rare one stands for.

Every word tries its own edits (one code point left out, or replaced by a greater one of the alphabet; insertions are the other
word's omissions) against blocked Bloom filters of the vocabulary, one per word length. The filters are built where the
words are, are of a bounded size, and go to every task; a vocabulary too large for them is taken in several passes. Only the
edits that a filter does not rule out are shuffled, to an exact join with the vocabulary, which removes the false ones.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.rowwise import REMEMBERED, mixed
from tallyframe.sources.shared import settle

#: A word is a run of A-Z, a-z and U+00C0 to U+00FF; only A-Z are lower-cased.
_LATIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
#: Bytes of words a task remembers before it passes its counts on.
REMEMBERED_BYTES = 64 << 20
_ROWS_OUT = 50_000


# -- the vocabulary --------------------------------------------------------------------------------------------------------


def count_words(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = 6, least_count: int = 5,
    thinned: int | None = None,
) -> DataFrame:
    """`word` and `n`, its occurrences in whole texts, for words long and frequent enough.

    With `thinned`, a run loses the code point h % length if that number divides h, the crc32 of "<key>:<run>" in UTF-8; what
    remains is counted. NULL and empty texts hold no words; a NULL key is written as nothing. Words are counted in
    each task first, so one that every document holds costs a row a task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        size = 0

        def flushed():
            words, times = [w.decode("latin-1") for w in held], list(held.values())
            held.clear()
            for start in range(0, len(words), _ROWS_OUT):
                part = slice(start, start + _ROWS_OUT)
                yield pa.RecordBatch.from_arrays([pa.array(words[part], pa.string()), pa.array(times[part], pa.int64())], ["word", "n"])

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not content:
                    continue
                # a code point beyond U+00FF becomes "?", which ends a run like any other that is no letter
                runs = Counter([r for r in content.encode("latin-1", "replace").translate(_LATIN).split() if len(r) >= least_length])
                begun = zlib.crc32(f"{name}:".encode())
                for run, times in runs.items():
                    if thinned:
                        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), begun)
                        if h % thinned == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1:]
                            if len(run) < least_length:
                                continue
                    if run not in held:
                        size += len(run)
                    held[run] += times
                if len(held) > REMEMBERED or size > REMEMBERED_BYTES:
                    yield from flushed()
                    size = 0
        yield from flushed()

    source = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), F.col(f"`{text}`").cast("string"))
    counted = source.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


# -- hashes of words and of their edits ------------------------------------------------------------------------------------

_STEP, _SIZE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _symbols(codes: np.ndarray) -> np.ndarray:
    return mixed(codes.astype(np.uint64) + _STEP) | np.uint64(1)


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), _STEP)]))[:n]


def _finished(sums: np.ndarray, length: int) -> np.ndarray:
    return mixed(sums + np.uint64(length * int(_SIZE) % 2**64))


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)


def word_codes(words: list[str]) -> np.ndarray:
    """The hash that filters know a word by; words of one length."""
    codes = _codes(words)
    return _finished((_symbols(codes) * _powers(codes.shape[1])).sum(1, dtype=np.uint64), codes.shape[1])


# -- filters ---------------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Shards:
    """Where each length has its blocks. A block is a cache line, eight numbers of 64 bits, and a word sets a bit in each.

    Lengths above `longest` share the last shard. A word belongs to one of `passes` rounds.
    """

    offsets: dict[int, int]
    blocks: dict[int, int]
    longest: int
    total: int
    passes: int

    def shard(self, length: int) -> int:
        return min(length, self.longest + 1)

    def of(self, codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Block and bits of each hash."""
        s = self.shard(length)
        place = ((codes >> np.uint64(32)) * np.uint64(self.blocks[s])) >> np.uint64(32)
        return place.astype(np.int64) + self.offsets[s], mixed(codes ^ _SIZE)

    def turn(self, codes: np.ndarray) -> np.ndarray:
        return (mixed(codes + _STEP) % np.uint64(self.passes)).astype(np.int64)


LANES = 8
SEGMENT = 1024  # blocks, 64 KB
BITS_A_WORD, LONGEST = 16, 64
_LEAST_BLOCKS = 256


def plan_shards(lengths: dict[int, int], max_bytes: int) -> Shards:
    """Sizes from the number of words of each length; a shard of more than LONGEST code points gets four times the room."""
    held: Counter[int] = Counter()
    for length, n in lengths.items():
        held[min(length, LONGEST + 1)] += n * (4 if length > LONGEST else 1)

    def sized(passes: int) -> dict[int, int]:
        return {s: max(_LEAST_BLOCKS, -(-n * BITS_A_WORD // (512 * passes))) for s, n in sorted(held.items())}

    passes = 1
    while sum(sized(passes).values()) * LANES * 8 > max_bytes and sized(passes) != sized(2 * passes):
        passes *= 2
    blocks, offsets, at = sized(passes), {}, 0
    for s, n in blocks.items():
        offsets[s], at = at, at + n
    return Shards(offsets, blocks, LONGEST, at, passes)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """Length, places and words, a length at a time."""
    groups: dict[int, list[int]] = {}
    for at, word in enumerate(words):
        groups.setdefault(len(word), []).append(at)
    for length, places in groups.items():
        yield length, np.array(places), [words[p] for p in places]


def _bit(bits: np.ndarray, lane: int) -> np.ndarray:
    return np.uint64(1) << ((bits >> np.uint64(6 * lane)) & np.uint64(63))


def build_filter(vocabulary: DataFrame, shards: Shards, turn: int) -> np.ndarray:
    """The filter of one round. Tasks each fill the segments whose words are dealt to them; the driver lays them side by side,
    in all as large as the shards were planned."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for length, _, words in _by_length(batch.column(0).to_pylist()):
                codes = word_codes(words)
                found.append(shards.of(codes[shards.turn(codes) == turn], length))
            blocks = np.concatenate([b for b, _ in found]) if found else np.empty(0, np.int64)
            bits = np.concatenate([b for _, b in found]) if found else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((blocks // SEGMENT).astype(np.int32)), pa.array(blocks % SEGMENT), pa.array(bits.view(np.int64))],
                ["segment", "block", "bits"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments: dict[int, np.ndarray] = {}
        for batch in batches:
            segment, block, bits = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            bits = np.ascontiguousarray(bits).view(np.uint64)
            for s in np.unique(segment).tolist():
                rows = np.flatnonzero(segment == s)
                lanes = segments.setdefault(s, np.zeros(SEGMENT * LANES, np.uint64))
                for lane in range(LANES):
                    np.bitwise_or.at(lanes, block[rows] * LANES + lane, _bit(bits[rows], lane))
        for s, lanes in segments.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([lanes.tobytes()], pa.binary())], ["segment", "content"])

    placed = vocabulary.select("word").mapInArrow(place, "segment int, block long, bits long")
    filled = placed.repartition("segment").mapInArrow(fill, "segment int, content binary")
    lanes = np.zeros(-(-shards.total // SEGMENT) * SEGMENT * LANES, np.uint64)
    for row in filled.toLocalIterator():
        lanes[row["segment"] * SEGMENT * LANES:(row["segment"] + 1) * SEGMENT * LANES] = np.frombuffer(row["content"], np.uint64)
    return lanes


def _present(lanes: np.ndarray, shards: Shards, codes: np.ndarray, length: int, turn: int) -> np.ndarray:
    """Places of the hashes that the filter does not rule out."""
    if shards.shard(length) not in shards.blocks:
        return np.empty(0, np.int64)
    blocks, bits = shards.of(codes, length)
    blocks *= LANES
    left = np.flatnonzero(lanes[blocks] & _bit(bits, 0))
    for lane in range(1, LANES):
        left = left[(lanes[blocks[left] + lane] & _bit(bits[left], lane)) != 0]
    return left if shards.passes == 1 else left[shards.turn(codes[left]) == turn]


_AT_ONCE = 1 << 20  # edits tried at a time


def _edits(words: list[str], alphabet: np.ndarray, lanes: np.ndarray, shards: Shards, turn: int) -> Iterator[tuple[int, str]]:
    """For words of one length: the place of a word and an edit of it that may be a word. Each pair of words comes up once:
    by the shorter one's omission, or by the greater code point; a code point is left out at the start of its run."""
    codes = _codes(words)
    length = codes.shape[1]
    powers = _powers(length)
    values = _symbols(codes)
    terms = values * powers
    sums = terms.sum(1, dtype=np.uint64)
    signs = _symbols(alphabet)
    letters = [chr(a) for a in alphabet.tolist()]
    step = max(1, _AT_ONCE // max(len(words) * len(alphabet), 1))
    for start in range(0, length, step):
        part = slice(start, min(start + step, length))
        tried = (sums[:, None] - terms[:, part])[:, :, None] + powers[part][None, :, None] * signs[None, None, :]
        for p in _present(lanes, shards, _finished(tried.ravel(), length), length, turn).tolist():
            row, (at, a) = p // (tried.shape[1] * len(alphabet)), divmod(p % (tried.shape[1] * len(alphabet)), len(alphabet))
            at += start
            if alphabet[a] > codes[row, at]:
                yield row, f"{words[row][:at]}{letters[a]}{words[row][at + 1:]}"
    if length > 1:
        moved = values[:, 1:] * powers[:-1]  # what follows moves one place up
        before = np.cumsum(terms, 1, dtype=np.uint64) - terms
        after = np.zeros_like(terms)
        after[:, :-1] = np.cumsum(moved[:, ::-1], 1, dtype=np.uint64)[:, ::-1]
        for p in _present(lanes, shards, _finished((before + after).ravel(), length - 1), length - 1, turn).tolist():
            row, at = divmod(p, length)
            if not at or codes[row, at] != codes[row, at - 1]:
                yield row, words[row][:at] + words[row][at + 1:]


def near_candidates(vocabulary: DataFrame, alphabet: np.ndarray, lanes: np.ndarray, shards: Shards, turn: int) -> DataFrame:
    """`edit`, `word` and `n`: the edits of every word that the filter of this round may hold."""
    sent = vocabulary.sparkSession.sparkContext.broadcast(lanes)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lanes = sent.value
        for batch in batches:
            words, times = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for length, places, group in _by_length(words):
                rows = max(1, _AT_ONCE // (length * max(len(alphabet), 1)))
                for start in range(0, len(group), rows):
                    part = group[start:start + rows]
                    found = list(_edits(part, alphabet, lanes, shards, turn))
                    at = [places[start + row] for row, _ in found]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([e for _, e in found], pa.string()), pa.array([words[a] for a in at], pa.string()),
                         pa.array([times[a] for a in at], pa.int64())], ["edit", "word", "n"])

    return vocabulary.select("word", "n").mapInArrow(probe, "edit string, word string, n long")


def near_pairs(vocabulary: DataFrame, max_filter_bytes: int = 64 << 20) -> DataFrame:
    """`word`, `n`, `near` and `near_n`: each two words one inserted, deleted or replaced code point apart, once.

    `vocabulary` has one row per `word`, with its `n`; it is read several times, so pass it stored. Words may hold any code
    points. NULL and empty words are near nothing.
    """
    vocabulary = vocabulary.where("word <> ''")
    # a row per length, and one per code point in use
    lengths = {r[0]: r[1] for r in vocabulary.groupBy(F.least(F.length("word"), F.lit(LONGEST + 1))).count().collect()}
    symbols = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct().collect()
    alphabet = np.array(sorted(ord(r["c"]) for r in symbols), np.uint32)
    shards = plan_shards(lengths, max_filter_bytes)
    found = None
    for turn in range(shards.passes if lengths else 0):
        lanes = build_filter(vocabulary, shards, turn)
        part = near_candidates(vocabulary, alphabet, lanes, shards, turn)
        if shards.passes > 1:
            part = settle(part, "near-candidates")
        found = part if found is None else found.unionAll(part)
    if found is None:
        return vocabulary.limit(0).selectExpr("word", "n", "word as near", "n as near_n")
    exact = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.join(exact, F.col("edit") == F.col("near")).select("word", "n", "near", "near_n")


def follow(forms: DataFrame) -> DataFrame:
    """`word` and `root` for every word with a form: forms followed to the last, twice as far each round."""
    reached = settle(forms.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = reached.join(further, "root", "left")
        joined = settle(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        reached = joined.select("word", "root")
        if joined.where("moved").limit(1).count() == 0:
            return reached


def group_variants(vocabulary: DataFrame, times: int = 5, max_filter_bytes: int = 64 << 20) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near` and `form_n` for every row of the vocabulary (`word`, `n`; a row per word).

    A word's form is its near word of largest n, the first in code-point order of equally frequent ones, if that is at least
    `times` the word's n; else NULL. `root` follows the forms to the last and is the word itself without one. Each step
    multiplies n, so forms never run in a circle and a chain is as long as a logarithm of n. No words give no rows.
    """
    vocabulary = settle(vocabulary.select("word", "n"), "vocabulary")
    both = near_pairs(vocabulary, max_filter_bytes).select(F.inline(F.array(
        F.struct("word", F.col("near").alias("other"), F.col("near_n").alias("m")),
        F.struct(F.col("near").alias("word"), F.col("word").alias("other"), F.col("n").alias("m")))))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    chosen = -F.col("best.m") >= F.lit(times) * F.col("n")
    forms = settle(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(chosen, F.col("best.other")).alias("form"),
        F.when(chosen, -F.col("best.m")).alias("form_n")), "forms")
    roots = follow(forms)
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
