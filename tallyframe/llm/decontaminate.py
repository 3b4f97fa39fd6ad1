"""Benchmark passages in documents: SimHash of item-sized windows, found by blocks of bits, verified on shingles."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.rowwise import per_text, shingle_hashes, word_hashes
from tallyframe.sources.shared import settle

_SHINGLE = 5
_STEP = 4
_SIZES = (8, 12, 16, 20, 28, 36, 48, 60)  #: words of a window that starts at a multiple of the step
_LONGEST_RUN = _SIZES[-1] + _STEP - 1
_CHUNK = 1 << 15  #: window starts handled at once
#: Every byte that is no ASCII letter or digit and begins no other character separates words.
_TO_SPACE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters, digits and non-ASCII characters, so case and punctuation don't matter."""
    return text.lower().encode().translate(_TO_SPACE).split() if text else []


def weights(found: Sequence[bytes]) -> np.ndarray:
    """1 to 4: long words say more than short ones."""
    return 1 + np.minimum(np.fromiter(map(len, found), np.int64, len(found)), 9) // 3


def unbroken_run(weight: np.ndarray, percent: int) -> int:
    """The number of consecutive words of an item that every region as similar as `percent` holds unchanged somewhere, up to
    _LONGEST_RUN.

    A region loses a share of the item's shingles by weight where words are changed, or gains as much of its own, and it may
    lose or gain only so much. A cut between two words costs the shingles across it that no earlier cut has cost; or, where
    both neighbouring shingles are kept but apart, the eight that the region needs for that, of five letters at least. The
    cheapest cuts that leave no run of r words are found by going through the places in order; r is unbroken if they
    cost more than the similarity allows.
    """
    spans = _spans(weight)
    words, allowed = len(weight), int(spans.sum()) * (100 - percent)
    apart = 8 * _SHINGLE * percent
    until = np.concatenate([[0], np.cumsum(spans)])

    def leaves_none(run: int) -> bool:
        least = np.zeros(words)  # the cost of the cheapest cuts up to a place, the last one there
        for place in range(1, words):
            before = np.arange(max(0, place - run + 1), place)
            first = np.maximum(before, max(0, place - _SHINGLE + 1))
            cost = np.minimum(100 * (until[min(place, len(spans))] - until[np.minimum(first, len(spans))]), apart)
            least[place] = (least[before] + cost).min()
        return least[max(1, words - run + 1):].min() <= allowed

    low, high = min(_SHINGLE, words), min(words, _LONGEST_RUN)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (low, middle - 1) if leaves_none(middle) else (middle, high)
    return low


def window_kind(run: int) -> tuple[int, int]:
    """Step and size of the windows that find an item: one that starts at a multiple of the step, wherever that is, lies inside any
    run of so many words."""
    fit = [size for size in _SIZES if size + _STEP - 1 <= run]
    return (_STEP, fit[-1]) if fit else (1, _SIZES[0] if run >= _SIZES[0] else _SHINGLE)


class Votes:
    """Bit votes of the words of a sequence, from which SimHashes of windows are added up by doubling."""

    def __init__(self, hashes: np.ndarray, weight: np.ndarray):
        votes = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).view(np.int8)
        votes += votes
        votes -= 1
        votes *= weight.astype(np.int8)[:, None]
        self.doubled = {1: [votes]}
        whole = len(votes) // _STEP * _STEP
        self.doubled[_STEP] = [sum(votes[i:whole:_STEP].astype(np.int16) for i in range(1, _STEP)) + votes[:whole:_STEP]]

    def simhashes(self, step: int, size: int) -> np.ndarray:
        """Fingerprints of the windows of `size` words that start at multiples of `step`."""
        powers, blocks = self.doubled[step], size // step
        while 1 << len(powers) <= blocks:
            last, reach = powers[-1], 1 << len(powers) - 1
            powers.append(last[:-reach].astype(np.int16) + last[reach:] if len(last) > reach else last[:0])
        count, at, total = len(powers[0]) - blocks + 1, 0, None
        if count < 1:
            return np.zeros(0, np.uint64)
        for bit, sums in enumerate(powers):
            if blocks >> bit & 1:
                part = sums[at:at + count]
                total = part.astype(np.int16) if total is None else total + part
                at += 1 << bit
        return np.packbits((total > 0).ravel()).view(np.uint64)


class Index:
    """Fingerprints of one window size. Two within the radius agree in one of radius + 1 blocks of bits at least."""

    def __init__(self, prints: np.ndarray, items: np.ndarray, radius: int):
        self.prints, self.items, self.radius = prints, items, radius
        edges = np.linspace(0, 64, radius + 2).astype(int)
        self.blocks = []
        for low, high in zip(edges, edges[1:], strict=False):
            values = self._block(prints, low, high)
            order = np.argsort(values, kind="stable")
            first = np.searchsorted(values[order], np.arange((1 << (high - low)) + 1))
            self.blocks.append((low, high, order, first))

    @staticmethod
    def _block(prints: np.ndarray, low: int, high: int) -> np.ndarray:
        return ((prints >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)).astype(np.int64)

    def within(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (place in `prints`, place in the index) within the radius; a pair may come several times."""
        left, right = [], []
        for low, high, order, first in self.blocks:
            values = self._block(prints, low, high)
            start = first[values]
            many = first[values + 1] - start
            place = np.repeat(np.arange(len(prints)), many)
            inside = np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many)
            entry = order[start[place] + inside]
            near = np.bitwise_count(prints[place] ^ self.prints[entry]) <= self.radius
            left.append(place[near])
            right.append(entry[near])
        return np.concatenate(left), np.concatenate(right)


class Shingled:
    """A weighted bag of shingles."""

    def __init__(self, hashes: np.ndarray, weight: np.ndarray):
        found = shingle_hashes(hashes, _SHINGLE)
        self.shingles, first, self.counts = np.unique(found, return_index=True, return_counts=True)
        self.total = int((_spans(weight)[first] * self.counts).sum())

    def best_region(self, hashes: np.ndarray, weight: np.ndarray, percent: int) -> tuple[float, int, int] | None:
        """Weighted Jaccard similarity (shared weight over total weight, each shingle as often as it occurs), first word and
        words of the most similar region, the first and shortest of equals; None if none reaches `percent`.

        The best region begins and ends with a shingle of the bag, and weighs total * 100 / percent at most. Every such region
        counts: from each start the shared weight is added up shingle by shingle to each end. Starts that cannot reach the best
        found so far are left out.
        """
        found, span = shingle_hashes(hashes, _SHINGLE), _spans(weight)
        entry = np.minimum(np.searchsorted(self.shingles, found), len(self.shingles) - 1)
        at = np.flatnonzero(self.shingles[entry] == found)
        if not len(at):
            return None
        # the place of the shingle as many occurrences before as the bag holds: beyond it a region has one too many
        order = np.lexsort((at, entry[at]))
        kind, limit = entry[at][order], self.counts[entry[at]][order]
        back = np.arange(len(at)) - limit
        full = np.full(len(at), -1, np.int64)
        full[order] = np.where((back >= 0) & (kind[back] == kind), at[order][back], -1)
        before = np.concatenate([[0], np.cumsum(span)])
        own, held = span[at], np.concatenate([[0], np.cumsum(span[at])])
        last = np.searchsorted(before[at + 1], before[at] + self.total * 100 // percent, "right")
        most = np.minimum(held[last] - held[:-1], self.total)
        best, value = None, 0.0
        for i in np.argsort(-most, kind="stable").tolist():
            if 100 * most[i] < percent * self.total or most[i] / self.total < value or value == 1:
                break
            stop = int(last[i])
            shared = np.cumsum(np.where(full[i:stop] < at[i], own[i:stop], 0))
            union = self.total + before[at[i:stop] + 1] - before[at[i]] - shared
            share = shared / union
            j = int(share.argmax())
            if 100 * shared[j] >= percent * union[j] and (best is None or (-share[j], at[i]) < (-value, best[1])):
                value = float(share[j])
                best = value, int(at[i]), int(at[i + j] - at[i]) + _SHINGLE
        return best


def _spans(weight: np.ndarray) -> np.ndarray:
    """The weight of each shingle, the sum of its words'."""
    return np.convolve(weight, np.ones(min(_SHINGLE, len(weight)), np.int64), "valid") if len(weight) else weight


class Benchmark:
    """The items, as words with weights, shingle bags, and window fingerprints by window kind.

    Windows are as large as an item allows, see `unbroken_run`, and kept for every place of the item. So a region as similar as
    `percent` has a window with the fingerprint of one of the item's, wherever its edits are; fingerprints within the radius bring
    in regions with an edit in every window as well.
    """

    def __init__(self, items: Sequence[tuple[int, str | None]], percent: int, radius: int):
        self.percent, self.items, self.whole, prints = percent, [], {}, {}
        for item_id, text in items:
            found = words(text)
            h, w = word_hashes(found), weights(found)
            if len(found) < _SHINGLE:
                if found:
                    self.whole.setdefault(tuple(found), []).append(item_id)
                continue
            step, size = window_kind(unbroken_run(w, percent))
            for start in range(min(step, len(found) - size + 1)):
                windows = Votes(h[start:], w[start:]).simhashes(step, size)
                prints.setdefault((step, size), []).append((windows, np.full(len(windows), len(self.items))))
            self.items.append((item_id, Shingled(h, w)))
        self.index = {}
        for kind, parts in sorted(prints.items()):
            found = np.unique(np.stack([np.concatenate([p for p, _ in parts]), np.concatenate([i for _, i in parts]).astype(np.uint64)]), axis=1)
            self.index[kind] = Index(found[0], found[1].astype(np.int64), radius)
        self.longest = max((size for _, size in self.index), default=_SHINGLE)

    def leaks(self, texts: Sequence[str | None]) -> list[list[tuple[int, float, int, int]]]:
        """For each text the items in it: id, similarity, first word and words of the best region."""
        parts = [words(t) for t in texts]
        lengths = np.array([len(p) for p in parts])
        ends = np.cumsum(lengths)
        flat = [w for p in parts for w in p]
        h, w, of = word_hashes(flat), weights(flat), np.repeat(np.arange(len(parts)), lengths)
        pairs = set()
        for chunk in range(0, len(flat) if self.index else 0, _CHUNK):
            stop = min(len(flat), chunk + _CHUNK + self.longest)
            votes = Votes(h[chunk:stop], w[chunk:stop])
            for (step, size), index in self.index.items():
                windows = votes.simhashes(step, size)[:-(-_CHUNK // step)]
                places = chunk + np.arange(len(windows)) * step
                inside = np.flatnonzero(of[places] == of[places + size - 1])
                left, right = index.within(windows[inside])
                found = np.unique(of[places[inside[left]]] * len(self.items) + index.items[right])
                pairs.update(found.tolist())
        out = [[] for _ in parts]
        for text, item in (divmod(pair, len(self.items)) for pair in sorted(pairs)):
            first, end = int(ends[text] - lengths[text]), int(ends[text])
            item_id, bag = self.items[item]
            best = bag.best_region(h[first:end], w[first:end], self.percent)
            if best:
                out[text].append((item_id, *best))
        for text, found in enumerate(parts):
            whole = self.whole.get(tuple(found), ()) if len(found) < _SHINGLE else ()
            out[text] = sorted(out[text]) + [(i, 1.0, 0, len(found)) for i in whole]
        return out


LEAKS = T.StructField("leaks", T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("similarity", T.DoubleType()),
    T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType())])))


def _blocks(items: DataFrame, max_bytes: int) -> list[DataFrame]:
    """The items (i, t) in parts of at most `max_bytes` of text each, dealt by a hash; an item larger than that is a part of its own."""
    size = F.octet_length("t")
    total = items.agg(F.sum(size)).first()[0] or 0
    if total <= max_bytes:
        return [items]
    large, parts = items.where(size > max_bytes), -(-2 * total // max_bytes)
    rest = items.where(size <= max_bytes)
    while True:
        block = F.pmod(F.xxhash64("i", "t"), F.lit(parts))
        if (rest.groupBy(block).agg(F.sum(size).alias("s")).agg(F.max("s")).first()[0] or 0) <= max_bytes:
            break
        parts *= 2
    found = [rest.where(block == n) for n in range(parts)]
    return found + [large.where((F.col("i") == i) & (F.xxhash64("t") == x)) for i, x in large.select("i", F.xxhash64("t")).distinct().collect()]


def find_leaks(
    df: DataFrame, benchmark: DataFrame, key: str | Sequence[str] = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", percent: int = 80, radius: int = 5, max_bytes: int = 32 << 20,
) -> DataFrame:
    """The key columns and `leaks`, one row per row of `df`: the items in it, most similar region of each.

    An item of five words or more leaks where a region of a document has a weighted 5-word-shingle similarity of
    `percent` or more with it, and every such item is found. Candidates are documents with a window whose SimHash is within
    `radius` bits of one of the item's windows; the windows are of a size that a region similar enough leaves unchanged
    somewhere. In a candidate every region is compared. Shorter items
    leak into documents of just their words. Words ignore case and punctuation. NULL and empty texts and items have no
    leaks; items without an id are ignored, of repeated ids each text counts; equal documents have equal leaks; an empty
    benchmark gives empty lists; other columns are not read. Whole texts, every window. The items are the
    stated query set: each task holds at most `max_bytes` of their text. A larger benchmark is taken in blocks, a pass over
    the documents each, whose few findings are stored and then joined to the documents by the key and a hash of the text.
    """
    keys = [key] if isinstance(key, str) else list(key)
    items = benchmark.where(F.col(f"`{item_key}`").isNotNull() & F.col(f"`{item_text}`").isNotNull()).select(
        F.col(f"`{item_key}`").cast("bigint").alias("i"), F.col(f"`{item_text}`").cast("string").alias("t"))
    blocks = _blocks(items, max_bytes)
    if len(blocks) == 1:
        return _pass(df, items, keys, text, percent, radius)
    hashed = df.withColumn("__x", F.xxhash64(f"`{text}`"))
    found = None
    for block in blocks:
        part = settle(_pass(hashed, block, [*keys, "__x"], text, percent, radius).where(F.size("leaks") > 0).distinct(), "leaks")
        found = part if found is None else found.unionAll(part)
    renamed = found.select(*(F.col(f"`{k}`").alias(f"__k{n}") for n, k in enumerate(keys)), F.col("__x").alias("__y"), "leaks")
    merged = renamed.groupBy(*(f"__k{n}" for n in range(len(keys))), "__y").agg(F.array_sort(F.flatten(F.collect_list("leaks"))).alias("leaks"))
    same = F.col("__x").eqNullSafe(F.col("__y"))
    for n, k in enumerate(keys):
        same &= F.col(f"`{k}`").eqNullSafe(F.col(f"__k{n}"))
    rows = hashed.select(*(F.col(f"`{k}`") for k in keys), "__x")
    none = F.array().cast(LEAKS.dataType)
    return rows.join(merged, same, "left").select(*(F.col(f"`{k}`") for k in keys), F.coalesce("leaks", none).alias("leaks"))


def _pass(df: DataFrame, items: DataFrame, keys: list[str], text: str, percent: int, radius: int) -> DataFrame:
    sent = df.sparkSession.sparkContext.broadcast(Benchmark(sorted(map(tuple, items.collect())), percent, radius))

    def setup():
        return lambda texts: [sent.value.leaks(texts)]

    return per_text(df, keys, text, [LEAKS], setup)
