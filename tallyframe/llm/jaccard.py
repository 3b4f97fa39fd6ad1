"""Similarity join on n-gram sets: count vectors in an R-tree, within blocks that no linked pair can miss."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.components import components
from tallyframe.llm.rowwise import ascii_words, bounded_batches, mixed, per_text, shingle_hashes, word_hashes
from tallyframe.sources.shared import settle

_LEAST_BITS = 5  #: of the number of groups of a count vector
_LEAF = 32
_ANCHORS = 32


@dataclass(frozen=True)
class Threshold:
    """Two sets link when 100 * intersection >= percent * union."""

    percent: int

    def bounds(self, size: int) -> list[int]:
        """Starts of size classes up to that of `size` and two more: linked sets are in one class or in neighbours."""
        return _bounds(self.percent, size)

    def differing(self, sizes: int) -> int:
        """Most elements in one of two linked sets only, given the sum of their sizes."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def needed(self, sizes: np.ndarray | int):
        """Least intersection of two linked sets, given the sum of their sizes."""
        return -(-self.percent * sizes // (100 + self.percent))


@cache
def _bounds(percent: int, size: int) -> list[int]:
    starts = [1, 2]
    while len(starts) < 3 or starts[-3] <= size:
        starts.append(max(starts[-1] + 1, (starts[-1] - 1) * 100 // percent + 1))
    return starts


def block_keys(hashes: np.ndarray, limit: Threshold) -> np.ndarray:
    """64-bit keys of a sorted set, of which two linked, different sets share at least one.

    Linked sets of sizes in classes j and j or j + 1 differ in e elements at most. The hash range is cut into e + 1 + s
    segments, so at least s + 1 segments hold the same elements of both; a key is the class, the segment and a sum over its
    elements. Of these, one holds an element unless both sets leave s + 1 segments empty, so only sets that do have keys for
    empty segments; s is so large that hardly any does, as sets without anything in common would meet there. Each set has
    keys for its own class and for the class below. Where e is 0, only equal sets link and no key is needed.
    """
    n = len(hashes)
    starts = limit.bounds(1 << (n - 1).bit_length() if n else 1)
    own = int(np.searchsorted(starts, n, "right")) - 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes + np.uint64(1)), dtype=np.uint64)])
    high, out = hashes >> np.uint64(32), []
    for j in (own, own - 1):
        if j < 0:
            continue
        differing = limit.differing(starts[j + 1] - 1 + starts[j + 2] - 1)
        if not differing:
            continue
        empty = (differing + 1) * np.exp(-starts[j] / (differing + 1))
        spare = int(empty + 4 * empty ** 0.5)
        segments = differing + 1 + spare
        edges = np.searchsorted((high * np.uint64(segments)) >> np.uint64(32), np.arange(segments + 1, dtype=np.uint64))
        place = np.arange(segments, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j)
        content = sums[edges[1:]] - sums[edges[:-1]]
        held = edges[1:] - edges[:-1]
        keys = mixed(content + mixed(place + held.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
        out.append(keys if (held == 0).sum() > spare else keys[held > 0])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def counts(hashes: np.ndarray) -> bytes | None:
    """How many elements fall into each group of the hash range: one byte a group, a power of two of groups so that about eight to
    sixteen elements fall into one, as fewer groups would not tell long sets apart. Nothing where a count exceeds a byte."""
    bits = max(_LEAST_BITS, (max(len(hashes) // 8, 1) - 1).bit_length())
    found = np.bincount((mixed(hashes) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return found.astype(np.uint8).tobytes() if found.max(initial=0) < 256 else None


def folded(vectors: list[bytes | None]) -> np.ndarray | None:
    """Vectors as points of one dimension, the least among them: neighbouring groups are added up. None if one is missing."""
    if any(v is None for v in vectors):
        return None
    least = min(map(len, vectors))
    return np.stack([np.frombuffer(v, np.uint8).reshape(least, -1).sum(1, dtype=np.int32) for v in vectors])


class RTree:
    """Count vectors packed into nodes of nearby points; a node keeps its box and the range of its sizes.

    `order` lists points so that each node is a run; nodes are (start, end, lowest size, highest size, upper corner,
    children). Boxes need only their upper corner: the sum of coordinate minima with it bounds every overlap inside.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.order = np.arange(len(points))
        self.root = self._pack(0, len(points))

    def _pack(self, start: int, end: int):
        run = self.order[start:end]
        corner = self.points[run].max(0)
        children = ()
        if end - start > _LEAF:
            spread = np.concatenate([[np.ptp(self.sizes[run])], np.ptp(self.points[run], axis=0)])
            axis = int(spread.argmax())
            values = self.sizes[run] if axis == 0 else self.points[run, axis - 1]
            middle = (end - start) // 2
            self.order[start:end] = run[np.argpartition(values, middle)]
            children = (self._pack(start, start + middle), self._pack(start + middle, end))
        return start, end, int(self.sizes[run].min()), int(self.sizes[run].max()), corner, children

    def candidates(self, point: int, limit: Threshold, label: np.ndarray) -> Iterator[int]:
        """Points that may link with `point` and have another label when reached, with overlap bounds that suffice."""
        vector, size = self.points[point], int(self.sizes[point])
        waiting = [self.root]
        while waiting:
            start, end, least, most, corner, children = waiting.pop()
            if 100 * least > 100 * 100 * size // limit.percent or 100 * most < limit.percent * size:
                continue
            if np.minimum(corner, vector).sum() < limit.needed(size + least):
                continue
            run = self.order[start:end]
            if (label[run] == label[point]).all():
                continue
            if children:
                waiting += children
                continue
            run = run[label[run] != label[point]]
            near = run[np.minimum(self.points[run], vector).sum(1) >= limit.needed(size + self.sizes[run])]
            for other in near.tolist():
                if label[other] != label[point]:
                    yield other


def forest(sets: list[np.ndarray], label: np.ndarray, limit: Threshold, ask: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that join what the sets' links join: each found through the tree and verified, none within one label.

    `label` tells what is joined already and is updated; only the points in `ask` are looked up.
    """
    points = folded([counts(s) for s in sets])
    sizes = np.array([len(s) for s in sets])
    if points is None:  # sets so odd that their counts exceed a byte are compared one by one
        points = sizes[:, None]
    tree, found = RTree(points, sizes), []
    for point in (range(len(sets)) if ask is None else ask.tolist()):
        for other in tree.candidates(point, limit, label):
            a, b = sets[point], sets[other]
            if len(a) > len(b):
                a, b = b, a
            place = np.minimum(np.searchsorted(b, a), len(b) - 1)
            if int((b[place] == a).sum()) >= limit.needed(len(a) + len(b)):
                found.append((point, other))
                label[label == label[other]] = label[point]
    return found


def clusters(sizes: np.ndarray, vectors: list[bytes | None], limit: Threshold) -> np.ndarray:
    """A label for each set, shared by those that a chain of pairs joins whose summed coordinate minima reach the overlap they need."""
    points = folded(vectors)
    label = np.arange(len(sizes))
    tree = RTree(sizes[:, None] if points is None else points, sizes)
    for point in range(len(sizes)):
        for other in tree.candidates(point, limit, label):
            label[label == label[other]] = label[point]
    return label


def element_set(text: str | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct runs of `size` words."""
    return np.unique(shingle_hashes(word_hashes(ascii_words(text)), size))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    with np.errstate(over="ignore"):
        pair = np.array([mixed(hashes).sum(dtype=np.uint64), mixed(hashes ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64)])
    return tuple(_signed(mixed(pair + np.uint64(len(hashes)))).tolist())


def fingerprints(df: DataFrame, key: str | Sequence[str], text: str, size: int) -> DataFrame:
    """The key columns, n, two halves of the set's digest, and its count vector, one row per row of `df`."""
    fields = [T.StructField(n, T.LongType()) for n in ("n", "h1", "h2")] + [T.StructField("vector", T.BinaryType())]

    def setup():
        def work(texts):
            sets = [element_set(t, size) for t in texts]
            return list(zip(*((len(s), *_digest(s), counts(s)) for s in sets), strict=True))

        return work

    return per_text(df, key, text, fields, setup)


def block_key_lists(df: DataFrame, key: str, text: str, size: int, limit: Threshold) -> DataFrame:
    """The digest and the block keys of every row with a key and words."""
    fields = [T.StructField(n, T.LongType()) for n in ("n", "h1", "h2")] + [T.StructField("keys", T.ArrayType(T.LongType()))]

    def setup():
        def work(texts):
            sets = [element_set(t, size) for t in texts]
            return list(zip(*((len(s), *_digest(s), _signed(block_keys(s, limit))) for s in sets), strict=True))

        return work

    return per_text(df.where(F.col(f"`{key}`").isNotNull()), key, text, fields, setup).where("n > 0")


_LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _search(rows: DataFrame, size: int, limit: Threshold) -> DataFrame:
    """Links found by an R-tree per task key. rows: task, cls, h1, h2, label, asks, text, sorted by task in each partition."""

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        if len(held) > 1:
            ids = list(held)
            names = {}
            label = np.array([names.setdefault(held[i][1], len(names)) for i in ids])
            ask = np.array([n for n, i in enumerate(ids) if held[i][2]])
            found = forest([held[i][0] for i in ids], label, limit, ask)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[x] for x, _ in found], pa.int64()), pa.array([ids[y] for _, y in found], pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, {}
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for r in batch.slice(start, 256).to_pylist():
                    if r["task"] != task:
                        yield from flush(held)
                        task, held = r["task"], {}
                    if r["cls"] in held:
                        held[r["cls"]][2] |= r["asks"]
                        continue
                    s = element_set(r["text"], size)
                    if _digest(s) == (r["h1"], r["h2"]):  # an id may repeat with another text
                        held[r["cls"]] = [s, r["label"], r["asks"]]
        yield from flush(held)

    return bounded_batches(rows.repartition("task").sortWithinPartitions("task")).mapInArrow(run, _LINKS)


def _shared_keys(keyed: DataFrame) -> DataFrame:
    """The rows (k, cls) whose key has several holders, and those of the first and the last key of a task, which may go on
    in another. Rows are dealt by ranges of key and holder, so a key that many hold is spread over tasks, and move once; most
    keys of unlike documents have one holder, so little is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = before = None
        k = cls = np.zeros(0, np.int64)  # the last row so far, kept back until the next one is known
        for batch in batches:
            if not batch.num_rows:
                continue
            k, cls = (np.concatenate([kept, batch.column(i).to_numpy()]) for i, kept in enumerate((k, cls)))
            first = k[0] if first is None else first
            same = k[1:] == k[:-1]
            shared = np.concatenate([[before is not None and before == k[0]], same[:-1]]) | same if len(same) else same
            keep = shared | (k[:-1] == first)
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(k[:-1][keep]), pa.array(cls[:-1][keep])], names=["k", "cls"])
            before = k[-2] if len(k) > 1 else before
            k, cls = k[-1:], cls[-1:]
        if len(k):
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(cls)], names=["k", "cls"])

    dealt = keyed.select("k", "cls").repartitionByRange("k", "cls").sortWithinPartitions("k", "cls")
    return dealt.mapInArrow(run, "k bigint, cls bigint")


_NEAR = T.StructType([T.StructField(n, T.LongType()) for n in ("k", "cls", "head")])


def _near(held: DataFrame, classes: DataFrame, limit: Threshold, group_rows: int) -> DataFrame:
    """Rows (k, cls, head): holders of a key that count vectors do not rule out as linked, each with a head of its cluster.

    Of keys with the same holders one is enough. A key of more than `group_rows` holders is one cluster, as it is.
    """
    same = held.groupBy("k").agg(
        F.count("*").alias("c"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("y"),
        F.min("cls").alias("head"))
    kept = settle(same.where("c > 1").groupBy("c", "x", "y", "head").agg(F.min("k").alias("k")).select("k", "c", "head"), "kept-keys")
    few, many = kept.where(F.col("c") <= group_rows), kept.where(F.col("c") > group_rows)
    grouped = held.join(few.select("k"), "k").join(classes.select("cls", "n", "vector"), "cls").select("k", "cls", "n", "vector")

    def flush(key, rows: list) -> Iterator[pa.RecordBatch]:
        if len(rows) < 2:
            return
        label = clusters(np.array([n for _, n, _ in rows]), [v for _, _, v in rows], limit)
        members: dict[int, list[int]] = {}
        for (cls, _, _), at in zip(rows, label.tolist(), strict=True):
            members.setdefault(at, []).append(cls)
        found = [(cls, min(group)) for group in members.values() if len(group) > 1 for cls in group]
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(found), pa.int64()), *(pa.array([f[i] for f in found], pa.int64()) for i in range(2))], names=_NEAR.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                for k, cls, n, vector in zip(*(c.to_pylist() for c in batch.slice(start, 4096).columns), strict=True):
                    if k != key:
                        yield from flush(key, rows)
                        key, rows = k, []
                    rows.append((cls, n, vector))
        yield from flush(key, rows)

    clustered = grouped.repartition("k").sortWithinPartitions("k").mapInArrow(run, _NEAR)
    whole = held.join(many.select("k", "head"), "k").select("k", "cls", "head")
    return settle(clustered.unionAll(whole), "near")


def _chunked(rows: DataFrame, chunk_rows: int, chunk_elements: int) -> DataFrame:
    """Rows (block, cls, n, ...) with the number of chunks of their block, their chunk, and whether they are among its anchors."""
    heights = settle(rows.groupBy("block").agg(F.count("*").alias("rows"), F.sum("n").alias("elements")), "heights")
    chunks = F.greatest(F.ceil(F.col("rows") / chunk_rows), F.ceil(F.col("elements") / chunk_elements)).cast("int")
    return rows.join(heights, "block").withColumn("chunks", chunks).withColumns({
        "chunk": F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"),
        "anchor": F.pmod(F.xxhash64("cls", F.lit(1)), F.col("rows")) < _ANCHORS}).drop("rows", "elements")


def similar_components(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, percent: int = 90, chunk_rows: int = 500,
    chunk_elements: int = 2_000_000, broadcast_rows: int = 1_000_000, carry: Sequence[str] = (),
) -> DataFrame:
    """key, n_shingles, component_id and the columns to carry, one row per row of `df`.

    A document's set is the distinct runs of `size` words (A-Z lower-cased, split at ASCII white space); the whole
    sequence if it is shorter; empty without words. Sets link when 100 * intersection >= percent * union; component_id is
    the smallest key reachable. Empty sets link with nothing. Rows without a key have no component and link with nothing.
    Rows that repeat a key are documents of their own: equal texts share a component, different ones only by links. An
    empty table gives no rows. Other columns are not read. Sets are compared by 64-bit hashes of their elements.

    1. Equal sets collapse to one numbered class each, counted in the map tasks first.
    2. Block keys: linked sets share one, see `block_keys`. Keys move once, and those with one holder go.
    3. Among the holders of a key an R-tree over count vectors finds the pairs whose summed coordinate minima reach the overlap they
       need. That moves vectors, of a fortieth of the text, and leaves few documents besides those that do resemble another.
    4. Such pairs, directly or in a chain, form a block. Within it an R-tree over count vectors gives the pairs to verify on the
       sets. Pairs already joined are skipped, so a block of n near copies costs about n checks. A text moves once.
    5. A block above `chunk_rows` documents or `chunk_elements` elements is cut into chunks that share a few anchors. Then the
       documents outside the block's largest component are searched against every chunk; or, where they are many, which is a
       chain of unlike documents, among the clusters of the keys they hold. So no link is lost.

    Texts are read again for members of blocks only. Up to `broadcast_rows` member ids, eight bytes each, are broadcast to
    pick those texts before they move.
    """
    limit = Threshold(percent)
    known = settle(fingerprints(df, [key, *carry], text, size).withColumnRenamed(key, "id"), "fingerprints")
    one = known.where("n > 0 and id is not null").groupBy("h1", "h2").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), F.first("vector").alias("vector"))
    # written with its number, which is what it is from then on
    classes = settle(one.withColumn("cls", F.monotonically_increasing_id()), "classes")
    lists = block_key_lists(df, key, text, size, limit).groupBy("h1", "h2").agg(F.first("keys").alias("keys"))
    keyed = lists.join(classes.select("h1", "h2", "cls"), ["h1", "h2"]).select("cls", F.explode("keys").alias("k"))
    near = _near(settle(_shared_keys(keyed), "held"), classes, limit, 4 * chunk_rows)
    blocks = components(near, "cls", "head")

    found = blocks.select(F.struct(F.lit(None).cast("bigint").alias("k"), F.col("component").alias("at")).alias("block"), F.col("node").alias("cls"))
    members = settle(_chunked(found.join(classes.select("cls", "id", "h1", "h2", "n"), "cls"), chunk_rows, chunk_elements), "members")
    texts = df.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    wanted = members.select("id").distinct()
    texts = texts.join(F.broadcast(wanted) if wanted.count() <= broadcast_rows else wanted, "id", "left_semi")
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    own = members.withColumn("c", F.explode(F.when(F.col("anchor"), every).otherwise(F.array("chunk"))))
    links = settle(_search(
        own.select(F.struct("block", "c").alias("task"), "cls", "id", "h1", "h2", F.col("cls").alias("label"), F.lit(True).alias("asks"))
        .join(texts, "id"), size, limit), "jaccard-links")

    large = members.where("chunks > 1")
    if large.limit(1).count():
        asked = _asked(large, links, near, chunk_rows, chunk_elements)
        links = settle(links.unionAll(_across(asked, texts, size, limit, chunk_rows)), "jaccard-links")
    joined = components(links, "a", "b").withColumnRenamed("node", "cls")
    of_class = classes.select("h1", "h2", "cls", "id").join(joined, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    least = of_class.groupBy("component").agg(F.min("id").alias("least"))
    of_class = of_class.join(least, "component").select("h1", "h2", "least")
    has_set = F.col("id").isNotNull() & (F.col("n") > 0)
    linked = known.where(has_set).join(of_class, ["h1", "h2"])
    alone = known.where(~has_set).withColumn("least", F.when(F.col("n") == 0, F.col("id")))
    shape = [F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("least").alias("component_id"), *carry]
    return linked.select(shape).unionAll(alone.select(shape))


def _asked(large: DataFrame, links: DataFrame, near: DataFrame, chunk_rows: int, chunk_elements: int) -> DataFrame:
    """The members of large blocks with their label, the component they have by now, and whether they are outside the block's
    largest one and ask. Where more than a chunk of a block ask, the clusters of keys that hold one of these take the block's place,
    if that moves fewer rows: a member is in a cluster for each of its keys, whereas a block is searched once for each chunk that asks."""
    joined = components(links, "a", "b").withColumnRenamed("node", "cls")
    keys = near.groupBy("cls").agg(F.count("*").alias("keys"))
    labelled = settle(
        large.join(joined, "cls", "left").withColumn("label", F.coalesce("component", "cls")).drop("component").join(keys, "cls", "left"), "joined")
    order = F.struct("c", "label")
    main = (
        labelled.groupBy("block", "label", "chunks").agg(F.count("*").alias("c"), F.sum("keys").alias("keys"))
        .groupBy("block", "chunks").agg(
            F.max_by("label", order).alias("main"), F.sum("c").alias("rows"), (F.sum("c") - F.max("c")).alias("askers"),
            F.sum("keys").alias("keys"), (F.sum("keys") - F.max_by("keys", order)).alias("asking_keys")))
    moved = F.col("askers") * F.col("chunks") + F.col("rows") * F.ceil(F.col("askers") / chunk_rows)
    chained = (F.col("askers") > chunk_rows) & (moved > F.col("keys") + F.col("asking_keys"))
    labelled = settle(labelled.drop("chunks", "keys").join(main, "block").select(
        "block", "cls", "id", "h1", "h2", "n", "label", (F.col("label") != F.col("main")).alias("asks"), "chunk", "chunks",
        chained.alias("chained")), "labelled")
    whole, chained = labelled.where("not chained").drop("chained"), labelled.where("chained").drop("chained")
    if not chained.limit(1).count():
        return whole
    held = near.join(chained.drop("block", "chunk", "chunks"), "cls").withColumn("block", F.struct("k", F.col("head").alias("at"))).drop("k", "head")
    asking = settle(held.groupBy("block").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("block"), "asking-clusters")
    return whole.unionByName(_chunked(held.join(asking, "block"), chunk_rows, chunk_elements).drop("anchor"))


def _across(labelled: DataFrame, texts: DataFrame, size: int, limit: Threshold, chunk_rows: int) -> DataFrame:
    """Links of the asking members of each block with members of its chunks that have another label."""
    labelled = settle(labelled, "asked")
    asking = labelled.where("asks")
    numbers = asking.groupBy("block").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("parts"))
    asking = asking.join(numbers, "block").withColumn("part", F.pmod(F.xxhash64("cls", F.lit(2)), F.col("parts")).cast("int"))
    askers = asking.withColumn("c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    asked = labelled.join(numbers, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    shape = lambda d, c, asks: d.select(
        F.struct("block", F.col(c).alias("c"), "part").alias("task"), "cls", "id", "h1", "h2", "label", F.lit(asks).alias("asks"))
    rows = shape(askers, "c", True).unionAll(shape(asked, "chunk", False))
    return _search(rows.join(texts, "id"), size, limit)
