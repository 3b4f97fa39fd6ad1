"""WARC archives: a writer with revisit records, and a reader that salvages what it can from damaged archives."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyframe.sources.shared import settle, shared_path

_MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/[01]\.[0-9]+\r?\n")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
_FEED = 1 << 16
_HEADER_LIMIT = 1 << 20


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> str:
    """Control characters would end a header line; they are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in text)


def record(kind: str, record_id: str, date: str, uri: str | None, payload: bytes, refers_to: str | None = None) -> bytes:
    """One WARC/1.1 record. A revisit's block is the HTTP header alone; it names the digest and length of the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if kind == "response":
        block += payload
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_header_value(uri)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member whose last byte is 0: large data is followed by an empty member, whose length field is 0."""
    packed = gzip.compress(data, 6, mtime=0)
    return packed if packed.endswith(b"\0") else packed + gzip.compress(b"", mtime=0)


def write_archives(
    df: DataFrame, path: str, key: str = "page_id", uri: str = "url", payload: str = "html", min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z", archive_bytes: int = 32 << 20, name: str = "urn:page:",
) -> None:
    """Write a record per row of `df` below `path`, each a gzip member of its own, about `archive_bytes` per archive.

    Of the rows with one payload of `min_bytes` or more, that with the largest key is a response and the others are
    revisits that refer to it; smaller payloads are always responses. A NULL payload is empty. Rows without a key are
    responses and nothing refers to them; repeated rows with the largest key are responses all. An empty table writes no
    record. Other columns are not read. Digests are counted before any shuffle, so copies by the thousand cost one row per
    task; pages move once, by their unique key. Archives are stored by Spark's own writer, which commits whole tasks: each
    row is a member without its last byte, and the line separator is that byte.
    """
    pages = df.select(
        F.col(f"`{key}`").alias("k"), F.col(f"`{uri}`").cast("string").alias("uri"),
        F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).alias("payload"))
    spark = df.sparkSession
    digests = settle(pages.select("k", F.sha1("payload").alias("h"), F.octet_length("payload").cast("bigint").alias("n")), "digests")
    total = digests.agg(F.sum("n")).head()[0] or 0
    archives = max(1, -(-total // archive_bytes))
    heads = (
        digests.where(F.col("k").isNotNull() & (F.col("n") >= min_bytes))
        .groupBy("h").agg(F.max("k").alias("head"), F.count("*").alias("c")).where("c > 1").drop("c"))
    revisits = digests.where(F.col("n") >= min_bytes).join(heads, "h").where("k < head").select("k", "h", "head").distinct()
    revisits = settle(revisits, "revisits")
    rows = (
        pages.withColumn("h", F.sha1("payload")).repartition(archives, "k", "h")
        .join(revisits.repartition(archives, "k", "h"), ["k", "h"], "left")
        .select(F.col("k").cast("string"), "uri", F.encode("payload", "UTF-8").alias("payload"), F.col("head").cast("string")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                out = []
                for r in batch.slice(start, 64).to_pylist():
                    refers = None if r["head"] is None else name + r["head"]
                    out.append(member(record(
                        "response" if refers is None else "revisit", name + (r["k"] or "none"), date, r["uri"], r["payload"],
                        refers))[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    members = rows.mapInArrow(run, T.StructType([T.StructField("value", T.BinaryType())]))
    members.select(F.col("value").cast("string")).write.option("lineSep", "\0").text(path)


class Damaged(Exception):
    """A member or record failed a check; the message is the reason."""


def _inflate(data: memoryview, start: int) -> tuple[bytes, int, str | None]:
    """The content of the gzip member at `start`, where it ends, and None if its checksum and length are right; else what did
    inflate, how far that goes, and the reason."""
    inflater, out, at = zlib.decompressobj(31), [], start
    try:
        while not inflater.eof:
            if at >= len(data):
                return b"".join(out), at, "member is cut off"
            out.append(inflater.decompress(data[at:at + _FEED]))
            at = min(at + _FEED, len(data))
    except zlib.error as error:  # the same again, then byte by byte, as a failing call gives nothing
        inflater = zlib.decompressobj(31)
        out = [inflater.decompress(data[i:i + _FEED]) for i in range(start, at, _FEED)]
        try:
            while True:
                out.append(inflater.decompress(data[at:at + 1]))
                at += 1
        except zlib.error:
            return b"".join(out), at, f"member: {error}"
    return b"".join(out), at - len(inflater.unused_data), None


def _inside(content: bytes, verify: bool) -> tuple[list[dict], list[str]]:
    """The sound records of a member's content, and the gaps between, as text. After a failed check the next version line is
    tried, and so on."""
    found, gaps, at, gap, reason = [], [], 0, None, ""
    while at < len(content):
        try:
            entry, end = _one(content, at, verify)
        except Damaged as error:
            if gap is None:
                gap, reason = at, str(error)
            at = content.find(b"WARC/", at + 1)
            if at < 0:
                break
            continue
        if gap is not None:
            gaps.append(f"in a member, bytes {gap} to {at}: {reason}")
            gap = None
        found.append(entry)
        at = end
    if gap is not None:
        gaps.append(f"in a member, bytes {gap} to {len(content)}: {reason}")
    return found, gaps


def _one(data: bytes, start: int, verify: bool) -> tuple[dict, int]:
    """The record at `start` and where it ends; raises if the header, length, end mark or a digest is wrong."""
    if not _VERSION.match(data, start):
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", start, start + _HEADER_LIMIT)
    if end < 0:
        raise Damaged("header has no end")
    head = {}
    for line in data[start:end].split(b"\r\n")[1:]:
        field, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a colon")
        head[field.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    for field in ("warc-type", "warc-record-id", "warc-date"):  # the format demands them
        if not head.get(field):
            raise Damaged(f"no {field}")
    if not re.fullmatch("[0-9]{1,18}", head.get("content-length", "")):
        raise Damaged("no length")
    first, last = end + 4, end + 4 + int(head["content-length"])
    if last + 4 > len(data):
        raise Damaged("record is cut off")
    if data[last:last + 4] != b"\r\n\r\n":
        raise Damaged("no end mark where the length says")
    block = data[first:last]
    http_end = block.find(b"\r\n\r\n") if head.get("content-type", "").startswith("application/http") else -4
    payload = block[http_end + 4:] if http_end >= 0 or http_end == -4 else block
    http = block[:max(0, http_end)]
    if verify:
        for field, content in (("warc-block-digest", block), ("warc-payload-digest", payload)):
            named = head.get(field, "")
            if named.startswith("sha1:") and not (field == "warc-payload-digest" and head.get("warc-type") != "response"):
                if named[5:].upper() != digest(content):
                    raise Damaged(f"{field} differs")
    return {"head": head, "http": http, "payload": payload}, last + 4


def salvage(data: bytes, verify: bool = True) -> Iterator[tuple[int, int, dict | str]]:
    """Start, end and record of every sound record of an archive in order, or start, end and reason of a byte gap.

    Gzip members (one or several records each) and plain records may be mixed. After a failed check the next place that
    looks like a member or version line is tried, and so on until one passes; the bytes between are one gap. Inside a member
    it is the same with its content: its sound records are given, and each inner gap as a gap with the member's range. Of a
    damaged member the records in what did inflate are given, with the range that held them, and the rest is a gap that
    names the inner ones. Gaps and records cover the archive.
    """
    view, at, gap, reason, held, reach = memoryview(data), 0, None, "", [], 0

    def until(to: int) -> Iterator[tuple[int, int, dict | str]]:
        edge = max(gap, min(reach, to - 1)) if held else gap
        for entry in held:
            yield gap, edge, entry
        yield edge, to, reason

    while at < len(data):
        found, inner, wrong = [], [], None
        if data.startswith(_MAGIC, at):
            content, end, wrong = _inflate(view, at)
            found, inner = _inside(content, verify)
        else:
            try:
                entry, end = _one(data, at, verify)
                if at < reach and entry in held:  # stored in the damaged member that gave it
                    wrong = "given already"
                else:
                    found.append(entry)
            except Damaged as error:
                wrong = str(error)
        if wrong is None or found:
            if gap is not None:
                yield from until(at)
            gap, held, reach = None, [], 0
        if wrong is not None:
            if gap is None:
                gap, reason, held, reach = at, "; ".join([wrong, *inner]) if found else wrong, found, end if found else 0
            at = _next(data, at + 1)
            continue
        for entry in found:
            yield at, end, entry
        for lost in inner:
            yield at, end, lost
        at = end
    if gap is not None:
        yield from until(len(data))


def _next(data: bytes, start: int) -> int:
    """Where the next member or version line may begin; the end if nowhere."""
    places = [i for i in (data.find(_MAGIC, start), data.find(b"WARC/", start)) if i >= 0]
    return min(places, default=len(data))


RECORDS = T.StructType([
    T.StructField("archive", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("gap", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("record_id", T.StringType()), T.StructField("date", T.StringType()), T.StructField("uri", T.StringType()),
    T.StructField("refers_to", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload", T.BinaryType())])


def _row(archive: str, start: int, end: int, found: dict | str, with_payload: bool) -> tuple:
    if isinstance(found, str):
        return (archive, start, end, found) + (None,) * 8
    head, payload = found["head"], found["payload"]
    kind = head.get("warc-type")
    if kind == "revisit":  # the payload is elsewhere: its length and digest are what this record says
        length = re.search(rb"(?im)^content-length:[ \t]*([0-9]{1,18})[ \t]*\r?$", found["http"])
        size, sha = int(length[1]) if length else None, head.get("warc-payload-digest", "").removeprefix("sha1:") or None
        payload = None
    else:
        size, sha = len(payload), digest(payload)
    bare = lambda field: head[field].strip("<>") if field in head else None
    return (archive, start, end, None, kind, bare("warc-record-id"), head.get("warc-date"), head.get("warc-target-uri"),
            bare("warc-refers-to"), size, sha, payload if with_payload else None)


def read_archives(spark: SparkSession, path: str, verify: bool = True, with_payload: bool = True) -> DataFrame:
    """A row per sound record and per quarantined byte gap of the archives below `path`.

    For a gap, `gap` is the reason and only archive, start and end are set. A response's digest and length are of the
    bytes read; a revisit's are those it names. Archives are read through Spark, one row each, so an archive must fit in
    a task: `write_archives` keeps them to a bound. No archives or empty ones give no rows. `with_payload=False` leaves
    the payload NULL.
    """
    kinds = [to_arrow_type(f.dataType) for f in RECORDS]

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=RECORDS.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                archive, held, size = batch.column(0)[i].as_py(), [], 0
                for start, end, found in salvage(batch.column(1)[i].as_py() or b"", verify):
                    held.append(_row(archive, start, end, found, with_payload))
                    size += 1000 + (end - start)
                    if size > 4 << 20:
                        yield pack(held)
                        held, size = [], 0
                if held:
                    yield pack(held)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, RECORDS)


def round_trip(df: DataFrame, **options) -> DataFrame:
    """Write the rows as archives in the shared folder and read them back; see the two functions."""
    path = shared_path(df.sparkSession, "warc")
    write_archives(df, path, **options)
    return read_archives(df.sparkSession, path, with_payload=False)
