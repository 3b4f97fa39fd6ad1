"""Byte-level BPE by a sentencepiece model written straight from a rank vocabulary."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator, Sequence
from itertools import chain
from pathlib import Path

import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.rowwise import REMEMBERED, per_text

_BPE, _NORMAL, _UNKNOWN = 2, 1, 2  # fixed values of the model format
_UNKNOWN_PIECE = "\ue000"  # not among the characters that stand for bytes


def byte_characters() -> list[str]:
    """A visible character for each byte: itself where it is visible Latin-1, else the next one from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(0x100 + hidden.index(b)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 and rank on each line), in order of rank; ranks must be 0, 1, 2 ..."""
    pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, Path(path).read_bytes().splitlines()))
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError(f"{path}: ranks have gaps or repeat")
    return [token for _, token in pairs]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out) + bytes([n])


def _field(number: int, value: int | float | bytes) -> bytes:
    """A protobuf field: whole number, 32-bit float, or bytes."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialised_model(tokens: Sequence[bytes]) -> bytes:
    """A sentencepiece BPE model: piece i is token i in byte characters, scored -i, so the lowest rank merges first.

    One unknown piece follows, which the format requires; no text reaches it, as every byte is a piece. The normaliser is
    the identity: no dummy prefix, no trimming, no escaped white space.
    """
    characters = byte_characters()
    pieces = b"".join(
        _field(1, _field(1, "".join(map(characters.__getitem__, token)).encode()) + _field(2, float(-rank)) + _field(3, _NORMAL))
        for rank, token in enumerate(tokens))
    pieces += _field(1, _field(1, _UNKNOWN_PIECE.encode()) + _field(2, 0.0) + _field(3, _UNKNOWN))
    trainer = _field(3, _BPE) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + _field(45, _UNKNOWN_PIECE.encode())
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return pieces + _field(2, trainer) + _field(3, normaliser)


class ByteBpe:
    """Encodes and decodes with such a model; `pattern` splits a text before the merges, the ids of `remembered` parts are kept."""

    def __init__(self, model: bytes, pattern: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pattern = regex.compile(pattern)
        self.to_characters = dict(enumerate(byte_characters()))
        self.to_bytes = {ord(c): b for b, c in self.to_characters.items()}
        self.pieces = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size() - 1)]
        self.whole = {piece: i for i, piece in enumerate(self.pieces)}
        self.decimal = [str(i) for i in range(len(self.pieces))]
        self.known: dict[str, tuple[int, ...]] = {}

    def _learn(self, parts: Sequence[str]) -> None:
        """Remember the ids of new parts; a part that is a token of its own needs no merges."""
        mapped = [p.encode().decode("latin-1").translate(self.to_characters) for p in parts]
        merged = [i for i, m in enumerate(mapped) if m not in self.whole]
        self.known.update((p, (self.whole[m],)) for p, m in zip(parts, mapped, strict=True) if m in self.whole)
        ids = self.processor.encode([mapped[i] for i in merged], num_threads=1) if merged else []
        self.known.update((parts[i], tuple(x)) for i, x in zip(merged, ids, strict=True))

    def encode_all(self, texts: Sequence[str]) -> Iterator[list[int]]:
        """The ids of each text; `known` never holds more than `remembered` parts and those of one text."""
        for text in texts:
            parts = self.pattern.findall(text)
            if len(self.known) > self.remembered:
                self.known.clear()
            new = set(parts).difference(self.known)
            if new:
                self._learn(list(new))
            yield list(chain.from_iterable(map(self.known.__getitem__, parts)))

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def decode(self, ids: Sequence[int]) -> bytes:
        return "".join(map(self.pieces.__getitem__, ids)).translate(self.to_bytes).encode("latin-1")


def encode_documents(
    df: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = True,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per row of `df`: key, n_tokens, ids, ids_sha256 and decoded_sha256 (of the bytes decoded from the ids).

    Whole texts; each match of `pattern` is encoded by itself, without special tokens. The digest of the ids is over the
    decimal ids joined by one space. NULL and empty texts have no tokens. Equal rows are encoded alike; an empty table
    gives no rows; other columns are not read. The vocabulary file is read once on the driver and sent to the tasks as
    a serialised model; its size is that of the file, whatever the data. `with_ids=False` leaves `ids` NULL. A task
    remembers the ids of `remembered` parts, about 300 bytes each, and encodes more often with fewer. One pass, no shuffle.
    """
    model = df.sparkSession.sparkContext.broadcast(serialised_model(read_ranks(vocabulary)))
    fields = [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]

    def setup():
        coder = ByteBpe(model.value, pattern, remembered)

        def work(texts):
            rows = []
            for ids in coder.encode_all([t or "" for t in texts]):
                rows.append((
                    len(ids), ids if with_ids else None, hashlib.sha256(" ".join(map(coder.decimal.__getitem__, ids)).encode()).hexdigest(),
                    hashlib.sha256(coder.decode(ids)).hexdigest()))
            return list(zip(*rows, strict=True))

        return work

    return per_text(df, key, text, fields, setup)


def decode_ids(df: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per row of `df`: key and the `bytes` its token ids stand for; NULL ids give empty bytes."""
    model = df.sparkSession.sparkContext.broadcast(serialised_model(read_ranks(vocabulary)))
    as_text = df.select(F.col(f"`{key}`"), F.array_join(F.col(f"`{ids}`").cast("array<string>"), " ").alias("__ids"))

    def setup():
        coder = ByteBpe(model.value, "$^")
        return lambda lists: [[coder.decode([int(i) for i in (x or "").split()]) for x in lists]]

    return per_text(as_text, key, "__ids", [T.StructField("bytes", T.BinaryType())], setup)
