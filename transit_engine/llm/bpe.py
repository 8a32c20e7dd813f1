"""Byte-level BPE by a sentencepiece model made from the vocabulary itself.

The model is serialised directly: every token of a rank file becomes a piece, its bytes mapped to
one character each, with its negative rank as score, so that sentencepiece merges what the ranks
merge first. Normalisation is the identity. Texts are cut into pre-tokens by a pattern, each is
encoded on its own; ids are decoded by the inverse of the byte map.

The vocabulary is read once by the driver and sent to the tasks (its size is bounded by the file
and checked). Rows don't depend on each other: there is no shuffle, and a lost task is run again.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from transit_engine.llm.common import broadcast_bounded

# Wire numbers of the public sentencepiece model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE, UNKNOWN = 1, 2, 3, 2
MODEL_TYPE, BPE = 3, 2
NORMALIZER_NAME, SWITCHED_OFF = 1, (3, 4, 5)  # no dummy prefix, no space removal, no space escapes
VARINT, LENGTH, FIXED32 = 0, 2, 5

FIRST_CHARACTER = 0x100  # byte b is character 0x100 + b: letters that nothing normalises
TO_CHARACTERS = {b: chr(FIRST_CHARACTER + b) for b in range(256)}

REMEMBERED = 200_000  # pre-tokens a task keeps the ids of; only saves time
LONG = 1_000_000  # texts above this many characters are cut into pre-tokens bit by bit
AT_ONCE = 100_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, kind: int, value: bytes | int | float) -> bytes:
    key = _varint(number << 3 | kind)
    if kind == LENGTH:
        return key + _varint(len(value)) + value
    return key + (_varint(value) if kind == VARINT else struct.pack("<f", value))


def mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(TO_CHARACTERS)


def serialised_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model whose piece ids are the ranks, which must run from 0 without gaps."""
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every byte must have a rank")
    pieces = [
        _field(PIECE_TEXT, LENGTH, mapped(t).encode()) + _field(PIECE_SCORE, FIXED32, -float(k))
        for k, t in enumerate(tokens)
    ]
    # The format asks for an unknown piece; it can't occur, as every byte has a piece.
    pieces.append(_field(PIECE_TEXT, LENGTH, b"<unk>") + _field(PIECE_TYPE, VARINT, UNKNOWN))
    normalizer = _field(NORMALIZER_NAME, LENGTH, b"identity")
    normalizer += b"".join(_field(n, VARINT, 0) for n in SWITCHED_OFF)
    return (
        b"".join(_field(PIECES, LENGTH, p) for p in pieces)
        + _field(TRAINER, LENGTH, _field(MODEL_TYPE, VARINT, BPE))
        + _field(NORMALIZER, LENGTH, normalizer)
    )


class Codec:
    """Encodes texts to packed ids (little-endian unsigned 32-bit) and decodes them."""

    def __init__(self, model: bytes, pattern: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pattern = regex.compile(pattern)
        unknown = self.pieces.unk_id()
        self.tokens = [
            bytes(ord(c) - FIRST_CHARACTER for c in self.pieces.id_to_piece(i))
            for i in range(self.pieces.vocab_size()) if i != unknown
        ]
        self.known: dict[str, bytes] = {}

    def pre_tokens(self, text: str) -> Iterator[list[str]]:
        if len(text) <= LONG:
            yield self.pattern.findall(text)
            return
        found = (m.group() for m in self.pattern.finditer(text))
        while part := list(islice(found, AT_ONCE)):
            yield part

    def encode(self, text: str | None) -> bytes:
        packed = []
        for part in self.pre_tokens(text or ""):
            new = list({t for t in part if t not in self.known})
            if len(self.known) + len(new) > REMEMBERED:
                self.known.clear()
                new = list(set(part))
            if new:
                ids = self.pieces.encode([mapped(t.encode()) for t in new], num_threads=1)
                self.known.update((t, struct.pack(f"<{len(i)}I", *i)) for t, i in zip(new, ids))
            packed.append(b"".join(map(self.known.__getitem__, part)))
        return b"".join(packed)

    def decode(self, packed: bytes) -> bytes:
        ids = memoryview(packed).cast("I") if _LITTLE else struct.unpack(f"<{len(packed) // 4}I", packed)
        return b"".join(map(self.tokens.__getitem__, ids))


_LITTLE = struct.pack("=I", 1) == struct.pack("<I", 1)
_CODECS: dict[tuple, Codec] = {}


def _codec(model: bytes, pattern: str) -> Codec:
    """One codec per Python worker, whichever tasks it runs."""
    key = (hash(model), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(model, pattern)
    return _CODECS[key]


def encoded(docs: DataFrame, vocabulary: str, pattern: str, decode: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (packed) and, with ``decode``, what the ids decode to.

    ``vocabulary`` is the path of a rank file, ``pattern`` what cuts a text into pre-tokens. No
    special tokens: their strings are ordinary text. Null counts as an empty text, which has no
    ids. Rows are encoded one by one, repeated ones alike; other columns are not looked at.
    """
    spark = docs.sparkSession
    model = serialised_model(read_ranks(vocabulary))
    sent = broadcast_bounded(spark, model, len(model))
    schema = "doc_id long, n_tokens long, ids binary" + ", decoded binary" * decode

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(sent.value, pattern)
        for batch in batches:
            ids = [codec.encode(text.as_py()) for text in batch.column(1)]
            columns = [
                batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array(ids, pa.binary()),
            ]
            if decode:
                columns.append(pa.array([codec.decode(x) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=_arrow(decode))

    rows = docs.selectExpr("cast(doc_id as bigint) AS doc_id", "text")
    return rows.mapInArrow(run, schema)


def _arrow(decode: bool) -> pa.Schema:
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    return pa.schema(fields + [("decoded", pa.binary())] * decode)
