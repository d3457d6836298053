"""Byte-level BPE encoding and decoding (operator 1).

The rank file of a byte-level vocabulary is turned into a sentencepiece BPE
model without any training: the model's protocol buffer is written here field by
field.  Every token's bytes become printable characters one to one, the piece's
score is its negative rank (so the merge of the lowest rank wins, leftmost
first), and normalisation is the identity.  Texts are split by the pre-token
pattern; every pre-token is encoded on its own and decoding is the inverse table.

Pre-tokens repeat, so each Python worker keeps a bounded memo from pre-token to
packed ids.  There is no shuffle: both directions are narrow maps over Arrow
batches, and a lost executor only costs its own input splits.

Defined cases: a null text encodes as the empty text (no ids); texts of any length
are handled whole; repeated rows and repeated ids each give their own row; an
empty table gives an empty result; only the id and text columns are read, so
other columns, whatever their names, cannot clash.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelloom.llm.arrow import bound_batches, sliced

#: Entries a worker's memo may hold before it starts anew (about 50 MB).
MEMO_ENTRIES = 250_000


def _byte_chars() -> list[str]:
    """One printable, non-space character per byte: the byte's own if visible, else from U+0100 on."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    chars = {b: chr(b) for b in visible}
    chars |= {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in chars)}
    return [chars[b] for b in range(256)]


BYTE_CHARS = _byte_chars()
#: latin-1 text -> byte characters, for str.translate.
_TO_CHARS = dict(enumerate(BYTE_CHARS))
_TO_BYTE = {c: b for b, c in enumerate(BYTE_CHARS)}


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 token, space, rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (x.split() for x in f if x.strip())}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _sized(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _flag(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece ModelProto of a vocabulary: piece i is the token of the i-th lowest rank, the unknown piece last."""
    normal, unknown = 1, 2
    body = bytearray()
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        piece = token.decode("latin-1").translate(_TO_CHARS).encode()
        body += _sized(1, _sized(1, piece) + b"\x15" + struct.pack("<f", -rank) + _flag(3, normal))
    body += _sized(1, _sized(1, b"<unk>") + b"\x15" + struct.pack("<f", -float(len(ranks))) + _flag(3, unknown))
    trainer = _flag(3, 2) + _flag(40, len(ranks))  # model_type BPE, unk_id
    identity = _sized(1, b"identity") + _flag(3, 0) + _flag(4, 0) + _flag(5, 0)
    return bytes(body + _sized(2, trainer) + _sized(3, identity))


class Codec(dict):
    """Pre-token -> packed little-endian uint32 ids, filled on demand through sentencepiece."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import sentencepiece

        super().__init__()
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(ranks))
        self.rank_of = np.array(sorted(ranks.values()), dtype="<u4")
        size = int(self.rank_of[-1]) + 1 if ranks else 0
        self.bytes_of: list[bytes] = [b""] * size
        for i, rank in enumerate(self.rank_of.tolist()):
            self.bytes_of[rank] = bytes(_TO_BYTE[c] for c in self.model.id_to_piece(i))

    def __missing__(self, pretoken: str) -> bytes:
        raw = pretoken.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(raw)
        if whole is not None:
            ids = struct.pack("<I", whole)
        else:
            found = self.model.encode(raw.decode("latin-1").translate(_TO_CHARS))
            ids = self.rank_of[found].tobytes()
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        if len(pretoken) <= 64:
            self[pretoken] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, self.split(text))) if text else b""

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(rank_path: str, pattern: str) -> Codec:
    """This process's codec of a rank file, made once."""
    key = (rank_path, pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(load_ranks(rank_path), pattern)
    return _CODECS[key]


def encode(df: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): each text's token ids, packed as little-endian uint32."""

    bound_batches(df)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_path, pattern)
        for b in sliced(batches):
            ids = pa.array([own.encode(x.as_py()) for x in b.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=[id_col, "ids"])

    picked = df.select(F.col(id_col), F.col(text_col))
    return picked.mapInArrow(run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, ids binary")


def decode(df: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, ids, decoded): adds the bytes that the ids stand for; null ids decode to no bytes."""

    bound_batches(df)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_path, pattern)
        for b in sliced(batches):
            out = pa.array([own.decode(x.as_py() or b"") for x in b.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), out], names=[id_col, "ids", "decoded"])

    picked = df.select(F.col(id_col), F.col("ids"))
    return picked.mapInArrow(run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, ids binary, decoded binary")


def round_trip(df: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded): ``encode`` and ``decode`` of its ids in one pass, by one set of workers."""
    bound_batches(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(rank_path, pattern)
        for b in sliced(batches):
            ids = [own.encode(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), pa.array(map(own.decode, ids), pa.binary())], names=[id_col, "ids", "decoded"])

    picked = df.select(F.col(id_col), F.col(text_col))
    return picked.mapInArrow(run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, ids binary, decoded binary")
