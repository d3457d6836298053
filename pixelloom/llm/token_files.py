"""Token-ID files: frequency-ranked ids in a byte-aligned code with separate control bytes (operator 7).

The file is a Parquet dataset of *blocks*, so that any store that Spark can write will do and
task commits keep it whole when executors are lost.  A block holds consecutive documents:

    part, start     which range of documents, and the number of ids before the block in the whole dataset
    doc_ids, sizes  the documents and their numbers of ids, the end id included
    control         two bits per id, four ids a byte, low bits first: bytes of the id's rank, less one
    data            the ranks, little-endian, one to four bytes each

Ids are replaced by their rank by frequency over all documents, so that frequent ids take
one byte.  The rank table is part of the dataset's metadata (one row per id of the
vocabulary, bounded by it) and is all that is broadcast.

Writing takes three steps: texts are range-partitioned by document id and tokenised in that order
(the one shuffle), ids are counted by partial sums, blocks are recoded in a narrow pass.
Reading looks control bytes up in a table of lengths with numpy and gathers the ranks at once.

Defined cases: a null text is the empty text (just the end id); texts of any length stay whole,
since a block holds at least one document; rows of equal id stay neighbours, in order of
their texts; null ids come first; empty tables give empty files; only the id and text columns
are read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelloom.llm.arrow import bound_batches, kind_of
from pixelloom.llm.pretoken import ChunkEncoder
from pixelloom.sources.storage import materialise, new_path

#: Ids after which a block ends.
BLOCK_IDS = 200_000
END_ID = 0
#: The pre-token pattern of a byte-level pre-tokenizer with its regex switched on (the tokenizer file's own).
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], dtype=np.int64)
_MASKS = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, dtype="<u4")
    code = (values > 0xFF).astype(np.uint8)
    if values.size and values.max() > 0xFFFF:
        code += (values > 0xFFFF).astype(np.uint8) + (values > 0xFFFFFF)
    width = int(code.max(initial=0)) + 1
    narrow = values.astype("<u2") if width <= 2 else values
    kept = np.zeros((len(values), 2 if width <= 2 else 4), bool)
    for k in range(width):
        kept[:, k] = code >= k
    data = np.compress(kept.ravel(), narrow.view(np.uint8))
    four = np.zeros((-(-len(values) // 4), 4), dtype=np.uint8)
    four.ravel()[: len(values)] = code
    return (four << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(1, dtype=np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of control and data bytes."""
    size = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(size) - size
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    value = raw[at].astype(np.uint32)
    for k in range(1, int(size.max(initial=1))):
        value |= raw[at + k].astype(np.uint32) << np.uint32(8 * k)
    return value & _MASKS[size - 1]


_ENCODERS: dict[str, tuple[Callable[[str | None], bytes], str]] = {}


def encoder(tokenizer_path: str) -> tuple[Callable[[str | None], bytes], str]:
    """This process's encoder of a tokenizer file, text to packed ids by the tokenizers library, and the ids' numpy type.

    Byte-level files whose pre-tokenizer adds nothing and whose normaliser is empty go through the memo; strings of
    special tokens inside a text are found by the library, as it does by default."""
    if tokenizer_path not in _ENCODERS:
        import regex
        from tokenizers import Tokenizer

        from pixelloom.llm.bpe import BYTE_CHARS

        tokenizer, chars = Tokenizer.from_file(tokenizer_path), dict(enumerate(BYTE_CHARS))
        spec = json.loads(tokenizer.to_str())
        pre = spec["pre_tokenizer"] or {}
        plain = spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        special = [t["content"] for t in spec["added_tokens"]]
        tokenize = tokenizer.model.tokenize
        kind = "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        packed = [i.to_bytes(int(kind[2]), "little") for i in range(tokenizer.get_vocab_size())]

        def by_library(text: str) -> bytes:
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, kind).tobytes()

        def pretoken(x: str) -> bytes:
            mapped = chars[32] + x[1:] if x[0] == " " and x[1:].isalpha() and x.isascii() else x.encode().decode("latin-1").translate(chars)
            return b"".join([packed[t.id] for t in tokenize(mapped)])

        memo = ChunkEncoder(regex.compile(BYTE_LEVEL_PATTERN).findall, pretoken)

        def encode(text: str | None) -> bytes:
            if not text:
                return b""
            if not plain or any(s in text for s in special):
                return by_library(text)
            return memo(text)

        _ENCODERS[tokenizer_path] = encode, kind
    return _ENCODERS[tokenizer_path]


_RAW = "part int, part_start long, doc_ids array<{kind}>, sizes array<long>, ids binary, counts binary"


def _raw_blocks(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, block_ids: int) -> DataFrame:
    """Blocks of unranked ids in ascending order of document id, numbered by range, and a row of id counts for each range."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("body"))
    kind = kind_of(picked, "id")
    id_type = pa.int64() if kind == "bigint" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (encode, of), part, start = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        end = np.array([END_ID], of).tobytes()
        names, sizes, ids, n = [], [], [], 0
        counts = np.zeros(1 << 16, np.int64)
        kinds = [pa.int32(), pa.int64(), pa.list_(id_type) if id_type else pa.list_(pa.null()), pa.list_(pa.int64()), pa.binary(), pa.binary()]

        def block() -> pa.RecordBatch:
            nonlocal counts
            found = np.bincount(np.frombuffer(b"".join(ids), of), minlength=len(counts))
            counts = found + np.pad(counts, (0, len(found) - len(counts)))
            columns = [pa.array([part], pa.int32()), pa.array([start], pa.int64()), pa.array([names], pa.list_(id_type) if id_type else None), pa.array([sizes], pa.list_(pa.int64())), pa.array([b"".join(ids)], pa.binary()), pa.nulls(1, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["part", "part_start", "doc_ids", "sizes", "ids", "counts"])

        for b in batches:
            for name, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                packed = encode(text.as_py()) + end
                names.append(name)
                sizes.append(len(packed) // len(end))
                ids.append(packed)
                n += sizes[-1]
                if n >= block_ids:
                    yield block()
                    start, names, sizes, ids, n = start + n, [], [], [], 0
        if names:
            yield block()
        there = np.flatnonzero(counts)
        columns = [*(pa.nulls(1, k) for k in kinds[:5]), pa.array([np.stack([there, counts[there]]).astype("<i8").tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "part_start", "doc_ids", "sizes", "ids", "counts"])

    return picked.repartitionByRange("id").sortWithinPartitions("id", "body").mapInArrow(run, _RAW.format(kind=kind))


def _counts(raw: DataFrame) -> DataFrame:
    """(id, n): how often each id occurs, from the ranges' counts; the ids themselves aren't read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for counts in b.column(0):
                ids, n = np.frombuffer(counts.as_py(), "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], names=["id", "n"])

    return raw.where("counts is not null").select("counts").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


@dataclass
class TokenFiles:
    """Where a dataset lies, its rank table (id by rank) and the number of ids before each part."""

    path: str
    id_of_rank: np.ndarray
    schema: str


def write(docs: DataFrame, tokenizer_path: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS) -> TokenFiles:
    """Tokenise ``docs`` and write the dataset; ``path`` defaults to a new one in the shared folder."""
    bound_batches(docs)
    spark = docs.sparkSession
    kind, of = kind_of(docs, id_col), encoder(tokenizer_path)[1]
    found = materialise(_raw_blocks(docs, tokenizer_path, id_col, text_col, block_ids), "raw-ids")
    raw = found.where("part is not null").drop("counts")
    # the vocabulary bounds both collected tables' sizes: its ids here, the shuffle partitions below
    ranked = [r.id for r in _counts(found).orderBy(F.desc("n"), "id").collect()]
    id_of_rank = np.array(ranked, np.uint32)
    rank_of_id = np.zeros(max(ranked, default=0) + 1, np.uint32)
    rank_of_id[id_of_rank] = np.arange(len(ranked), dtype=np.uint32)
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    totals, before, offset = raw.groupBy("part").agg(F.sum(size).alias("n")).orderBy("part").collect(), {}, 0
    for r in totals:
        before[r.part] = offset
        offset += r.n
    shared = spark.sparkContext.broadcast((rank_of_id, before))

    def recode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, offsets = shared.value
        for b in batches:
            start = [offsets[p] + s for p, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            packed = [pack(ranks[np.frombuffer(x.as_py(), of)]) for x in b.column(4)]
            columns = [b.column(0), pa.array(start, pa.int64()), b.column(2), b.column(3), *(pa.array([p[i] for p in packed], pa.binary()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "start", "doc_ids", "sizes", "control", "data"])

    path = path or new_path(spark, "token-files")
    schema = f"part int, start long, doc_ids array<{kind}>, sizes array<long>, control binary, data binary"
    raw.mapInArrow(recode, schema).write.parquet(path)
    return TokenFiles(path, id_of_rank, schema)


def read(spark: SparkSession, files: TokenFiles, id_col: str = "doc_id") -> DataFrame:
    """(id, start, ids): each document's packed little-endian uint32 ids and the number of ids before it."""
    shared = spark.sparkContext.broadcast(files.id_of_rank)
    blocks = spark.read.schema(files.schema).parquet(files.path).select("start", "doc_ids", "sizes", "control", "data")
    kind = kind_of(blocks, "doc_ids")[len("array<") : -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            for i in range(b.num_rows):
                sizes = np.array(b.column(2)[i].as_py(), np.int64)
                ends = np.cumsum(sizes)
                ids = table[unpack(b.column(3)[i].as_py(), b.column(4)[i].as_py(), int(sizes.sum()))].astype("<u4").tobytes()
                starts = ends - sizes
                packed = [ids[4 * s : 4 * e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [b.column(1)[i].values, pa.array(starts + b.column(0)[i].as_py(), pa.int64()), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "start", "ids"])

    return blocks.mapInArrow(run, f"`{id_col}` {kind}, start long, ids binary")
