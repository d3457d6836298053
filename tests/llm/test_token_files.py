import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pixelloom.llm import token_files as T

PATH = P.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300)))
def test_pack_round_trip(values):
    control, data = T.pack(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert T.unpack(control, data, len(values)).tolist() == values


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab 'sé1\n\t 　\x1c\x85!ß中")) | st.characters(exclude_categories=["Cs"]), max_size=60))
def test_encoder_equals_library(text):
    encode, kind = T.encoder(PATH)
    assert np.frombuffer(encode(text), kind).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_files_read_back(spark):
    texts = [None, "", "one two  three", "a<|endoftext|>b", "x" * 9000, "Déjà vu, it's\n\nso. " * 400, "same", "same"]
    rows = [(7 * i % 40, t, "clash") for i, t in enumerate(texts * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(4)
    want, at = [], 0
    for i, t, _ in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1])):
        ids = np.array(LIBRARY.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    for block in (50, T.BLOCK_IDS):
        files = T.write(df, PATH, block_ids=block)
        got = sorted((r.doc_id, r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in T.read(spark, files).collect())
        assert got == sorted(want)
        starts = [(r.start, r.doc_ids) for r in spark.read.schema(files.schema).parquet(files.path).orderBy("start").collect()]
        assert [d for _, ds in starts for d in ds] == [w[0] for w in want]
    assert T.read(spark, T.write(df.limit(0), PATH)).count() == 0
