import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from pixelloom.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    ranks = bpe.load_ranks(PATH)
    return bpe.codec(PATH, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def agree(both, text):
    import numpy as np

    own, public = both
    ids = own.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == public.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


def test_every_token_and_plain_cases(both):
    for token in list(both[0].ranks)[::7]:
        agree(both, token.decode("utf-8", "ignore"))
    for text in ("", " ", "   a", "it's we'll\n\n\tx  ", "\x1c\x1d a\x85b c　", "<unk> <s> ▁", "é" * 5000, "a" * 30_000, "\U0001f600" * 9):
        agree(both, text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_random_texts(both, text):
    agree(both, text)


def test_query_defined_cases(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "same", "z"), (3, "same", "z")], "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(df, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert sorted((r.doc_id, bytes(r.decoded)) for r in out) == [(1, b""), (2, b""), (3, b"same"), (3, b"same")]
    assert sorted(map(tuple, out)) == sorted(map(tuple, bpe.round_trip(df, PATH, P.PATTERN).collect()))
    assert bpe.encode(df.limit(0), PATH, P.PATTERN).count() == bpe.round_trip(df.limit(0), PATH, P.PATTERN).count() == 0
