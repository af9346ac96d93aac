import hashlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st

from tradelens.llm import byte_bpe as B

RANKS = B.load_ranks(P.path("byte_bpe_50k.tiktoken"))
CODER = B.Coder(RANKS, P.PATTERN, limit=7)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "Bc", " ", "  ", "\n", "\t", "'s", "é", "1", "22", "!", "\x1c", "\x85", "　", "日", "'"])).map("".join))
def test_cut_texts_give_the_ids_of_whole_texts(text):
    whole = CODER.encoding.encode_ordinary(text)
    assert CODER._long(text) == whole
    assert "".join(B.pieces(text, 3)) == text
    assert CODER.decode(np.array(whole, "<u4")) == text.encode()


def test_very_long_texts():
    coder = B.Coder(RANKS, P.PATTERN)
    for text in ("ab cd\n" * 60_000, "x" * 300_000, " " * 150_000 + "a", "a" + "\n" * 30_000, "1" * 100_000 + " end"):
        assert coder.encode(text).tolist() == coder.encoding.encode_ordinary(text)
    for text in (" \n" * 2_000_000 + "z", "a" + " " * 3_000_000):  # the library's matcher fails on these whole
        assert coder.decode(coder.encode(text)) == text.encode()


def test_columns(spark):
    rows = [(1, "Hello world"), (2, None), (2, ""), (None, "naïve café 日本"), (1, "Hello world")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, ids int")
    done = B.decode_documents(B.encode_documents(df, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in done) == sorted((t or "").encode() for _, t in rows)
    checked = df.select("text", B.bpe_checked_ids(df.text, RANKS, P.PATTERN).alias("c")).collect()
    assert all(r.c.round_trip and r.c.ids == CODER.encoding.encode_ordinary(r.text or "") for r in checked)
    got = df.select("text", B.bpe_round_trip(df.text, RANKS, P.PATTERN).alias("d")).select("text", "d.*").collect()
    for r in got:
        ids = np.array(CODER.encoding.encode_ordinary(r.text or ""), "<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    assert df.limit(0).select(B.bpe_round_trip(df.text, RANKS, P.PATTERN)).count() == 0
