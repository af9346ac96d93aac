import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard as zstd
from tokenizers import Tokenizer

from tradelens.llm import bitplane as BIT
from tradelens.llm import queries as Q
from tradelens.llm import warc as W

VOCAB = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
TEXTS = ["Hello, World!  It's 12 o'clock.", "", None, "a\tb c d", "line one\nline  two\n\n", " \n ", "é ́x",
         "<|endoftext|> <|startoftext|>", "mixed\x1cseparators\x85here", "ÉCOLE straße İstanbul", "long " * 3000, "x" * 5000,
         "don't can't we'll I'm", "Ab.c d__ e-f g!! h'! 'i j' ÀÉ. ﬁn ǅ ŉ ΑΣ. e\u0301x q\u0307. naïve%%% ß, x² ½ a\u0338= <b> i\u0307", "日本語のテキスト です", "\r\n tabs\t\tand\rcr"]


def test_words_equal_whole_texts():
    whole = Tokenizer.from_str(VOCAB)
    whole.encode_special_tokens = True
    words = BIT.Words(VOCAB, memory=20)
    for _ in range(2):
        for text, got in zip(TEXTS, words.encode(TEXTS), strict=True):
            want = whole.encode(text or "", add_special_tokens=False).ids
            assert np.frombuffer(got, "<u4").tolist() == want, repr(text)
    assert words.direct
    import random
    rng = random.Random(4)
    parts = ["a", "Zb", "é", "É", "İ", "ß", ".", ",", "'", "'s", "!!", "_", "-", "1", "\u0301", "ﬁ", "日", "\x1c", "\xa0", "²", "<"]
    for _ in range(3000):
        word = "".join(rng.choice(parts) for _ in range(rng.randint(1, 5)))
        want = whole.encode(word, add_special_tokens=False).ids
        assert np.frombuffer(words.encode([word])[0], "<u4").tolist() == want, repr(word)


def test_words_equal_the_library_with_default_settings():
    whole = Tokenizer.from_str(VOCAB)
    texts = [*TEXTS, "end <|endoftext|> of", "a<|endoftext|>b", "x.<|startoftext|>, y", "<|endoftext|", "two <|endoftext|><|endoftext|>\n.",
             "<|EndOfText|>", "<|endoftext|>."]
    for text, got in zip(texts, BIT.Words(VOCAB, special=True).encode(texts), strict=True):
        want = whole.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(got, "<u4").tolist() == want, repr(text)


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_format_round_trip_and_random_access(kind):
    rng = np.random.default_rng(1)
    arrays = [rng.integers(0, 2**32, n, dtype=np.uint64).astype("<u4") for n in (0, 1, 7, 100, 1000)]
    arrays.append(np.full(333, 2, "<u4"))
    ids = [None, 1, 2, 2, 5, 9]
    data = b"".join(BIT.encode_file(ids, arrays, kind, block_ids=64))
    back = list(BIT.decode_file(data))
    assert [d for d, _ in back] == ids and all(np.array_equal(a, b) for a, (_, b) in zip(arrays, back, strict=True))
    index = BIT.read_index(data)
    flat = np.concatenate(arrays)
    assert np.array_equal(BIT.read_block(data, index, 3), flat[3 * 64:4 * 64])
    with pytest.raises(ValueError):
        BIT.read_index(data[:-1])


def test_planes_query_against_whole_texts(spark, tmp_path):
    rows = [(i * 3 % 17, t, 7) for i, t in enumerate(TEXTS)] + [(None, "null id", 7), (4, TEXTS[0], 7), (4, TEXTS[0], 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    whole = Tokenizer.from_str(VOCAB)
    whole.encode_special_tokens = True
    got = sorted(Q.token_planes(spark, df, file_ids=700).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    at = 0
    want = {}
    for i, t, _ in rows:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        at += r.n_tokens
    assert Q.token_planes(spark, df.limit(0)).count() == 0


def test_registered_query_codes_special_tokens_as_the_library_does(spark, tmp_path):
    texts = ["end <|endoftext|> of", "plain words"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    whole = Tokenizer.from_str(VOCAB)
    got = {r.doc_id: r.ids_crc32 for r in Q.q_token_planes(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        ids = np.array([*whole.encode(t, add_special_tokens=False).ids, 2], "<u4")
        assert got[i] == zlib.crc32(ids.tobytes())


def test_a_lost_or_replaced_file_raises(spark, tmp_path):
    df = spark.createDataFrame([(i, f"some words {i}") for i in range(40)], "doc_id long, text string")
    folder = str(tmp_path / "planes")
    written = BIT.write_planes(df, folder, VOCAB, 2, file_ids=30)
    read = BIT.read_planes(BIT.open_planes(spark, folder))
    assert written.count() > 3 and BIT.document_ranges(written, read).count() == 40
    one = written.orderBy("shard", "file").first()
    for changed in (read.where(f"NOT (shard = {one.shard} AND file = {one.file})"),
                    read.where(f"NOT (shard = {one.shard} AND file = {one.file} AND doc = 0)"),
                    read.unionByName(read.where(f"file = {one.file}").selectExpr("shard", "file + 1000 AS file", "doc", "id", "ids"))):
        with pytest.raises(ValueError):
            BIT.document_ranges(written, changed)


def pages_brute(rows):
    best = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= 1000 and i is not None:
            best[p] = max(best.get(p, i), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        r = best.get(p) if sum((x[2] or "").encode() == p for x in rows) > 1 else None
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "response" if r is None or r == i else "revisit",
                    None if r is None or r == i else r))
    return sorted(out, key=str)


def test_warc_query_against_brute_force(spark):
    big, long = "é" * 600, "<p>x</p>\r\n\r\n" * 40_000
    rows = [(1, "http://a/", big), (2, "http://b/\n", big), (3, None, big), (4, "u", None), (5, "u", ""), (6, "u", "small"),
            (7, "u", "small"), (8, "u", long), (None, "u", long), (None, "u", "n" * 2000), (9, "u", "k" * 1000), (9, "u", "k" * 1000)]
    rows += [(100 + i, f"http://x/{i}", f"<html>{i} {'word ' * 300}</html>") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in Q.warc_digest(spark, df).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    assert got == pages_brute(rows)
    assert Q.warc_digest(spark, df.limit(0)).count() == 0


def test_archive_reader_rejects_bad_input():
    records = [W.build_record(i, "u", b"payload %d " % i * 50) for i in range(40)]
    dictionary = W.train_dictionary(records)
    data = b"".join(W.encode_archive(records, dictionary))
    assert dictionary and [b for _, b in W.read_archive(data)] == [b"payload %d " % i * 50 for i in range(40)]
    packed = zstd.ZstdCompressor().compress(dictionary)  # the dictionary may itself be compressed
    other = W.dictionary_frame(packed) + data[8 + len(dictionary):]
    assert len(list(W.read_archive(other))) == 40
    assert len(list(W.read_archive(b"".join(zstd.ZstdCompressor().compress(r) for r in records)))) == 40
    for bad in (data[:-3], data[:6], data + b"junk"):
        with pytest.raises(ValueError):
            list(W.read_archive(bad))
    good = W.build_record(1, "u", b"abc")
    for bad in (good[:-1], good.replace(b"abc", b"abd"), good.replace(b"Content-Length: 3", b"Content-Length: x"),
                good.replace(b"WARC-Date", b"X-Date"), good.replace(b"WARC/1.1", b"WARC/0.9"), good.replace(b"WARC-Type: r", b"WARC-Type: q")):
        with pytest.raises(ValueError):
            W.parse_record(bad)
