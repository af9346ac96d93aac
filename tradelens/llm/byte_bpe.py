"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Every match of the split pattern is encoded on its own.  A long text is first cut where a
white-space character follows a character that is none: no match of the pattern can span
such a point, so the ids of the pieces, joined, are those of the whole text, and the memory
and time of one library call stay bounded by the longest stretch without a boundary.  A very
long run of white space, which the library's matcher can't walk, is by the pattern one match
(without its last character if something follows) and is merged as one piece.

Texts: null counts as empty (no ids).  Rows are handled one by one, so repeated rows, ties
and null ids need no rule; other columns are passed through untouched.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_process

PIECE_CHARS = 50_000

# The characters that ``\s`` of the split pattern matches.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = re.compile(f"[{WHITE_SPACE}]{{10000,}}")


def load_ranks(path: str) -> bytes:
    """The rank file's bytes, read once on the driver (a vocabulary: its size is fixed)."""
    with open(path, "rb") as f:
        return f.read()


def make_encoding(ranks: bytes, pattern: str):
    """A tiktoken encoding without special tokens from rank-file bytes."""
    import tiktoken
    table = {base64.b64decode(token): int(rank) for token, rank in
             (line.split() for line in ranks.splitlines() if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def pieces(text: str, limit: int = PIECE_CHARS):
    """Cut a text at safe boundaries into pieces of about ``limit`` characters.

    A boundary lies before a space or line feed that follows a character which is not white
    space.  A piece grows past the limit until the next boundary.
    """
    start, n = 0, len(text)
    while n - start > limit:
        cut = start + limit
        while True:
            spots = [p for p in (text.find(" ", cut), text.find("\n", cut)) if p >= 0]
            cut = min(spots, default=n)
            if cut >= n or not text[cut - 1].isspace():
                break
            cut += 1
        yield text[start:cut]
        start = cut
    if start < n:
        yield text[start:]


class Coder:
    """Encodes and decodes texts of any length."""

    def __init__(self, ranks: bytes, pattern: str, limit: int = PIECE_CHARS):
        self.encoding = make_encoding(ranks, pattern)
        self.limit = limit

    def _long(self, text: str) -> list[int]:
        ids: list[int] = []
        at = 0
        for run in LONG_RUN.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            for piece in pieces(text[at:run.start()], self.limit):
                ids.extend(self.encoding.encode_ordinary(piece))
            ids.extend(self.encoding._encode_single_piece(text[run.start():end].encode("utf-8")))
            at = end
        for piece in pieces(text[at:], self.limit):
            ids.extend(self.encoding.encode_ordinary(piece))
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        ids = self.encoding.encode_ordinary(text) if len(text) < 10_000 else self._long(text)
        return np.array(ids, "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return self.encoding.decode_bytes(ids.tolist())


def bpe_ids(text: Column, ranks: bytes, pattern: str) -> Column:
    """The ids of a text column, as an array of ints."""
    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = per_process(("bpe", zlib.crc32(ranks), pattern), lambda: Coder(ranks, pattern))
        for texts in batches:
            yield pd.Series([coder.encode(t).astype("int32") for t in texts], index=texts.index, dtype=object)

    return run(text)


def bpe_bytes(ids: Column, ranks: bytes, pattern: str) -> Column:
    """The raw bytes that an array of ids stands for (null: empty)."""
    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = per_process(("bpe", zlib.crc32(ranks), pattern), lambda: Coder(ranks, pattern))
        for arrays in batches:
            yield pd.Series([b"" if a is None else coder.decode(np.asarray(a)) for a in arrays],
                            index=arrays.index, dtype=object)

    return run(ids)


def bpe_round_trip(text: Column, ranks: bytes, pattern: str) -> Column:
    """Digests of encoding and decoding back: ``struct<n_tokens, ids_sha256, decoded_sha256>``.

    ``ids_sha256`` covers the ids as little-endian unsigned 32-bit integers.
    """
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = per_process(("bpe", zlib.crc32(ranks), pattern), lambda: Coder(ranks, pattern))
        for texts in batches:
            rows = []
            for t in texts:
                ids = coder.encode(t)
                rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                             hashlib.sha256(coder.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"], index=texts.index)

    return run(text)


def bpe_checked_ids(text: Column, ranks: bytes, pattern: str) -> Column:
    """``struct<ids, round_trip>``: the ids, and whether they decode back to the text's bytes.

    Both directions run in one worker per task; ``bpe_bytes`` over ``bpe_ids`` takes two."""
    @F.pandas_udf("ids array<int>, round_trip boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = per_process(("bpe", zlib.crc32(ranks), pattern), lambda: Coder(ranks, pattern))
        for texts in batches:
            ids = [coder.encode(t) for t in texts]
            same = [coder.decode(i) == (t or "").encode("utf-8") for i, t in zip(ids, texts, strict=True)]
            yield pd.DataFrame({"ids": pd.Series([i.astype("int32") for i in ids], index=texts.index, dtype=object),
                                "round_trip": pd.Series(same, index=texts.index, dtype=bool)})

    return run(text)


def encode_documents(docs: DataFrame, ranks: bytes, pattern: str, text_col: str = "text",
                     out_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text_col`` in ``out_col`` (which it replaces if present)."""
    return docs.withColumn(out_col, bpe_ids(F.col(text_col), ranks, pattern))


def decode_documents(docs: DataFrame, ranks: bytes, pattern: str, ids_col: str = "ids",
                     out_col: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of ``ids_col`` in ``out_col``."""
    return docs.withColumn(out_col, bpe_bytes(F.col(ids_col), ranks, pattern))
