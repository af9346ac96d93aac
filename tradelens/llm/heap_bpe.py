"""BPE encoding and decoding: a priority queue of merge ranks over a doubly linked symbol list.

A text is cut where an added token stands in it (leftmost, then longest), the rest is split
by the byte-level pattern, and every match is merged on its own: its bytes become a doubly
linked list of symbols, the ranks of all neighbouring pairs go into a priority queue with
their places, and the pair of the lowest rank, leftmost among equals, is merged until the
queue is empty.  Merging unlinks the right symbol and queues the two pairs it creates; entries
whose pair is gone by the time they are taken are stale and are skipped.  A match of n bytes
takes O(n log n) steps, however long it is.  Decoding concatenates the vocabulary's strings
and turns their letters back into bytes.

Words come again, so a worker process remembers the ids of ``WORD_MEMORY`` words and then
starts over; words longer than ``LONG_WORD`` are merged each time.  Long texts are matched
piece by piece between safe boundaries, so memory follows the piece and the ids, not the
number of words of a text.

Texts: null counts as empty (no ids).  Rows are handled one by one, so repeated rows, ties
and null ids need no rule; other columns are passed through untouched, a column of the output's
name is replaced.  Bytes that are not whole characters decode to U+FFFD; an id outside the
vocabulary raises.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .byte_bpe import pieces
from .common import per_process

#: Words whose ids a worker process remembers, and the characters above which it does not.
WORD_MEMORY = 300_000
LONG_WORD = 64
PIECE_CHARS = 50_000

# Fixed value: the split pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_vocabulary(path: str) -> str:
    """The tokenizer file's text, read once on the driver (a vocabulary: its size is fixed)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def byte_letters() -> list[str]:
    """The letter for each byte: printable Latin-1 bytes stand for themselves, the others for
    the code points from 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    extra = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(extra)) for b in range(256)]


class HeapBpe:
    """Encodes and decodes texts of any length by a tokenizer file's vocabulary and merges.

    Only for byte-level vocabularies without normalizer, dropout or prefix space, and added
    tokens that stand for their plain text; anything else raises.
    """

    def __init__(self, vocabulary: str, memory: int = WORD_MEMORY, piece_chars: int = PIECE_CHARS):
        import regex
        spec = json.loads(vocabulary)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = (spec["normalizer"] is None and before["type"] == "ByteLevel" and before["use_regex"]
                 and not before["add_prefix_space"] and not model.get("dropout") and not model.get("ignore_merges")
                 and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]))
        if model["type"] != "BPE" or not plain:
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        ids = model["vocab"]
        letters = byte_letters()
        self.byte_ids = [ids[c] for c in letters]
        # (left, right) -> (rank, merged id), keyed by one number.
        self.width = max(ids.values()) + 1
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[left] * self.width + ids[right]] = (rank, ids[left + right])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        to_byte = {c: b for b, c in enumerate(letters)}
        self.strings = {i: bytes(to_byte[c] for c in token) for token, i in ids.items()}
        self.strings.update({i: token.encode("utf-8") for token, i in self.added.items()})
        self.match = regex.compile(PATTERN).findall
        self.memory, self.piece_chars = memory, piece_chars
        self.known: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        merges, width = self.merges, self.width
        symbol = [self.byte_ids[b] for b in word]
        n = len(symbol)
        after = list(range(1, n + 1))     # n: none
        before = list(range(-1, n - 1))   # -1: none
        # One number per entry orders by rank, then place.
        queue = []
        for at in range(n - 1):
            found = merges.get(symbol[at] * width + symbol[at + 1])
            if found:
                queue.append(found[0] << 40 | at)
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            at = entry & 0xFFFFFFFFFF
            right = after[at]
            if symbol[at] < 0 or right == n:
                continue
            found = merges.get(symbol[at] * width + symbol[right])
            if not found or found[0] != entry >> 40:
                continue
            symbol[at], symbol[right] = found[1], -1
            end = after[at] = after[right]
            if end < n:
                before[end] = at
                found = merges.get(symbol[at] * width + symbol[end])
                if found:
                    heapq.heappush(queue, found[0] << 40 | at)
            left = before[at]
            if left >= 0:
                found = merges.get(symbol[left] * width + symbol[at])
                if found:
                    heapq.heappush(queue, found[0] << 40 | left)
        return [s for s in symbol if s >= 0]

    def _word(self, word: str) -> bytes:
        ids = array("I", self.merge(word.encode("utf-8"))).tobytes()
        if len(word) <= LONG_WORD:
            if len(self.known) >= self.memory:
                self.known.clear()
            self.known[word] = ids
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        out = []
        for part in self.cut.split(text or "") if self.cut else [text or ""]:
            if part in self.added:
                out.append(array("I", [self.added[part]]).tobytes())
                continue
            for piece in pieces(part, self.piece_chars):
                known = self.known.get
                out.append(b"".join([known(w) or self._word(w) for w in self.match(piece)]))
        return np.frombuffer(b"".join(out), np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        strings = self.strings
        return b"".join([strings[i] for i in ids.tolist()]).decode("utf-8", errors="replace")


def _coder(vocabulary: str) -> HeapBpe:
    return per_process(("heap-bpe", zlib.crc32(vocabulary.encode())), lambda: HeapBpe(vocabulary))


def heap_ids(text: Column, vocabulary: str) -> Column:
    """The ids of a text column, as an array of ints."""
    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = _coder(vocabulary)
        for texts in batches:
            yield pd.Series([coder.encode(t).astype("int32") for t in texts], index=texts.index, dtype=object)

    return run(text)


def heap_text(ids: Column, vocabulary: str) -> Column:
    """The text that an array of ids stands for (null: empty)."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = _coder(vocabulary)
        for arrays in batches:
            yield pd.Series(["" if a is None else coder.decode(np.asarray(a)) for a in arrays],
                            index=arrays.index, dtype=object)

    return run(ids)


def heap_round_trip(text: Column, vocabulary: str) -> Column:
    """Digests of encoding and decoding back: ``struct<n_tokens, ids_sha256, decoded_sha256>``.

    ``ids_sha256`` covers the decimal ids joined by commas, ``decoded_sha256`` the decoded text
    in UTF-8.
    """
    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = _coder(vocabulary)
        decimal = [str(i) for i in range(max(coder.strings) + 1)]
        for texts in batches:
            rows = []
            for t in texts:
                ids = coder.encode(t)
                listed = ",".join([decimal[i] for i in ids.tolist()])
                rows.append((len(ids), hashlib.sha256(listed.encode()).hexdigest(),
                             hashlib.sha256(coder.decode(ids).encode("utf-8")).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"], index=texts.index)

    return run(text)


def encode_documents(docs: DataFrame, vocabulary: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text_col`` in ``out_col``."""
    return docs.withColumn(out_col, heap_ids(F.col(text_col), vocabulary))


def decode_documents(docs: DataFrame, vocabulary: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids_col`` in ``out_col``."""
    return docs.withColumn(out_col, heap_text(F.col(ids_col), vocabulary))
