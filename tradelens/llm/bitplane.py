"""Token-id files: fixed-size id blocks as bit or byte planes, each compressed with zstandard.

A file holds whole documents in ascending id order.  Layout (little-endian):

* ``MAGIC`` (8 bytes);
* per block of ``block_ids`` ids (the last may be shorter): its planes, one zstandard frame
  each.  A block of n unsigned 32-bit ids is transposed into 32 bit planes (plane j packs bit
  j of every id) or 4 byte planes (plane j holds byte j of every id); planes of zeros alone
  are not stored (length 0);
* one zstandard frame of the chunk index: a JSON object with the kind of planes, the block
  size, the number of ids, the offset and plane lengths of every block, and the documents'
  ids and lengths;
* the index frame's length (8 bytes) and ``MAGIC`` again.

The block index gives random access: a block is read from its offset alone.

Documents: a null text is an empty one; the end id is appended to every document.  Files are
ordered by document id, null ids first; rows of one id are ordered by a hash of their texts,
and rows that agree in both are interchangeable.  An empty table gives no file and no row.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_process, read_files, stored, write_file

MAGIC = b"TLPLANE1"
BLOCK_IDS = 65_536
LEVEL = 3
SUFFIX = ".planes"
#: Ids in one file, about; a file is read by one task.
FILE_IDS = 4_000_000
#: Distinct words whose ids a task remembers before it starts over.
WORD_MEMORY = 400_000
# Letters, then ASCII punctuation without the apostrophe (it begins contractions).
PLAIN_WORD = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")
# Letters whose lower case Python and a lower-casing normalizer agree on, and which are in NFC.
LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")


# --------------------------------------------------------------------------- the format

def _planes(ids: np.ndarray, kind: str) -> list[bytes]:
    data = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [np.ascontiguousarray(data[:, j]).tobytes() for j in range(4)]
    bits = np.unpackbits(data, axis=1, bitorder="little")
    return [np.packbits(bits[:, j], bitorder="little").tobytes() for j in range(32)]


def _from_planes(planes: list[bytes | None], n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        data = np.zeros((n, 4), np.uint8)
        for j, plane in enumerate(planes):
            if plane is not None:
                data[:, j] = np.frombuffer(plane, np.uint8)
    else:
        bits = np.zeros((n, 32), np.uint8)
        for j, plane in enumerate(planes):
            if plane is not None:
                bits[:, j] = np.unpackbits(np.frombuffer(plane, np.uint8), bitorder="little")[:n]
        data = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(data).view("<u4").reshape(-1)


def encode_file(doc_ids: list, arrays: list[np.ndarray], kind: str = "byte", block_ids: int = BLOCK_IDS,
                level: int = LEVEL) -> Iterator[bytes]:
    """The parts of a file holding the given documents, in their order."""
    import zstandard as zstd
    if kind not in ("bit", "byte"):
        raise ValueError("kind must be bit or byte")
    coder = zstd.ZstdCompressor(level=level)
    ids = np.concatenate(arrays) if arrays else np.empty(0, "<u4")
    yield MAGIC
    at, blocks = len(MAGIC), []
    for start in range(0, len(ids), block_ids):
        frames = [coder.compress(p) if any(p) else b"" for p in _planes(ids[start:start + block_ids], kind)]
        blocks.append([at, [len(f) for f in frames]])
        for f in frames:
            yield f
            at += len(f)
    index = {"kind": kind, "block_ids": block_ids, "n_ids": len(ids), "blocks": blocks,
             "doc_ids": doc_ids, "lengths": [len(a) for a in arrays]}
    frame = coder.compress(json.dumps(index).encode("utf-8"))
    yield frame
    yield len(frame).to_bytes(8, "little")
    yield MAGIC


def read_index(data: bytes) -> dict:
    import zstandard as zstd
    if len(data) < 24 or data[:8] != MAGIC or data[-8:] != MAGIC:
        raise ValueError("not a whole plane file")
    n = int.from_bytes(data[-16:-8], "little")
    return json.loads(zstd.ZstdDecompressor().decompress(data[-16 - n:-16]))


def read_block(data: bytes, index: dict, block: int) -> np.ndarray:
    """The ids of one block, from its own bytes."""
    import zstandard as zstd
    coder = zstd.ZstdDecompressor()
    at, lengths = index["blocks"][block]
    n = min(index["block_ids"], index["n_ids"] - block * index["block_ids"])
    planes = []
    for size in lengths:
        planes.append(coder.decompress(data[at:at + size]) if size else None)
        at += size
    return _from_planes(planes, n, index["kind"])


def decode_file(data: bytes) -> Iterator[tuple[object, np.ndarray]]:
    """``(document id, ids)`` of every document of a file."""
    index = read_index(data)
    if sum(index["lengths"]) != index["n_ids"]:
        raise ValueError("the documents' lengths do not add up to the file's ids")
    ids = [read_block(data, index, b) for b in range(len(index["blocks"]))]
    flat = np.concatenate(ids) if ids else np.empty(0, "<u4")
    at = 0
    for doc, n in zip(index["doc_ids"], index["lengths"], strict=True):
        yield doc, flat[at:at + n]
        at += n


# --------------------------------------------------------------------------- tokenizing

def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 bytes
    for themselves, the others for the code points from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words:
    """Whole-text ids with the tokenizers library, remembering the ids of words.

    Only for vocabularies whose pre-tokenizer never joins what a blank or a line feed parts
    and drops that white space: the text's ids are then those of its words, joined.

    Most words are letters, perhaps with punctuation behind them.  Where the vocabulary parts
    the two, letters are handed to the library's normalizer and merge model directly, which
    spares its matcher; whether it does is tried out on ``PROBES`` first.

    ``special``: the text of a special token, such as ``<|endoftext|>``, becomes that token, as
    the library does by default; otherwise it is coded as ordinary text.
    """

    PROBES = ("ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞß", "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ", "thing", "Thing.", "über,", "ÉCOLE!!", "İstanbul", "naïve%%%", "日本語", "ab_", "Σίσυφος", "ﬁn;", "x")

    def __init__(self, vocabulary: str, memory: int = WORD_MEMORY, special: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = not special
        self.memory = memory
        self.known: dict[str, bytes] = {}
        self.letters: dict[str, bytes] = {}
        self.bytes = _byte_letters()
        self.direct = True
        self.direct = all(self._direct(w) in (None, self._whole([w])[0]) for w in self.PROBES)

    def _whole(self, words: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in done]

    def _letters(self, low: str) -> bytes:
        known = self.letters.get(low)
        if known is None:
            text = low if low.isascii() else "".join(self.bytes[b] for b in low.encode("utf-8"))
            if len(self.letters) >= self.memory:
                self.letters.clear()
            known = self.letters[low] = array("I", [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()
        return known

    def _direct(self, word: str) -> bytes | None:
        """The ids of letters and trailing punctuation; None for any other word."""
        m = PLAIN_WORD.fullmatch(word) if self.direct else None
        if not m:
            return None
        word, tail = m.groups()
        if LATIN.fullmatch(word):
            low = word.lower()
        else:
            low = self.tokenizer.normalizer.normalize_str(word)
            if not low.isalpha():
                return None
        ids = self._letters(low)
        return ids + (self.known.get(tail) or self._new(tail)) if tail else ids

    def _new(self, word: str) -> bytes:
        """The ids of a word that is not remembered."""
        ids = self._direct(word)
        if ids is None:
            ids = self._whole([word])[0]
        if len(self.known) >= self.memory:
            self.known.clear()
        self.known[word] = ids
        return ids

    def encode(self, texts: list[str | None]) -> list[bytes]:
        known, new = self.known.get, self._new
        return [b"".join([known(w) or new(w) for w in t.replace("\n", " ").split(" ") if w]) if t else b"" for t in texts]


def tokenized(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, rows_at_once: int = 256,
              special: bool = False) -> Iterator[tuple[object, bytes]]:
    """``(id, ids)`` of ``(id, text)`` batches: the document's ids and the end id, as bytes."""
    words = per_process(("words", zlib.crc32(vocabulary.encode()), special), lambda: Words(vocabulary, special=special))
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        for at in range(0, batch.num_rows, rows_at_once):
            part = batch.slice(at, rows_at_once)
            ids = words.encode(part.column(1).to_pylist())
            yield from zip(part.column(0).to_pylist(), (x + end for x in ids), strict=True)


# --------------------------------------------------------------------------- files on a cluster

def write_planes(docs: DataFrame, folder: str, vocabulary: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", kind: str = "byte", file_ids: int = FILE_IDS,
                 block_ids: int = BLOCK_IDS, special: bool = False) -> DataFrame:
    """Tokenize ``docs`` and write them in ascending id order; ``(shard, file, docs, n_ids)``.

    The texts are dealt by ranges of document ids and sorted, then each task tokenizes and
    writes its own range, so no file depends on another; a range of more than ``file_ids`` ids
    becomes several files.  Shard and file numbers follow the order.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // (3 * file_ids)))  # an id stands for about three bytes
    ordered = rows.repartitionByRange(parts, F.col("id"), F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard = TaskContext.get().partitionId()
        out, ids, arrays, size = [], [], [], 0

        def close():
            nonlocal ids, arrays, size
            name = f"part-{shard:06d}-{len(out):06d}{SUFFIX}"
            write_file(folder, name, encode_file(ids, arrays, kind, block_ids))
            out.append((shard, len(out), len(ids), size))
            ids, arrays, size = [], [], 0

        for doc, data in tokenized(batches, vocabulary, end_id, special=special):
            ids.append(doc)
            arrays.append(np.frombuffer(data, "<u4"))
            size += len(data) // 4
            if size >= file_ids:
                close()
        if ids:
            close()
        cols = [pa.array([r[i] for r in out], pa.int64()) for i in range(4)]
        yield pa.RecordBatch.from_arrays(cols, ["shard", "file", "docs", "n_ids"])

    return stored(ordered.mapInArrow(run, "shard long, file long, docs long, n_ids long"), "planes-written")


def read_planes(files: DataFrame, id_type: str = "long") -> DataFrame:
    """``(shard, file, doc, id, ids)`` of every document of the files (``path, content``);
    ``doc`` is its place in the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard, file = (int(x) for x in path.rpartition("/")[2].removesuffix(SUFFIX).split("-")[1:])
                docs = list(decode_file(data.as_py()))
                for at in range(0, len(docs), 1_000):
                    some = docs[at:at + 1_000]
                    yield pa.RecordBatch.from_pydict({
                        "shard": [shard] * len(some), "file": [file] * len(some),
                        "doc": list(range(at, at + len(some))), "id": [d for d, _ in some],
                        "ids": [a.tobytes() for _, a in some]}, schema=schema)

    schema = pa.schema([("shard", pa.int64()), ("file", pa.int64()), ("doc", pa.int64()),
                        ("id", pa.int64() if id_type == "long" else pa.string()), ("ids", pa.binary())])
    return files.mapInArrow(run, f"shard long, file long, doc long, id {id_type}, ids binary")


def document_ranges(written: DataFrame, docs: DataFrame) -> DataFrame:
    """``(id, start, n_tokens, ids_crc32)``: every document's place in the whole sequence.

    ``docs`` are the documents read back: the ids before a file are summed over the files that
    were read, those before a document within its file.  ``written``, the writer's row per
    file, must name the same files with as many documents and ids: a lost, replaced or extra
    file raises.
    """
    from pyspark.sql import Window
    narrow = stored(docs.select("shard", "file", "doc", "id", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                                F.crc32("ids").alias("ids_crc32")), "planes-read")
    files = narrow.groupBy("shard", "file").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("n_ids"))
    both = files.withColumn("read", F.lit(1)).unionByName(written.select(*files.columns).withColumn("read", F.lit(-1)))
    bad = both.groupBy(*files.columns).agg(F.sum("read").alias("read")).where("read != 0").orderBy("shard", "file").take(3)
    if bad:
        raise ValueError(f"the files read back are not those written: {bad}")
    before = Window.orderBy("shard", "file").rowsBetween(Window.unboundedPreceding, -1)
    base = files.select("shard", "file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("shard", "file").orderBy("doc").rowsBetween(Window.unboundedPreceding, -1)
    placed = narrow.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    return placed.join(base, ["shard", "file"]).select(
        "id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def open_planes(spark, folder: str) -> DataFrame:
    return read_files(spark, folder, SUFFIX)
