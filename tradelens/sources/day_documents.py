"""A Spark data source of documents by key and day, over a transport.

An interface that is asked for a key (a coin, a trade direction) and a span of days becomes
``spark.read.format("day_documents")`` and ``spark.readStream.format("day_documents")`` with the
columns ``key``, ``file`` (where the document came from) and ``doc`` (its text).  Only the
transport runs in Python: documents are parsed, checked and loaded by built-in expressions
(``prices.checked_price_docs``, ``trades.parse_trade_docs``).

Options: ``keys`` (a JSON list), ``first`` and ``end`` (days, ``yyyy-mm-dd``; ``end`` is not
included) and ``days`` (days of one partition, 1 by default).  A partition is one key, one window
and one of the pieces into which the transport cuts it, so neither a long history nor a key that
holds most documents is one task.

As a stream, the offset is the first day not read yet.  A micro-batch takes all days that are
complete, as many tasks as a batch read would; a day is read once, so documents that come after
their day was read need a batch read.  ``end`` is optional there and bounds the stream.
"""

from __future__ import annotations

import datetime as dt
import json
import sys
from abc import ABC, abstractmethod
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "day_documents"
SCHEMA = "key string, file string, doc string"
# Bytes of the files that one task reads (a larger file is a piece of its own).
PIECE_BYTES = 128 * 1024 * 1024


class Transport(ABC):
    """Where documents come from.  It is sent to the tasks, so it holds settings only."""

    def pieces(self, key: str, first: dt.date, end: dt.date) -> list[str]:
        """The parts that tasks read on their own; asked for when the read is planned."""
        return [""]

    @abstractmethod
    def documents(self, key: str, first: dt.date, end: dt.date, piece: str) -> Iterator[tuple[str, str]]:
        """``(file, text)`` of the documents of a piece, one at a time."""

    def complete_until(self, keys: list[str]) -> dt.date | None:
        """The first day that may still get documents; None if there is no document."""
        raise NotImplementedError("this transport does not tell which days are complete")


class FolderTransport(Transport):
    """Documents landed under ``<root>/<key name>=<key>/day=<yyyy-mm-dd>/``, as ``land_by_day``
    writes them: one per line, or with ``whole`` one per file.

    A day is complete once a later day has a folder under any of the keys."""

    def __init__(self, root: str, key_name: str = "coin", whole: bool = False, piece_bytes: int = PIECE_BYTES):
        self.root, self.key_name, self.whole, self.piece_bytes = root, key_name, whole, piece_bytes

    def _store(self):
        from pyarrow import fs
        if self.root.startswith("file:"):
            return fs.LocalFileSystem(), "/" + self.root[len("file:"):].lstrip("/")
        return fs.FileSystem.from_uri(self.root) if "://" in self.root else (fs.LocalFileSystem(), self.root)

    def _listed(self, folder: str) -> list:
        from pyarrow import fs
        store, root = self._store()
        found = store.get_file_info(fs.FileSelector(f"{root}/{folder}", allow_not_found=True))
        return sorted((f for f in found if not f.base_name.startswith(("_", "."))), key=lambda f: f.path)

    def _folder(self, key: str) -> str:
        # Fixed value: the characters that Spark escapes in the names of partition folders.
        name = "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{[]^\x7f" or c < " " else c for c in key)
        return f"{self.key_name}={name}"

    def pieces(self, key, first, end):
        out, room = [], 0
        for i in range((end - first).days):
            for f in self._listed(f"{self._folder(key)}/day={first + dt.timedelta(days=i)}"):
                if not out or f.size > room:
                    out.append([])
                    room = self.piece_bytes
                out[-1].append(f.path)
                room -= f.size
        return [json.dumps(paths) for paths in out]

    def documents(self, key, first, end, piece):
        import io
        store, _ = self._store()
        for path in json.loads(piece):
            with io.TextIOWrapper(store.open_input_stream(path), encoding="utf-8", errors="replace", newline="\n") as text:
                docs = [text.read()] if self.whole else (line.rstrip("\r\n") for line in text)
                yield from ((path, doc) for doc in docs if doc.strip())

    def complete_until(self, keys):
        days = [f.base_name[len("day="):] for key in keys for f in self._listed(self._folder(key)) if f.base_name.startswith("day=")]
        days = [d for d in days if len(d) == 10 and d[4] == d[7] == "-" and d.replace("-", "").isdigit()]
        return dt.date.fromisoformat(max(days)) if days else None


# --------------------------------------------------------------------------- the source

@dataclass
class _Window(InputPartition):
    key: str
    first: dt.date
    end: dt.date
    piece: str


class _Request:
    """The options of a read, and the partitions of a span of days."""

    def __init__(self, transport: Transport, options):
        if "keys" not in options or "first" not in options:
            raise ValueError("the options keys (a JSON list) and first (a day) are needed")
        self.transport = transport
        self.keys = list(dict.fromkeys(json.loads(options["keys"])))
        self.first = dt.date.fromisoformat(options["first"])
        self.end = dt.date.fromisoformat(options["end"]) if "end" in options else None
        self.days = int(options.get("days", 1))
        if self.days < 1:
            raise ValueError("days must be at least 1")

    def windows(self, first: dt.date, end: dt.date) -> list[_Window]:
        out = []
        for at in range(0, (end - first).days, self.days):
            lo = first + dt.timedelta(days=at)
            hi = min(end, lo + dt.timedelta(days=self.days))
            out += [_Window(k, lo, hi, piece) for k in self.keys for piece in self.transport.pieces(k, lo, hi)]
        return out

    def rows(self, window: _Window) -> Iterator[tuple]:
        for file, doc in self.transport.documents(window.key, window.first, window.end, window.piece):
            yield window.key, file, doc


class _Reader(DataSourceReader):
    def __init__(self, request: _Request):
        if request.end is None:
            raise ValueError("the option end (a day, not included) is needed")
        self.request = request

    def partitions(self):
        return self.request.windows(self.request.first, self.request.end)

    def read(self, partition):
        # Without any window Spark asks for one partition, None.
        return self.request.rows(partition) if partition is not None else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, request: _Request):
        self.request = request

    def initialOffset(self):
        return {"day": self.request.first.isoformat()}

    def latestOffset(self):
        r = self.request
        until = r.transport.complete_until(r.keys) or r.first
        until = until if r.end is None else min(until, r.end)
        return {"day": max(until, r.first).isoformat()}

    def partitions(self, start, end):
        return self.request.windows(dt.date.fromisoformat(start["day"]), dt.date.fromisoformat(end["day"]))

    def read(self, partition):
        return self.request.rows(partition)


def register(spark: SparkSession, transport: Transport, name: str = FORMAT) -> str:
    """Make ``transport`` readable as format ``name`` in this session; returns the name."""

    class DayDocuments(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return SCHEMA

        def reader(self, schema):
            return _Reader(_Request(transport, self.options))

        def streamReader(self, schema):
            return _StreamReader(_Request(transport, self.options))

    # The workers need no installed package: this module's classes are sent along.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(DayDocuments)
    return name


def land_by_day(docs: DataFrame, root: str, key_name: str = "coin") -> None:
    """Append ``docs (key, day, doc)`` as lines under ``root/<key_name>=<key>/day=<day>/``."""
    rows = docs.select(F.col("key").alias(key_name), F.col("day").cast("date").alias("day"), "doc")
    rows.write.mode("append").partitionBy(key_name, "day").text(root)
