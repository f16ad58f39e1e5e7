"""Growing JSON lines as a data source: what was read stays read, what is appended is read alone.

An offset names each file with the bytes that were read of it (always up to the end of a line, so a line that is still being written waits) and
digests of the first and the last ``EDGE`` bytes of that part. A file that grew is read from there; one that shrank, or whose
edges are others, is read from its beginning. So an append of n bytes costs n bytes and the edges. A change in the middle of what
was read, of equal length, shows only with the option ``check`` set to ``whole``, which digests that part at every look.

Files are read by byte ranges on the executors, through pyarrow's file systems (folders, hdfs, s3, gs). Rows are (value, file, at): the line, its file and its first byte, so
lines of one file are in order by ``at``.
"""

from __future__ import annotations

import hashlib
import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: Bytes at both ends of the part read that tell whether it is still the same, bytes that a task reads, rows that it hands on at a time.
EDGE, SPLIT, ROWS = 4096, 64 << 20, 10_000
SCHEMA = "value string, file string, at long"


@dataclass
class Part(InputPartition):
    """Lines that begin in ``a`` to ``b`` of a file; ``inside``: ``a`` may lie within a line, which the part before has."""

    file: str
    a: int
    b: int
    inside: bool

    def __hash__(self) -> int:
        return hash((self.file, self.a, self.b))


class Growing:
    """The files under a path, and how far their whole lines go."""

    def __init__(self, path: str, check: str = "edges", split: int = SPLIT):
        self.whole, self.split = check == "whole", split
        self.fs, self.path = pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)
        #: Sizes and times at the last look, with what was found.
        self.seen: dict[str, tuple] = {}

    def _files(self) -> list[pafs.FileInfo]:
        info = self.fs.get_file_info(self.path)
        if info.type == pafs.FileType.NotFound:
            return []
        found = [info] if info.is_file else self.fs.get_file_info(pafs.FileSelector(self.path))
        return sorted((x for x in found if x.is_file and x.base_name[0] not in "._"), key=lambda x: x.path)

    def _bytes(self, file: str, a: int, b: int) -> bytes:
        with self.fs.open_input_file(file) as f:
            f.seek(a)
            return f.read(b - a)

    def _last_line(self, file: str, size: int) -> int:
        """Where the last whole line ends."""
        end = size
        while end:
            a = max(0, end - EDGE)
            at = self._bytes(file, a, end).rfind(b"\n")
            if at >= 0:
                return a + at + 1
            end = a
        return 0

    def mark(self, file: str, at: int) -> str:
        """Digest of what tells the first ``at`` bytes."""
        told = hashlib.sha256()
        if self.whole:
            for a in range(0, at, 1 << 20):
                told.update(self._bytes(file, a, min(at, a + (1 << 20))))
        else:
            told.update(self._bytes(file, 0, min(at, EDGE)))
            told.update(self._bytes(file, max(0, at - EDGE), at))
        return told.hexdigest()[:32]

    def latest(self) -> dict:
        """The offset of all whole lines that are there."""
        out = {}
        for info in self._files():
            key = (info.size, info.mtime_ns)
            held = self.seen.get(info.path)
            if self.whole or held is None or held[0] != key:
                at = self._last_line(info.path, info.size)
                held = self.seen[info.path] = (key, {"at": at, "mark": self.mark(info.path, at)})
            if held[1]["at"]:
                out[info.path] = held[1]
        return {"files": out}

    def parts(self, start: dict, end: dict) -> list[Part]:
        """The byte ranges between two offsets; from the beginning of a file that isn't the same any more."""
        out = []
        for file, to in sorted(end["files"].items()):
            held = start["files"].get(file)
            if held == to:
                continue
            same = held is not None and held["at"] <= to["at"] and self.mark(file, held["at"]) == held["mark"]
            first = held["at"] if same else 0
            out += [Part(file, a, min(a + self.split, to["at"]), a > first) for a in range(first, to["at"], self.split)]
        return out

    def lines(self, part: Part) -> Iterator[pa.RecordBatch]:
        with self.fs.open_input_file(part.file) as raw:
            at = part.a - 1 if part.inside else part.a
            raw.seek(at)
            held = io.BufferedReader(raw, 1 << 20)
            if part.inside:
                at += len(held.readline())
            values, places = [], []
            while at < part.b and (line := held.readline()):
                values.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
                places.append(at)
                at += len(line)
                if len(values) == ROWS:
                    yield self._batch(values, places, part.file)
                    values, places = [], []
            if values:
                yield self._batch(values, places, part.file)

    @staticmethod
    def _batch(values: list[str], places: list[int], file: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values, pa.string()), pa.array([file] * len(values), pa.string()), pa.array(places, pa.int64())], names=["value", "file", "at"])


NOTHING = {"files": {}}


def _growing(options: dict) -> Growing:
    return Growing(options["path"], options.get("check", "edges"), int(options.get("split", SPLIT)))


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options, self.growing = options, _growing(options)

    def __getstate__(self):
        return {"options": self.options}

    def __setstate__(self, state):
        self.__init__(state["options"])

    def initialOffset(self) -> dict:
        return NOTHING

    def latestOffset(self) -> dict:
        return self.growing.latest()

    def partitions(self, start: dict, end: dict) -> list[Part]:
        return self.growing.parts(start, end)

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return self.growing.lines(partition)


class _Reader(DataSourceReader):
    """What lies between the offsets of the options ``start`` and ``end``."""

    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[Part]:
        growing = _growing(self.options)
        end = json.loads(self.options["end"]) if "end" in self.options else growing.latest()
        return growing.parts(json.loads(self.options.get("start") or json.dumps(NOTHING)), end) or [Part("", 0, 0, False)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        return _growing(self.options).lines(partition) if partition.b else iter(())


class GrowingLines(DataSource):
    """``spark.read`` and ``spark.readStream`` of the format ``growing_lines``, once it is registered."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(dict(self.options))

    def streamReader(self, schema) -> _StreamReader:
        return _StreamReader(dict(self.options))


def register(spark: SparkSession) -> str:
    spark.dataSource.register(GrowingLines)
    return GrowingLines.name()


def as_lines(rows: DataFrame) -> DataFrame:
    """(value, _line) as ``landing`` reads them."""
    return rows.select("value", F.struct("file", F.lit(0).cast("long").alias("block"), "at").alias("_line"))


def tail(spark: SparkSession, path: str, start: dict | None = None, check: str = "edges", split: int = SPLIT) -> tuple[DataFrame, dict]:
    """Lines (value, _line) that came since an offset, and the offset that they lead to."""
    end = Growing(path, check, split).latest()
    rows = spark.read.format(register(spark)).options(path=path, check=check, split=str(split), start=json.dumps(start or NOTHING), end=json.dumps(end)).load()
    return as_lines(rows), end
