"""Text files by byte ranges, as a source of the Python Data Source API.

Two tables over all files of one ending below a folder. ``lines`` has every
non-blank line with the byte at which it begins: big files are cut into ranges,
small ones share a task, and a line belongs to the range that holds its first
byte, so a line has the same place in every scan. ``heads`` has one row a file
and reads no further than it must: up to the first line with a mark, or the
first two lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a task's ranges, and bytes read at once.
SPLIT = 64 << 20
CHUNK = 1 << 20
#: Files whose heads one task reads.
HEADS = 64

LINES = "file string, at long, line string"
HEAD_ROW = "file string, at long, line string, before string"


class Ranges(InputPartition):
    """(path, first byte, end) pieces of files for one task."""

    def __init__(self, pieces: list[tuple[str, int, int]]):
        self.pieces = pieces


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def files_below(uri: str, ending: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files, in order of path; names that begin with ``_`` or ``.`` are hidden."""
    system, root = open_folder(uri)
    info = system.get_file_info(root)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, recursive=True))
    own = [f for f in found if f.type == fs.FileType.File and f.base_name.endswith(ending)]
    shown = [f for f in own if not any(part.startswith(("_", ".")) for part in f.path[len(root) :].split("/"))]
    return sorted((f.path, f.size) for f in shown)


def plan(files: list[tuple[str, int]], split: int) -> list[Ranges]:
    """Ranges of at most ``split`` bytes; short ones are put together up to that size."""
    tasks: list[Ranges] = []
    held, size = [], 0
    for path, total in files:
        for start in range(0, total, split):
            end = min(start + split, total)
            if held and size + end - start > split:
                tasks.append(Ranges(held))
                held, size = [], 0
            held.append((path, start, end))
            size += end - start
    return [*tasks, Ranges(held)] if held else tasks


def lines_of(system: fs.FileSystem, path: str, start: int, end: int) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(places, lines) of the lines that begin in [start, end), a chunk at a time."""
    with system.open_input_file(path) as file:
        at = max(0, start - 1)
        file.seek(at)
        tail = b""
        skip = start > 0  # the rest of a line that began before
        while at < end or tail:
            data = file.read(CHUNK)
            block, tail = tail + data, b""
            if skip:
                cut = block.find(b"\n")
                if cut < 0:
                    at += len(block)
                    if not data:
                        return
                    continue
                at, block, skip = at + cut + 1, block[cut + 1 :], False
            if data:
                cut = block.rfind(b"\n") + 1
                block, tail = block[:cut], block[cut:]
            if block:
                rows = block.split(b"\n")
                if block.endswith(b"\n"):
                    rows.pop()
                texts = block.decode("utf-8", "replace").split("\n")[: len(rows)]
                places = at + np.cumsum([0, *(len(r) + 1 for r in rows[:-1])])
                at += len(block)
                own = int(np.searchsorted(places, end))
                yield places[:own], texts[:own]
                if own < len(rows):
                    return
            if not data:
                return


def tidy(line: str) -> str:
    return line.rstrip("\r").replace("﻿", "")


class FileReader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri, self.ending = options["path"], options.get("ending", ".csv")
        self.split = int(options.get("split", SPLIT))
        self.table, self.mark = options["table"], options.get("mark")

    def partitions(self) -> list[InputPartition]:
        files = files_below(self.uri, self.ending)
        if self.table == "lines":
            return plan(files, self.split) or [Ranges([])]
        return [Ranges([(p, 0, size) for p, size in files[i : i + HEADS]]) for i in range(0, len(files), HEADS)] or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(self.uri)
        if self.table == "heads":
            rows = [(p, *self._head(system, p, size)) for p, _, size in partition.pieces]
            rows = [r for r in rows if r[1] is not None]
            kinds = [("file", pa.string()), ("at", pa.int64()), ("line", pa.string()), ("before", pa.string())]
            yield pa.RecordBatch.from_pylist([dict(zip([k for k, _ in kinds], r)) for r in rows], schema=pa.schema(kinds))
            return
        for path, start, end in partition.pieces:
            for places, texts in lines_of(system, path, start, end):
                kept = [(int(at), line) for at, line in zip(places, map(tidy, texts)) if line.strip()]
                ats, lines = zip(*kept) if kept else ((), ())
                columns = [pa.array([path] * len(kept), pa.string()), pa.array(ats, pa.int64()), pa.array(lines, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "at", "line"])

    def _head(self, system: fs.FileSystem, path: str, size: int) -> tuple:
        """(at, line, line before) of the first line with the mark, or of the second line where no mark is asked for."""
        before = None
        for places, texts in lines_of(system, path, 0, size):
            for at, line in zip(places, map(tidy, texts)):
                if not line.strip():
                    continue
                if self.mark in line.lower() if self.mark else before is not None:
                    return int(at), line, before
                before = line
        return None, None, None


class FileRanges(DataSource):
    """Options: ``path`` (a URI that pyarrow's file systems open), ``table`` (lines or heads), ``ending``, ``mark``, ``split``."""

    @classmethod
    def name(cls) -> str:
        return "tilth_file_ranges"

    def schema(self) -> str:
        return LINES if self.options["table"] == "lines" else HEAD_ROW

    def reader(self, schema) -> FileReader:
        return FileReader(dict(self.options))


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI, by Spark's own default file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    uri = system.makeQualified(target).toString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def reachable(uri: str) -> bool:
    """Whether pyarrow has a file system for the URI; Spark knows more kinds."""
    try:
        open_folder(uri)
    except (pa.ArrowException, ValueError, OSError, NotImplementedError):
        return False
    return True


def scan(spark: SparkSession, uri: str, table: str, **options) -> DataFrame:
    spark.dataSource.register(FileRanges)
    reader = spark.read.format(FileRanges.name()).option("path", uri).option("table", table)
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader.load()
