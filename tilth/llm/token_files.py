"""Flat token files, and token counts of documents found by scanning them for end marks.

A flat file is a row of token ids with an end mark after each document and no index. It is
kept as blocks of equal size whose borders ignore documents. A scan searches each block for
marks on its own; the pieces at block borders are stitched by running sums over the blocks
of a file: how many marks came before, and how many tokens stand open since the last one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource

from tilth.llm.common import pick, raw
from tilth.llm.tokens import encoder
from tilth.sources.file_ranges import SPLIT, FileReader, Ranges, files_below, open_folder, plan, qualified, reachable

#: No id of the vocabularies here, nor of their added tokens: a text may hold the literal of any of them.
END = 65535
BLOCK = 1 << 19


def write_tokens(docs: DataFrame, path: str, ranks: str | None = None, end: int = END, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(file, part, tokens binary, doc_ids array): blocks of flat files, one file for each task of the input.

    Every block but a file's last holds ``block`` tokens. The rows with tokens null list the
    ids of the file's documents in order. Tokens are little-endian, 16 bits if the vocabulary
    and the end mark allow, else 32. A null text has no tokens. A text that spells an added
    token, such as <|endoftext|>, holds that token's id like the tokenizer gives it; an ``end``
    that is an id of the vocabulary is refused if a text holds it.
    """
    source = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = TaskContext.get().partitionId()
        own = encoder(path, ranks)
        kind = np.uint16 if own.kind == np.uint16 and end < 1 << 16 else np.uint32
        held, size, number, listed = [], 0, 0, 0

        def row(part: int, tokens: bytes | None, ids) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([file]), pa.array([part]), pa.array([tokens], pa.binary()), pa.array([ids], pa.list_(pa.int64()))], names=["file", "part", "tokens", "doc_ids"])

        for batch in parts:
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                ids, counts = own.encode(raw(rows.column(1)))
                if (ids == end).any():
                    raise ValueError(f"a text holds the end mark {end}")
                stream = np.insert(ids.astype(kind), np.cumsum(counts), end)
                held.append(stream)
                size += len(stream)
                yield row(listed, None, rows.column(0).to_numpy())
                listed += 1
                if size >= block:
                    flat = np.concatenate(held)
                    for i in range(0, size - block + 1, block):
                        yield row(number, flat[i : i + block].tobytes(), None)
                        number += 1
                    held = [flat[size - size % block :]]
                    size %= block
        if size:
            yield row(number, np.concatenate(held).tobytes(), None)

    return source.mapInArrow(run, "file long, part long, tokens binary, doc_ids array<long>")


class TokenReader(FileReader):
    """Blocks of equal size of flat files; a task's ranges begin at block borders."""

    def partitions(self) -> list[Ranges]:
        return plan(files_below(self.uri, self.ending), self.split) or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        width = int(self.table)
        system, _ = open_folder(self.uri)
        for path, start, end in partition.pieces:
            with system.open_input_file(path) as file:
                for at in range(start, end, width):
                    file.seek(at)
                    tokens = file.read(min(width, end - at))
                    columns = [pa.array([path]), pa.array([at // width], pa.int64()), pa.array([tokens], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["file", "part", "tokens"])


class TokenFiles(DataSource):
    """Options: ``path`` (a URI that pyarrow's file systems open), ``table`` (bytes of a block), ``split`` (bytes of a task), ``ending``."""

    @classmethod
    def name(cls) -> str:
        return "tilth_token_files"

    def schema(self) -> str:
        return "file string, part long, tokens binary"

    def reader(self, schema) -> TokenReader:
        return TokenReader(dict(self.options))


def read_files(spark, path: str, block: int = BLOCK, ending: str = "") -> DataFrame:
    """(file string, part, tokens) of raw flat files below a folder, whatever wrote them.

    Files are cut into byte ranges at block borders, so a file of any size is read by many tasks and a
    task holds one block; a file without bytes gives no row. File systems that Spark knows and pyarrow
    doesn't are read file by file, where a file is one row of at most 2 GB.
    """
    width = block * 4
    uri = qualified(spark, path)
    if reachable(uri):
        spark.dataSource.register(TokenFiles)
        options = {"path": uri, "table": str(width), "split": str(max(1, SPLIT // width) * width), "ending": ending}
        return spark.read.format(TokenFiles.name()).options(**options).load()
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("content").alias("tokens"))
    files = files.where(F.col("file").endswith(ending) & (F.length("tokens") > 0))
    cut = files.select("file", "tokens", F.explode(F.sequence(F.lit(0), F.ceil(F.length("tokens") / width).cast("int") - 1)).alias("part"))
    return cut.select("file", F.col("part").cast("long").alias("part"), F.substring("tokens", F.col("part") * width + 1, F.lit(width)).alias("tokens"))


def scan(blocks: DataFrame, end: int = END, width: int = 2) -> DataFrame:
    """(file, ordinal, start, n_tokens): the documents of each flat file, counted from 0; the mark isn't counted.

    blocks: (file, part, tokens) in any order, ``width`` bytes to a token. start: tokens and marks
    of the file before the document. What follows a file's last mark is a document without mark,
    returned only if it has tokens. A file or block without bytes has no documents.
    """
    spaces = "documents long, head long, tail long, size long, starts binary, lengths binary"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                tokens = np.frombuffer(one.column(2)[0].as_py() or b"", f"<u{width}")
                marks = np.flatnonzero(tokens == end)
                size = len(tokens)
                head = int(marks[0]) if len(marks) else size
                tail = size - int(marks[-1]) - 1 if len(marks) else size
                starts, lengths = marks[:-1] + 1, np.diff(marks) - 1
                new = [[len(marks)], [head], [tail], [size], [starts.astype("<i8").tobytes()], [lengths.astype("<i8").tobytes()]]
                kinds = [pa.int64()] * 4 + [pa.binary()] * 2
                yield pa.RecordBatch.from_arrays([one.column(0), one.column(1), *(pa.array(c, k) for c, k in zip(new, kinds))], names=["file", "part", "documents", "head", "tail", "size", "starts", "lengths"])

    kinds = dict(blocks.dtypes)
    own = blocks.select("file", "part", "tokens").mapInArrow(run, f"file {kinds['file']}, part {kinds['part']}, {spaces}")
    order = W.partitionBy("file").orderBy("part")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    sums = own.select(
        "*",
        F.coalesce(F.sum("documents").over(before), F.lit(0)).alias("ahead"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"),
        F.lead("part").over(order).isNull().alias("last"),
    )
    # tokens open at a block's start: those since the last block with a mark, from its tail on
    open_ = F.coalesce(F.sum("tail").over(W.partitionBy("file", "ahead").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    carried = F.when(F.col("ahead") > 0, F.coalesce(F.last(F.when(F.col("documents") > 0, F.col("tail")), ignorenulls=True).over(before), F.lit(0))).otherwise(F.lit(0))
    stitched = sums.withColumn("open", open_ + carried)

    def spread(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row, file in zip(batch.select([*names]).to_pylist(), batch.column(0)):
                n, offset = row["documents"], row["offset"]
                starts, lengths = [], []
                if n:
                    starts.append([offset - row["open"]])
                    lengths.append([row["open"] + row["head"]])
                    starts.append(np.frombuffer(row["starts"], "<i8") + offset)
                    lengths.append(np.frombuffer(row["lengths"], "<i8"))
                left = row["tail"] if n else row["open"] + row["size"]
                if row["last"] and left:
                    starts.append([offset + row["size"] - left])
                    lengths.append([left])
                if starts:
                    s, length = np.concatenate(starts).astype(np.int64), np.concatenate(lengths).astype(np.int64)
                    ordinal = row["ahead"] + np.arange(len(s))
                    files = pa.array([file.as_py()] * len(s), batch.schema.field(0).type)
                    yield pa.RecordBatch.from_arrays([files, pa.array(ordinal), pa.array(s), pa.array(length)], names=["file", "ordinal", "start", "n_tokens"])

    names = ("documents", "head", "tail", "size", "starts", "lengths", "ahead", "offset", "last", "open")
    return stitched.select("file", *names).mapInArrow(spread, f"file {kinds['file']}, ordinal long, start long, n_tokens long")


def token_counts(store: DataFrame, end: int = END, width: int = 2) -> DataFrame:
    """(doc_id, file, ordinal, start, n_tokens) over a written store of ``write_tokens``: counts from the scan, names by order.

    Every row written is a document of its own, so a repeated row or id comes back as often as it was
    written, under its own ordinal. A null or empty text has 0 tokens; an empty store gives no rows.
    """
    found = scan(store.where("tokens is not null"), end, width)
    lists = store.where("tokens is null").select("file", "part", "doc_ids", F.size("doc_ids").alias("n"))
    ahead = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    names = lists.select("file", "doc_ids", ahead.alias("ahead")).select("file", "ahead", F.posexplode("doc_ids").alias("i", "doc_id"))
    return names.select("file", (F.col("ahead") + F.col("i")).alias("ordinal"), "doc_id").join(found, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens")
