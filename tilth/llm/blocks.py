"""Blocks of whole texts that ask buckets and get answers, so that neither texts nor single keys are shuffled.

Texts are written once as compressed blocks, bucketed by block number. A block asks each
bucket about its own distinct keys, in an order it can work out again; a bucket sees the
keys of all blocks and answers each in the order it asked. Answers meet their block by a
join that leaves the written blocks where they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import raw
from tilth.session import scratch_path

BLOCK = 4 << 20
ASKS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("blob", pa.binary())])


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, the bytes of equal weight side by side."""
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T) if a.itemsize > 1 and len(a) else a
        parts.append(f"{a.dtype.str} {len(a)};".encode() + planes.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def expand(blob: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    arrays, at = [], 0
    while at < len(data):
        stop = data.index(b";", at)
        kind, n = data[at:stop].split()
        dtype, n = np.dtype(kind.decode()), int(n)
        size = n * dtype.itemsize
        planes = np.frombuffer(data, np.uint8, size, stop + 1)
        arrays.append(np.ascontiguousarray(planes.reshape(dtype.itemsize, n).T).reshape(-1).view(dtype) if dtype.itemsize > 1 and n else planes.view(dtype))
        at = stop + 1 + size
    return arrays


def write_blocks(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """(block, ids, flags, lengths, text) of documents (doc_id long, text, flag boolean), in blocks of about ``size`` bytes; runs a job.

    The table is bucketed by block, so joins on it move only the other side. A text longer
    than ``size`` is a block of its own; a null text is empty.
    """
    spark = docs.sparkSession

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, flags, texts, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            row = [number, np.array(ids, np.int64).tobytes(), np.array(flags, np.uint8).tobytes(), lengths.tobytes(), zstandard.ZstdCompressor(level=3).compress(b"".join(texts))]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [pa.int64()] + [pa.binary()] * 4)], names=["block", "ids", "flags", "lengths", "text"])

        for part in parts:
            for i, text, flag in zip(part.column(0).to_pylist(), raw(part.column(1)), part.column(2).to_pylist()):
                if held and held + len(text) > size:
                    yield block()
                    number, ids, flags, texts, held = number + 1, [], [], [], 0
                ids.append(i)
                flags.append(bool(flag))
                texts.append(text)
                held += len(text) + 1
        if ids:
            yield block()

    packed = docs.select("doc_id", "text", "flag").mapInArrow(run, "block long, ids binary, flags binary, lengths binary, text binary")
    path, name = scratch_path(spark, "blocks"), f"blocks_{uuid.uuid4().hex}"
    buckets = min(20_000, max(8, 4 * docs.rdd.getNumPartitions()))
    packed.write.bucketBy(buckets, "block").option("path", path).option("compression", "none").saveAsTable(name)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.table(name)


class Block:
    """One block's documents."""

    def __init__(self, number: int, ids: bytes, flags: bytes, lengths: bytes, text: bytes):
        self.number = number
        self.ids = np.frombuffer(ids, np.int64)
        self.flags = np.frombuffer(flags, np.uint8).astype(bool)
        self.lengths = np.frombuffer(lengths, np.int64)
        self.text = zstandard.ZstdDecompressor().decompress(text)

    def texts(self) -> Iterator[bytes]:
        at = 0
        for n in self.lengths.tolist():
            yield self.text[at : at + n]
            at += n


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Slices of equal buckets of a sorted array."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)]):
        if b > a:
            yield int(bucket[a]), slice(a, b)


def hash_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each 64-bit hash; rises with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


Asks = Iterable[tuple[int, bytes]]


def each_block(blocks: DataFrame, fn: Callable[..., Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """Runs ``fn(block, *answers)`` on every block; answers: (bucket, blob) lists, in order of bucket."""
    columns = blocks.columns

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                row = [part.column(k)[i].as_py() for k in range(len(columns))]
                told = [sorted((a["bucket"], a["blob"]) for a in answers or []) for answers in row[5:]]
                yield from fn(Block(*row[:5]), *told)

    return blocks.mapInArrow(run, schema)


def asks(blocks: DataFrame, fn: Callable[..., Asks]) -> DataFrame:
    """(bucket, block, blob) of what each block asks."""

    def rows(block: Block, *answers) -> Iterator[pa.RecordBatch]:
        found = list(fn(block, *answers))
        if found:
            buckets, blobs = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), pa.array([block.number] * len(found), pa.int64()), pa.array(blobs, pa.binary())], schema=ASKS)

    return each_block(blocks, rows, "bucket long, block long, blob binary")


def answers(asked: DataFrame, fn: Callable[[int, list[bytes]], Iterable[bytes | None]]) -> DataFrame:
    """(bucket, block, blob): ``fn(bucket, blobs)`` gives each ask's answer in order, None for none; blobs are in order of block."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        number = group.column("block").to_numpy()
        order = np.argsort(number)
        blobs = group.column("blob").take(pa.array(order)).to_pylist()
        bucket = key[0].as_py()
        told = [(int(number[i]), a) for i, a in zip(order, fn(bucket, blobs)) if a is not None]
        return pa.table([pa.array([bucket] * len(told), pa.int64()), pa.array([n for n, _ in told], pa.int64()), pa.array([a for _, a in told], pa.binary())], schema=ASKS)

    return asked.groupBy("bucket").applyInArrow(run, "bucket long, block long, blob binary")


def with_answers(blocks: DataFrame, told: DataFrame, name: str) -> DataFrame:
    """The blocks with one more column: the answers each got, from a written table."""
    own = told.groupBy("block").agg(F.collect_list(F.struct("bucket", "blob")).alias(name))
    return blocks.join(own.hint("merge"), "block", "left").select(*blocks.columns, name)
