"""Mixture-controlled packing: every window takes from each source its target share of tokens.

Sources are queues of tokens, and windows of 1024 tokens are filled round robin. What a
window owes a source beyond whole tokens is its deficit, carried to the next window. The
shares hold until a queue ends, then the others share by their targets: a phase. After P
tokens of a phase's first s + 1 sources the first s have given floor(P * Q(s) / Q(s + 1)),
Q being their tokens of the phase; so the state at any window is known without the windows
before, and each task serves its own stretch of the queues. Without targets a source's share
is that of all tokens, and all queues end with the last window.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilth.llm.common import pick, raw, written
from tilth.llm.tokens import encoder

WINDOW = 1024
END = 0


def tokenised(docs: DataFrame, path: str, ranks: str | None = None, end: int = END, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(part, source, doc_id, place, n, ids binary): each document's ids and the end id; place: tokens of its source before it in the task."""
    source = pick(docs, doc_id=id_col, text=text_col, source=source_col).select("doc_id", "text", F.col("source").cast("string").alias("source"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, ranks)
        part = TaskContext.get().partitionId()
        given: dict[str | None, int] = {}
        for batch in parts:
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                ids, counts = own.encode(raw(rows.column(1)))
                stream = np.insert(ids, np.cumsum(counts), end).astype("<u4" if own.kind == np.uint32 else "<u2")
                counts = counts + 1
                edges = np.concatenate([[0], np.cumsum(counts)]) * stream.itemsize
                places = []
                for s, n in zip(rows.column(2).to_pylist(), counts.tolist()):
                    places.append(given.get(s, 0))
                    given[s] = places[-1] + n
                packed = pa.Array.from_buffers(pa.binary(), rows.num_rows, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(stream)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(rows.num_rows, part, np.int32)), rows.column(2), rows.column(0), pa.array(places, pa.int64()), pa.array(counts), packed], names=["part", "source", "doc_id", "place", "n", "ids"])

    return source.mapInArrow(run, f"part int, source string, doc_id {kind}, place long, n long, ids binary")


#: Token counts below this are told apart by a double's product to within one.
MOST = 1 << 50


def part_of(a: np.ndarray, b: int, c: int) -> np.ndarray:
    """floor(a * b / c) of counts below ``MOST``, a and b at most c: a double is off by one at most, and wrapped 64-bit differences tell by what."""
    near = np.floor(a * (b / c)).astype(np.int64)
    return near + (a * np.int64(b) - near * np.int64(c)) // c


def phases(totals: list[int], weights: list[float] | None = None) -> list[list[int]]:
    """Tokens of each source in each phase; a phase ends with the queue that ends next. Sources without a weight share the last one."""
    if weights is None:
        return [totals]
    shares = [Fraction(w) for w in weights]
    reached, found = [0] * len(totals), []
    for level in sorted({n / w for n, w in zip(totals, shares) if w > 0}):
        now = [min(n, int(w * level)) for n, w in zip(totals, shares)]
        found.append([b - a for a, b in zip(reached, now)])
        reached = now
    found.append([n - a for a, n in zip(reached, totals)])
    return [own for own in found if any(own)]


class Shares:
    """How many tokens each source has given after any number of windows. totals: tokens of each source, none zero."""

    def __init__(self, totals: list[int], window: int = WINDOW, weights: list[float] | None = None):
        self.window, self.totals, self.all = window, totals, sum(totals)
        if self.all >= MOST:
            raise ValueError(f"packs fewer than {MOST} tokens")
        self.windows = -(-self.all // window)
        parts = phases(totals, weights)
        #: Per phase: tokens of the first sources in it, and its place among all tokens.
        self.upto = [np.cumsum(own).tolist() for own in parts]
        self.start = np.cumsum([0, *[own[-1] for own in self.upto[:-1]]]).tolist()
        self.past = np.cumsum([[0] * len(totals), *self.upto[:-1]], axis=0, dtype=np.int64)

    def given(self, s: int, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens of sources before s, tokens of sources up to s) after so many windows, which ascend."""
        tokens = np.minimum(windows * self.window, self.all)
        first, last = (bisect_right(self.start, int(t)) - 1 for t in (tokens[0], tokens[-1]))
        before = np.full(len(tokens), self.past[first][s - 1] if s else 0)
        upto = np.full(len(tokens), self.past[first][s])
        for phase in range(first, last + 1):
            sums = self.upto[phase]
            own = np.clip(tokens - self.start[phase], 0, sums[-1])
            for k in range(len(sums) - 2, s - 1, -1):
                own = part_of(own, sums[k], max(1, sums[k + 1]))
            upto += own
            if s:
                before += part_of(own, sums[s - 1], max(1, sums[s]))
        return before, upto

    def served(self, s: int, window: int) -> int:
        before, upto = self.given(s, np.array([window]))
        return int(upto[0] - before[0])

    def window_of(self, s: int, place: int) -> int:
        """The window that takes the source's token at ``place``."""
        low, high = 0, self.windows
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if self.served(s, mid) <= place else (low, mid)
        return low

    def cuts(self, s: int, start: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the source's tokens from start to stop: windows that take some, each one's first place, and its offset there."""
        first, last = self.window_of(s, start), self.window_of(s, stop - 1)
        found = []
        for at in range(first, last + 1, 1 << 16):
            windows = np.arange(at, min(at + (1 << 16), last + 1) + 1)
            before, upto = self.given(s, windows)
            place = upto - before
            takes = np.diff(place) > 0
            found.append((windows[:-1][takes], place[:-1][takes], np.diff(before)[takes]))
        return tuple(np.concatenate(c) for c in zip(*found))


def pieces(store: DataFrame, window: int = WINDOW, targets: dict[str | None, float] | None = None) -> DataFrame:
    """(doc_id, start, length, ids binary, doc_tokens, sequence_id, offset) from a written table of ``tokenised``; runs a job.

    ids: 32 bits each, little-endian. Totals of the sources come to the driver: a mixture's
    parts, one number each.
    """
    own = store.groupBy("source", "part").agg(F.sum("n").alias("n"))
    ahead = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = own.groupBy("source").agg(F.sum("n").alias("n")).orderBy(F.asc_nulls_last("source")).collect()
    numbers = {row["source"]: i for i, row in enumerate(totals)}
    weights = None if targets is None else [targets.get(row["source"], 0) for row in totals]
    shares = Shares([row["n"] for row in totals], window, weights)
    base = written(own.select("source", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base")), "bases")
    kind = store.schema["doc_id"].dataType.simpleString()
    match = store["part"].eqNullSafe(base["part"]) & store["source"].eqNullSafe(base["source"])
    placed = store.join(base, match).select(store["source"], "doc_id", (F.col("base") + F.col("place")).alias("place"), "n", "ids")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            number = np.array([numbers[s] for s in batch.column(0).to_pylist()], np.int64)
            place, n = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            ids = batch.column(4).to_pylist()
            order = np.lexsort((place, number))
            # runs of documents that follow each other in their queue
            breaks = (number[order][1:] != number[order][:-1]) | (place[order][1:] != (place + n)[order][:-1])
            for own in np.split(order, np.flatnonzero(breaks) + 1):
                if len(own):
                    yield stretch(batch.column(1).take(pa.array(own)), int(number[own[0]]), place[own], n[own], [ids[i] for i in own])

    def stretch(doc: pa.Array, s: int, place: np.ndarray, n: np.ndarray, ids: list[bytes]) -> pa.RecordBatch:
        stop = int(place[-1] + n[-1])
        windows, first, offset = shares.cuts(s, int(place[0]), stop)
        edges = np.unique(np.concatenate([place, first[(first > place[0]) & (first < stop)]]))
        length = np.diff(np.append(edges, stop))
        w = np.searchsorted(first, edges, side="right") - 1
        d = np.searchsorted(place, edges, side="right") - 1
        width = len(ids[0]) // int(n[0])
        flat = np.frombuffer(b"".join(ids), f"<u{width}").astype("<u4")
        spans = (np.append(edges, stop) - place[0]) * 4
        packed = pa.Array.from_buffers(pa.binary(), len(edges), [None, pa.py_buffer(spans.astype(np.int32)), pa.py_buffer(flat)])
        columns = [doc.take(pa.array(d)), pa.array(edges - place[d]), pa.array(length), packed, pa.array(n[d]), pa.array(windows[w]), pa.array(offset[w] + edges - first[w])]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return placed.mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def pack(
    docs: DataFrame, path: str, ranks: str | None = None, window: int = WINDOW, end: int = END, targets: dict[str | None, float] | None = None
) -> DataFrame:
    """All documents with an id, cut into pieces of windows; runs jobs. Columns as ``pieces``.

    targets: the share of each source (as text; None for a null source), in any unit. Every
    window but the last is full and holds each source in its share, to within some tokens,
    until a queue ends; the others then share by their targets. Sources without a target, or
    with 0, come after all that have one, in their shares of what is left; so without
    ``targets`` every source has its share of all tokens from the first window to the last.
    A null or empty text is its end id alone; a null source is a source; repeated rows are
    packed one by one; an empty table has no pieces.
    """
    if targets and not all(0 <= w < float("inf") for w in targets.values()):
        raise ValueError("targets are finite and not below 0")
    return pieces(written(tokenised(docs, path, ranks, end), "tokens"), window, targets)


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
