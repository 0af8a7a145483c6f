"""SimHash near-duplicates: fingerprints, and their links by a self-join of binary tries.

Fingerprints are cut into three segments of bits. Two that differ in at most four bits
differ in at most one bit of some segment, so the trie is walked once for each segment
put first, with a budget of one bit inside it and four in all. The upper levels of the
trie are cells of the join: a cell is a pair of nodes whose prefixes differ within the
budget. Cells that hold too many fingerprints are dealt to pairs of deeper nodes. Inside a
cell node pairs are expanded together, level by level, and dropped once the budget is
exceeded or both nodes already are of one component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import pick, raw, written
from tilth.llm.components import components

SHINGLE, SEED, BITS = 4, 42, 4
#: Left turns that bring each segment to the top, and the segments' lengths.
TURNS, SEGMENTS = (0, 21, 42), (21, 21, 22)
#: Fingerprints of a cell on average, at most (fuller ones are dealt on by STEP bits), and depths of the first cells and of the last.
CELL, FULL, STEP = 4096, 1 << 18, 4
FIRST_DEPTH, LAST_DEPTH = 20, 60
#: Bits from the top in which one may differ, whatever the segment.
STRICT = min(SEGMENTS)
FRONTIER = 1 << 17
CELLS = "r int, a long, b long, key long, rep long"


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits; a bit is 1 if set in over half of the hashes of the text's shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    last = ends[len(words) - n :] if len(words) >= shingle else ends[-1:]
    sums = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        spans = zip(starts[at : min(n, at + (1 << 16))].tolist(), last[at : at + (1 << 16)].tolist())
        hashes = np.array([digest(line[a:b], seed) for a, b in spans], "<u8")
        sums += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * sums > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long): fp holds the 64 bits as a signed number. A null text counts as empty."""
    source = pick(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            fps = np.array([fingerprint(t) for t in raw(part.column(1))], "<u8").view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return source.mapInArrow(run, f"doc_id {kind}, fp long")


def _batch(r: np.ndarray, a: np.ndarray, b: np.ndarray, key: np.ndarray, rep: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(r, pa.int32()), pa.array(a), pa.array(b), pa.array(key.view(np.int64)), pa.array(rep)], names=["r", "a", "b", "key", "rep"])


def _cells(depth: int):
    """Sends each fingerprint to the cells (a, b) of its own node and of the nodes one bit away, for each segment put first."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            fp = part.column(0).to_numpy().view(np.uint64)
            rep = part.column(1).to_numpy()
            for r, turn in enumerate(TURNS):
                key = fp if not turn else (fp << np.uint64(turn)) | (fp >> np.uint64(64 - turn))
                node = (key >> np.uint64(64 - depth)).astype(np.int64) if depth else np.zeros(len(key), np.int64)
                for bit in [0, *(1 << j for j in range(depth))]:
                    yield _batch(np.full(len(key), r), node & ~bit, node | bit, key, rep)

    return run


def _deeper(old: int, new: int, bits: int):
    """Deals the rows of cells at one depth to pairs of deeper nodes that differ within the budget."""
    step = new - old
    budget = 1 if new <= STRICT else bits

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            r, a, b, key, rep = (part.column(i).to_numpy() for i in range(5))
            key = key.view(np.uint64)
            left = budget - np.bitwise_count(a ^ b).astype(np.int64)
            second = (a != b) & ((key >> np.uint64(64 - old)).astype(np.int64) == b)
            own = (key >> np.uint64(64 - new)).astype(np.int64) & ((1 << step) - 1)
            for mask in range(1 << step):
                fits = mask.bit_count() <= left
                x, y = own[fits], own[fits] ^ mask
                # of one node's children the smaller comes first; of two nodes each keeps its place
                turned = np.where((a == b)[fits], x > y, second[fits])
                low, high = (a[fits] << step) | np.where(turned, y, x), (b[fits] << step) | np.where(turned, x, y)
                yield _batch(r[fits], low, high, key[fits], rep[fits])

    return run


def union(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merges the components of linked positions; a label is the smallest position of its component."""
    while len(a):
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up
    return labels


def trie_components(keys: np.ndarray, split: int, depth: int, segment: int, bits: int = BITS, diff: int = 1) -> np.ndarray:
    """Component label of each key, over links of at most ``bits`` differing bits inside one cell.

    keys: distinct, sorted from 0 to ``split`` and from there on. With split 0 they are one node
    of ``depth`` equal bits; else two nodes whose prefixes differ in ``diff`` bits, and only pairs
    across them are compared. ``segment``: bits from the top in which one may differ.
    """
    n = len(keys)
    labels = np.arange(n)
    ones: dict[int, np.ndarray] = {}
    popcount = np.bitwise_count

    def rising(level: int) -> np.ndarray:
        if level not in ones:
            bit = ((keys >> np.uint64(63 - level)) & np.uint64(1)).astype(np.int64)
            ones[level] = np.concatenate([[0], np.cumsum(bit)])
        return ones[level]

    if split:
        start = np.array([[0], [split], [split], [n], [diff]], np.int64)
    else:
        start = np.array([[0], [n], [0], [n], [0]], np.int64)
    stack = [(depth, start)]
    while stack:
        level, pairs = stack.pop()
        a0, a1, b0, b1, diff = pairs
        change = np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])]) if n > 1 else np.zeros(n, np.int64)
        one = (change[a0] == change[a1 - 1]) & (change[b0] == change[b1 - 1]) & (labels[a0] == labels[b0])
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1)
        hit = leaf & ~one
        if hit.any():
            i, j = a0[hit], b0[hit]
            near = popcount(keys[i] ^ keys[j]) <= bits
            labels = union(labels, i[near], j[near])
        open_ = ~leaf & ~one
        if level == 64 or not open_.any():
            continue
        a0, a1, b0, b1, diff = pairs[:, open_]
        count = rising(level)
        am, bm = a1 - (count[a1] - count[a0]), b1 - (count[b1] - count[b0])
        self_ = a0 == b0
        budget = 1 if level < segment else bits
        kids = [
            np.stack([a0, am, b0, bm, diff]),
            np.stack([am, a1, bm, b1, diff]),
            np.stack([a0, am, bm, b1, diff + 1]),
            np.stack([am, a1, b0, bm, diff + 1])[:, ~self_],
        ]
        kids = np.concatenate(kids, axis=1)
        alive = (kids[1] > kids[0]) & (kids[3] > kids[2]) & (kids[4] <= budget)
        alive &= ~((kids[0] == kids[2]) & (kids[1] - kids[0] == 1))
        kids = kids[:, alive]
        for at in range(0, kids.shape[1], FRONTIER):
            stack.append((level + 1, kids[:, at : at + FRONTIER]))
    return labels


def _join_cell(depth: int, bits: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        r, a, b = (k.as_py() for k in key)
        keys = group.column("key").to_numpy().view(np.uint64)
        reps = group.column("rep").to_numpy()
        if a != b:
            side = (keys >> np.uint64(64 - depth)).astype(np.int64) == b
            order = np.lexsort((keys, side))
            split = int((~side).sum())
        else:
            order, split = np.argsort(keys), 0
        keys, reps = keys[order], reps[order]
        if len(keys) < 2 or (a != b and split in (0, len(keys))):
            return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        labels = trie_components(keys, split, depth, SEGMENTS[r], bits, (a ^ b).bit_count())
        moved = np.flatnonzero(labels != np.arange(len(labels)))
        return pa.table({"u": reps[moved], "v": reps[labels[moved]]})

    return run


def near_links(fps: DataFrame, bits: int = BITS, full: int = FULL, cell: int = CELL) -> DataFrame:
    """(fp, rep), distinct fp, to links (u, v) between reps that join every two within ``bits`` bits, directly or by others; runs jobs.

    The depth of the first cells follows the number of fingerprints, so a cell holds some
    thousands (``cell``) on average, and a fingerprint goes to three cells and three more for
    each level. Cells of more than ``full`` fingerprints, such as a large family's that agree in
    a segment, are dealt to pairs of nodes some bits deeper until none is left.
    """
    if bits != BITS:
        raise ValueError("the three segments are laid out for four bits")
    n = fps.count()
    depth = min(FIRST_DEPTH, max(0, math.ceil(math.log2(max(1, n) / cell))))
    rows, links = fps.mapInArrow(_cells(depth), CELLS), None
    while True:
        large = None
        # a cell holds a fingerprint once, so few fingerprints fill none
        if n > full and depth < LAST_DEPTH:
            second = F.count_if((F.col("a") != F.col("b")) & (F.shiftrightunsigned("key", 64 - depth) == F.col("b"))) if depth else F.lit(0)
            sizes = rows.groupBy("r", "a", "b").agg(F.count("*").alias("n"), second.alias("n2")).where(F.col("n") > full)
            # two nodes of which one is empty have no pairs
            large = written(sizes.withColumn("pairs", (F.col("a") == F.col("b")) | ((F.col("n2") > 0) & (F.col("n2") < F.col("n")))), "large")
            large = None if large.isEmpty() else large
        small = rows if large is None else rows.join(large, ["r", "a", "b"], "left_anti")
        found = small.groupBy("r", "a", "b").applyInArrow(_join_cell(depth, bits), "u long, v long")
        links = found if links is None else links.unionByName(found)
        if large is None:
            return links
        deeper = min(depth + STEP, STRICT if depth < STRICT else LAST_DEPTH)
        rows = written(rows.join(large.where("pairs"), ["r", "a", "b"], "left_semi").select("r", "a", "b", "key", "rep").mapInArrow(_deeper(depth, deeper, bits), CELLS), "cells")
        depth = deeper


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document with an id; runs jobs.

    component_id: the smallest doc_id that can be reached over fingerprints of at most four
    differing bits. Null and empty texts have fingerprint zero and are linked like any other.
    Rows with the same doc_id are separate documents. Exact copies meet in one fingerprint,
    which is compared once.
    """
    marks = written(fingerprints(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "fp"), "fingerprints")
    classes = written(marks.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    found = components(near_links(classes))
    component = classes.join(found, classes["rep"] == found["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return marks.join(component, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, of which each group of near copies keeps the one with the smallest id; runs jobs.

    Of repeated rows with that id all stay; rows without an id go.
    """
    kept = simhash_classes(docs, id_col, text_col).where("doc_id = component_id").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, docs[id_col] == kept["__kept"], "left_semi")


