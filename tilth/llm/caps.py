"""Near-duplicate embeddings by spherical-cap filters with structured random product codes.

Space is turned at random and cut into two halves with a code of random directions each; a
filter is a pair of codes, its direction the two side by side. A vector belongs to every
filter whose direction it exceeds a threshold on. They are listed without trying all pairs:
for each code of the first half, the codes of the second, sorted by their part of the sum,
are taken as far as the sum suffices. Vectors that share a filter are compared exactly. Of
the filters that two vectors share only the smallest counts their link.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import pick, written
from tilth.llm.components import components
from tilth.llm.simhash import union

COSINE = 0.95
#: Filters that a vector exceeds and vectors in a filter, both on average.
LISTED, LOAD = 10, 512
#: Codes of their own, each with its turn; pairs that one code misses meet in another.
CODES = 4
#: A cap's threshold, as a cosine, is this at most.
WIDEST = 0.6
#: A filter with more vectors is cut into blocks of about this many, and its pairs of blocks are compared apart.
GROUP = 2048
SEED = 17
#: Coordinates, turns and codes are whole numbers of these units, so sums are exact in any order.
UNIT, TURN = 1 << 15, 1 << 9


class Codes:
    """The filters for vectors of one length."""

    def __init__(self, dim: int, n: int, listed: float = LISTED, load: int = LOAD, seed: int = SEED):
        rng = np.random.default_rng([seed, dim])
        self.half = max(1, math.ceil(dim / 2))
        width = 2 * self.half
        self.size = max(16, math.ceil(math.sqrt(n * listed / load)))
        turn = np.linalg.qr(rng.standard_normal((width, width)))[0][:, :dim]
        self.turn = np.rint(turn * TURN)
        codes = rng.standard_normal((2, self.size, self.half))
        self.codes = np.rint(codes / np.linalg.norm(codes, axis=2, keepdims=True) * math.sqrt(self.half) * TURN / 4)
        self.least = self._threshold(rng, min(0.5, listed / self.size**2))

    def _threshold(self, rng: np.random.Generator, share: float) -> float:
        """The sum that this share of filters exceeds on random vectors; below what a trial can tell, by the normal law."""
        tried = units(rng.standard_normal((2048, self.turn.shape[1])))
        first, second = self._sums(tried)
        i, j = rng.integers(0, self.size, (2, 1024))
        sums = first[:, i] + second[:, j]
        told = max(share, 1e-5)
        law = NormalDist()
        least = np.quantile(sums, 1 - told) + (law.inv_cdf(1 - share) - law.inv_cdf(1 - told)) * sums.std()
        # in few dimensions a cap must stay wide enough for two linked vectors
        return float(min(least, WIDEST * UNIT * TURN * TURN / 4 * math.sqrt(2 * self.half)))

    def _sums(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turned = np.rint(unit * UNIT) @ self.turn.T
        return turned[:, : self.half] @ self.codes[0].T, turned[:, self.half :] @ self.codes[1].T

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of all filters that the unit vectors exceed."""
        first, second = self._sums(unit)
        order = np.argsort(-second, axis=1, kind="stable")
        sums = np.take_along_axis(second, order, axis=1)
        row, code = np.nonzero(first + sums[:, :1] >= self.least)
        rows, filters = [], []
        for at in range(0, len(row), 1 << 18):
            r, c = row[at : at + (1 << 18)], code[at : at + (1 << 18)]
            taken = (sums[r] >= (self.least - first[r, c])[:, None]).sum(axis=1) if self.size <= 64 else _prefix(sums, r, self.least - first[r, c])
            step = np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken)
            r2 = np.repeat(r, taken)
            rows.append(r2)
            filters.append(np.repeat(c, taken).astype(np.int64) * self.size + order[r2, step])
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(rows), np.concatenate(filters)


class Family:
    """Several codes; the filters of all are numbered in a row."""

    def __init__(self, dim: int, n: int):
        self.codes = [Codes(dim, n, seed=SEED + k) for k in range(CODES)]

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, filters = zip(*(c.decode(unit) for c in self.codes))
        return np.concatenate(rows), np.concatenate([f + k * self.codes[0].size ** 2 for k, f in enumerate(filters)])


_families: dict[tuple[int, int], Family] = {}


def family(dim: int, n: int) -> Family:
    """One for each worker process."""
    if (dim, n) not in _families:
        _families[dim, n] = Family(dim, n)
    return _families[dim, n]


def _prefix(sums: np.ndarray, row: np.ndarray, least: np.ndarray) -> np.ndarray:
    """How many of a row's falling sums are at least the bound, by halving."""
    low, high = np.zeros(len(row), np.int64), np.full(len(row), sums.shape[1], np.int64)
    while (low < high).any():
        mid = (low + high) // 2
        ok = (low < high) & (sums[row, np.minimum(mid, sums.shape[1] - 1)] >= least)
        low = np.where(ok, mid + 1, low)
        high = np.where(ok | (low >= high), high, mid)
    return low


def units(vectors: np.ndarray) -> np.ndarray:
    v = np.ascontiguousarray(vectors, np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # squares of very large or small numbers stay in range
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _decoder(n: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            dims = part.column(2).to_numpy()
            for dim in np.unique(dims).tolist():
                rows = part.filter(pa.array(dims == dim))
                for at in range(0, rows.num_rows, 512):
                    some = rows.slice(at, 512)
                    row, number = family(dim, n).decode(units(_matrix(some.column(3), dim)))
                    yield some.take(pa.array(row)).append_column("filter", pa.array(number))

    return run


def _compare(n: int, least: float):
    """Links of one filter, or of two of its blocks: (u, v, links) with v the smallest vector joined here."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        dim, number, a, b = (k.as_py() for k in key)
        rep = group.column("rep").to_numpy()
        order = np.argsort(rep, kind="stable")
        rep, size, block = rep[order], group.column("size").to_numpy()[order], group.column("block").to_numpy()[order]
        unit = units(_matrix(group.column("vector"), dim)[order])
        left = np.flatnonzero(block == a)
        right = left if a == b else np.flatnonzero(block == b)
        found = []
        for at in range(0, len(left), 512):
            rows = left[at : at + 512]
            i, j = np.nonzero(unit[rows] @ unit[right].T >= least)
            i, j = rows[i], right[j]
            found.append((i[i < j], j[i < j]) if a == b else (i, j))
        i, j = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
        links = np.zeros(len(rep), np.int64)
        labels = np.arange(len(rep))
        if len(i):
            own = _first(unit, i, j, number, family(dim, n))
            i, j = i[own], j[own]
            np.add.at(links, i, size[j])
            np.add.at(links, j, size[i])
            labels = union(labels, i, j)
        told = np.flatnonzero(links)
        return pa.table({"u": rep[told], "v": rep[labels[told]], "links": links[told]})

    return run


def _first(unit: np.ndarray, i: np.ndarray, j: np.ndarray, number: int, codes: Family) -> np.ndarray:
    """Which pairs share no filter smaller than ``number``."""
    some, place = np.unique(np.concatenate([i, j]), return_inverse=True)
    i, j = place[: len(i)], place[len(i) :]
    row, filters = codes.decode(unit[some])
    row, filters = row[filters < number], filters[filters < number]
    order = np.lexsort((row, filters))
    row, filters = row[order], filters[order]
    earlier = np.zeros((len(some), len(some)), bool)
    for members in np.split(row, np.flatnonzero(np.diff(filters)) + 1):
        if len(members) > 1:
            earlier[np.ix_(members, members)] = True
    return ~earlier[i, j]


def cosine_classes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector with an id; runs jobs.

    Links join pairs whose cosine in double precision is ``least`` or more; vectors that are
    null, zero, empty or hold a null or a number that isn't finite have none, nor have vectors
    of different length. Equal vectors are compared once and counted each. Rows are vectors of
    their own; those with one id are one node of the components.
    """
    source = pick(vectors, vec_id=id_col, vector=vector_col).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    sound = F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = source.select("vec_id", F.when(sound, F.col("vector")).alias("vector"))
    good = rows.where("vector is not null")
    classes = written(good.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size")).select("rep", "size", F.size("vector").cast("long").alias("dim"), "vector"), "classes")
    n, kind = classes.count(), dict(classes.dtypes)["vector"]
    listed = classes.mapInArrow(_decoder(n), f"rep long, size long, dim long, vector {kind}, filter long")
    load = written(listed.groupBy("dim", "filter").agg(F.count("*").alias("load")).where(F.col("load") > GROUP), "full-filters")
    blocks = F.coalesce(F.ceil(F.col("load") / GROUP), F.lit(1))
    split = listed.join(load, ["dim", "filter"], "left").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = split.withColumn("other", other).select("dim", "filter", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "rep", "size", "vector")
    links = written(dealt.groupBy("dim", "filter", "a", "b").applyInArrow(_compare(n, least), "u long, v long, links long"), "links")
    found = components(links.select("u", "v"))
    counts = links.groupBy("u").agg(F.sum("links").alias("others"))
    told = classes.join(counts, classes["rep"] == counts["u"], "left").join(found, classes["rep"] == found["node"], "left")
    told = told.select("vector", (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    linked = good.join(told, "vector").select("vec_id", "n_links", "component_id")
    alone = rows.where("vector is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
