"""Bagged regression trees learned from binned rows, whatever their number.

MLlib's trainer keeps an object per row in a cache and reads all of them for every group
of nodes; once memory doesn't hold the cache, each of those readings goes to disk. Here a
row is its label, a byte for each feature (the bin) and a byte for each tree (how often
its bag holds the row), and is written once. Large nodes are split by histograms summed
over all tasks; only the child with fewer rows is summed up, the other's histogram is what
the parent's leaves. The rows of a node of at most ``LOCAL_ROWS`` go to one task, which grows
all that is below it. Candidate splits, choice of splits, leaves and pruning are MLlib's.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilth.session import materialize

#: MLlib's defaults: bins of a feature, and rows from which candidate splits are drawn up.
BINS, CANDIDATE_ROWS = 32, 10_000
#: A node whose bag is at most this large is grown by one task; its rows take about 120 bytes each there.
LOCAL_ROWS = 1 << 22
#: Rows of a written block, rows of a task that are worked on at once, and nodes whose splits are compared at once.
BLOCK, CHUNK, NODES = 1 << 15, 1 << 19, 1 << 10
#: Below this a node's variance is none, as in MLlib.
EPSILON = 2.0**-52

FOUND = "w double, s double, ss double, feature int, cut int, gain double, lw double"
NAMES = tuple(field.split()[0] for field in FOUND.split(", "))


def candidates(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between a feature's values, at most ``bins`` - 1 and evenly filled, by MLlib's rule."""
    found, counts = np.unique(values, return_counts=True)
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) < bins:
        return middle
    stride = target = len(values) / bins
    seen, out = counts[0], []
    for i in range(1, len(found)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def thresholds(rows: DataFrame, n: int, seed: int) -> list[np.ndarray]:
    """Candidate thresholds of each feature; from a sample, as MLlib's, where rows are many. Runs a job."""
    some = rows.select("x") if n <= CANDIDATE_ROWS else rows.select("x").sample(False, CANDIDATE_ROWS / n, seed)
    x = np.array([r["x"] for r in some.collect()])
    return [candidates(x[:, f], min(BINS, n)) for f in range(x.shape[1])]


def binned(rows: DataFrame, cuts: list[np.ndarray], trees: int, bagged: bool, seed: int) -> DataFrame:
    """Blocks of rows: labels, bins (feature by feature) and bag counts (tree by tree), the last drawn from a Poisson distribution of mean one."""

    def block(x: np.ndarray, y: np.ndarray, draw: np.random.Generator) -> pa.RecordBatch:
        if not (np.isfinite(x).all() and np.isfinite(y).all()):
            raise ValueError("features and labels of training rows must be finite")
        codes = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)])
        bag = draw.poisson(1.0, (trees, len(y))) if bagged else np.ones((trees, len(y)))
        blobs = (y.astype(np.float64), codes.astype(np.uint8), bag.astype(np.uint8))
        return pa.RecordBatch.from_arrays([pa.array([b.tobytes()], pa.binary()) for b in blobs], names=["labels", "bins", "bag"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng((seed, TaskContext.get().partitionId()))
        for some in _gathered(parts, BLOCK):
            x = np.concatenate([part.column("x").flatten().to_numpy(zero_copy_only=False) for part in some])
            y = np.concatenate([part.column("label").to_numpy(zero_copy_only=False) for part in some])
            yield block(x.reshape(len(y), len(cuts)), y, draw)

    return rows.mapInArrow(run, "labels binary, bins binary, bag binary")


def _gathered(parts: Iterator[pa.RecordBatch], least: int, size=lambda part: part.num_rows) -> Iterator[list[pa.RecordBatch]]:
    """Batches together, until they are of ``least`` rows or none are left."""
    held, n = [], 0
    for part in parts:
        if not part.num_rows:
            continue
        held.append(part)
        n += size(part)
        if n >= least:
            yield held
            held, n = [], 0
    if held:
        yield held


def _chunks(parts: Iterator[pa.RecordBatch], features: int, trees: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bins (a row per feature), labels and bag counts (a row per tree) of several blocks at a time."""
    blocks = (part.slice(i, 1) for part in parts for i in range(part.num_rows))
    for some in _gathered(blocks, CHUNK, lambda part: len(part["labels"][0].as_buffer()) // 8):
        held = lambda c, kind, width: [np.frombuffer(part[c][0].as_buffer(), kind).reshape(width, -1) for part in some]
        bins, labels, bag = (np.concatenate(held(*c), axis=1) for c in (("bins", np.uint8, features), ("labels", np.float64, 1), ("bag", np.uint8, trees)))
        yield bins, labels[0], bag


class Tree:
    """The upper nodes of one tree, children of a node next to each other."""

    def __init__(self):
        self.found: list[dict] = [{}]
        self.left = [-1]

    def split(self, node: int) -> tuple[int, int]:
        left = self.left[node] = len(self.left)
        self.found += [{}, {}]
        self.left += [-1, -1]
        return left, left + 1

    def route(self, wanted: dict[int, int]) -> dict[int, tuple]:
        """For the wanted nodes and those above: number among the wanted or -1, feature, last bin that goes left, left child."""
        out: dict[int, tuple] = {}
        for node in range(len(self.left) - 1, -1, -1):  # children come after their parent
            left, found = self.left[node], self.found[node]
            below = left >= 0 and (left in out or left + 1 in out)
            if below or node in wanted:
                out[node] = (wanted.get(node, -1), *((found["feature"], found["cut"], left) if below else (-1, -1, -1)))
        return out


def _reached(codes: np.ndarray, bag: np.ndarray, route: dict[int, tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a tree's bag that come to a wanted node, node by node, and that node's number; ``codes`` has a row per feature."""
    rows, numbers, todo = [], [], [(0, np.flatnonzero(bag))]
    while todo:
        node, some = todo.pop()
        number, feature, cut, left = route[node]
        if number >= 0:
            rows.append(some)
            numbers.append(number)
        if left >= 0:
            right = codes[feature][some] > cut
            todo += [(child, some[side]) for child, side in ((left, ~right), (left + 1, right)) if child in route]
    return np.concatenate(rows), np.repeat(numbers, [len(some) for some in rows])


def _sums(codes: np.ndarray, at: np.ndarray, nodes: int, w: np.ndarray, wy: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Weight and weighted label by node, feature and bin; ``codes`` has a row per feature, whose places ``some`` are taken."""
    out = np.empty((2, nodes, len(codes), BINS))
    base = at * BINS
    for f, code in enumerate(codes):
        place = base + code[some]
        for k, values in enumerate((w, wy)):
            out[k, :, f] = np.bincount(place, values, nodes * BINS).reshape(nodes, BINS)
    return out


def _choose(sums: np.ndarray, totals: Sequence[np.ndarray]) -> dict[str, np.ndarray]:
    """Each node's totals and its best split; feature -1 in a leaf. The first of equal splits is taken, as by MLlib."""
    w, s, ss = totals
    left = sums.cumsum(-1)[..., :-1]
    lw, ls = left[0], left[1]
    rw, rs = w[:, None, None] - lw, s[:, None, None] - ls
    with np.errstate(divide="ignore", invalid="ignore"):
        score = ls * ls / lw + rs * rs / rw - (s * s / w)[:, None, None]
    score[(lw <= 0) | (rw <= 0)] = -np.inf
    score = score.reshape(len(w), -1)
    best = score.argmax(1)
    each = np.arange(len(w))
    gain = score[each, best] / w
    leaf = (gain <= 0) | (np.abs(ss - s * s / w) / w < EPSILON)
    feature, cut = np.divmod(best, BINS - 1)
    return {
        "w": w,
        "s": s,
        "ss": ss,
        "feature": np.where(leaf, -1, feature).astype(np.int32),
        "cut": np.where(leaf, -1, cut).astype(np.int32),
        "gain": np.where(leaf, -1.0, gain),
        "lw": lw.reshape(len(w), -1)[each, best],
    }


def _leaves(w: np.ndarray, s: np.ndarray, ss: np.ndarray) -> dict[str, np.ndarray]:
    """As :func:`_choose` for nodes that must be leaves."""
    none = np.full(len(w), -1, np.int32)
    return {"w": w, "s": s, "ss": ss, "feature": none, "cut": none, "gain": none * 1.0, "lw": none * 1.0}


def histograms(rows: DataFrame, routes: dict[int, dict], features: int, trees: int) -> dict[int, tuple[np.ndarray, float]]:
    """Sums (see :func:`_sums`) and weighted squares of the wanted nodes, by their number. Runs a job; some kilobytes per node come back."""

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        numbers = {t: sorted(r[0] for r in route.values() if r[0] >= 0) for t, route in routes.items()}
        for codes, y, bag in _chunks(parts, features, trees):
            for t, route in routes.items():
                some, at = _reached(codes, bag[t], route)
                at = np.searchsorted(numbers[t], at)
                w = bag[t][some].astype(float)
                wy = w * y[some]
                nodes = len(numbers[t])
                new = [_sums(codes, at, nodes, w, wy, some), np.bincount(at, wy * y[some], nodes)]
                held[t] = [a + b for a, b in zip(held[t], new)] if t in held else new
        part = TaskContext.get().partitionId()
        for t, (sums, squares) in held.items():
            blobs = [np.ascontiguousarray(sums[:, i]).tobytes() for i in range(len(squares))]
            where = [np.array(numbers[t], np.int32), np.full(len(squares), part, np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, where), pa.array(blobs, pa.binary()), pa.array(squares)], names=["number", "part", "sums", "squares"])

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        sums = sum(np.frombuffer(b.as_buffer()) for b in group["sums"])
        squares = group["squares"].to_numpy().sum()
        return pa.table({"number": group["number"][:1], "sums": pa.array([sums.tobytes()], pa.binary()), "squares": [squares]})

    parts = rows.mapInArrow(add, "number int, part int, sums binary, squares double")
    found = parts.groupBy("number").applyInArrow(merge, "number int, sums binary, squares double").collect()
    return {r["number"]: (np.frombuffer(r["sums"]).reshape(2, 1, features, BINS), r["squares"]) for r in found}


def grow(codes: np.ndarray, y: np.ndarray, w: np.ndarray, levels: int) -> dict[str, np.ndarray]:
    """The tree over some rows, at most ``levels`` deep; nodes level by level, ``left`` is -1 in a leaf.

    Of two children only the one with fewer rows is summed up by bins; the other's sums are what
    the parent's leave. Totals, which tell leaves and predictions, come from all rows.
    """
    wy = w * y
    wyy = wy * y
    at, nodes, done, out = np.zeros(len(y), np.int64), 1, 0, []
    sums = None
    for level in range(levels + 1):
        totals = [np.bincount(at, v, nodes) for v in (w, wy, wyy)]
        if level == levels:
            out.append({**_leaves(*totals), "left": np.full(nodes, -1)})
            break
        if sums is None:
            sums = _sums(codes, at, nodes, w, wy, np.arange(len(y)))
        else:
            counts = np.bincount(at, minlength=nodes).reshape(-1, 2)
            fewer = np.zeros((nodes // 2, 2), bool)
            fewer[np.arange(nodes // 2), counts.argmin(1)] = True
            some = np.flatnonzero(fewer.ravel()[at])
            own = _sums(codes, at[some] // 2, nodes // 2, w[some], wy[some], some)
            parents, sums = sums, np.empty((2, nodes, *own.shape[2:]))
            sums[:, fewer.ravel()] = own
            sums[:, ~fewer.ravel()] = parents - own
        parts = [_choose(sums[:, i : i + NODES], [v[i : i + NODES] for v in totals]) for i in range(0, nodes, NODES)]
        found = {c: np.concatenate([x[c] for x in parts]) for c in NAMES}
        inner = found["feature"] >= 0
        first = 2 * (np.cumsum(inner) - 1)
        done += nodes
        out.append({**found, "left": np.where(inner, done + first, -1)})
        nodes = 2 * int(inner.sum())
        if not nodes:
            break
        if not inner.all():
            kept = inner[at]
            codes, y, w, wy, wyy, at = codes[:, kept], y[kept], w[kept], wy[kept], wyy[kept], at[kept]
            sums = sums[:, inner]
        right = codes[found["feature"][at], np.arange(len(at))] > found["cut"][at]
        at = first[at] + right
    return {c: np.concatenate([x[c] for x in out]) for c in (*NAMES, "left")}


def grow_small(rows: DataFrame, routes: dict[int, dict], levels: Sequence[int], features: int, trees: int) -> pa.Table:
    """All nodes at and below the wanted ones, whose rows go to one task each; ``levels`` may be grown below. Runs a job."""

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for turn, (codes, y, bag) in enumerate(_chunks(parts, features, trees)):
            for t, route in routes.items():
                some, at = _reached(codes, bag[t], route)
                begin = np.flatnonzero(np.diff(at, prepend=-1))
                groups, ends, n = at[begin], np.append(begin, len(at)).astype(np.int64), len(begin)

                def blobs(values: np.ndarray, size: int) -> pa.Array:
                    held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends * size), pa.py_buffer(values)])
                    return held.cast(pa.binary())

                columns = [groups.astype(np.int32), np.full(n, part, np.int32), np.full(n, turn, np.int32)]
                data = [blobs(np.ascontiguousarray(codes[:, some].T), features), blobs(y[some], 8), blobs(bag[t][some], 1)]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *data], names=["group", "part", "turn", "bins", "labels", "bag"])

    def one(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("part", "ascending"), ("turn", "ascending")])
        joined = lambda c, kind: np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in group[c]])
        codes = np.ascontiguousarray(joined("bins", np.uint8).reshape(-1, features).T)
        labels, bag = joined("labels", np.float64), joined("bag", np.uint8).astype(float)
        number = key[0].as_py()
        del group
        found = grow(codes, labels, bag, levels[number])
        n = len(found["w"])
        return pa.table({"group": np.full(n, number, np.int32), "node": np.arange(n, dtype=np.int32), **found, "left": found["left"].astype(np.int32)})

    dealt = rows.mapInArrow(deal, "group int, part int, turn int, bins binary, labels binary, bag binary")
    return dealt.groupBy("group").applyInArrow(one, f"group int, node int, {FOUND}, left int").toArrow()


def learn(rows: DataFrame, n: int, trees: int, max_depth: int, seed: int, bagged: bool = True) -> tuple[list[dict[str, np.ndarray]], list[np.ndarray]]:
    """Nodes of each tree, pruned and in pre-order, and the thresholds of each feature; runs jobs.

    ``rows`` are the ``n`` written rows (x, label).
    """
    cuts = thresholds(rows, n, seed)
    features = len(cuts)
    rows = materialize(binned(rows, cuts, trees, bagged, seed), "binned")
    grown = [Tree() for _ in range(trees)]
    asked = {t: {0: t} for t in range(trees)} if n > LOCAL_ROWS else {}
    small = [] if asked else [(t, 0, 0) for t in range(trees)]
    route = lambda wanted: {t: grown[t].route(nodes) for t, nodes in wanted.items()}
    summed = histograms(rows, route(asked), features, trees) if asked else {}
    large = {(t, 0): summed[t] for t in asked}
    for depth in range(max_depth + 1):
        asked, pairs = {}, []
        for (t, node), (sums, squares) in large.items():
            totals = [*sums[:, :, 0].sum(-1), np.array([squares])]
            found = _choose(sums, totals) if depth < max_depth else _leaves(*totals)
            got = grown[t].found[node] = {c: v[0] for c, v in found.items()}
            if got["feature"] < 0:
                continue
            weights = dict(zip(grown[t].split(node), (got["lw"], got["w"] - got["lw"])))
            small += [(t, child, depth + 1) for child, weight in weights.items() if weight <= LOCAL_ROWS]
            if max(weights.values()) > LOCAL_ROWS:
                fewer, more = sorted(weights, key=weights.get)
                asked.setdefault(t, {})[fewer] = len(pairs)
                pairs.append((t, sums, squares, fewer, more, weights[fewer] > LOCAL_ROWS))
        summed = histograms(rows, route(asked), features, trees) if asked else {}
        large = {}
        for i, (t, sums, squares, fewer, more, both) in enumerate(pairs):
            large[t, more] = (sums - summed[i][0], squares - summed[i][1])
            large |= {(t, fewer): summed[i]} if both else {}
    wanted = {}
    for i, (t, node, _) in enumerate(small):
        wanted.setdefault(t, {})[node] = i
    below = grow_small(rows, route(wanted), [max_depth - level for _, _, level in small], features, trees) if small else None
    return [in_order(joined(tree)) for tree in _with_small(grown, small, below)], cuts


def _with_small(grown: list[Tree], small: list[tuple[int, int, int]], below: pa.Table | None) -> list[tuple[Tree, list]]:
    """Each tree with what tasks have grown below its nodes: (node, its columns by place)."""
    parts: list[list] = [[] for _ in grown]
    if below is not None:
        table = {c: below[c].to_numpy() for c in below.column_names}
        order = np.lexsort((table["node"], table["group"]))
        ends = np.searchsorted(table["group"][order], np.arange(len(small) + 1))
        for i, (t, node, _) in enumerate(small):
            own = order[ends[i] : ends[i + 1]]
            parts[t].append((node, {c: table[c][own] for c in (*NAMES, "left")}))
    return list(zip(grown, parts))


def joined(tree: tuple[Tree, list]) -> dict[str, np.ndarray]:
    """One tree's nodes as columns; what was grown below a node takes its place and follows after the others."""
    top, parts = tree
    n = len(top.left)
    out = {c: [np.array([found.get(c, -1) for found in top.found], float)] for c in NAMES}
    out["left"] = [np.array(top.left, float)]
    for node, found in parts:
        left = np.where(found["left"] > 0, found["left"] + n - 1, -1)
        for c, values in {**found, "left": left}.items():
            out[c][0][node] = values[0]
            out[c].append(values[1:])
        n += len(left) - 1
    whole = {c: np.concatenate(values) for c, values in out.items()}
    return {c: v.astype(np.int64) if c in ("feature", "cut", "left", "w") else v for c, v in whole.items()}


def in_order(tree: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The nodes in pre-order; two leaves of one prediction become one, from the bottom up, as by MLlib."""
    left, mean = tree["left"].copy(), tree["s"] / tree["w"]
    levels = [np.array([0])]
    while len(inner := levels[-1][left[levels[-1]] >= 0]):
        levels.append(np.concatenate([left[inner], left[inner] + 1]))
    size = np.ones(len(left), np.int64)
    for nodes in reversed(levels):
        inner = nodes[left[nodes] >= 0]
        a, b = left[inner], left[inner] + 1
        same = (left[a] < 0) & (left[b] < 0) & (mean[a] == mean[b])
        size[inner] = np.where(same, 1, 1 + size[a] + size[b])
        left[inner[same]] = -1
    place = np.full(len(left), -1, np.int64)
    place[0] = 0
    for nodes in levels:
        inner = nodes[(left[nodes] >= 0) & (place[nodes] >= 0)]
        place[left[inner]] = place[inner] + 1
        place[left[inner] + 1] = place[inner] + 1 + size[left[inner]]
    kept = np.flatnonzero(place >= 0)
    kept = kept[np.argsort(place[kept])]
    inner, first = left[kept] >= 0, np.maximum(left[kept], 0)
    w, s, ss = (tree[c][kept] for c in ("w", "s", "ss"))
    return {
        "id": np.arange(len(kept)),
        "prediction": mean[kept],
        "impurity": (ss - s * s / w) / w,
        "w": w,
        "s": s,
        "ss": ss,
        "gain": np.where(inner, tree["gain"][kept], -1.0),
        "left": np.where(inner, place[first], -1),
        "right": np.where(inner, place[np.minimum(first + 1, len(place) - 1)], -1),
        "feature": np.where(inner, tree["feature"][kept], -1),
        "cut": np.where(inner, tree["cut"][kept], -1),
    }


def node_rows(spark: SparkSession, trees: list[dict[str, np.ndarray]], cuts: list[np.ndarray]) -> DataFrame:
    """The nodes as MLlib stores them: (treeID, nodeData)."""
    columns = {c: np.concatenate([t[c] for t in trees]) for c in trees[0]}
    columns["tree"] = np.repeat(np.arange(len(trees)), [len(t["id"]) for t in trees])
    table = np.zeros((len(cuts), BINS))
    for f, c in enumerate(cuts):
        table[f, : len(c)] = c
    columns["threshold"] = table[columns["feature"], columns["cut"]]
    whole = lambda c: F.col(c).cast("int")
    split = F.struct(
        whole("feature").alias("featureIndex"),
        F.when(F.col("feature") >= 0, F.array("threshold")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    node = F.struct(
        whole("id").alias("id"),
        "prediction",
        "impurity",
        F.array(F.col("w").cast("double"), "s", "ss").alias("impurityStats"),
        F.col("w").cast("long").alias("rawCount"),
        "gain",
        whole("left").alias("leftChild"),
        whole("right").alias("rightChild"),
        split.alias("split"),
    )
    return spark.createDataFrame(pa.table(columns)).select(whole("tree").alias("treeID"), node.alias("nodeData"))
