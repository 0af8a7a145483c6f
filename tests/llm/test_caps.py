import numpy as np
import pytest

from tilth.llm import caps
from tilth.llm.caps import Codes, cosine_classes, units


def plain(rows, least=0.95):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for a in ok:
        for b in ok:
            if a < b and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1]) / np.abs(rows[k][1]).max() for k in (a, b))
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                    links[a] += 1
                    links[b] += 1
                    parent[root(a)] = root(b)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), d), d)
    return {d: (links[i], low[root(i)], low[root(i)] == d) for i, (d, _) in enumerate(rows)}


def corpus(seed, dim, n=250):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 5, dim))
    vectors = [*rng.normal(size=(n, dim)), *(c + 0.25 * rng.normal(size=dim) for c in centres for _ in range(4))]
    vectors = [np.round(v, 6).tolist() for v in vectors]
    vectors += [vectors[0]] * 6 + [(3 * np.array(vectors[1])).tolist()]
    vectors += [None, [], [0.0] * dim, [float("nan")] * dim, [float("inf"), *[1.0] * (dim - 1)], [None, *[1.0] * (dim - 1)], [1.0] * (dim + 3), [1e-200] * dim]
    return [(int(i) * 2, v) for i, v in zip(rng.permutation(len(vectors)), vectors)]


@pytest.mark.parametrize("dim,group", [(64, 2048), (8, 40), (1, 2048)])
def test_matches_brute_force(spark, dim, group, monkeypatch):
    monkeypatch.setattr(caps, "GROUP", group)
    rows = corpus(dim, dim)
    frame = spark.createDataFrame([(d, v, "clash", 1) for d, v in rows], "vec_id long, embedding array<double>, rep string, size int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cosine_classes(frame).collect()}
    want = plain(rows)
    linked = sum(v[0] for v in want.values())
    assert set(got) == set(want)
    assert all(got[d][0] <= want[d][0] for d in want)
    assert sum(v[0] for v in got.values()) >= 0.99 * linked
    assert sum(got[d][1] == want[d][1] for d in want) >= 0.99 * len(want)


def test_lists_exactly_the_filters_exceeded():
    rng = np.random.default_rng(1)
    for dim, n in ((64, 5000), (5, 300), (64, 2_000_000)):
        codes = Codes(dim, n)
        x = units(rng.normal(size=(40, dim)))
        row, number = codes.decode(x)
        first, second = codes._sums(x)
        want = np.argwhere((first[:, :, None] + second[:, None, :] >= codes.least).reshape(40, -1))
        assert sorted(zip(row.tolist(), number.tolist())) == list(map(tuple, want.tolist()))


def test_edges(spark):
    schema = "vec_id long, embedding array<float>"
    assert cosine_classes(spark.createDataFrame([], schema)).count() == 0
    rows = spark.createDataFrame([(None, [1.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (3, [1.0, 2.0])], schema)
    assert sorted(map(tuple, cosine_classes(rows).collect())) == [(3, 2, 3, True), (7, 2, 3, False), (7, 2, 3, False)]
