import math
import re
from collections import Counter

import numpy as np
import pandas as pd

from tilth.llm.ngram_trie import MU, EliasFano, Trie, lm_scores

AZ = {i: i + 32 for i in range(65, 91)}


def test_elias_fano_round_trip_and_search():
    rng = np.random.default_rng(1)
    for n, top in ((1, 0), (1, 10**12), (5, 3), (1000, 50), (1000, 10**9), (4000, 1 << 45), (300, 301)):
        values = np.sort(rng.integers(0, top + 1, n, dtype=np.uint64))
        ef = EliasFano.of(values)
        assert (ef[np.arange(n)] == values).all()
        ask = np.concatenate([values, rng.integers(0, top + 5, 500, dtype=np.uint64)])
        a = rng.integers(0, n + 1, len(ask))
        b = np.maximum(a, rng.integers(0, n + 1, len(ask)))
        found = ef.find(ask, a, b)
        for x, s, e, f in zip(ask, a, b, found):
            inside = values[s:e]
            assert (f == -1 and x not in inside) or (s <= f < e and values[f] == x)
    assert EliasFano.of(np.zeros(0, np.uint64)).find(np.array([3]), np.array([0]), np.array([0])).tolist() == [-1]


def test_trie_finds_every_pair_after_mapping():
    rng = np.random.default_rng(2)
    pairs = sorted({(int(c), int(w)) for c, w in zip(rng.zipf(1.3, 3000) % 10**9, rng.zipf(1.2, 3000) % 10**7)})
    context, word = (np.array(x, np.int64) for x in zip(*pairs))
    value = rng.normal(size=len(pairs))
    trie = Trie.of(context, word, value).mapped()
    assert (trie.find(context, word) == np.arange(len(pairs))).all()
    assert np.abs(trie.book[trie.codes] - value).mean() < 0.02
    missing = [(c, w) for c, w in zip(context + 1, word) if (c, w) not in set(pairs)]
    c, w = (np.array(x) for x in zip(*missing))
    assert (trie.find(c, w) == -1).all()


def plain(rows):
    tokens = {i: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(AZ)) if w] + [None] for i, (_, t, _) in enumerate(rows)}
    train = [i for i, r in enumerate(rows) if r[2]]
    single = Counter(w for i in train for w in tokens[i])
    pair = Counter(p for i in train for p in zip([None, *tokens[i]], tokens[i]))
    n, v = sum(single.values()), len(single)
    out = []
    for i, (d, _, _) in enumerate(rows):
        base = score = 0.0
        for a, b in zip([None, *tokens[i]], tokens[i]):
            p = (single[b] + 1) / (n + v + 1)
            base += math.log10(p)
            score += math.log10((pair[a, b] + MU * p) / (single[a] + MU))
        out.append((d, len(tokens[i]), sum(single[w] > 0 for w in tokens[i]), n, base, score))
    return sorted(out)


def test_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    vocabulary = ["The", "the", "of", "Ämter", "ämter", "x", "\x1c", "a b", *(f"w{i}" for i in range(60))]
    weight = 1 / np.arange(1, len(vocabulary) + 1)
    make = lambda: " ".join(rng.choice(vocabulary, int(rng.integers(0, 80)), p=weight / weight.sum()))
    texts = [make() for _ in range(60)] + [None, "", "\n\t ", "unseen words only", "the " * 5000]
    rows = [(i * 3, t, bool(i % 3)) for i, t in enumerate(texts)] + [(3, texts[1], True)]
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "learn"]).assign(flag="clash", block=1)
    got = sorted(map(tuple, lm_scores(spark.createDataFrame(frame).repartition(4), "learn").collect()))
    for g, w in zip(got, plain(rows), strict=True):
        assert g[:4] == w[:4]
        assert math.isclose(g[4], w[4], rel_tol=1e-9)
        assert abs(g[5] - w[5]) <= 0.01 * w[1] + 0.01  # one byte to a probability


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b", None), (None, "c", True)], "doc_id long, text string, learn boolean")
    assert [tuple(r)[:4] for r in lm_scores(docs, "learn").collect()] == [(1, 3, 0, 0)]
    assert lm_scores(docs.where("false"), "learn").count() == 0
