import numpy as np
import pandas as pd
import pytest
import xxhash

from tilth.llm.simhash import fingerprint, near_links, one_of_each, simhash_classes, trie_components

AZ = {i: i + 32 for i in range(65, 91)}


def plain_fingerprint(text):
    words = (text or "").translate(AZ).replace("\x1c", "\x1c")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, bits=4):
    parent = {i: i for i in range(len(ids))}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        least[root(i)] = min(least.get(root(i), d), d)
    return [least[root(i)] for i in range(len(ids))]


TEXTS = ["", None, "  \n ", "One", "ONE", "a b c", "Ünïcode Straße A B C d", "same same same same same same", "x " * 70000, "same same same same same same"]


def test_fingerprint_is_the_plain_one():
    rng = np.random.default_rng(1)
    texts = TEXTS + [" ".join(rng.choice(["a", "B", "cc d", "\t", "é"], rng.integers(1, 60))) for _ in range(60)]
    for t in texts:
        assert fingerprint((t or "").encode()) == plain_fingerprint(t)


@pytest.mark.parametrize("seed", range(4))
def test_trie_walk_links_what_brute_force_links(seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    keys = {int(c) for c in rng.integers(0, 1 << 63, 300, dtype=np.uint64)}
    for c in centres:
        for _ in range(12):
            keys.add(int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)))
    keys = np.array(sorted(keys), np.uint64)
    # one node, no bits fixed: pairs whose first segment differs in one bit at most
    labels = trie_components(keys, 0, 0, 21)
    top = np.uint64(43)
    near = lambda i, j: int(np.bitwise_count(keys[i] ^ keys[j])) <= 4 and int(np.bitwise_count((keys[i] ^ keys[j]) >> top)) <= 1
    full = plain_components(list(range(len(keys))), [int(k) for k in keys])
    for i in range(len(keys)):
        assert full[labels[i]] == full[i]
        for j in range(i):
            assert not near(i, j) or labels[i] == labels[j]


def test_classes_match_brute_force(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = list(TEXTS)
    for _ in range(40):
        words = list(rng.choice(vocabulary, rng.integers(60, 400)))
        texts.append(" ".join(words))
        for _ in range(rng.integers(0, 4)):
            edited = list(words)
            edited[rng.integers(len(words))] = "changed"
            texts.append(" ".join(edited))
    ids = [int(i) for i in rng.permutation(len(texts)) * 3]
    frame = pd.DataFrame({"doc_id": ids, "text": texts, "fp": 1, "rep": "clash", "component_id": 0})
    got = simhash_classes(spark.createDataFrame(frame)).toPandas().set_index("doc_id")
    fps = [plain_fingerprint(t) for t in texts]
    assert [got.loc[i, "fingerprint"] for i in ids] == [f"{f:016x}" for f in fps]
    assert [got.loc[i, "component_id"] for i in ids] == plain_components(ids, fps)


def test_empty_null_ids_and_repeats(spark):
    docs = spark.createDataFrame([(None, "x"), (1, "a b"), (1, "a b"), (2, "a b")], "doc_id long, text string")
    assert sorted(map(tuple, simhash_classes(docs).select("doc_id", "component_id").collect())) == [(1, 1), (1, 1), (2, 1)]
    assert [r.doc_id for r in one_of_each(docs).collect()] == [1, 1]
    assert simhash_classes(docs.where("false")).count() == 0


@pytest.mark.parametrize("full, cell", [(250, 60), (1 << 18, 30)])
def test_full_cells_are_dealt_to_deeper_ones(spark, full, cell):
    rng = np.random.default_rng(5)
    keys = {int(k) for k in rng.integers(0, 1 << 63, 200, dtype=np.uint64)}
    # families that agree in whole segments: in the first and second, in the last, in all but the last bits
    for fixed, n in (((1 << 22) - 1, 300), (((1 << 42) - 1) << 22, 150), ((1 << 8) - 1, 120)):
        base = int(rng.integers(0, 1 << 63))
        for _ in range(n):
            keys.add(base ^ sum({1 << int(b) for b in rng.choice(64, 9)} & {1 << b for b in range(64) if fixed >> b & 1}))
    keys = sorted(keys)
    fps = spark.createDataFrame([(k - (1 << 64) if k >> 63 else k, i) for i, k in enumerate(keys)], "fp long, rep long")
    parent = list(range(len(keys)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for u, v in near_links(fps, full=full, cell=cell).collect():
        parent[max(root(u), root(v))] = min(root(u), root(v))
    assert [root(i) for i in range(len(keys))] == plain_components(list(range(len(keys))), keys)
