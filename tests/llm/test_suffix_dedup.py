import hashlib

import numpy as np
import pandas as pd
import pytest
import zstandard

from tilth.llm import suffix_dedup
from tilth.llm.blocks import Block
from tilth.llm.suffix_dedup import least_documents, remove_repeats


def plain(ids, texts):
    """Bytes left of each text, and runs removed."""
    first = {}
    raw = [(t or "").encode() for t in texts]
    for d, t in zip(ids, raw):
        for i in range(len(t) - 49):
            first[t[i : i + 50]] = min(d, first.get(t[i : i + 50], d))
    out = []
    for d, t in zip(ids, raw):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 49):
            if first[t[i : i + 50]] < d:
                gone[i : i + 50] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(t) else 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed, n=60):
    rng = np.random.default_rng(seed)
    words = ["alpha", "beta", "gämma", "δ", "x", "the quick", "0123456789" * 3]
    make = lambda k: " ".join(rng.choice(words, k))
    shared = [make(30) for _ in range(4)]
    texts = []
    for _ in range(n):
        parts = [make(int(rng.integers(0, 40)))]
        if rng.random() < 0.7:
            s = shared[rng.integers(4)]
            a = rng.integers(0, 40)
            parts += [s[a : a + int(rng.integers(30, 160))], make(int(rng.integers(0, 10)))]
        texts.append("".join(parts))
    texts += [None, "", "a" * 300, "a" * 49, "a" * 50, "b" + "a" * 120, texts[0], texts[0], "z" * 49, "ab" * 2000]
    return [int(i) for i in rng.permutation(len(texts)) * 7], texts


def test_least_documents():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 3, 400, dtype=np.uint8)
    pool = np.concatenate([base, base[37:300], base[100:260], np.zeros(64, np.uint8)])
    n = len(pool) - 64
    suffix = np.arange(n - 50)
    doc = rng.integers(0, 100, len(suffix))
    first = {}
    for i, d in zip(suffix, doc):
        k = pool[i : i + 50].tobytes()
        first[k] = min(d, first.get(k, d))
    assert least_documents(pool, suffix, doc).tolist() == [first[pool[i : i + 50].tobytes()] for i in suffix]


@pytest.mark.parametrize("seed,sorted_", [(1, 1 << 20), (2, 300)])
def test_matches_brute_force(spark, seed, sorted_, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SORTED", sorted_)
    ids, texts = corpus(seed)
    frame = pd.DataFrame({"doc_id": ids, "text": texts, "block": "clash", "flag": 1, "ids": "x"})
    docs = spark.createDataFrame(frame).repartition(5)
    got = sorted(map(tuple, remove_repeats(docs).collect()))
    assert got == plain(ids, texts)


def test_a_group_grows_with_blocks_not_with_documents(monkeypatch):
    rng = np.random.default_rng(5)
    line, *texts = ("".join(map(chr, rng.integers(97, 123, n))) for n in [120] + [100] * 400)
    texts = [a + line + b for a, b in zip(texts[:200], texts[200:])]
    blocks = []
    for n in (0, 1):
        own = [t.encode() for t in texts[100 * n : 100 * n + 100]]
        columns = np.arange(100) + 100 * n, np.zeros(100, np.uint8), np.array(list(map(len, own)))
        blocks.append(Block(n, *(c.tobytes() for c in columns), zstandard.compress(b"".join(own))))
    sizes = []
    monkeypatch.setattr(suffix_dedup, "SORTED", 300)
    monkeypatch.setattr(suffix_dedup, "least_documents", lambda pool, suffix, doc: sizes.append(len(suffix)) or least_documents(pool, suffix, doc))

    def told(ask, answer, *before):
        asked, out = {}, ([], [])
        for block in blocks:
            for bucket, blob in ask(block, *(b[block.number] for b in before)):
                asked.setdefault(bucket, []).append((block.number, blob))
        for bucket in sorted(asked):
            for (n, _), blob in zip(asked[bucket], answer(bucket, [b for _, b in asked[bucket]])):
                out[n].append((bucket, blob))
        return out

    keys = told(suffix_dedup.ask_keys(4), suffix_dedup.answer_keys)
    pieces = told(suffix_dedup.ask_pieces(4), suffix_dedup.answer_pieces, keys)
    assert max(sizes) <= 2 * 300  # what fits, and the rest of the last group
    rows = [r for b in blocks for part in suffix_dedup.cut(4, False)(b, keys[b.number], pieces[b.number]) for r in part.to_pylist()]
    assert [tuple(r.values()) for r in rows] == plain(range(200), texts)


def test_repeated_rows_empty_and_null_ids(spark):
    long = "".join(chr(97 + i * i % 26) for i in range(90))
    docs = spark.createDataFrame([(1, long), (1, long), (2, long), (None, long)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in remove_repeats(docs).collect()) == [(1, 0), (1, 0), (2, 90)]
    assert remove_repeats(docs.where("false")).count() == 0
    kept = {r.doc_id: r.kept_text for r in remove_repeats(docs, with_text=True).collect()}
    assert kept == {1: long, 2: ""}
