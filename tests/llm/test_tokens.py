import random
import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tilth.llm import token_files
from tilth.llm.packing import Shares, digest, pack, part_of, phases
from tilth.llm.tokens import Encoder

BPE, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["a", "B", " ", "  ", "\n", " \n", "\t", "!", "'s", "12", "é", " ", "　", "\r\n", "\x1c", "漢字", "🙂", "\x85", "à", "\xa0", " à", "…", "word ", " the"]


def odd_texts(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(BPE)


@pytest.mark.parametrize("ranks", [None, RANKS])
def test_encoder_equals_the_tokenizer(tokenizer, ranks):
    texts = odd_texts(4000) + ["<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "x " * 30000]
    ids, counts = Encoder(BPE, ranks).encode([t.encode() for t in texts])
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == list(map(len, want))
    assert ids.tolist() == [i for w in want for i in w]


def corpus():
    texts = odd_texts(300, 2) + [None, "", "long text " * 4000, "again", "again"]
    sources = ["s1", "s2", None, "rare", "s1"]
    return pd.DataFrame({"doc_id": np.arange(len(texts)) * 5, "text": texts, "source": [sources[i % 5] if i % 5 != 3 or i < 20 else "s1" for i in range(len(texts))], "ids": "clash", "n": 1, "part": 0})


def test_packing_holds_every_id_once(spark, tokenizer):
    frame = corpus()
    got = digest(pack(spark.createDataFrame(frame).repartition(4), BPE, RANKS, window=64)).toPandas()
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for d, t in zip(frame.doc_id, frame.text)}
    for d, own in got.sort_values("start").groupby("doc_id"):
        at = 0
        for r in own.itertuples():
            assert r.start == at and r.doc_tokens == len(ids[d])
            assert r.ids_crc32 == zlib.crc32(np.array(ids[d][at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids[d])
    assert set(got.doc_id) == set(frame.doc_id)
    full = got.sort_values(["sequence_id", "offset"])
    for _, own in full.groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
    sizes = full.groupby("sequence_id").length.sum()
    assert (sizes.iloc[:-1] == 64).all() and sizes.max() <= 64
    # every window holds the sources in their shares, to within some tokens
    source = dict(zip(frame.doc_id, frame.source.fillna("?")))
    by = full.assign(s=full.doc_id.map(source)).groupby(["sequence_id", "s"]).length.sum().unstack(fill_value=0).iloc[:-1]
    share = full.assign(s=full.doc_id.map(source)).groupby("s").length.sum() / full.length.sum()
    assert ((by - 64 * share).abs() < 6).all().all()


def test_packing_edges(spark):
    schema = "doc_id long, text string, source string"
    assert pack(spark.createDataFrame([], schema), BPE).count() == 0
    rows = pack(spark.createDataFrame([(1, None, None), (1, None, None), (None, "x", "s")], schema), BPE, RANKS).collect()
    assert sorted((r.doc_id, r.start, r.length, r.doc_tokens, r.sequence_id, r.offset) for r in rows) == [(1, 0, 1, 1, 0, 0), (1, 0, 1, 1, 0, 1)]


def test_shares_rise_and_end_together():
    rng = np.random.default_rng(1)
    for totals in ([1], [5, 1, 1], rng.integers(1, 5000, 30).tolist(), [10**12, 3, 10**10]):
        shares = Shares(totals, 16)
        last = np.arange(max(0, shares.windows - 500), shares.windows + 1)
        sums = 0
        for s, total in enumerate(totals):
            before, upto = shares.given(s, last)
            own = (upto - before).astype(np.int64)
            assert (np.diff(own) >= 0).all() and own[-1] == total
            sums = sums + own
        assert (np.asarray(sums, object) == np.minimum(last.astype(object) * 16, sum(totals))).all()


def test_parts_of_large_counts_are_exact():
    rng = np.random.default_rng(2)
    for bits in (3, 31, 33, 49):
        for _ in range(50):
            c = int(rng.integers(1, 1 << bits)) + 1
            b = int(rng.integers(0, c + 1))
            a = np.unique(np.concatenate([rng.integers(0, c + 1, 200), [0, c, c - 1]]))
            assert part_of(a, b, c).tolist() == [x * b // c for x in a.tolist()]


def served(totals, weights):
    """Tokens of each source after each token: phase by phase, the sources nested as two queues at a time."""
    given, out = [0] * len(totals), [[0] * len(totals)]
    while any(g < n for g, n in zip(given, totals)):
        open_ = [s for s, (g, n) in enumerate(zip(given, totals)) if g < n and weights[s] > 0]
        open_ = open_ or [s for s, (g, n) in enumerate(zip(given, totals)) if g < n]
        if all(weights[s] > 0 for s in open_):
            level = min(Fraction(totals[s]) / weights[s] for s in open_)
            upto = [min(n, int(weights[s] * level)) if s in open_ else given[s] for s, n in enumerate(totals)]
        else:
            upto = totals
        own = [u - g for u, g in zip(upto, given)]
        for t in range(1, sum(own) + 1):
            taken, left = [0] * len(own), t
            for s in range(len(own) - 1, 0, -1):
                all_, rest = sum(own[: s + 1]), sum(own[:s])
                low = left * rest // all_ if all_ else 0
                taken[s], left = left - low, low
            taken[0] = left
            out.append([g + x for g, x in zip(given, taken)])
        given = list(upto)
    return out


def test_targets_hold_until_a_queue_ends():
    rng = np.random.default_rng(3)
    cases = [([7, 5], [1, 1]), ([40, 3, 90], [2, 1, 0]), ([5], [0]), ([30, 30], [0, 0])]
    cases += [(rng.integers(1, 300, 5).tolist(), rng.integers(0, 6, 5).tolist()) for _ in range(30)]
    for totals, weights in cases:
        shares = Shares(totals, 8, weights)
        want = served(totals, weights)
        windows = np.arange(shares.windows + 1)
        for s in range(len(totals)):
            before, upto = shares.given(s, windows)
            assert (upto - before).tolist() == [want[min(8 * w, sum(totals))][s] for w in windows.tolist()]
    assert [sum(c) for c in zip(*phases([100, 7, 60], [0.5, 0.3, 0]))] == [100, 7, 60]


def test_windows_hold_target_shares(spark, tokenizer):
    frame = corpus()
    docs = spark.createDataFrame(frame).repartition(3)
    names = sorted(frame.source.dropna().unique())
    targets = {names[0]: 3.0, None: 1.0}
    got = pack(docs, BPE, RANKS, window=64, targets=targets).toPandas()
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for d, t in zip(frame.doc_id, frame.text)}
    for d, own in got.sort_values("start").groupby("doc_id"):
        assert np.frombuffer(b"".join(own.ids), "<u4").tolist() == ids[d]
    assert set(got.doc_id) == set(frame.doc_id)
    source = dict(zip(frame.doc_id, frame.source.fillna("?")))
    by = got.assign(s=got.doc_id.map(source)).groupby(["sequence_id", "s"]).length.sum().unstack(fill_value=0)
    both = by[(by.get("?", 0) > 0) & (by[names[0]] > 0)].index.max()
    assert ((by.loc[: both - 1, names[0]] - 48).abs() < 3).all() and ((by.loc[: both - 1, "?"] - 16).abs() < 3).all()
    assert (by.sum(axis=1).iloc[:-1] == 64).all()
    with pytest.raises(ValueError):
        pack(docs, BPE, targets={"a": -1.0})


def test_counts_from_scanned_files(spark, tokenizer):
    frame = corpus()
    docs = spark.createDataFrame(frame).repartition(3)
    for block in (7, 1000, 1 << 19):
        store = token_files.write_tokens(docs, BPE, RANKS, block=block)
        got = {r.doc_id: r.n_tokens for r in token_files.token_counts(store).collect()}
        assert got == {d: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for d, t in zip(frame.doc_id, frame.text)}
    assert token_files.token_counts(token_files.write_tokens(docs.where("false"), BPE)).count() == 0


def test_texts_that_spell_the_end_of_text_are_counted(spark, tokenizer):
    texts = ["<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "<|endoftext|>" * 40, "plain", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    for block in (5, 1 << 19):
        store = token_files.write_tokens(docs, BPE, RANKS, block=block)
        assert {r.doc_id: r.n_tokens for r in token_files.token_counts(store).collect()} == want


@pytest.mark.parametrize("seed", range(3))
def test_scan_matches_splitting(spark, seed):
    rng = np.random.default_rng(seed)
    rows, want = [], {}
    for file in range(4):
        tokens = rng.integers(0, 4 if file else 40, int(rng.integers(0, 400)))  # 0 is the mark
        parts = np.split(tokens, np.sort(rng.integers(0, len(tokens) + 1, 12)))
        rows += [(file, i, p.astype("<u4").tobytes()) for i, p in enumerate(parts)]
        at, own = 0, []
        for piece in "".join(map(chr, tokens)).split("\0"):
            own.append((at, len(piece)))
            at += len(piece) + 1
        if not own[-1][1]:
            own.pop()
        want |= {(file, i): o for i, o in enumerate(own)}
    blocks = spark.createDataFrame(rows, "file int, part int, tokens binary")
    got = {(r.file, r.ordinal): (r.start, r.n_tokens) for r in token_files.scan(blocks, end=0, width=4).collect()}
    assert got == want


def test_raw_files(spark, tmp_path):
    np.array([5, 6, 9, 7, 9, 8], "<u4").tofile(tmp_path / "a.bin")
    (tmp_path / "b.bin").touch()
    blocks = token_files.read_files(spark, str(tmp_path), block=2)
    assert sorted(r.n_tokens for r in token_files.scan(blocks, end=9, width=4).collect()) == [1, 1, 2]
    assert blocks.select("part").dtypes == [("part", "bigint")]


def test_raw_files_are_read_by_ranges(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(6)
    tokens = rng.integers(0, 40, 5000).astype("<u2")
    tokens.tofile(tmp_path / "big one.bin")
    tokens[:7].tofile(tmp_path / "small.bin")
    (tmp_path / "note.txt").write_text("no tokens")
    monkeypatch.setattr(token_files, "SPLIT", 1000)
    blocks = token_files.read_files(spark, str(tmp_path), block=16, ending=".bin")
    assert blocks.rdd.getNumPartitions() >= 10
    assert max(len(r.tokens) for r in blocks.collect()) == 64
    got = {}
    for r in token_files.scan(blocks, end=9, width=2).orderBy("file", "ordinal").collect():
        got.setdefault(r.file.rsplit("/", 1)[1], []).append((r.start, r.n_tokens))
    for name, ids in (("big one.bin", tokens), ("small.bin", tokens[:7])):
        cuts = np.flatnonzero(ids == 9).tolist()
        spans = list(zip([0, *(c + 1 for c in cuts)], [*cuts, len(ids)]))
        assert got[name] == [(a, b - a) for i, (a, b) in enumerate(spans) if b > a or i < len(cuts)]
