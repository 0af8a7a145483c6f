import math
from fractions import Fraction

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tilth.llm import langid

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def sums(word, probs):
    """Probability of a word over all segmentations, by trying every one."""
    if not word:
        return 1.0
    return sum(p * sums(word[len(k) :], probs) for k, p in probs.items() if word.startswith(k))


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(1)
    names = [b"a", b"b", b"ab", b"ba", b"aab", b" a", b" ", b"abababab", b"bbbb"]
    pieces = langid.Pieces(names)
    probs = rng.dirichlet(np.ones(len(names)), 3).T
    words = [b" " + bytes(rng.choice([97, 98], rng.integers(1, 14)).tolist()) for _ in range(60)]
    got = langid.word_logs(words, pieces, np.vstack([probs, np.zeros(3)]))
    for w, row in zip(words, got):
        for k in range(3):
            assert np.isclose(row[k], np.log(sums(w, dict(zip(names, probs[:, k])))))
    names = [b"a", b"b", b"ab", b"abababababab", b"ba" * 10, b"b" * 9, b"a" * 60, b"x", b" "]
    pieces = langid.Pieces(names)
    probs = np.array([[1e-8, 0.3], [1e-9, 0.2], [1e-7, 0.1], [0.2, 0.1], [0.3, 0.1], [0.1, 0.1], [0.2, 0.05], [0.1, 0.05], [0.1, 0.1]])
    words = [b" " + w for w in (b"ab" * 9, b"ba" * 11 + b"b" * 10, b"a" * 59, b"a" * 61, b"b" * 9 + b"a" * 130 + b"x", b"abababababa")]
    got = langid.word_logs(words, pieces, np.vstack([probs, np.zeros(2)]))
    for w, row in zip(words, got):
        for k in range(2):
            ways = [Fraction(1)] + [Fraction(0)] * len(w)
            shares = [Fraction(p) for p in probs[:, k].tolist()]
            for at in range(1, len(w) + 1):
                ways[at] = sum(ways[at - len(n)] * p for n, p in zip(names, shares) if w[:at].endswith(n))
            exact = math.log(ways[-1].numerator) - math.log(ways[-1].denominator)
            assert math.isclose(row[k], exact, rel_tol=1e-9)
    long = langid.word_logs([b" " + b"ab" * 5000], pieces, np.vstack([probs, np.zeros(2)]))
    assert np.isfinite(long).all()


def test_learning_raises_the_likelihood():
    rng = np.random.default_rng(2)
    pieces = langid.Pieces(sorted({*(bytes([b]) for b in range(256)), b" the", b"ing", b" a", b"he"}))
    words = [b" the", b" thing", b" a", b" he", b" heing"]
    counts = rng.integers(1, 50, len(words)).astype(float)
    fits = [counts @ langid.word_logs(words, pieces, np.append(langid.learn_pieces(words, counts, pieces, rounds=r), 0)[:, None])[:, 0] for r in (1, 3, 6)]
    assert fits[0] < fits[1] < fits[2]


def test_learning_counts_every_segmentation():
    names = sorted({*(bytes([b]) for b in range(256)), b" the", b"ing", b" thingthingthingthing", b"ingthing"})
    pieces = langid.Pieces(names)
    words = [b" the", b" thing", b" " + b"thing" * 4, b" " + b"thing" * 20]  # the last of 101 bytes
    counts = np.array([3.0, 2, 5, 7])
    got = langid.learn_pieces(words, counts, pieces, rounds=1, prior=0.05)
    p, expected = Fraction(1, len(names)), dict.fromkeys(names, 0.0)
    for w, n in zip(words, counts):
        front, back = [Fraction(1)], [Fraction(0)] * len(w) + [Fraction(1)]
        for at in range(1, len(w) + 1):
            front.append(sum(front[at - len(k)] * p for k in names if w[:at].endswith(k)))
        for at in range(len(w) - 1, -1, -1):
            back[at] = sum(p * back[at + len(k)] for k in names if w.startswith(k, at))
            for k in names:
                if w.startswith(k, at):
                    expected[k] += n * float(front[at] * p * back[at + len(k)] / front[-1])
    want = np.array([expected[k] + 0.05 for k in names])
    assert np.allclose(got, want / want.sum(), rtol=1e-9)


def test_whole_vocabulary_is_used():
    assert max(map(len, langid.vocabulary(PATH))) > 30
    assert len(langid.vocabulary(PATH)) >= 50_256
    every = langid.vocabulary(PATH)
    pieces = langid.Pieces(every)
    long = [p for p in every if len(p) > 8]
    for i in range(0, len(long), 97):
        n = len(long[i])
        ((number,),) = [numbers for length, _, numbers in pieces.longer(np.frombuffer(long[i], np.uint8)[None])[n] if length == n]
        assert every[number] == long[i]


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    words = {"xx": ["the", "and", "of", "with", "house"], "yy": ["der", "und", "von", "mit", "straße"], "zz": ["été", "où", "garçon", "forêt", "être"]}
    rows = [(i, " ".join(rng.choice(words[lang], 12)), lang if i % 4 else None, lang, 1) for i, lang in enumerate(["xx", "yy", "zz"] * 30)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string, score int")


def test_predicts_held_out_documents(spark, docs):
    out = langid.held_out(F.col("doc_id"), 4, 2)
    models = langid.learn(docs.where(~out), PATH)
    assert list(models) == ["xx", "yy", "zz"]
    got = langid.predict(docs, models, PATH).toPandas().set_index("doc_id")
    truth = docs.toPandas().set_index("doc_id")["truth"]
    assert (got["lang_pred"] == truth).all()
    assert got["score"].between(0, 1).all()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "THE 1 house"), (4, "und"), (None, "x"), (5, "漢" * 3000)], "doc_id long, text string")
    rows = langid.predict(odd, models, PATH).toPandas()
    assert rows[rows.doc_id <= 3]["lang_pred"].tolist() == ["und"] * 3
    assert rows[rows.doc_id <= 3]["score"].tolist() == [0.0] * 3
    assert rows[rows.doc_id == 4]["lang_pred"].tolist() == ["xx", "yy"] and len(rows) == 6


def test_nothing_learned_and_rejection(spark, docs):
    assert langid.learn(docs.where("false"), PATH) == {}
    assert {r.lang_pred for r in langid.predict(docs, {}, PATH).collect()} == {"und"}
    models = langid.learn(docs, PATH)
    some = docs.union(spark.createDataFrame([(1000, "42", "xx", "", 0)], docs.schema))
    kept = langid.accepted(some, models, PATH)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert all(r.lang == r.truth for r in kept.collect())  # a null lang is filled
    only = langid.accepted(some.union(some), models, PATH, only=("yy", "zz"))
    assert only.count() == 2 * docs.where("truth <> 'xx'").count()
    assert langid.predict(docs.where("false"), models, PATH).count() == 0


def test_sample_follows_its_bound(spark):
    frame = pd.DataFrame({"doc_id": range(4000), "text": "the house", "lang": "xx"})
    assert list(langid.learn(spark.createDataFrame(frame), PATH, sample=50)) == ["xx"]
