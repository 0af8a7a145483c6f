import re

import numpy as np
import pandas as pd

from tilth.llm.notices import NOTICES, Notice, apart, find_notices, licence_report, scan

AZ = {i: i + 32 for i in range(65, 91)}
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def words(text):
    return WORD.findall((text or "").translate(AZ))


def base_places(text):
    own = words(text)
    return [(i, label) for phrase, label in BASE.items() for i in range(len(own)) if own[i : i + len(phrase.split())] == phrase.split()]


def least_edits(own, n):
    """Fewest edits between the notice and any run of whole words; None if the fixed part is nowhere."""
    best = None
    line = " ".join(own)
    for a in [0] + [i + 1 for i, c in enumerate(line) if c == " "]:
        if not line.startswith(n.fixed, a):
            continue
        a += len(n.fixed)
        row = list(range(len(n.text) + 1))
        for at, c in enumerate(line[a : a + len(n.text) + n.edits + 1]):
            new = [at + 1]
            for j, p in enumerate(n.text, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != c)))
            row = new
            if (a + at + 1 == len(line) or line[a + at + 1] == " ") and (best is None or row[-1] < best):
                best = row[-1]
    return best


def spoil(rng, text, edits):
    for _ in range(edits):
        i = int(rng.integers(0, len(text)))
        kind = rng.integers(0, 3)
        text = text[:i] + ("" if kind == 0 else "xé q"[rng.integers(0, 4)]) + text[i + (kind != 1) :]
    return text


def made(rng, n=150):
    plain = ["Mit", "permit", "license", "LICENSE", "apache", "general", "public", "the", "Ünder", "terms", "licensed", "cc", "by", "bsd", "\x0b", "\n", "--", "漢字", "2"]
    out = []
    for _ in range(n):
        parts = list(rng.choice(plain, int(rng.integers(0, 25))))
        for _ in range(int(rng.integers(0, 3))):
            notice = NOTICES[rng.integers(0, len(NOTICES))]
            parts.insert(int(rng.integers(0, len(parts) + 1)), notice.fixed + spoil(rng, notice.text, int(rng.integers(0, notice.edits + 3))))
        out.append(str(rng.choice([" ", ", ", "\n"])).join(parts))
    return out


def test_labels_match_edit_distances(spark):
    rng = np.random.default_rng(8)
    texts = made(rng) + [None, "", " \n", "MIT License", "mit", "x" * 200000, "mit license " * 3000, "general public " * 3000, "the MIT Licence", "Released under the mit-license!"]
    frame = pd.DataFrame({"doc_id": range(len(texts)), "text": texts, "hits": "clash", "n_words": 3, "labels": 1})
    docs = spark.createDataFrame(frame, "doc_id long, text string, hits string, n_words int, labels int")
    got = licence_report(docs.union(docs.where("doc_id < 3"))).toPandas()
    assert len(got) == len(texts) + 3
    for r in got.itertuples():
        text = texts[r.doc_id]
        own, places = words(text), base_places(text)
        starts = [i for i, _ in places]
        assert (r.n_words, r.n_base) == (len(own), len(places))
        assert (r.first_word, r.last_word) == (min(starts), max(starts)) if starts else (pd.isna(r.first_word) and pd.isna(r.last_word))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        if len(own) < 1000:
            least = [(n, least_edits(own, n)) for n in NOTICES]
            near = [(n, e) for n, e in least if e is not None and e <= n.edits]
            assert r.labels == ",".join(sorted({n.label for n, _ in near})), text
            assert abs(r.score - max([1 - e / len(n.whole) for n, e in near], default=0.0)) < 1e-12, text


def test_spans_are_those_of_the_text():
    text = "Ünder é the MIT\n\tLicence. 漢 gnu GENERAL-Public license, mit license"
    ((n, hits),) = scan([text.encode()])
    assert n == 12
    assert [(h["label"], text[h["char_from"] : h["char_to"]], h["edits"], h["base"]) for h in hits] == [
        ("mit", "MIT\n\tLicence", 1, False),
        ("gpl", "GENERAL-Public license", 0, True),
        ("mit", "mit license", 0, True),
    ]
    own = words(text)
    assert [" ".join(own[h["word_from"] : h["word_to"]]) for h in hits] == ["mit licence", "general public license", "mit license"]


def test_texts_do_not_run_together():
    assert [len(h) for _, h in scan([b"the mit", b"license", b"mit license", b"", b"mit licen\xffe"])] == [0, 0, 1, 0, 1]


def test_best_of_overlapping_spans():
    rng = np.random.default_rng(9)
    for _ in range(200):
        spans = {(int(rng.integers(0, 3)), a, a + int(rng.integers(1, 6))) for a in rng.integers(0, 30, 8).tolist()}
        want = []
        for e, a, b in sorted(spans):
            if all(b <= x or a >= y for _, x, y in want):
                want.append((e, a, b))
        assert list(apart(spans)) == want


def test_own_notices_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "mit license"), (1, "all rights reservd to us")], "id long, body string")
    own = (Notice("closed", "all rights reserved", 2),)
    (row,) = find_notices(docs, own, "id", "body").collect()
    assert (row["doc_id"], row["n_words"], [(h["label"], h["edits"]) for h in row["hits"]]) == (1, 5, [("closed", 1)])
    assert licence_report(docs.limit(0).toDF("doc_id", "text")).count() == 0
