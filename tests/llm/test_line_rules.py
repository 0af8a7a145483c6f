import re

import numpy as np
import pandas as pd

from tilth.llm.line_rules import clean_lines, furniture_fails, furniture_lines, judge, line_first, line_key, navigation_fails, punctuation_fails

SENTENCE = "A line of plain words that goes on for a while and ends well, as it should."


def plain(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    n = len(words)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(n - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside), n < 50 or 100 * len(inside) > 50 * n


def test_counts_match_brute_force(spark):
    rng = np.random.default_rng(1)
    vocabulary = ["a", "B", "é", "漢", "x#", "|", "<b>", "\n", "\t", "\x0b", "\x1c", "\x85", "word", "same same"]
    texts = [" ".join(rng.choice(vocabulary, int(rng.integers(0, 90)))) for _ in range(80)]
    texts += [None, "", " \n ", "a b", "a a a a", "a b c a b c", "x\n\nx\n x\nx", "w " * 20000, SENTENCE * 10]
    frame = pd.DataFrame({"doc_id": range(len(texts)), "text": texts, "kept": "clash", "n_words": 3})
    got = line_first(spark.createDataFrame(frame).union(spark.createDataFrame(frame.tail(1)))).toPandas()
    assert len(got) == len(texts) + 1
    for r in got.itertuples():
        text = texts[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (plain(text) if len(text or "") < 20000 else judge(text)[:6])
        assert not (r.base_failed and r.kept)
    assert judge("w " * 20000)[:6] == (20000, 20000, 0, 0, 20000, True)


def test_lines_are_judged_one_by_one():
    words = str.split
    assert not punctuation_fails(SENTENCE, words(SENTENCE))
    assert punctuation_fails("Home Contact", ["Home", "Contact"])
    assert not punctuation_fails("He said: “yes.”", words("He said: “yes.”"))
    assert punctuation_fails("THE!! WORD!! OF!! IT.", words("THE!! WORD!! OF!! IT."))
    assert punctuation_fails("of### it*** and&&& here.", words("of### it*** and&&& here."))
    assert navigation_fails(words("Home | News | About us | Contact"))
    assert not navigation_fails(words("Either | or."))
    assert furniture_fails("Please accept cookies.", words("Please accept cookies."))
    assert not furniture_fails(SENTENCE, words(SENTENCE))
    long = " ".join(["word"] * 60)
    assert clean_lines("\n".join([SENTENCE, "Home | a | b | c", long, ""])) == ("\n".join([SENTENCE, long, ""]), 299, 309)


def test_texts_that_lose_too_much_go():
    rng = np.random.default_rng(2)
    make = lambda: " ".join("".join(rng.choice(list("abcdef"), 5)) for _ in range(60))
    clean = "\n".join(make() + "." for _ in range(5))
    menu = "\n".join(" | ".join(make().split()[:9]) for _ in range(12))
    assert judge(clean)[6] is True
    assert judge(menu)[5:7] == (False, False)
    assert judge(clean + "\n" + menu[:300])[6] is True


def test_empty_table_and_null_ids(spark):
    docs = spark.createDataFrame([(None, SENTENCE)], "doc_id long, text string")
    assert line_first(docs).count() == 0


def plain_furniture(texts, share, least, contexts):
    shape = lambda x: " ".join(re.sub("[A-Z]", lambda m: m[0].lower(), x).split())
    rows = [[shape(x) for x in (t or "").split("\n") if x.split()] for t in texts]
    out = {}
    for line in {x for r in rows for x in r if len(x.split()) <= 40}:
        at = [(r, r.index(line)) for r in rows if line in r]
        before = {r[i - 1] if i else None for r, i in at}
        after = {r[i + 1] if i + 1 < len(r) else None for r, i in at}
        around = max(len(before), len(after))
        if len(at) >= max(least, share * len(rows)) and around >= contexts * len(at):
            out[line_key(line.encode())] = (len(at), around)
    return out


def test_furniture_is_learned_from_all_documents(spark):
    rng = np.random.default_rng(3)
    make = lambda n: " ".join("".join(rng.choice(list("abcdef"), 4)) for _ in range(n)) + "."
    footer, family, long = "Alle Rechte  VORBEHALTEN, seit 1999.", [make(12) for _ in range(6)], make(60)
    texts = ["\n".join([make(30), make(30), footer if i % 2 else footer.lower(), make(30)]) for i in range(30)]
    texts += ["\n".join(family)] * 25 + ["\n".join([make(20), long, make(20)]) for _ in range(25)]
    texts += ["Nur eine Zeile."] * 25 + [None, "", "\n \n", "x " * 30000, "\n".join([footer] * 3)]
    docs = spark.createDataFrame(pd.DataFrame({"doc_id": range(len(texts)), "text": texts, "key": 1, "n": "clash"})).repartition(5)
    found = furniture_lines(docs, least=20)
    assert {r.key: (r.holders, r.contexts) for r in found.collect()} == plain_furniture(texts, 0.005, 20, 0.5)
    assert [r.key for r in found.collect()] == [line_key(b"alle rechte vorbehalten, seit 1999.")]
    got = {r.doc_id: r for r in line_first(docs, furniture=found).collect()}
    assert len(got) == len(texts)
    for i in range(30):
        assert got[i].kept and got[i].cleaned == "\n".join(x for j, x in enumerate(texts[i].split("\n")) if j != 2)
    assert all(got[i].kept and got[i].cleaned == texts[i] for i in range(30, 80))
    assert judge("\n".join([make(20), *["menu " * 38 + "end."] * 3]), frozenset([line_key(b"menu " * 38 + b"end.")]))[5:7] == (True, False)


def test_furniture_of_few_documents(spark):
    docs = spark.createDataFrame([(None, SENTENCE), (1, None), (2, SENTENCE), (2, SENTENCE)], "doc_id long, text string")
    assert furniture_lines(docs).count() == 0
    assert furniture_lines(docs.where("false")).count() == 0
    assert [tuple(r) for r in furniture_lines(docs, least=2).collect()] == [(line_key(SENTENCE.encode()), 2, 1)]
