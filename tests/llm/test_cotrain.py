import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tilth.llm.cotrain import META, TEXT, Logistic, meta_view, quality, sigmoid, text_view, train

DOCS = "doc_id long, text string, source string, lang string, n_chars long, score string"


def corpus(n=600):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = rng.choice(["plain", "words", "in", "a", "row", "here."], 40)
        text = " ".join(words) if good else " ".join(f"{w}###" for w in words)
        rows.append((i, text, f"s{rng.integers(5) + 5 * good}", "en" if i % 9 else None, len(text), "clash"))
        labels.append((i, int(good), None))
    return rows, labels


def test_views_have_a_row_for_each_text():
    x = text_view([b"", b"a b a b", b"A! \n" * 3000, b"\xff\xfe"])
    assert x.shape == (4, TEXT) and np.isfinite(x).all() and not x[0, :-3].any()
    assert meta_view([None, "a"], ["en", None], [None, 10**9]).shape == (2, META)


def test_held_out_accuracy_and_exchange(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows + [(9999, None, None, None, None, None)], DOCS)
    told = spark.createDataFrame([x for x in labels if x[0] % 2] + [(None, 1, None), (2, None, None)], "doc_id long, quality int, toxic int")
    got = quality(docs, told).toPandas().set_index("doc_id")
    truth = pd.Series({i: bool(q) for i, q, _ in labels})
    hidden = truth.index[truth.index % 2 == 0]
    assert (got.loc[hidden, "kept"] == truth[hidden]).mean() > 0.97
    assert (got[["text_score", "meta_score", "score"]].stack().between(0, 1)).all() and len(got) == len(rows) + 1


def co_trained(rows, labels, marks):
    """Scores of all rows with every exchange done over plain lists. marks: the hash that breaks ties."""
    text = text_view([(r[1] or "").encode() for r in rows])
    meta = meta_view([r[2] for r in rows], [r[3] for r in rows], [r[4] for r in rows])
    views = (text.astype(float), meta.astype(float))
    first = {}
    for i, r in enumerate(rows):
        if r[0] in labels and (r[0] not in first or marks[i] < marks[first[r[0]]]):
            first[r[0]] = i
    known = [first[d] for d in sorted(first)]
    y = np.array([labels[rows[i][0]] for i in known], float)
    apart = np.arange(len(known)) % 4 == 0
    free, seen = [], set()
    for i, r in enumerate(rows):
        if r[0] not in labels and (r[0], marks[i]) not in seen:
            seen.add((r[0], marks[i]))
            free.append(i)
    size = sum(r[0] not in labels for r in rows)
    given = [{}, {}]  # what each view was told: row to label

    def fit():
        models = []
        for k in (0, 1):
            own = [i for i, a in zip(known, apart) if not a]
            said = [labels[rows[i][0]] for i in own] + list(given[k].values())
            model = Logistic(views[k][own + list(given[k])], np.array(said, float))
            held = [i for i, a in zip(known, apart) if a]
            scale = Logistic(model.logit(views[k][held])[:, None], y[apart])
            models.append(lambda x, model=model, scale=scale: scale.logit(model.logit(x)[:, None]))
        return models

    for _ in range(4):
        models = fit()
        new = [{}, {}]
        for k in (0, 1):
            z = models[k](views[k])
            for good, share in ((1.0, y.mean()), (0.0, 1 - y.mean())):
                sure = [(-(z[i] if good else -z[i]), marks[i], i) for i in free if i not in given[1 - k] and (z[i] if good else -z[i]) >= np.log(19)]
                for *_, i in sorted(sure)[: max(1, int(0.05 * share * size))]:
                    new[1 - k][i] = good
        for k in (0, 1):
            given[k] |= new[k]
    models = fit()
    held = [i for i, a in zip(known, apart) if a]
    both = np.stack([models[k](views[k]) for k in (0, 1)], axis=1)
    last = Logistic(both[held], y[apart])
    return [len(g) for g in given], np.stack([sigmoid(both[:, 0]), sigmoid(both[:, 1]), sigmoid(last.logit(both))], axis=1)


def test_matches_co_training_over_plain_lists(spark):
    rng = np.random.default_rng(4)
    rows, labels = [], {}
    for i in range(700):
        good = rng.random() < 0.6
        words = [f"w{rng.integers(0, 40 if good else 15)}{'' if rng.random() < (0.9 if good else 0.6) else '###'}" for _ in range(int(rng.integers(5, 60)))]
        rows.append((i, " ".join(words), f"s{rng.integers(0, 4) + (rng.random() < 0.8) * 4 * good}", "en", float(rng.integers(1, 4000) + 2000 * good)))
        if i % 4 == 0:
            labels[i] = float(good)
    rows += [(800, "long " * 60000, "s1", "en", None), (801, None, None, None, None), rows[3], rows[3], (8, "another row of a labelled id", "s2", "de", 5.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars double")
    columns = docs.columns
    marked = docs.select("*", F.xxhash64(*columns, *(F.col(c).isNull() for c in columns)).alias("mark")).collect()
    marks = {tuple(r)[:5]: r.mark for r in marked}
    told, want = co_trained(rows, labels, [marks[r] for r in rows])
    frame = spark.createDataFrame([(i, int(q)) for i, q in labels.items()], "doc_id long, quality int")
    assert train(docs, frame.withColumn("quality", F.col("quality").cast("double"))).named == told[::-1] and min(told) > 10
    got = sorted((r.doc_id, r.text_score, r.meta_score, r.score) for r in quality(docs, frame).collect())
    plain = sorted((r[0], *w) for r, w in zip(rows, want.tolist()))
    assert len(got) == len(rows)
    assert np.allclose(np.array(got), np.array(plain), atol=1e-6)


def test_every_unlabelled_document_can_be_named(spark):
    kinds = {"good": "plain words in a row here.", "bad": "plain### words### in### a### row###", "mid": "nothing to see for either view"}
    rows = [(i, kinds[("good", "bad", "mid")[i % 3]]) for i in range(1500)]
    told = [(i, float((1, 0, i // 12 % 2)[i % 3])) for i in range(1500)]
    rows += [(5000 + i, kinds["good" if i % 500 == 7 else "mid"]) for i in range(20000)]
    docs = spark.createDataFrame([(i, t, "s", "en", 30.0) for i, t in rows], "doc_id long, text string, source string, lang string, n_chars double")
    judge = train(docs, spark.createDataFrame(told, "doc_id long, quality double"))
    assert judge.named[0] == 40


def test_few_or_no_labels(spark):
    rows, labels = corpus(20)
    docs = spark.createDataFrame(rows + rows[:1], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality(docs, none).collect()} == {0.5}
    assert quality(docs, none).count() == 21
    few = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (3, 0), (4, 1)], "doc_id long, quality int")
    assert {r.score for r in quality(docs, few).collect()} == {0.75}
    assert quality(docs.where("false"), few).count() == 0
