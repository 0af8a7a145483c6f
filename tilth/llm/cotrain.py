"""Quality by co-training: a text view and a metadata view teach each other, then judge together.

Each view has a logistic regression of its own. In every round either one scores all
unlabelled documents and names those it is surest of, good and bad in the proportion of the
labels; of these a bounded number, drawn by hash, joins the training set of the other. In the end each view's score is calibrated on
labelled documents it never saw, and a last regression on the two calibrated scores
combines them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import forget, pick, raw, written
from tilth.llm.words import LOWER, joined, span_hash, word_spans

#: Rows of the fit: the expected number of labelled ones, drawn by a hash of the id, and the most that a view adds to the other's in a round.
LABELLED, ADDED = 6000, 300
ROUNDS, NAMED, SURE = 4, 0.05, 0.95
#: Share of the labelled documents kept for calibration.
APART = 0.25
WORDS, SOURCES, LANGS = 512, 64, 32
#: Fixed classes of a word's last character; letters, digits and the rest are classes as well.
MARKS = b".,!?;:#*$%&|<>"
_first = np.zeros(256, np.int64)
_first[65:91], _first[97:123], _first[128:], _first[48:58] = 1, 2, 2, 3
_last = np.full(256, 15, np.int64)
_last[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 0
for _i, _c in enumerate(MARKS, start=1):
    _last[_c] = _i
SHAPES = 4 * 16 * 4
TEXT, META = WORDS + SHAPES + 3, SOURCES + LANGS + 3


def text_view(texts: list[bytes]) -> np.ndarray:
    """A row for each text: roots of the shares of hashed words and of word shapes, repetition, length."""
    buffer, at = joined(texts)
    starts, ends = word_spans(buffer)
    n = len(texts)
    doc = np.searchsorted(at, starts, side="right") - 1
    total = np.bincount(doc, minlength=n).astype(float)
    h = span_hash(LOWER[buffer], starts, ends)
    words = np.bincount(doc * WORDS + (h % np.uint64(WORDS)).astype(np.int64), minlength=n * WORDS).reshape(n, WORDS)
    before = np.where(ends - starts > 1, _first[buffer[ends - 2]], 0) if len(starts) else starts
    shape = (_first[buffer[starts]] * 16 + _last[buffer[ends - 1]]) * 4 + before if len(starts) else starts
    shapes = np.bincount(doc * SHAPES + shape, minlength=n * SHAPES).reshape(n, SHAPES)
    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    most = np.maximum(total, 1)
    size = np.fromiter(map(len, texts), float, n)
    rest = np.stack([np.bincount(doc, again, n) / most, np.log1p(total) / 10, size / most / 20], axis=1)
    return np.concatenate([np.sqrt(words / most[:, None]), np.sqrt(shapes / most[:, None]), rest], axis=1).astype(np.float32)


def meta_view(source: list, lang: list, chars: list) -> np.ndarray:
    """A row for each document: source and language by hash, null being a value of its own, and the length stated."""
    out = np.zeros((len(source), META), np.float32)
    for column, values, base, size in ((0, source, 0, SOURCES), (1, lang, SOURCES, LANGS)):
        names = [b"\0" if v is None else str(v).encode("utf-8", "surrogatepass") for v in values]
        buffer = np.frombuffer(b"".join(names) or b"\0", np.uint8)
        ends = np.cumsum([len(x) for x in names]).astype(np.int64)
        starts = ends - np.array([len(x) for x in names], np.int64)
        out[np.arange(len(names)), base + (span_hash(buffer, starts, ends, column) % np.uint64(size)).astype(np.int64)] = 1
    size = np.array([-1.0 if c is None else float(c) for c in chars])
    out[:, -3] = size < 0
    out[:, -2] = np.log1p(np.maximum(size, 0)) / 10
    out[:, -1] = out[:, -2] ** 2
    return out


class Logistic:
    """Ridge logistic regression by Newton's method."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 8):
        self.mean = x.mean(axis=0)
        self.spread = x.std(axis=0) + 1e-2
        a = self._rows(x)
        self.w = np.zeros(a.shape[1])
        penalty = np.full(a.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(steps):
            p = sigmoid(a @ self.w)
            v = np.maximum(p * (1 - p), 1e-4)
            step = np.linalg.solve(a.T @ (a * v[:, None]) + np.diag(penalty), a.T @ (y - p) - penalty * self.w)
            self.w += step * min(1.0, 4 / max(1e-9, np.abs(a @ step).max(initial=0)))

    def _rows(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([(x - self.mean) / self.spread, np.ones((len(x), 1))], axis=1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self._rows(x) @ self.w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Judge:
    """Both views' regressions, their calibrations, and the last one over both."""

    def __init__(self, views: tuple[np.ndarray, np.ndarray], y: np.ndarray, apart: np.ndarray, told: tuple = ()):
        """apart: labelled rows kept for calibration; told: for each view the (rows, labels) that the other one has named."""
        self.prior = float(y.mean()) if len(y) else None
        self.models = None
        self.named = [0, 0]
        learn = ~apart
        if min(np.bincount(y[learn].astype(int), minlength=2)) < 5 or min(np.bincount(y[apart].astype(int), minlength=2)) < 5:
            return
        sets = [[v[learn]] for v in views]
        labels = [[y[learn]], [y[learn]]]
        for k, (rows, said) in enumerate(told):
            sets[k].append(rows)
            labels[k].append(said)
            self.named[1 - k] = len(said)
        self.models = [Logistic(np.concatenate(s), np.concatenate(t)) for s, t in zip(sets, labels)]
        self.scales = [Logistic(m.logit(v[apart])[:, None], y[apart]) for m, v in zip(self.models, views)]
        both = np.stack([self._calibrated(k, views[k][apart]) for k in (0, 1)], axis=1)
        self.last = Logistic(both, y[apart])

    def _calibrated(self, k: int, x: np.ndarray) -> np.ndarray:
        return self.scales[k].logit(self.models[k].logit(x)[:, None])

    def score(self, x: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """(text, metadata, both) of each row, 0 bad to 1 good."""
        if self.models is None:
            return np.full((len(x[0]), 3), 0.5 if self.prior is None else self.prior)
        both = np.stack([self._calibrated(k, x[k]) for k in (0, 1)], axis=1)
        return np.concatenate([sigmoid(both), sigmoid(self.last.logit(both))[:, None]], axis=1)


def _draw(seed: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) / F.lit(1 << 30)


def _views(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return text_view(raw(part.column("text"))), meta_view(*(part.column(c).to_pylist() for c in ("source", "lang", "n_chars")))


def _features(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, quality, pupil, views) of documents that have the first four."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            both = [v.tobytes() for v in np.concatenate(_views(part), axis=1)]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "mark", "quality", "pupil")), pa.array(both, pa.binary())], names=["doc_id", "mark", "quality", "pupil", "views"])

    columns = docs.select("doc_id", "mark", "quality", "pupil", "text", "source", "lang", "n_chars")
    return columns.mapInArrow(rows, "doc_id long, mark long, quality double, pupil int, views binary")


def _fit(lessons: DataFrame) -> Judge:
    """Both views learn in one task from rows of ``_features``; pupil is the view that a row was named for, -1 for a labelled one."""
    import pickle

    none = np.zeros((0, TEXT)), np.zeros((0, META))

    def fit(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values(["doc_id", "mark"])
        x = np.frombuffer(b"".join(sample["views"]), np.float32).reshape(len(sample), TEXT + META)
        views, y, pupil = (x[:, :TEXT], x[:, TEXT:]), sample["quality"].to_numpy(float), sample["pupil"].to_numpy()
        has = pupil < 0
        apart = np.arange(int(has.sum())) % round(1 / APART) == 0
        told = tuple((v[pupil == k], y[pupil == k]) for k, v in enumerate(views))
        return pd.DataFrame({"model": [pickle.dumps(Judge((views[0][has], views[1][has]), y[has], apart, told))]})

    found = lessons.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(fit, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else Judge(none, np.zeros(0), np.zeros(0, bool))


def _named(docs: DataFrame, labels: DataFrame, judge: Judge, m: int, taken: tuple[set, set], added: int, number: int) -> DataFrame:
    """(doc_id, mark, quality, pupil): of the m unlabelled documents those that each view names for the other; runs jobs.

    Of a class a view names the surest ``NAMED`` of its share of all, if it is sure of so many.
    ``added`` bounds the rows of both classes that are drawn from these. taken: marks that a view was given before.
    """
    least = float(np.log(SURE / (1 - SURE)))
    gone = [np.array(sorted(t), np.int64) for t in taken]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 256):
                rows = part.slice(at, 256)
                views = _views(rows)
                mark = rows.column("mark").to_numpy()
                z = [np.where(np.isin(mark, gone[1 - k]), 0, judge._calibrated(k, views[k])) for k in (0, 1)]
                some = pa.array(np.maximum(np.abs(z[0]), np.abs(z[1])) >= least)
                out = pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("mark"), *map(pa.array, z)], names=["doc_id", "mark", "z0", "z1"])
                yield out.filter(some)

    sure = docs.mapInArrow(run, "doc_id long, mark long, z0 double, z1 double").join(labels, "doc_id", "left_anti")
    sure = written(sure.dropDuplicates(["doc_id", "mark"]), "sure")
    kinds = [(k, good, F.col(f"z{k}") * (1 if good else -1), judge.prior if good else 1 - judge.prior) for k in (0, 1) for good in (1.0, 0.0)]
    most = [max(1, int(NAMED * share * m)) for *_, share in kinds]
    counts = sure.agg(*[F.count_if(z >= least) for _, _, z, _ in kinds]).first()
    limits = sure.agg(*[F.percentile_approx(F.when(z >= least, z), max(0.0, 1 - n / max(1, c)), 10_000) for (_, _, z, _), n, c in zip(kinds, most, counts)]).first()
    chosen = None
    for (k, good, z, share), n, limit in zip(kinds, most, limits):
        cap = max(1, int(added * share))
        own = sure.where(z >= (least if limit is None else max(least, limit)))
        order = [z.desc(), F.col("mark")] if n <= cap else [F.xxhash64("mark", F.lit(number))]
        own = own.orderBy(*order).limit(min(n, cap)).select("doc_id", "mark", F.lit(good).alias("quality"), F.lit(1 - k).alias("pupil"))
        chosen = own if chosen is None else chosen.union(own)
    chosen = written(chosen, "named")
    forget(sure)
    return chosen


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, added: int = ADDED) -> Judge:
    """Learns in one task from a bounded sample of the labelled rows and from rows named among all others, which Spark scores in every round; runs jobs.

    docs: as ``quality`` selects them. Equal rows of one document are named once; of the
    rows of a labelled id one is learned from, the one with the smallest hash.
    """
    columns = ("doc_id", "text", "source", "lang", "n_chars")
    docs = docs.select(*columns, F.xxhash64(*columns, *(F.col(c).isNull() for c in columns)).alias("mark"))
    labels = written(labels.select("doc_id", "quality"), "labels")
    known = docs.groupBy("doc_id").agg(F.min("mark").alias("mark")).join(labels, "doc_id")
    n = known.count()
    m = docs.select("doc_id").join(labels, "doc_id", "left_anti").count()
    drawn = written(known.where(_draw(3) * n < labelled).select("doc_id", "mark", "quality", F.lit(-1).alias("pupil")), "sample")
    lessons = written(_features(docs.join(drawn, ["doc_id", "mark"])).dropDuplicates(["doc_id", "mark"]), "lessons")
    judge = _fit(lessons)
    taken: tuple[set, set] = set(), set()
    for number in range(ROUNDS if judge.models is not None and m else 0):
        named = _named(docs, labels, judge, m, taken, added, number)
        for row in named.collect():
            taken[row["pupil"]].add(row["mark"])
        more = _features(docs.join(named, ["doc_id", "mark"])).dropDuplicates(["doc_id", "mark", "pupil"])
        lessons = lessons.union(written(more, "lessons"))
        judge = _fit(lessons)
    return judge


def quality(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """(doc_id, text_score, meta_score, score, kept) of every document with an id; runs jobs.

    docs: doc_id, text, source, lang, n_chars; labels: doc_id, quality (0 or 1). Labels without
    id or quality are passed over; of several for one document the majority counts, a tie as
    good. With fewer than five examples of a class every score is the share of good labels, or
    a half without labels. Null texts are empty, nulls in metadata a value of their own; texts
    of any length are read whole. Repeated rows are scored one by one and learned from once;
    of equally sure documents the one with the smaller hash is named.
    """
    source = pick(docs, doc_id="doc_id", text="text", source="source", lang="lang", n_chars="n_chars")
    source = source.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("double").alias("n_chars"))
    told = pick(labels, doc_id="doc_id", quality="quality").where("quality is not null")
    told = told.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("quality") >= 0.5).cast("double").alias("quality"))
    judge = train(source, told)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 256):
                rows = part.slice(at, 256)
                scores = judge.score(_views(rows))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *(pa.array(c) for c in scores.T.astype(float)), pa.array(scores[:, 2] >= least)], names=["doc_id", "text_score", "meta_score", "score", "kept"])

    return source.mapInArrow(run, "doc_id long, text_score double, meta_score double, score double, kept boolean")
