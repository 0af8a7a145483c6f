"""Language ID by unigram piece models whose score sums over all segmentations.

Each language has probabilities of the pieces of one fixed public vocabulary. The
probability of a word is the sum over every way to cut it into pieces, by the forward
recursion; a text's log-probability adds up its words. Words are the runs of letters of
the lower-cased text, each with a leading space. Probabilities are learned by
expectation-maximisation over the same sums.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import pick, written

#: Pieces of up to so many bytes are found by a 64-bit key, longer ones by a hash and their bytes.
SHORT = 8
#: Odd factor of the hash of longer pieces: 2^64 over the golden ratio.
FACTOR = 0x9E3779B97F4A7C15
ROUNDS, PRIOR = 4, 0.05
#: Documents learned from in each language: their expected number, drawn by a hash of the id.
SAMPLE = 1500
#: Words a worker remembers before it starts anew.
REMEMBERED = 150_000
LETTERS = re.compile(r"[^\W\d_]+")


def vocabulary(path: str) -> list[bytes]:
    """Pieces of a rank file: a base64 piece and its rank on each line. All single bytes are added."""
    with open(path, "rb") as lines:
        pieces = {base64.b64decode(line.split()[0]) for line in lines if line.strip()}
    return sorted(pieces | {bytes([b]) for b in range(256)})


class Pieces:
    """Piece numbers of substrings: by length, sorted keys and the numbers that go with them."""

    def __init__(self, pieces: list[bytes]):
        self.size = len(pieces)
        self.longest = max(map(len, pieces))
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.short, self.long = [], []
        for length in range(1, max(SHORT, self.longest) + 1):
            numbers = np.flatnonzero(lengths == length).astype(np.int32)
            spelled = np.frombuffer(b"".join(pieces[i] for i in numbers), np.uint8).reshape(len(numbers), length)
            if length <= SHORT:
                keys = np.zeros(len(numbers), np.uint64)
                for at in range(length):
                    keys = keys << np.uint64(8) | spelled[:, at]
                order = np.argsort(keys)
                self.short.append((keys[order], numbers[order]))
            elif len(numbers):
                keys = self._hashes(spelled)[:, -1]
                order = np.argsort(keys, kind="stable")
                marks = np.zeros(1 << 16, bool)
                marks[keys >> np.uint64(48)] = True
                self.long.append((length, keys[order], numbers[order], spelled[order], marks, np.uint64(pow(FACTOR, length, 1 << 64))))

    @staticmethod
    def _hashes(words: np.ndarray) -> np.ndarray:
        """Hash of every prefix of words of one length, the empty one first."""
        out = np.zeros((len(words), words.shape[1] + 1), np.uint64)
        for at in range(words.shape[1]):
            out[:, at + 1] = out[:, at] * np.uint64(FACTOR) + words[:, at] + np.uint64(1)
        return out

    def ending_at(self, words: np.ndarray, at: int) -> list[np.ndarray]:
        """For lengths 1 to 8, the number of the piece ending before position ``at`` of each word; ``size`` if none."""
        found, key = [], np.zeros(len(words), np.uint64)
        for length in range(1, min(SHORT, at) + 1):
            key = key | (words[:, at - length].astype(np.uint64) << np.uint64(8 * (length - 1)))
            keys, numbers = self.short[length - 1]
            if not len(keys):
                found.append(np.full(len(words), self.size, np.int32))
                continue
            place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            found.append(np.where(keys[place] == key, numbers[place], self.size).astype(np.int32))
        return found

    def longer(self, words: np.ndarray) -> dict[int, list[tuple[int, np.ndarray, np.ndarray]]]:
        """By position: (length, rows, numbers) of the longer pieces that end before it, their bytes compared."""
        found: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
        if words.shape[1] <= SHORT:
            return found
        prefix = self._hashes(words)
        for length, keys, numbers, spelled, marks, power in self.long:
            if length > words.shape[1]:
                break
            key = prefix[:, length:] - prefix[:, :-length] * power
            rows, starts = np.nonzero(marks[key >> np.uint64(48)])
            key = key[rows, starts]
            # pieces of one hash stand together; most often there is one
            first, after = np.searchsorted(keys, key), np.searchsorted(keys, key, side="right")
            for step in range(int((after - first).max(initial=0))):
                near = np.flatnonzero(first + step < after)
                place = first[near] + step
                own = words[rows[near, None], starts[near, None] + np.arange(length)]
                same = (own == spelled[place]).all(axis=1)
                hit, place = near[same], place[same]
                order = np.argsort(starts[hit], kind="stable")
                hit, place = hit[order], place[order]
                ends, cuts = np.unique(starts[hit] + length, return_index=True)
                for end, rows_here, pieces_here in zip(ends.tolist(), np.split(rows[hit], cuts[1:]), np.split(numbers[place], cuts[1:])):
                    found.setdefault(end, []).append((length, rows_here, pieces_here))
        return found


def by_length(words: list[bytes], most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, matrix of bytes) of words of equal length, in chunks of at most that many bytes or one word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for same in np.split(order, cuts):
        if not len(same):
            continue
        n = int(lengths[same[0]])
        rows = max(1, min(1 << 14, most // max(1, n)))
        for i in range(0, len(same), rows):
            part = same[i : i + rows]
            yield part, np.frombuffer(b"".join(words[j] for j in part), np.uint8).reshape(len(part), n)


def word_logs(words: list[bytes], pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """log P(word) in each language, over all segmentations. probs: (pieces + a last row of zeros, languages)."""
    out = np.zeros((len(words), probs.shape[1]))
    for part, matrix in by_length(words):
        past = [np.ones((len(part), probs.shape[1]))]  # forward sums of the last positions, newest first
        scale = np.zeros((len(part), probs.shape[1]))
        longer = pieces.longer(matrix)
        logs = {0: scale} if longer else {}
        for at in range(1, matrix.shape[1] + 1):
            now = 0.0
            for numbers, before in zip(pieces.ending_at(matrix, at), past):
                now = now + before * probs[numbers]
            for length, rows, numbers in longer.get(at, ()):
                gap = logs[at - length][rows] - scale[rows]
                over = np.maximum(gap - 300, 0)  # what a double can't hold is moved to the scale
                if over.any():
                    scale = scale.copy()
                    scale[rows] += over
                    for p in (now, *past):
                        p[rows] *= np.exp(-over)
                now[rows] += np.exp(gap - over) * probs[numbers]
            past = [now, *past[: SHORT - 1]]
            if at % 6 == 0:
                scale = scale + np.log(now)
                past = [p / now for p in past]
            if longer:
                logs[at] = scale + np.log(past[0])
                logs.pop(at - pieces.longest, None)
        out[part] = scale + np.log(past[0])
    return out


def learn_pieces(words: list[bytes], counts: np.ndarray, pieces: Pieces, rounds: int = ROUNDS, prior: float = PRIOR) -> np.ndarray:
    """Piece probabilities of one language by expectation-maximisation on its word counts; words of any length."""
    probs = np.full(pieces.size + 1, 1 / pieces.size)
    probs[-1] = 0
    chunks = []
    for part, m in by_length(words):
        every = np.arange(len(part))
        longer = pieces.longer(m)
        # (length, rows, numbers) of the pieces ending before each position
        chunks.append((part, [[*((i + 1, every, k) for i, k in enumerate(pieces.ending_at(m, at))), *longer.get(at, ())] for at in range(1, m.shape[1] + 1)]))
    for _ in range(rounds):
        expected = np.zeros(pieces.size + 1)
        with np.errstate(divide="ignore"):
            logs = np.log(probs)
        for part, found in chunks:
            n, none = len(found), -np.inf
            forward = np.full((n + 1, len(part)), none)
            back = np.full((n + 1, len(part)), none)
            forward[0] = back[n] = 0
            for at in range(1, n + 1):
                for length, rows, numbers in found[at - 1]:
                    forward[at, rows] = np.logaddexp(forward[at, rows], forward[at - length, rows] + logs[numbers])
            for at in range(n, 0, -1):
                for length, rows, numbers in found[at - 1]:
                    back[at - length, rows] = np.logaddexp(back[at - length, rows], back[at, rows] + logs[numbers])
            for at in range(1, n + 1):
                for length, rows, numbers in found[at - 1]:
                    share = np.exp(forward[at - length, rows] + logs[numbers] + back[at, rows] - forward[n, rows])
                    expected += np.bincount(numbers, share * counts[part[rows]], len(expected))
        expected[-1] = 0
        expected[:-1] += prior
        probs = expected / expected.sum()
    return probs[:-1]


def held_out(id_col: Column, modulus: int, rest: int) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % modulus == rest


def learn(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Piece probabilities by language from the documents that have one; runs two jobs.

    ``sample`` bounds the documents learned from in each language: each is taken with the
    probability that makes this their expected number. What comes to the driver has the
    vocabulary's size for each language. A language whose sample has no letter isn't learned.
    """
    source = pick(docs, doc_id=id_col, text=text_col, lang=lang_col).where("lang is not null and text is not null")
    totals = written(source.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / F.lit(1 << 30)
    drawn = source.join(totals, "lang").where(draw * F.col("n") < sample).select("lang", "text")
    pieces = Pieces(vocabulary(path))

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, int] = {}
        for part in parts:
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                for word in LETTERS.findall(text.lower()):
                    held[lang, word] = held.get((lang, word), 0) + 1
            if len(held) > REMEMBERED:
                yield tallies(held)
                held = {}
        if held:
            yield tallies(held)

    def tallies(held: dict[tuple, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.string()), pa.array(list(held.values()), pa.int64())], names=["lang", "word", "n"])

    def fit(own: pd.DataFrame) -> pd.DataFrame:
        words = [b" " + w.encode("utf-8", "surrogatepass") for w in own["word"]]
        probs = learn_pieces(words, own["n"].to_numpy(float), pieces)
        return pd.DataFrame({"lang": [own["lang"].iloc[0]], "probs": [probs.tobytes()]})

    words = drawn.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    models = words.groupBy("lang").applyInPandas(fit, "lang string, probs binary").collect()
    return {m["lang"]: np.frombuffer(m["probs"]) for m in sorted(models, key=lambda m: m["lang"])}


class Scorer:
    """Scores texts in every language and remembers words."""

    def __init__(self, pieces: Pieces, probs: np.ndarray):
        self.pieces, self.probs = pieces, np.vstack([probs, np.zeros(probs.shape[1])])
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.logs = np.zeros((0, self.probs.shape[1]))
        self.letters = np.zeros(0, bool)

    def add(self, tokens: list[str]) -> None:
        runs = [LETTERS.findall(t) for t in tokens]
        words = {w: i for i, w in enumerate({w for r in runs for w in r})}
        logs = word_logs([b" " + w.encode("utf-8", "surrogatepass") for w in words], self.pieces, self.probs)
        own = np.zeros((len(tokens), self.probs.shape[1]))
        np.add.at(own, np.repeat(np.arange(len(runs)), [len(r) for r in runs]), logs[[words[w] for r in runs for w in r]])
        self.logs = np.concatenate([self.logs, own])
        self.letters = np.concatenate([self.letters, np.array([bool(r) for r in runs], bool)])

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log-probabilities, whether there is a letter) of each text."""
        if len(self.numbers) > REMEMBERED:
            self.forget()
        numbers, known = self.numbers, len(self.numbers)
        places = []
        for text in texts:
            places.append(np.array([numbers.setdefault(t, len(numbers)) for t in text.lower().split()], np.int64))
        if len(numbers) > known:
            fresh = list(numbers)[known:]
            for i in range(0, len(fresh), 1 << 16):
                self.add(fresh[i : i + (1 << 16)])
        logs = np.array([self.logs[p].sum(axis=0) for p in places]).reshape(len(texts), -1)
        return logs, np.array([bool(self.letters[p].any()) for p in places], bool)


def _told(source: DataFrame, models: dict[str, np.ndarray], path: str, text_col: str, lang_col: str, score_col: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each row with its language and the posterior of it."""
    names = [*models, "und"]
    probs = np.stack(list(models.values()), axis=1).astype(np.float64) if models else None
    pieces = Pieces(vocabulary(path))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(pieces, probs) if models else None
        for part in parts:
            for at in range(0, part.num_rows, 256):
                rows = part.slice(at, 256)
                best, score = np.full(rows.num_rows, len(names) - 1), np.zeros(rows.num_rows)
                if scorer:
                    logs, letters = scorer.texts(pc.fill_null(rows.column(text_col), "").to_pylist())
                    first = logs.argmax(axis=1)
                    best = np.where(letters, first, best)
                    score = np.where(letters, 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1), 0.0)
                own = [rows.column(c) for c in keep]
                yield pa.RecordBatch.from_arrays([*own, pa.array([names[b] for b in best], pa.string()), pa.array(score)], names=[*keep, lang_col, score_col])

    kept = source.select(*keep).schema
    return source.mapInArrow(run, kept.add(lang_col, "string").add(score_col, "double"))


def predict(docs: DataFrame, models: dict[str, np.ndarray], path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every document with an id.

    score: the posterior of the language predicted, all being as likely before; ties go to
    the first by name. A text that is null or has no letter is ``und`` with score 0, and so is
    every text if no language was learned. Repeated rows are told one by one, and an empty
    table has no rows.
    """
    return _told(pick(docs, doc_id=id_col, text=text_col), models, path, "text", "lang_pred", "score", ["doc_id"])


def accepted(docs: DataFrame, models: dict[str, np.ndarray], path: str, least: float = 0.5, only: tuple[str, ...] | None = None) -> DataFrame:
    """The documents, all columns, whose language is recognised with a posterior of ``least``.

    ``only`` names the languages wanted, all by default. Where ``lang`` is null it becomes
    the language recognised. Rows without an id or a letter go; each row is judged on its
    own, so repeated rows stay or go together, and equal scores change nothing. No join.
    """
    told = _told(docs.where(docs["doc_id"].isNotNull()), models, path, "text", "__lang", "__score", docs.columns)
    wanted = F.col("__lang").isin(*only) if only is not None else F.col("__lang") != "und"
    kept = told.where(wanted & (F.col("__score") >= least))
    return kept.select(*[F.coalesce(c, "__lang").alias(c) if c == "lang" else F.col(c) for c in docs.columns])
