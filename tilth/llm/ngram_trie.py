"""Compact successor tries in Elias-Fano form, and language-model scores of documents from them.

A trie level is a row of numbers that never falls, kept in about two bits more than the
spread of its values needs. For every context the ids of its successors follow each other,
shifted by the context's place so that the whole level rises; a second row points to each
context's first successor. A query finds the context, then searches the successor within
the context's own range. Probabilities are kept as one byte each, by a codebook.

The model interpolates word pairs with single words: P(w | v) = (c(vw) + MU * P(w)) /
(c(v) + MU), P(w) being the add-one estimate. The pair's part, c(vw) / (c(v) + MU), is what
the trie holds. Contexts are dealt over tries by hash, frequent ones by their successors
too, so no trie grows with one word's share of the corpus.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm.blocks import Block, answers, asks, by_bucket, each_block, expand, hash_bucket, squeeze, with_answers, write_blocks
from tilth.llm.common import pick, written
from tilth.llm.words import LOWER, joined, span_hash, word_spans

MU = 100.0
#: Compressed input bytes for each bucket of words and of pairs.
SHARE = 4 << 20
END = np.uint64(1)


class Bits:
    """A bit row with select: where the k-th one, or the k-th zero, stands."""

    def __init__(self, words: np.ndarray, ones_before: np.ndarray):
        self.words, self.ones = words, ones_before

    @staticmethod
    def of(positions: np.ndarray, size: int) -> Bits:
        """Ones at the positions given, which rise."""
        flags = np.zeros((size // 64 + 1) * 64, np.uint8)
        flags[positions] = 1
        words = np.packbits(flags, bitorder="little").view(np.uint64)
        return Bits(words, np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]))

    def one(self, k: np.ndarray) -> np.ndarray:
        return self._select(k, self.ones, self.words)

    def zero(self, k: np.ndarray) -> np.ndarray:
        zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        return self._select(k, zeros, ~self.words)

    @staticmethod
    def _select(k: np.ndarray, before: np.ndarray, words: np.ndarray) -> np.ndarray:
        at = np.searchsorted(before, k, side="right") - 1
        left = k - before[at]
        word = words[at]
        place = at * 64
        for width in (32, 16, 8, 4, 2, 1):
            low = np.bitwise_count(word & np.uint64((1 << width) - 1)).astype(np.int64)
            skip = left >= low
            left = np.where(skip, left - low, left)
            word = np.where(skip, word >> np.uint64(width), word)
            place = place + np.where(skip, width, 0)
        return place


class EliasFano:
    """Numbers that never fall, by position and by successor search."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: Bits):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        flags = np.zeros(n * bits + 64, np.uint8)
        for b in range(bits):
            flags[b : n * bits : bits] = (values >> np.uint64(b)).astype(np.uint8) & 1
        low = np.packbits(flags[: (len(flags) // 64) * 64 + 64] if len(flags) % 64 == 0 else np.pad(flags, (0, 64 - len(flags) % 64)), bitorder="little").view(np.uint64)
        upper = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        return EliasFano(n, bits, low, Bits.of(upper, (top >> bits) + n + 1))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i * self.low_bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        after = np.where(shift > 0, self.low[np.minimum(word + 1, len(self.low) - 1)] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> shift) | after) & np.uint64((1 << self.low_bits) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        high = (self.high.one(i) - i).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(i)

    def find(self, x: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Position of each x within its range, -1 where it isn't there."""
        x = x.astype(np.uint64)
        if not self.n:
            return np.full(len(x), -1, np.int64)
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        most = int(self[np.array([self.n - 1])][0] >> np.uint64(self.low_bits))
        inside = high <= most
        h = np.minimum(high, most)
        first = np.where(h > 0, self.high.zero(np.maximum(h - 1, 0)) - h + 1, 0)
        last = self.high.zero(h) - h
        a, b = np.maximum(first, start), np.minimum(last, stop)
        want = x & np.uint64((1 << self.low_bits) - 1)
        a, b = np.where(inside, a, 0), np.where(inside, b, 0)
        end = b
        while (open_ := a < b).any():
            mid = (a + b) >> 1
            less = open_ & (self._low(np.minimum(mid, self.n - 1)) < want)
            a = np.where(less, mid + 1, a)
            b = np.where(open_ & ~less, mid, b)
        here = a < end
        here[here] = self._low(a[here]) == want[here]
        return np.where(here, a, -1)

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.int64), self.low, self.high.words, self.high.ones]

    @staticmethod
    def from_arrays(arrays: list[np.ndarray]) -> EliasFano:
        head, low, words, ones = arrays
        return EliasFano(int(head[0]), int(head[1]), low, Bits(words, ones))


class Trie:
    """Successors of contexts with a byte for each. Ids of successors are numbered within the trie first."""

    def __init__(self, contexts: EliasFano, words: EliasFano, pointers: EliasFano, level: EliasFano, codes: np.ndarray, book: np.ndarray):
        self.contexts, self.words, self.pointers, self.level, self.codes, self.book = contexts, words, pointers, level, codes, book

    @staticmethod
    def of(context: np.ndarray, word: np.ndarray, value: np.ndarray) -> Trie:
        """Pairs in order of (context, word), each once, with a number for each that is kept to one byte."""
        contexts, first, row = np.unique(context, return_index=True, return_inverse=True)
        words, local = np.unique(word, return_inverse=True)
        level = row.astype(np.uint64) * np.uint64(max(1, len(words))) + local.astype(np.uint64)
        book = np.unique(np.quantile(np.unique(value), np.linspace(0, 1, 255), method="nearest")).astype(np.float32) if len(value) else np.zeros(1, np.float32)
        code = np.clip(np.searchsorted((book[1:] + book[:-1]) / 2, value), 0, len(book) - 1).astype(np.uint8)
        return Trie(EliasFano.of(contexts), EliasFano.of(words), EliasFano.of(np.append(first, len(context))), EliasFano.of(level), code, book)

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Position of each pair, -1 if the trie hasn't got it."""
        whole = lambda e, x: e.find(x, np.zeros(len(x), np.int64), np.full(len(x), e.n, np.int64))
        row, local = whole(self.contexts, context), whole(self.words, word)
        known = np.flatnonzero((row >= 0) & (local >= 0))
        row, local = row[known], local[known]
        start, stop = self.pointers[row].astype(np.int64), self.pointers[row + 1].astype(np.int64)
        found = np.full(len(context), -1, np.int64)
        found[known] = self.level.find(row.astype(np.uint64) * np.uint64(max(1, self.words.n)) + local.astype(np.uint64), start, stop)
        return found

    def mapped(self) -> Trie:
        """The same trie over a file of its levels, mapped into memory."""
        parts = [a for e in (self.contexts, self.words, self.pointers, self.level) for a in e.arrays()] + [self.codes, self.book]
        with tempfile.TemporaryFile() as file:
            places = []
            for a in parts:
                file.write(bytes(-file.tell() % 8))
                places.append(file.tell())
                file.write(np.ascontiguousarray(a).data)
            file.write(bytes(8))
            file.flush()
            whole = np.memmap(file, np.uint8, "r")
        views = [whole[p : p + a.nbytes].view(a.dtype) for p, a in zip(places, parts)]
        levels = [EliasFano.from_arrays(views[4 * i : 4 * i + 4]) for i in range(4)]
        return Trie(*levels, views[16], views[17])


def _tokens(block: Block) -> tuple:
    """(distinct hashes, token numbers, document of each token, place of the end's number): each text's words, then its end."""
    buffer, at = joined(list(block.texts()))
    buffer = LOWER[buffer]
    starts, ends = word_spans(buffer)
    h = np.maximum(span_hash(buffer, starts, ends), np.uint64(2))
    distinct, number = np.unique(np.append(h, END), return_inverse=True)
    end = int(number[-1])
    words = np.diff(np.searchsorted(starts, at))
    after = np.cumsum(words)
    tokens = np.insert(number[:-1], after, end)
    doc = np.repeat(np.arange(len(words)), words + 1)
    before = np.insert(number[:-1], after - words, end)
    return distinct, tokens, before, doc, end


def ask_words(buckets: int):
    def fn(block: Block) -> Iterable[tuple[int, bytes]]:
        distinct, tokens, _, doc, _ = _tokens(block)
        times = np.bincount(tokens[block.flags[doc]], minlength=len(distinct)).astype(np.uint32)
        for bucket, s in by_bucket(hash_bucket(distinct, buckets)):
            yield bucket, squeeze(np.diff(distinct[s], prepend=np.uint64(0)), times[s])

    return fn


def answer_words(bucket: int, blobs: list[bytes]) -> Iterator[bytes]:
    """Count and number of each word asked about; numbers follow the counts, 0 is no word of the training texts."""
    lists = [expand(b) for b in blobs]
    hashes = [np.cumsum(step, dtype=np.uint64) for step, _ in lists]
    distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
    count = np.bincount(place, np.concatenate([t for _, t in lists])).astype(np.int64)
    number = np.zeros(len(distinct), np.uint32)
    number[np.argsort(-count, kind="stable")] = np.arange(1, len(distinct) + 1)
    number[count == 0] = 0
    at = 0
    for i, h in enumerate(hashes):
        own = place[at : at + len(h)]
        at += len(h)
        totals = np.array([count.sum(), (count > 0).sum()] if i == 0 else [0, 0], np.int64)
        yield totals.tobytes() + squeeze(count[own], number[own])


def _known(block: Block, told: list[tuple[int, bytes]], buckets: int) -> tuple:
    """Tokens as by ``_tokens``, with count and id of each distinct word; id 0: none."""
    distinct, tokens, before, doc, end = _tokens(block)
    count, ids = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
    said = dict(told)
    for bucket, s in by_bucket(hash_bucket(distinct, buckets)):
        c, number = expand(said[bucket][16:])
        count[s] = c
        ids[s] = np.where(number > 0, (number.astype(np.int64) - 1) * buckets + bucket + 1, 0)
    return tokens, before, doc, count, ids


def _pairs(tokens: np.ndarray, before: np.ndarray, count: np.ndarray, ids: np.ndarray, buckets: int, total: int) -> tuple:
    """Distinct pairs of known words in order of (bucket, context, word): (bucket, context and word number of each), and each token's pair, -1 for none."""
    known = np.flatnonzero((ids[before] > 0) & (ids[tokens] > 0))
    n = len(ids)
    key, place = np.unique(before[known].astype(np.int64) * n + tokens[known], return_inverse=True)
    context, word = key // n, key % n
    mixed = lambda x: (x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    # a context with more than a quarter of a bucket's mean load is dealt out by its successors
    ways = 1 + 4 * count[context] * buckets // max(1, total)
    bucket = ((mixed(ids[context]) + mixed(ids[word]) % ways.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((ids[word], ids[context], bucket))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    pair = np.full(len(tokens), -1, np.int64)
    pair[known] = rank[place]
    return bucket[order], context[order], word[order], pair


def ask_pairs(buckets: int, total: int):
    def fn(block: Block, told: list[tuple[int, bytes]]) -> Iterable[tuple[int, bytes]]:
        tokens, before, doc, count, ids = _known(block, told, buckets)
        bucket, context, word, pair = _pairs(tokens, before, count, ids, buckets, total)
        learnt = pair[block.flags[doc] & (pair >= 0)]
        times = np.bincount(learnt, minlength=len(bucket)).astype(np.uint32)
        for number, s in by_bucket(bucket):
            c, first = np.unique(ids[context[s]], return_index=True)
            size = np.diff(np.append(first, s.stop - s.start))
            yield number, squeeze(np.diff(c, prepend=0), count[context[s]][first], size.astype(np.uint32), ids[word[s]].astype(np.uint32 if ids.max() < 1 << 32 else np.uint64), times[s])

    return fn


def build_trie(context: np.ndarray, word: np.ndarray, times: np.ndarray, context_count: np.ndarray, mu: float = MU) -> Trie:
    """Trie of the pairs that occur; rows of one pair add up."""
    some = np.flatnonzero(times)
    context, word, times, context_count = context[some], word[some], times[some], context_count[some]
    order = np.lexsort((word, context))
    context, word = context[order], word[order]
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(context) != 0) | (np.diff(word) != 0)
    first = np.flatnonzero(new)
    total = np.add.reduceat(times[order], first) if len(first) else times[:0]
    value = np.log10(total / (context_count[order][first] + mu)) if len(first) else np.zeros(0)
    return Trie.of(context[first], word[first], value)


def answer_pairs(mu: float):
    def fn(bucket: int, blobs: list[bytes]) -> Iterator[bytes]:
        """The bucket's trie, and from it the code of each pair asked about, 0 for none."""
        rows = []
        for blob in blobs:
            step, count, size, word, times = expand(blob)
            rows.append((np.repeat(np.cumsum(step), size), word.astype(np.int64), times.astype(np.int64), np.repeat(count, size)))
        trie = build_trie(*(np.concatenate(c) for c in zip(*rows)), mu).mapped()
        for context, word, _, _ in rows:
            found = trie.find(context, word)
            code = np.where(found >= 0, trie.codes[np.maximum(found, 0)].astype(np.uint16) + 1 if len(trie.codes) else 0, 0).astype(np.uint8)
            yield squeeze(np.asarray(trie.book), code)

    return fn


def score(buckets: int, total: int, distinct: int, mu: float):
    def fn(block: Block, words: list[tuple[int, bytes]], told: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        tokens, before, doc, count, ids = _known(block, words, buckets)
        bucket, _, _, pair = _pairs(tokens, before, count, ids, buckets, total)
        part = np.zeros(len(bucket) + 1)  # the last is for no pair
        said = dict(told)
        for number, s in by_bucket(bucket):
            book, code = expand(said[number])
            part[s] = np.where(code > 0, 10.0 ** book.astype(np.float64)[np.maximum(code.astype(np.int64) - 1, 0)], 0.0)
        single = (count + 1) / (total + distinct + 1)
        whole = part[pair] + mu / (count[before] + mu) * single[tokens]
        n = len(block.ids)
        add = lambda x: np.bincount(doc, x, n)
        columns = [
            pa.array(block.ids),
            pa.array(np.bincount(doc, minlength=n)),
            pa.array(add(count[tokens] > 0).astype(np.int64)),
            pa.array(np.full(n, total, np.int64)),
            pa.array(add(np.log10(single)[tokens])),
            pa.array(add(np.log10(np.minimum(whole, 1.0)))),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return fn


def _totals(told: DataFrame) -> tuple[int, int]:
    """Tokens and distinct words of the training texts, from the heads of the answers."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(2, np.int64)
        for part in parts:
            for blob in part.column(0).to_pylist():
                sums += np.frombuffer(blob, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([int(sums[0])]), pa.array([int(sums[1])])], names=["n", "v"])

    row = told.select(F.substring("blob", 1, 16)).mapInArrow(run, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
    return row[0] or 0, row[1] or 0


def lm_scores(docs: DataFrame, train_col: str, id_col: str = "doc_id", text_col: str = "text", mu: float = MU) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every document with an id; runs jobs.

    Learns from the rows where ``train_col`` is true. Tokens are the lower-cased (A-Z) words
    between ASCII blanks and one end to each text; words are told apart by 64-bit hashes. A
    null text is empty: its one token is the end. score: log10 of the text's probability, each token
    given the one before; base_score: with each token alone. Repeated rows count and are scored each.
    """
    source = pick(docs, doc_id=id_col, text=text_col, flag=train_col)
    source = source.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("flag", F.lit(False)).alias("flag"))
    blocks = write_blocks(source)
    size = blocks.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(4, size // SHARE)
    words = written(answers(asks(blocks, ask_words(buckets)), answer_words), "words")
    total, distinct = _totals(words)
    known = with_answers(blocks, words, "words")
    pairs = written(answers(asks(known, ask_pairs(buckets, total)), answer_pairs(mu)), "pairs")
    both = with_answers(known, pairs, "pairs")
    return each_block(both, score(buckets, total, distinct, mu), "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
