"""Removal of repeated byte strings by suffix sorting, one bucket at a time, with difference covers.

A byte goes if it lies in a string of 50 bytes that also starts in a document with a smaller
id. Suffixes are dealt to buckets by the smallest hash of the 24-byte strings in their first
50 bytes: equal beginnings have equal smallest hashes, and neighbours mostly share one, so a
run of suffixes travels as one piece of text. First the blocks ask which of these hashes
occur in two documents; only runs with such a hash are sorted. If more suffixes have a hash
than are sorted at a time, they are dealt on one by one, by a hash of their first 50 bytes,
and of equal ones a block sends only that of its smallest document: at the edges of a passage
runs hold bytes of the document's own, so as runs they would come once for each document.

A bucket sorts its suffixes by their first 8 bytes. Longer ties are resolved by a difference
cover modulo 8: positions whose residue is 0, 1, 2 or 4 are ranked beforehand to 43 bytes,
by doubling, for a position and the one 8 further have the same residue. Any two suffixes have
a distance below 8 at which both reach such a position; there equal ranks, with equal first
and last 8 bytes, say that 50 bytes agree. So the smallest document among a suffix's equals is
the smallest over its four groups of equal keys, and no two suffixes are ever compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm.blocks import Block, answers, asks, by_bucket, each_block, expand, hash_bucket, squeeze, with_answers, write_blocks
from tilth.llm.common import pick, written
from tilth.llm.words import span_hash

LENGTH = 50
GRAM = 24
COVER, PERIOD, RANKED = (0, 1, 2, 4), 8, 43
#: Positions hashed and suffixes sorted at a time; input bytes for each bucket.
SLICE, SORTED, SHARE = 1 << 18, 1 << 18, 6 << 20
#: Bytes of text in a block.
BLOCK = 2 << 20
#: What a suffix sent by itself costs to sort, in suffixes of a run.
SINGLE = 10
_covered = np.isin(np.arange(PERIOD), COVER)
_odd = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _words(padded: np.ndarray, at: int, n: int, big: bool = False) -> np.ndarray:
    """The 8 bytes from each of n positions on, as numbers."""
    return np.ndarray((n,), ">u8" if big else "<u8", padded.data, at, (1,)).astype(np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(29))
    x *= _odd[3]
    x ^= x >> np.uint64(32)
    return x


def runs(text: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, start, suffixes, document) of the runs of neighbouring suffixes with one smallest hash, in order; suffixes shorter than 50 bytes are in none."""
    ends = np.cumsum(lengths)
    begin = ends - lengths
    n = len(text)
    padded = np.frombuffer(text + bytes(LENGTH + 32), np.uint8)
    wide = LENGTH - GRAM + 1
    marks = [np.zeros(0, np.int64)]
    keys = [np.zeros(0, np.uint64)]
    last = None
    for a in range(0, n, SLICE):
        b = min(n, a + SLICE)
        m = b - a + wide - 1
        h = _mix(_words(padded, a, m) * _odd[0] + _words(padded, a + 8, m) * _odd[1] + _words(padded, a + 16, m) * _odd[2])
        step = 1
        while step * 2 <= wide:
            h = np.minimum(h[:-step], h[step:])
            step *= 2
        if wide > step:
            h = np.minimum(h[: b - a], h[wide - step : wide - step + b - a])
        h = h[: b - a]
        new = np.ones(b - a, bool)
        new[1:] = h[1:] != h[:-1]
        if last is not None:
            new[0] = h[0] != last
        last = h[-1]
        new[begin[(begin >= a) & (begin < b)] - a] = True
        at = np.flatnonzero(new)
        marks.append(at + a)
        keys.append(h[at])
    start, key = np.concatenate(marks), np.concatenate(keys)
    doc = np.searchsorted(ends, start, side="right")
    stop = np.minimum(np.append(start[1:], n), ends[doc] - LENGTH + 1) if len(start) else start
    some = stop > start
    key = _mix(key * _odd[0])
    return key[some], start[some], (stop - start)[some], doc[some]


def _distinct_keys(block: Block) -> tuple:
    """The block's runs, its distinct keys, each run's key number, whether a key is in two documents here, and its suffixes."""
    key, start, count, doc = runs(block.text, block.lengths)
    distinct, place = np.unique(key, return_inverse=True)
    low = np.full(len(distinct), np.iinfo(np.int64).max)
    high = np.full(len(distinct), np.iinfo(np.int64).min)
    np.minimum.at(low, place, block.ids[doc])
    np.maximum.at(high, place, block.ids[doc])
    return start, count, doc, distinct, place, low < high, np.bincount(place, count, len(distinct)).astype(np.uint32)


def ask_keys(buckets: int):
    def fn(block: Block) -> Iterable[tuple[int, bytes]]:
        _, _, _, distinct, _, twice, size = _distinct_keys(block)
        short = distinct >> np.uint64(16)  # 48 bits; a chance hit only sorts a run for nothing
        for bucket, s in by_bucket(hash_bucket(distinct, buckets)):
            yield bucket, squeeze(np.diff(short[s], prepend=np.uint64(0)), twice[s].astype(np.uint8), size[s])

    return fn


def answer_keys(bucket: int, blobs: list[bytes], most: int | None = None) -> Iterator[bytes]:
    """For each key asked, whether it is in two documents, and whether more than ``most`` suffixes have it."""
    lists = []
    for blob in blobs:
        step, twice, size = expand(blob)
        lists.append((np.cumsum(step, dtype=np.uint64), twice, size))
    every = np.concatenate([k for k, _, _ in lists])
    order = np.argsort(every, kind="stable")
    new = np.ones(len(every), bool)
    new[1:] = np.diff(every[order]) > 0
    group = np.cumsum(new) - 1
    times = np.bincount(group)
    inside = np.bincount(group, np.concatenate([t for _, t, _ in lists])[order])
    total = np.bincount(group, np.concatenate([n for _, _, n in lists])[order])
    hit, many = np.empty(len(every), bool), np.empty(len(every), bool)
    hit[order] = ((times > 1) | (inside > 0))[group]
    many[order] = (total > (most or SORTED))[group]
    at = 0
    for k, _, _ in lists:
        yield squeeze(np.packbits(hit[at : at + len(k)]), np.packbits(many[at : at + len(k)]))
        at += len(k)


def _chosen(block: Block, told: list[tuple[int, bytes]], buckets: int) -> tuple:
    """Runs to be sorted, and which of them stand for equal pieces of text.

    (start, count, doc) of the runs, each one's piece number, whether it is a suffix dealt by
    itself; and of the pieces, in the order asked: bucket, the run that shows the text.
    """
    start, count, doc, distinct, place, _, _ = _distinct_keys(block)
    hit, many = np.zeros(len(distinct), bool), np.zeros(len(distinct), bool)
    said = dict(told)
    for bucket, s in by_bucket(hash_bucket(distinct, buckets)):
        if bucket in said:
            n = s.stop - s.start
            hit[s], many[s] = (np.unpackbits(bits, count=n).astype(bool) for bits in expand(said[bucket]))
    run = np.flatnonzero(hit[place])
    single = many[place[run]]
    times = np.where(single, count[run], 1)
    within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    run, single = np.repeat(run, times), np.repeat(single, times)
    start, count, doc, place = start[run] + within, np.where(single, 1, count[run]), doc[run], place[run]
    buffer = np.frombuffer(block.text, np.uint8)
    ends = start + count + LENGTH - 1
    one, two = (span_hash(buffer, start, ends, w) for w in (0, 1)) if len(run) else (np.zeros(0, np.uint64),) * 2
    group = np.where(single, one, distinct[place])
    order = np.lexsort((block.ids[doc], two, one, count, group))
    differ = np.ones(len(order), bool)
    for a in (one, two, count, group):
        differ[1:] &= a[order][1:] == a[order][:-1]
    differ[1:] = ~differ[1:]
    piece = np.empty(len(order), np.int64)
    piece[order] = np.cumsum(differ) - 1
    shown = order[differ]  # the run with the smallest document of each piece
    return start, count, doc, piece, single, hash_bucket(group[shown], buckets), shown


def ask_pieces(buckets: int):
    def fn(block: Block, told: list[tuple[int, bytes]]) -> Iterable[tuple[int, bytes]]:
        start, count, doc, _, single, bucket, shown = _chosen(block, told, buckets)
        buffer = np.frombuffer(block.text, np.uint8)
        for number, s in by_bucket(bucket):
            some = shown[s]
            size = count[some] + LENGTH - 1
            flat = np.arange(size.sum()) + np.repeat(start[some] - np.cumsum(size) + size, size)
            told_as = np.where(single[some], 0, count[some]).astype(np.uint32)
            yield number, squeeze(np.diff(block.ids[doc[some]], prepend=0), told_as, buffer[flat])

    return fn


def _rank(*keys: np.ndarray) -> np.ndarray:
    """Dense ranks of rows of keys."""
    if len(keys) == 1:
        return np.unique(keys[0], return_inverse=True)[1]
    first = keys[0].astype(np.uint64)
    for k in keys[1:]:
        first = np.unique(first, return_inverse=True)[1].astype(np.uint64) if first.max(initial=0) >= 1 << 32 else first
        first = (first << np.uint64(32)) | k.astype(np.uint64)
    return np.unique(first, return_inverse=True)[1]


def least_documents(pool: np.ndarray, suffix: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each suffix of the pool the smallest document among those whose first 50 bytes are the same.

    pool: bytes, 64 more than any suffix needs; suffix: positions, with 50 bytes each that belong to it.
    """
    n = len(pool) - 64
    spots = np.flatnonzero(_covered[np.arange(n) % PERIOD])
    first = np.ndarray((n,), ">u8", pool.data, 0, (1,))
    # ranks of the cover's positions to 8, 16, 32 and 43 bytes; a rank is looked up by position
    rank = np.zeros(n + 64, np.int64)
    wanted = np.zeros(n + 64, bool)
    for shift in range(PERIOD):
        wanted[suffix + shift] = True
    need43 = spots[wanted[spots]]
    need16 = np.unique(np.concatenate([need43, need43 + 16]))
    need16 = need16[need16 < n]
    r8 = rank.copy()
    r8[spots] = _rank(first[spots].astype(np.uint64))
    r16 = rank.copy()
    r16[need16] = _rank(r8[need16], r8[need16 + 8])
    r32 = _rank(r16[need43], r16[need43 + 16])
    tail = first[np.minimum(need43 + 40, n - 1)].astype(np.uint64) >> np.uint64(40)
    r43 = rank
    r43[need43] = _rank(_rank(r32, r8[need43 + 32]), tail)
    ends = _rank(_rank(first[suffix].astype(np.uint64)), _rank(first[suffix + LENGTH - 8].astype(np.uint64))).astype(np.uint64)
    least = doc.copy()
    for shift in range(PERIOD):
        here = np.flatnonzero(_covered[(suffix + shift) % PERIOD])
        if not len(here):
            continue
        key = (ends[here] << np.uint64(32)) | r43[suffix[here] + shift].astype(np.uint64)
        order = np.argsort(key, kind="stable")
        new = np.ones(len(here), bool)
        new[1:] = np.diff(key[order]) > 0
        low = np.minimum.reduceat(doc[here][order], np.flatnonzero(new))[np.cumsum(new) - 1]
        at = here[order]
        least[at] = np.minimum(least[at], low)
    return least


def answer_pieces(bucket: int, blobs: list[bytes], most: int | None = None) -> Iterator[bytes]:
    """For each suffix of each piece, whether a smaller document has its first 50 bytes; a count of 0 is a suffix dealt by itself."""
    lists = []
    for blob in blobs:
        step, count, text = expand(blob)
        lists.append((np.cumsum(step), count.astype(np.int64), text))
    doc = np.concatenate([d for d, _, _ in lists])
    count = np.concatenate([c for _, c, _ in lists])
    text = np.concatenate([t for _, _, t in lists])
    lists = [np.maximum(c, 1) for _, c, _ in lists]
    del blobs
    single = count == 0
    count = np.maximum(count, 1)
    size = count + LENGTH - 1
    start = np.cumsum(size) - size
    # one smallest hash, or one hash of 50 bytes, at a time would do; as many as fit are sorted together
    padded = np.concatenate([text, np.zeros(64, np.uint8)])
    key = np.empty(len(start), np.uint64)
    key[~single] = _piece_keys(padded, start[~single])
    key[single] = span_hash(padded, start[single], start[single] + LENGTH)
    order = np.argsort(key, kind="stable")
    total = np.cumsum(np.where(single, SINGLE, count)[order])
    hit = np.zeros(int(count.sum()), bool)
    offset = np.cumsum(count) - count
    a = 0
    while a < len(order):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + (most or SORTED), side="right")))
        while b < len(order) and key[order[b]] == key[order[b - 1]]:
            b += 1
        some = order[a:b]
        flat = np.arange(size[some].sum()) + np.repeat(start[some] - np.cumsum(size[some]) + size[some], size[some])
        pool = np.concatenate([text[flat], np.zeros(64, np.uint8)])
        base = np.cumsum(size[some]) - size[some]
        n = count[some]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        owner = np.repeat(doc[some], n)
        low = least_documents(pool, np.repeat(base, n) + within, owner)
        hit[np.repeat(offset[some], n) + within] = low < owner
        a = b
    at = 0
    for c in lists:
        n = int(c.sum())
        yield squeeze(np.packbits(hit[at : at + n]))
        at += n


def _piece_keys(padded: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The smallest hash that each piece's suffixes share, from its first suffix."""
    wide = LENGTH - GRAM + 1
    least = None
    words = np.ndarray((len(padded) - 7,), "<u8", padded.data, 0, (1,))
    for shift in range(wide):
        p = start + shift
        h = _mix(words[p] * _odd[0] + words[p + 8] * _odd[1] + words[p + 16] * _odd[2])
        least = h if least is None else np.minimum(least, h)
    return least


def cut(buckets: int, with_text: bool):
    def fn(block: Block, keys: list[tuple[int, bytes]], told: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        start, count, doc, piece, _, bucket, shown = _chosen(block, keys, buckets)
        n = len(block.text)
        edge = np.zeros(n + 1, np.int32)
        said = dict(told)
        own = block.ids[doc]
        lowest = own[shown]
        # every run of a piece but those of its smallest document repeats that document as a whole
        whole = np.flatnonzero(own > lowest[piece]) if len(piece) else piece
        np.add.at(edge, start[whole], 1)
        np.add.at(edge, start[whole] + count[whole] + LENGTH - 1, -1)
        part = np.flatnonzero(own == lowest[piece]) if len(piece) else piece
        size = count[shown]
        bits = np.zeros(int(size.sum()), bool)
        base = np.cumsum(size) - size
        for number, s in by_bucket(bucket):
            a, b = int(base[s.start]), int(base[s.stop - 1] + size[s.stop - 1])
            bits[a:b] = np.unpackbits(expand(said[number])[0], count=b - a)
        c = count[part]
        within = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        hit = bits[np.repeat(base[piece[part]], c) + within]
        at = (np.repeat(start[part], c) + within)[hit]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + LENGTH, -1)
        gone = np.cumsum(edge[:-1]) > 0
        ends = np.cumsum(block.lengths)
        begin = ends - block.lengths
        total = np.concatenate([[0], np.cumsum(gone)])
        removed = total[ends] - total[begin]
        rise = gone.copy()
        rise[1:] &= ~gone[:-1]
        inner = begin[block.lengths > 0]
        rise[inner] = gone[inner]
        opened = np.concatenate([[0], np.cumsum(rise)])
        spans = opened[ends] - opened[begin]
        buffer = np.frombuffer(block.text, np.uint8)
        kept = [buffer[a:b][~gone[a:b]].tobytes() if r else block.text[a:b] for a, b, r in zip(begin.tolist(), ends.tolist(), removed.tolist())]
        columns = [pa.array(block.ids), pa.array(block.lengths), pa.array(removed.astype(np.int64)), pa.array(spans.astype(np.int64))]
        if with_text:
            last = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
        else:
            last = pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())
        yield pa.RecordBatch.from_arrays([*columns, last], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_text" if with_text else "kept_sha256"])

    return fn


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document with an id; runs jobs.

    with_text: instead of the digest the text kept, ``kept_text``, without characters that a
    cut left incomplete. A null text is empty; texts under 50 bytes are never cut. Rows with
    one id are not smaller than each other, so they don't cut each other. Matches don't cross rows.
    """
    source = pick(docs, doc_id=id_col, text=text_col)
    source = source.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(True).alias("flag"))
    blocks = write_blocks(source, BLOCK)
    size = blocks.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(4, 2 * size // SHARE)
    blocks = with_answers(blocks, written(answers(asks(blocks, ask_keys(buckets)), partial(answer_keys, most=SORTED)), "keys"), "keys")
    blocks = with_answers(blocks, written(answers(asks(blocks, ask_pieces(buckets)), partial(answer_pieces, most=SORTED)), "pieces"), "pieces")
    last = "kept_text string" if with_text else "kept_sha256 string"
    return each_block(blocks, cut(buckets, with_text), f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with the text that is kept; runs jobs.

    ``n_chars``, where there is one, counts the characters left. A null text stays null. Ids
    are taken to be unique; rows without one go.
    """
    kept = remove_repeats(docs, with_text=True).where("n_removed > 0").select(F.col("doc_id").alias("__doc"), F.col("kept_text").alias("__text"))
    joined = docs.where("doc_id is not null").join(kept, docs["doc_id"] == kept["__doc"], "left")
    changed = F.col("__doc").isNotNull()
    out = joined.withColumn("text", F.when(changed, F.col("__text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
