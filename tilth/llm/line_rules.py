"""Line-first cleaning: rules judge single lines, failing lines go, and a text that loses too much goes as a whole.

Page furniture is known by a few fixed phrases and, in any language, by what the corpus repeats: a
short line that many documents hold between lines that differ (``furniture_lines``).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import pick, raw, written

LEAST_WORDS = 50
#: A text is rejected if 100 * repeated words > MOST_REPEATED * words.
MOST_REPEATED = 50
#: Share of a text's word characters that its lines must keep.
LEAST_KEPT = 0.5
SYMBOLS = "#*$%&|<>"
#: What may end a sentence, what stands between links, phrases of page furniture.
ENDS = (".", "!", "?", "…", "。", "！", "？", ":", ";")
CLOSERS = "\"'”’»)]}"
SEPARATORS = ("|", "»", "›", "•", "·", ">", "::", "/")
FURNITURE = re.compile(
    r"\b(?:all rights reserved|cookies?|privacy policy|terms of (?:use|service)|javascript|lorem ipsum|sign (?:in|up)|log ?in|"
    r"subscribe|newsletter|click here|read more|share this|follow us|powered by|skip to content|page not found)\b",
    re.IGNORECASE,
)
SENTENCE = re.compile(r"[.!?…]['\"”’»)\]]*\s")
SPACES = " \t\n\x0b\x0c\r"
LINE = 40
#: A repeated line is furniture if this share of all documents hold it, and this many of them, ...
HOLDERS_SHARE = 0.005
HOLDERS = 20
#: ... and the lines before it or the lines after it are at least this many for each holder.
CONTEXTS = 0.5
NO_LINES: frozenset[int] = frozenset()


def punctuation_fails(line: str, words: list[str]) -> bool:
    """No sentence: a short line without an end mark, or symbols and shouting on most words."""
    marked = sum(1 for w in words if w[-1] in SYMBOLS)
    shouted = sum(1 for w in words if w.endswith("!!"))
    if 2 * max(marked, shouted) > len(words):
        return True
    if line.rstrip().rstrip(CLOSERS).endswith(ENDS):
        return False
    return len(words) < LINE // 4 and not SENTENCE.search(line)


def navigation_fails(words: list[str]) -> bool:
    """Links in a row: three separators or more that stand alone, with at most three words to each."""
    alone = sum(1 for w in words if w in SEPARATORS)
    return alone >= 3 and len(words) - alone <= 3 * (alone + 1)


def furniture_fails(line: str, words: list[str]) -> bool:
    return len(words) <= LINE and FURNITURE.search(line) is not None


def split_words(text: str) -> list[str]:
    """Words between blanks of ASCII only."""
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def line_key(line: bytes) -> int:
    """Signed hash of a line's words, A-Z in lower case."""
    h = xxhash.xxh64_intdigest(b" ".join(line.lower().split()))
    return h - (h >> 63 << 64)


def clean_lines(text: str, learned: frozenset[int] = NO_LINES) -> tuple[str, int, int]:
    """(text of the lines that pass, their word characters, word characters in all)."""
    kept, own, total = [], 0, 0
    for line in text.split("\n"):
        words = split_words(line)
        size = sum(map(len, words))
        total += size
        if words and (punctuation_fails(line, words) or navigation_fails(words) or furniture_fails(line, words)):
            continue
        if learned and 0 < len(words) <= LINE and line_key(line.encode("utf-8", "surrogatepass")) in learned:
            continue
        kept.append(line)
        own += size
    return "\n".join(kept), own, total


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more, the first included."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    _, place, times = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    twice = times[place] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= twice
    return int(inside.sum())


def judge(text: str, learned: frozenset[int] = NO_LINES) -> tuple:
    """The row of a text but for its id, in the order of FIELDS."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    repeated = repeated_words(words)
    failed = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED * n
    cleaned, own, total = clean_lines(text, learned)
    kept = not failed and own >= LEAST_KEPT * total
    return n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, failed, kept, own, cleaned


FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, kept_chars long, cleaned string"


def short_lines(text: bytes) -> Iterator[tuple[int, int, int]]:
    """(key, key of the line before, of the line after) of each line of at most LINE words, at its first place; 0 for none."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    keys = [0, *map(line_key, lines), 0]
    seen = set()
    for i, line in enumerate(lines, 1):
        if keys[i] not in seen and len(line.split()) <= LINE:
            seen.add(keys[i])
            yield keys[i], keys[i - 1], keys[i + 1]


def furniture_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = HOLDERS_SHARE, least: int = HOLDERS, contexts: float = CONTEXTS) -> DataFrame:
    """(key, holders, contexts): short lines that many documents hold between lines that differ. Runs jobs.

    key: ``line_key`` of the line; holders: documents with it, every row counted, ids repeated or not;
    contexts: distinct lines before it or after it, whichever are more, at its first place in a text.
    Lines of copied passages keep their neighbours and are no furniture, nor are texts of one line.
    A null or empty text holds no line; an empty table gives no rows.

    Counts cover all documents. The lines asked about in the second scan are sent to every task: if a
    text has L short lines on average, at most L / ``share`` lines reach the share, at any corpus size.
    """
    source = pick(docs, doc_id=id_col, text=text_col)
    enough = max(least, math.ceil(share * source.count()))

    def held(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keys = np.fromiter((k for t in raw(part.column(1)) for k, _, _ in short_lines(t)), np.int64)
            found, times = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(times.astype(np.int64))], names=["key", "n"])

    counts = source.mapInArrow(held, "key long, n long").groupBy("key").agg(F.sum("n").alias("holders"))
    common = written(counts.where(F.col("holders") >= enough), "common_lines")
    asked = line_set(common)

    def beside(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = ((k, side, other) for t in raw(part.column(1)) for k, *both in short_lines(t) if k in asked for side, other in enumerate(both))
            rows = np.array(sorted(set(found)), np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, i]) for i in range(3)], names=["key", "side", "other"])

    pairs = source.mapInArrow(beside, "key long, side long, other long").distinct().groupBy("key", "side").agg(F.count("*").alias("n"))
    around = pairs.groupBy("key").agg(F.max("n").alias("contexts"))
    return common.join(around, "key").where(F.col("contexts") >= contexts * F.col("holders"))


def line_set(lines: DataFrame) -> frozenset[int]:
    return frozenset(r.key for r in lines.select("key").collect())


def line_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", furniture: DataFrame | None = None) -> DataFrame:
    """One row for each document with an id: counts, verdict, and the text that its passing lines leave.

    furniture: lines that fail wherever they stand, by ``key`` (``furniture_lines``); none if left out.
    A null text counts as empty: no words, so it fails the base rules. Repeated rows are judged one by one.
    """
    source = pick(docs, doc_id=id_col, text=text_col)
    learned = NO_LINES if furniture is None else line_set(furniture)
    kind = source.schema["doc_id"].dataType.simpleString()
    types = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.int64(), pa.string()]
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 512):
                rows = part.slice(at, 512)
                found = list(zip(*(judge(t or "", learned) for t in rows.column(1).to_pylist())))
                yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(c, t) for c, t in zip(found, types))], names=["doc_id", *names])

    return source.mapInArrow(run, f"doc_id {kind}, {FIELDS}")
