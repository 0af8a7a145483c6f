"""Fuzzy search for short licence notices.

Texts are normalised to lower-case words with one blank between them. A notice that may
have k errors is split into k + 1 pieces, one of which any occurrence holds unchanged; an
automaton finds the pieces of all notices in one pass, and the regex library's bounded-error
matching then looks for the notice in the few characters around a piece.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import pick, raw
from tilth.llm.words import LOWER, chunks, joined

WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
#: Windows whose match is remembered, notices being copied from text to text.
REMEMBERED = 50_000


@dataclass(frozen=True)
class Notice:
    """Normalised words: ``fixed`` stands unchanged before ``text``, which may have ``edits`` errors.

    An error is a letter or blank inserted, dropped or replaced. Occurrences begin and end
    at word borders. ``base`` marks the phrases that are counted where they stand unchanged.
    """

    label: str
    text: str
    edits: int = 0
    fixed: str = ""
    base: bool = False

    @property
    def whole(self) -> str:
        return self.fixed + self.text


#: Names and sentences of public licences.
NOTICES = (
    Notice("mit", "license", 1, "mit ", base=True),
    Notice("apache", "license", 1, "apache ", base=True),
    Notice("gpl", "general public license", 2, base=True),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("apache", "you may not use this file except in compliance with the license", 5),
    Notice("gpl", "it under the terms of the gnu general public license as published by", 5),
    Notice("agpl", "affero general public license", 2),
    Notice("lgpl", "lesser general public license", 2),
    Notice("bsd", "redistribution and use in source and binary forms with or without", 5),
    Notice("bsd", "license", 1, "bsd "),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", 6),
    Notice("mpl", "mozilla public license", 2),
    Notice("epl", "eclipse public license", 2),
    Notice("boost", "boost software license", 2),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 5),
    Notice("cc", "creative commons attribution", 2),
    Notice("cc", "licensed under cc by", 1),
)

FIELDS = "n_words long, hits array<struct<label:string,notice:string,base:boolean,edits:int,word_from:long,word_to:long,char_from:long,char_to:long>>"


class Search:
    """The automaton of all notices' pieces, and their patterns."""

    def __init__(self, notices: tuple[Notice, ...]):
        self.notices = notices
        self.patterns = [regex.compile(r"(?b)(?<=[ \n])(?:%s)(?:%s){e<=%d}(?=[ \n])" % (regex.escape(n.fixed), regex.escape(n.text), n.edits)) for n in notices]
        self.found: dict[tuple[int, str], tuple[int, int, int] | None] = {}
        pieces: dict[str, list[tuple[int, int]]] = {}
        for i, n in enumerate(notices):
            if n.fixed:
                cuts = [(-1, " " + n.fixed), (-1, "\n" + n.fixed)]
            else:
                ends = np.linspace(0, len(n.text), n.edits + 2).astype(int).tolist()
                cuts = [(a, n.text[a:b]) for a, b in zip(ends, ends[1:])]
            for at, piece in cuts:
                pieces.setdefault(piece, []).append((i, at))
        self.seeds = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()

    def _match(self, i: int, window: str) -> tuple[int, int, int] | None:
        """(start, end, edits) of the best match in a window."""
        key = (i, window)
        if key not in self.found:
            if len(self.found) >= REMEMBERED:
                self.found.clear()
            m = self.patterns[i].search(window)
            self.found[key] = (m.start(), m.end(), sum(m.fuzzy_counts)) if m else None
        return self.found[key]

    def run(self, text: str) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits) of the hits in a text of lines, in order; it begins and ends with a line end.

        Hits of one notice don't overlap, and none goes over a line.
        """
        tried: set[tuple[int, int]] = set()
        hits: dict[int, set[tuple[int, int, int]]] = {}
        for end, (size, places) in self.seeds.iter(text):
            for i, at in places:
                start = end + 1 - size - at
                if (i, start) in tried:
                    continue
                tried.add((i, start))
                n = self.notices[i]
                whole = n.whole
                if text.startswith(whole, start) and text[start - 1] in " \n" and text[start + len(whole)] in " \n":
                    hits.setdefault(i, set()).add((0, start, start + len(whole)))
                    continue
                if not n.edits:
                    continue
                a, b = max(0, start - n.edits - 1), start + len(whole) + n.edits + 1
                line = text.rfind("\n", a, end)
                a = max(a, line)
                line = text.find("\n", end, b)
                b = line + 1 if line >= 0 else b
                m = self._match(i, text[a:b])
                if m:
                    hits.setdefault(i, set()).add((m[2], a + m[0], a + m[1]))
        return sorted((a, b, i, edits) for i, own in hits.items() for edits, a, b in apart(own))


def apart(spans: set[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(edits, start, end): of spans that overlap the one with fewer edits, then the earlier and shorter one."""
    starts: list[int] = []
    ends: list[int] = []
    for edits, a, b in sorted(spans):
        at = bisect.bisect_left(starts, a)
        if (at == 0 or ends[at - 1] <= a) and (at == len(starts) or starts[at] >= b):
            starts.insert(at, a)
            ends.insert(at, b)
            yield edits, a, b


@lru_cache(maxsize=4)
def _search(notices: tuple[Notice, ...]) -> Search:
    return Search(notices)


def normalised(texts: list[bytes]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lines, place, begins, words, chars): a line of words for each text after a first empty line.

    place: the source byte of each character; begins: where each text's line begins;
    words: words begun before each character; chars: characters begun before each source byte.
    Where bytes are no UTF-8 every byte is a character.
    """
    buffer, at = joined(texts)
    low = LOWER[buffer]
    word = WORD_BYTE[low]
    last = np.concatenate([[False], word[:-1]])
    line_end = np.zeros(len(buffer), bool)
    line_end[at[1:] - 1] = True
    out = np.where(word, low, np.uint8(32))
    out[line_end] = 10
    place = np.flatnonzero(word | last | line_end)
    lines = out[place].tobytes()
    try:
        text, lead = lines.decode(), (buffer & 0xC0) != 0x80
    except UnicodeDecodeError:
        text, lead = lines.decode("latin-1"), np.ones(len(buffer), bool)
    place = place[lead[place]]
    starts = (word & ~last)[place]
    words = np.zeros(len(place) + 2, np.int64)
    np.cumsum(starts, out=words[2:])
    begins = np.searchsorted(place, at) + 1
    chars = np.zeros(len(buffer) + 1, np.int64)
    np.cumsum(lead, out=chars[1:])
    return "\n" + text, np.concatenate([[-1], place]), begins, words, chars


def scan(texts: list[bytes], notices: tuple[Notice, ...] = NOTICES) -> list[tuple[int, list[dict]]]:
    """(words, hits) of each text; hits in order of their places."""
    search = _search(notices)
    lines, place, begins, words, chars = normalised(texts)
    counts = np.diff(words[begins])
    hits: list[list[dict]] = [[] for _ in texts]
    for a, b, i, edits in search.run(lines):
        d = int(np.searchsorted(begins, a, side="right")) - 1
        first, after = int(words[a] - words[begins[d]]), int(words[b] - words[begins[d]])
        origin = chars[place[begins[d] - 1] + 1]
        n = notices[i]
        hits[d].append(
            {
                "label": n.label,
                "notice": n.whole,
                "base": n.base and not edits,
                "edits": edits,
                "word_from": first,
                "word_to": after,
                "char_from": int(chars[place[a]] - origin),
                "char_to": int(chars[place[b - 1]] + 1 - origin),
            }
        )
    return list(zip(counts.tolist(), hits))


def find_notices(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, hits) of every document with an id: words, and the spans that hold a notice.

    A hit has its label and notice, whether it is an unchanged base phrase, its edits, and
    the span as words and as characters of the text, from 0, the end not included. Whole texts are
    searched. Null and empty texts have no words and no hits; repeated rows are searched one by one. Overlapping
    spans of one notice give the one with the fewest edits, then the earliest.
    """
    source = pick(docs, doc_id=id_col, text=text_col)
    kind = source.schema["doc_id"].dataType.simpleString()
    hit = pa.struct(
        [("label", pa.string()), ("notice", pa.string()), ("base", pa.bool_()), ("edits", pa.int32())] + [(c, pa.int64()) for c in ("word_from", "word_to", "char_from", "char_to")]
    )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = raw(part.column(1))
            for a, b in chunks(texts):
                counts, hits = zip(*scan(texts[a:b], notices))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(a, b - a), pa.array(counts, pa.int64()), pa.array(hits, pa.list_(hit))], names=["doc_id", "n_words", "hits"]
                )

    return source.mapInArrow(run, f"doc_id {kind}, {FIELDS}")


def licence_report(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) from ``find_notices``.

    score: 1 less the share of errors in the notice's letters, of the best hit; 0 without one.
    """
    base = F.filter("hits", lambda h: h["base"])
    labels = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["label"]))), ",")
    scores = F.transform("hits", lambda h: 1 - h["edits"] / F.length(h["notice"]))
    places = F.transform("base_hits", lambda h: h["word_from"])
    found = find_notices(docs, notices).withColumn("base_hits", base)
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_hits").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        labels(F.col("base_hits")).alias("base_labels"),
        labels(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(scores), F.lit(0.0)).cast("double").alias("score"),
    )
