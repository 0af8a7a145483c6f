"""Token ids of whole texts by a public tokenizer file; a stretch between blanks is encoded once."""

from __future__ import annotations

import base64
import os

import numpy as np

from tilth.llm.words import chunks, span_hash

#: Stretches remembered by a worker before it starts anew.
REMEMBERED = 300_000
#: Bytes that may stand before a cut: none that ends a character which counts as blank.
_before = np.ones(256, bool)
_before[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF, *range(0x80, 0x8B)]] = False
#: Bytes that may stand after a cut: none that starts a character which counts as blank.
_after = np.ones(256, bool)
_after[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0xC2, 0xE1, 0xE2, 0xE3]] = False
#: Bytes of stretches that the rank file's own pattern splits just as the tokenizer file does: ASCII and accented Latin.
_latin = np.zeros(256, bool)
_latin[[10, *range(32, 127), *range(0xC3, 0xC9), *range(0x80, 0xC0)]] = True


class Encoder:
    """Encodes like the tokenizer file does, and remembers the ids of every stretch.

    The file's rules start a piece before each single blank between two characters that
    aren't blank, so texts are cut there, and the ids of the stretches in a row are the
    text's ids. ranks: a rank file of the same vocabulary; it gives the same ids of Latin
    stretches in a fraction of the time. Without it the tokenizer file encodes all.
    """

    def __init__(self, path: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.short = None
        if ranks:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.short = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
            self.width = np.zeros(max(table.values()) + 1, np.int64)
            for piece, rank in table.items():
                self.width[rank] = len(piece)
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted hashes, and what goes with each
        self.check = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.kind)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text), without special ids added."""
        parts, counts = [np.zeros(0, self.kind)], [np.zeros(0, np.int64)]
        for a, b in chunks(texts):
            ids, n = self._chunk(texts[a:b])
            parts.append(ids)
            counts.append(n)
        return np.concatenate(parts), np.concatenate(counts)

    def _chunk(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        data = b"".join(texts)
        if not data:
            return np.zeros(0, self.kind), np.zeros(len(texts), np.int64)
        buffer = np.frombuffer(data, np.uint8)
        cut = buffer == 32
        cut[1:] &= _before[buffer[:-1]]
        cut[:-1] &= _after[buffer[1:]]
        cut[-1] = False
        begin = np.cumsum(sizes) - sizes
        inner = np.zeros(len(buffer) + 1, bool)
        inner[begin] = True
        last = begin[sizes > 0] + sizes[sizes > 0] - 1
        cut[begin[sizes > 0]] = cut[last] = False  # a blank at an end of a text isn't between two characters
        inner[:-1] |= cut
        starts = np.flatnonzero(inner[:-1])
        ends = np.append(starts[1:], len(buffer))
        h = span_hash(buffer, starts, ends)
        hashes, first, place = np.unique(h, return_index=True, return_inverse=True)
        check = span_hash(buffer, starts, ends, 1)
        if not (check == check[first][place]).all():
            return self._plain(texts)
        if len(self.known) > REMEMBERED:
            self.forget()
        at = np.searchsorted(self.known, hashes)
        old = at < len(self.known)
        old[old] = self.known[at[old]] == hashes[old]
        if not (self.check[at[old]] == check[first[old]]).all():
            return self._plain(texts)
        fresh = first[~old]
        if len(fresh):
            self._learn(data, buffer, starts[fresh], ends[fresh], hashes[~old], check[fresh])
            at = np.searchsorted(self.known, hashes)
        row = at[place]
        length = self.length[row]
        total = np.cumsum(length)
        ids = self.ids[np.arange(total[-1]) + np.repeat(self.start[row] - total + length, length)]
        upto = np.concatenate([[0], total])
        edges = np.searchsorted(starts, np.append(begin, len(buffer)))
        return ids, np.diff(upto[edges])

    def _plain(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Every text by itself: the way out if two stretches have one hash."""
        own = [e.ids for e in self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)]
        return np.fromiter((i for ids in own for i in ids), self.kind), np.fromiter(map(len, own), np.int64, len(own))

    def _learn(self, data: bytes, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, check: np.ndarray) -> None:
        odd = np.concatenate([[0], np.cumsum(~_latin[buffer])])
        quick = (odd[ends] == odd[starts]) & (buffer[starts] == 32) if self.short else np.zeros(len(starts), bool)
        for mark in self.special:
            place = data.find(mark)
            while place >= 0:
                quick &= ~((starts < place + len(mark)) & (ends > place))
                place = data.find(mark, place + 1)
        counts = np.zeros(len(starts), np.int64)
        flat: list[np.ndarray] = []
        order = np.concatenate([np.flatnonzero(quick), np.flatnonzero(~quick)])
        n = int(quick.sum())
        if n:
            text = b"".join(data[a:b] for a, b in zip(starts[quick].tolist(), ends[quick].tolist()))
            ids = np.array(self.short(text.decode()), np.int64)
            upto = np.cumsum(self.width[ids])
            edges = np.searchsorted(upto, np.cumsum(ends[quick] - starts[quick]), side="right")
            counts[:n] = np.diff(np.concatenate([[0], edges]))
            flat.append(ids.astype(self.kind))
        rest = [data[a:b].decode("utf-8", "replace") for a, b in zip(starts[~quick].tolist(), ends[~quick].tolist())]
        own = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)] if rest else []
        counts[n:] = list(map(len, own))
        flat.append(np.fromiter((i for ids in own for i in ids), self.kind))
        begin = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate([self.ids, *flat])
        into = np.searchsorted(self.known, hashes[order])
        sort = np.argsort(hashes[order])
        self.check = np.insert(self.check, into[sort], check[order][sort])
        self.start = np.insert(self.start, into[sort], begin[sort])
        self.length = np.insert(self.length, into[sort], counts[sort])
        self.known = np.insert(self.known, into[sort], hashes[order][sort])


_encoders: dict[str, Encoder] = {}


def encoder(path: str, ranks: str | None = None) -> Encoder:
    """One for each worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, ranks)
    return _encoders[path]
