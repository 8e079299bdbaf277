"""Byte-level BPE ids of whole texts, by the tokenizers library, with repeated pieces encoded once.

The pre-tokenizer never joins across certain places: before a single space between two visible
characters, around a single line feed between two visible characters, and before a comma or full
stop that follows a letter. Texts are cut there with numpy, equal pieces are found by a 128-bit
hash, and only pieces not seen yet by the process go to the library. Anything unusual (other white
space, other scripts) is simply not cut, so it reaches the library as part of a longer piece.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import zstandard

from millrace.llm.words import U64, ByteHash, column_bytes

#: The id that ends a document.
END = 0
#: Pieces and ids a process remembers before it starts afresh.
MOST_PIECES, MOST_IDS = 1 << 20, 1 << 23

_A, _B = ByteHash(31, white=True), ByteHash(32, white=True)
_LINE = np.zeros(256, dtype=bool)
_LINE[0x0A] = True
_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[0x21:0x7F] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True
#: U+00C0 to U+00FF are 0xC3 and one more byte; two of them are signs, not letters.
_LATIN, _SIGNS = 0xC3, (0x97, 0xB7)
_LINE_FEED_ID = 198
#: The white space of ``str.split`` in one byte, and the bytes that longer ones of it begin with.
_WHITE, _MAYBE_WHITE = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_MAYBE_WHITE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin, the start of each non-empty text included."""
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)
    if n > 2:
        after_latin = np.zeros(n, dtype=bool)
        after_latin[1:] = data[:-1] == _LATIN
        ends_letter = _LETTER[data] | (after_latin & (data != _SIGNS[0]) & (data != _SIGNS[1]))
        seen_before, seen_after = _VISIBLE[data] | after_latin, _VISIBLE[data] | (data == _LATIN)
        single = np.zeros(n, dtype=bool)
        single[1:-1] = seen_before[:-2] & seen_after[2:]
        inside = offsets[(offsets > 0) & (offsets < n)]
        single[inside] = single[inside - 1] = False
        line = single & _LINE[data]
        cut[:n] = (single & (data == 0x20)) | line
        cut[1:] |= line
        stop = (data[1:] == 0x2C) | (data[1:] == 0x2E)
        cut[1:n] |= stop & ends_letter[:-1]
    cut[offsets[:-1]] = True
    cut[n] = False
    return np.flatnonzero(cut)


def _holds(marked: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which ranges hold a marked byte."""
    before = np.append(np.int32(0), np.cumsum(marked, dtype=np.int32))
    return before[ends] > before[starts]


def _plain(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which pieces are one word of ``str.split``, perhaps after a space."""
    body = starts + (data[starts] == 0x20)
    plain = (ends > body) & ~_holds(_WHITE[data], body, ends)
    for i in np.flatnonzero(plain & _holds(_MAYBE_WHITE[data], body, ends)):
        word = data[body[i]:ends[i]].tobytes().decode("utf-8")
        plain[i] = word.split() == [word]
    return plain


def _lines(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The pieces ``data[start:end]`` with a line feed between each two."""
    sizes = ends - starts + 1
    at = np.cumsum(sizes) - sizes
    out = data[np.minimum(np.arange(int(sizes.sum())) + np.repeat(starts - at, sizes), len(data) - 1)]
    out[at[1:] - 1] = 0x0A
    return out[:-1]


class Encoder:
    """The ids of Arrow batches of texts; keeps what it has learned about pieces."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self._clear()

    def _clear(self) -> None:
        self._grow_table(1 << 16)
        self.a, self.b = np.zeros(1 << 16, dtype=U64), np.zeros(1 << 16, dtype=U64)
        self.starts, self.sizes, self.n = np.zeros(1 << 16, dtype=np.int64), np.zeros(1 << 16, dtype=np.int64), 0
        self.ids, self.used = np.zeros(1 << 18, dtype=np.uint32), 0

    def _grow_table(self, size: int) -> None:
        self.mask = U64(size - 1)
        self.number = np.full(size, -1, dtype=np.int32)

    def _find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 for new ones; open addressing, all pieces at once."""
        slot = (a & self.mask).astype(np.int64)
        out = self.number[slot]
        rest = np.flatnonzero((out >= 0) & ((self.a[out] != a) | (self.b[out] != b)))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & int(self.mask)
            at = out[rest] = self.number[slot[rest]]
            rest = rest[(at >= 0) & ((self.a[at] != a[rest]) | (self.b[at] != b[rest]))]
        return out

    def _insert(self, a: np.ndarray, numbers: np.ndarray) -> None:
        slot, rest = (a & self.mask).astype(np.int64), np.arange(len(a))
        while len(rest):
            free = rest[self.number[slot[rest]] < 0]
            self.number[slot[free]] = numbers[free]  # of several for a slot, one stays
            rest = rest[self.number[slot[rest]] != numbers[rest]]
            slot[rest] = (slot[rest] + 1) & int(self.mask)

    def _remember(self, a: np.ndarray, b: np.ndarray, ids: np.ndarray | list[np.ndarray], sizes: np.ndarray | None = None) -> None:
        """Keep pieces by their hashes; ``ids`` are those of all pieces in a row with their ``sizes``, or a list by piece."""
        if sizes is None:
            ids, sizes = np.concatenate(ids), np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        count, total = len(sizes), len(ids)
        while self.n + count > len(self.starts):
            self.a, self.b = np.concatenate([self.a, self.a]), np.concatenate([self.b, self.b])
            self.starts, self.sizes = np.concatenate([self.starts, self.starts]), np.concatenate([self.sizes, self.sizes])
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, self.ids])
        numbers = np.arange(self.n, self.n + count)
        self.a[numbers], self.b[numbers] = a, b
        self.sizes[numbers] = sizes
        self.starts[numbers] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used:self.used + total] = ids
        self.n, self.used = self.n + count, self.used + total
        if 2 * self.n > len(self.number):
            self._grow_table(4 * len(self.number))
            self._insert(self.a[:self.n], np.arange(self.n))
        else:
            self._insert(a, numbers)

    def _encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces ``data[start:end]``, one piece after the other, and how many each has.

        Plain pieces go to the library as the lines of one text; their ids lie between those of the line feeds.
        """
        plain = _plain(data, starts, ends)
        sizes, parts = np.zeros(len(starts), dtype=np.int64), []
        if plain.any():
            ids = self._ids([_lines(data, starts[plain], ends[plain]).tobytes().decode("utf-8")])[0]
            feeds = np.flatnonzero(ids == _LINE_FEED_ID)
            if len(feeds) + 1 != plain.sum():
                raise RuntimeError("the library joined pieces that its pre-tokenizer keeps apart")
            sizes[plain] = np.diff(feeds, prepend=-1, append=len(ids)) - 1
            parts.append(np.delete(ids, feeds))
        others = np.flatnonzero(~plain)
        for i, ids in zip(others, self._ids([data[starts[i]:ends[i]].tobytes().decode("utf-8") for i in others])):
            sizes[i] = len(ids)
            parts.append(ids)
        ids, order = np.concatenate(parts), np.concatenate([np.flatnonzero(plain), others])
        if len(others) and plain.any():  # back in the order of the pieces
            held = np.empty(len(sizes), dtype=np.int64)
            held[order] = np.cumsum(sizes[order]) - sizes[order]
            ids = ids[np.arange(len(ids)) + np.repeat(held - (np.cumsum(sizes) - sizes), sizes)]
        return ids, sizes

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        """The library's ids, without the offsets that it otherwise keeps of every id."""
        return [np.array(e.ids, dtype=np.uint32) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts, END after each text, and where each text's ids begin."""
        data, offsets = column_bytes(column)
        starts = _cuts(data, offsets)
        ends = np.append(starts[1:], len(data))
        a, b = _A.words(data, starts, ends), _B.words(data, starts, ends)
        if self.n + len(starts) > MOST_PIECES or self.used > MOST_IDS:
            self._clear()
        number = self._find(a, b)
        new = np.flatnonzero(number < 0)
        if len(new):
            by_hash = new[np.lexsort((b[new], a[new]))]
            fresh = by_hash[np.concatenate([[True], (np.diff(a[by_hash]) != 0) | (np.diff(b[by_hash]) != 0)])]
            self._remember(a[fresh], b[fresh], *self._encode(data, starts[fresh], ends[fresh]))
            number[new] = self._find(a[new], b[new])
        sizes, begin = self.sizes[number], self.starts[number]
        texts = len(offsets) - 1
        owner = np.searchsorted(offsets, starts, side="right") - 1
        per_text = np.bincount(owner, weights=sizes, minlength=texts).astype(np.int64) + 1 if len(owner) else np.ones(texts, dtype=np.int64)
        first = np.cumsum(per_text) - per_text
        out = np.full(int(per_text.sum()), END, dtype=np.uint32)
        ahead = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        order = np.arange(total)
        out[order + np.repeat(owner, sizes)] = self.ids[order + np.repeat(begin - ahead, sizes)]
        return out, np.append(first, len(out))


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    """This process's encoder for a vocabulary file."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


def packed(ids: np.ndarray, level: int = 3) -> bytes:
    """Ids as compressed 32-bit planes; for data on its way only."""
    return zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return raw.reshape(4, -1).T.copy().view("<u4").ravel()
