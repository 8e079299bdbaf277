"""Words, word hashes and Rabin-Karp window values of whole Arrow batches, with numpy.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D, the splitting rule of
``bytes.split``. Nothing here loops over words in Python: positions come from byte masks
and hashes from cumulative sums, so a task spends some tens of nanoseconds per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Another way to part words: at ASCII signs and white space.
SIGNS = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
#: Bytes hashed at once; only a single longer word makes a block larger.
_BLOCK = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class ByteHash:
    """A polynomial hash of words over a table of 64-bit byte values, modulo 2**64.

    ``lower`` equates A-Z with a-z; ``white`` tells white space apart, for ranges that hold some.
    """

    def __init__(self, seed: int, lower: bool = False, white: bool = False):
        rank = np.arange(256, dtype=U64)
        if lower:
            rank[ord("A"):ord("Z") + 1] = rank[ord("a"):ord("z") + 1]
        self.table = mix(rank * U64(0x9E3779B97F4A7C15) + U64(seed))
        if not white:
            self.table[_SPACE] = 0
        base = (int(mix(np.array([seed], dtype=U64))[0]) & ~7) | 3
        self.base, self.inverse = U64(base), U64(pow(base, -1, 1 << 64))
        self.window_base = U64((int(mix(np.array([seed + 1], dtype=U64))[0]) & ~7) | 3)
        self.powers = self.inverses = np.ones(1, dtype=U64)

    def __reduce__(self):
        return _rebuilt, (self.table, self.base, self.inverse, self.window_base)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            steps = np.full(n, self.base, dtype=U64)
            steps[0] = 1
            self.powers = np.multiply.accumulate(steps)
            steps = np.full(n, self.inverse, dtype=U64)
            steps[0] = 1
            self.inverses = np.multiply.accumulate(steps)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit value for each word ``data[start:end]``."""
        out, i = np.empty(len(starts), dtype=U64), 0
        while i < len(starts):
            low = int(starts[i])
            j = max(i + 1, int(np.searchsorted(ends, low + _BLOCK, side="right")))
            part = data[low:int(ends[j - 1])]
            self._grow(len(part) + 1)
            sums = np.empty(len(part) + 1, dtype=U64)
            sums[0] = 0
            np.cumsum(self.table[part] * self.powers[:len(part)], out=sums[1:])
            s, e = starts[i:j] - low, ends[i:j] - low
            out[i:j] = mix((sums[e] - sums[s]) * self.inverses[s] + (e - s).astype(U64))
            i = j
        return out

    def windows(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """The Rabin-Karp value of every ``size`` consecutive hashes, built by doubling."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.empty(0, dtype=U64)
        out, done, piece, width = np.zeros(n, dtype=U64), 0, hashes, 1
        power, rest = np.array([self.window_base], dtype=U64), size
        while True:
            if rest & 1:
                out = out * power + piece[done:done + n]
                done += width
            rest >>= 1
            if not rest:
                return mix(out)
            piece = piece[:-width] * power + piece[width:]
            width, power = 2 * width, power * power


def _rebuilt(table, base, inverse, window_base) -> ByteHash:
    out = ByteHash.__new__(ByteHash)
    out.table, out.base, out.inverse, out.window_base = table, base, inverse, window_base
    out.powers = out.inverses = np.ones(1, dtype=U64)
    return out


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, one text after the other, and where each begins."""
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.empty(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


class Words:
    """The words of a batch of texts: byte ranges, and the first word of each text.

    ``separators`` tells for each byte value whether it parts words; white space by default.
    """

    def __init__(self, column: pa.Array, separators: np.ndarray = _SPACE):
        self.data, self.offsets = column_bytes(column)
        space = separators[self.data]
        inner = self.offsets[(self.offsets > 0) & (self.offsets < len(space))]
        before, after = np.ones(len(space), dtype=bool), np.ones(len(space), dtype=bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        before[inner], after[inner - 1] = True, True
        self.starts = np.flatnonzero(before & ~space)
        self.ends = np.flatnonzero(after & ~space) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.first) - 1

    def hashes(self, by: ByteHash) -> np.ndarray:
        return by.words(self.data, self.starts, self.ends)

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self), dtype=np.int64), self.counts)

    def whole_windows(self, size: int) -> np.ndarray:
        """First words of the windows that lie in one text."""
        n = len(self.starts) - size + 1
        if n <= 0:
            return np.empty(0, dtype=np.int64)
        owners = self.owners()
        return np.flatnonzero(owners[:n] == owners[size - 1:])


def by_text(words: Words, values: np.ndarray) -> Iterator[np.ndarray]:
    """The part of a per-word array that belongs to each text."""
    for i in range(len(words)):
        yield values[words.first[i]:words.first[i + 1]]


def planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit values with equal bytes together, which shuffle compression likes."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``size`` words that begins at one of ``starts``."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.asarray(starts) + size, -1)
    return np.cumsum(change[:-1]) > 0
