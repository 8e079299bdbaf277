"""Cuckoo filters over 16-byte keys, filled and searched a batch at a time with numpy."""

from __future__ import annotations

import numpy as np

from millrace.llm.words import U64, mix

SLOTS = 4
#: Share of a table's slots that is used before another table is opened, and rounds of moving entries about.
FULL, ROUNDS = 0.9, 400


class CuckooFilter:
    """Tables of 16-bit fingerprints; each key has two buckets in each of them.

    All tables have the same number of buckets. Two keys that share a fingerprint and a bucket
    in one table therefore do so in all, and it does not matter whose entry a removal takes:
    a key that is held is always found, as long as only held keys are removed.
    """

    def __init__(self, buckets: int = 1 << 14, stored: bytes | None = None):
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.buckets = buckets
        if stored:
            tables = np.frombuffer(stored, dtype="<u2").reshape(-1, buckets, SLOTS)
            self.tables = [t.copy() for t in tables]
        else:
            self.tables = [self._empty()]

    def _empty(self) -> np.ndarray:
        return np.zeros((self.buckets, SLOTS), dtype="<u2")

    def stored(self) -> bytes:
        return np.concatenate(self.tables).tobytes()

    def __len__(self) -> int:
        return sum(int(np.count_nonzero(t)) for t in self.tables)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First bucket and fingerprint of keys, an array of 16-byte values."""
        halves = np.ascontiguousarray(keys).view("<u8").reshape(-1, 2)
        marks = (halves[:, 1] >> U64(48)).astype("<u2")
        return (mix(halves[:, 0]) & U64(self.buckets - 1)).astype(np.int64), np.where(marks == 0, 1, marks).astype("<u2")

    def _other(self, bucket: np.ndarray, marks: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(marks.astype(U64) + U64(1)) & U64(self.buckets - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        bucket, marks = self._places(keys)
        other = self._other(bucket, marks)
        found = np.zeros(len(bucket), dtype=bool)
        for table in self.tables:
            found |= (table[bucket] == marks[:, None]).any(axis=1) | (table[other] == marks[:, None]).any(axis=1)
        return found

    def add(self, keys: np.ndarray) -> None:
        """Enter keys that are not held yet."""
        bucket, marks = self._places(keys)
        while len(bucket):
            room = int(FULL * self.tables[-1].size) - int(np.count_nonzero(self.tables[-1]))
            if room <= 0:
                self.tables.append(self._empty())
                continue
            left, left_marks = self._settle(self.tables[-1], bucket[:room], marks[:room])
            if len(left):  # no way found for these; they go to a new table
                self.tables.append(self._empty())
            bucket, marks = np.concatenate([left, bucket[room:]]), np.concatenate([left_marks, marks[room:]])

    def _settle(self, table: np.ndarray, bucket: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put entries into free slots of either bucket; every other round the first of a full bucket takes a slot over."""
        for turn in range(ROUNDS):
            if not len(bucket):
                break
            order = np.argsort(bucket, kind="stable")
            bucket, marks = bucket[order], marks[order]
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            place = np.arange(len(bucket)) - np.repeat(starts, np.diff(starts, append=len(bucket)))
            used = np.count_nonzero(table[bucket], axis=1)
            fits = used + place < SLOTS
            table[bucket[fits], (used + place)[fits]] = marks[fits]
            first = (place == 0)[~fits] if turn % 2 else np.zeros(int((~fits).sum()), dtype=bool)
            bucket, marks = bucket[~fits], marks[~fits]
            slot = (turn // 2) % SLOTS
            taken = table[bucket[first], slot].copy()
            table[bucket[first], slot] = marks[first]
            marks = marks.copy()
            marks[first] = taken
            bucket = self._other(bucket, marks)
        return bucket, marks

    def remove(self, keys: np.ndarray) -> None:
        """Take out keys that are held."""
        bucket, marks = self._places(keys)
        while len(bucket):
            other = self._other(bucket, marks)
            pair = np.minimum(bucket, other) << 16 | marks.astype(np.int64)
            _, now = np.unique(pair, return_index=True)  # one of equal entries at a time
            done = np.zeros(len(bucket), dtype=bool)
            for table in self.tables:
                for side in (bucket, other):
                    todo = now[~done[now]]
                    hit = table[side[todo]] == marks[todo][:, None]
                    has = hit.any(axis=1)
                    rows = side[todo][has]
                    table[rows, hit[has].argmax(axis=1)] = 0
                    touched = np.unique(rows)
                    table[touched] = -np.sort(-table[touched].astype(np.int32), axis=1)  # free slots last
                    done[todo[has]] = True
            if not done[now].all():
                raise ValueError("a key to remove is not held")
            bucket, marks = bucket[~done], marks[~done]
