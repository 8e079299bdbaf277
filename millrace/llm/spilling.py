"""A priority queue of bounded memory, for messages sent forward to later rows of a sorted stream."""

from __future__ import annotations

import heapq
import pickle
import tempfile
from collections.abc import Iterator

_BLOCK = 4096
_MOST_RUNS = 32


def _read(file) -> Iterator[tuple]:
    file.seek(0)
    while True:
        try:
            yield from pickle.load(file)
        except EOFError:
            file.close()
            return


class SpillingQueue:
    """Tuples, smallest first.

    Past ``most`` tuples the larger half goes to a sorted run in a nameless scratch file of the
    task's own, like the runs of Spark's sorts: no one else reads it, it goes with the process,
    and an attempt on another executor starts anew.
    """

    def __init__(self, most: int = 200_000):
        self.most = most
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # (first tuple, number, the rest)
        self.spilled = 0

    def __bool__(self) -> bool:
        return bool(self.heap or self.runs)

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.most:
            self.heap.sort()
            half = len(self.heap) // 2
            later = self.heap[half:]
            del self.heap[half:]
            if len(self.runs) >= _MOST_RUNS:
                runs, self.runs = self.runs, []
                self._keep(heapq.merge(later, *(self._whole(run) for run in runs)))
            else:
                self._keep(iter(later))

    @staticmethod
    def _whole(run: tuple) -> Iterator[tuple]:
        yield run[0]
        yield from run[2]

    def _keep(self, items: Iterator[tuple]) -> None:
        file, block = tempfile.TemporaryFile(), []
        for item in items:
            block.append(item)
            if len(block) == _BLOCK:
                pickle.dump(block, file, pickle.HIGHEST_PROTOCOL)
                block = []
        pickle.dump(block, file, pickle.HIGHEST_PROTOCOL)
        self.spilled += 1
        self._put(self.spilled, _read(file))

    def _put(self, number: int, rest: Iterator[tuple]) -> None:
        for first in rest:
            heapq.heappush(self.runs, (first, number, rest))
            return

    def first(self) -> tuple | None:
        """The smallest tuple, left in place."""
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        """The smallest tuple, taken out."""
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            first, number, rest = heapq.heappop(self.runs)
            self._put(number, rest)
            return first
        return heapq.heappop(self.heap)
