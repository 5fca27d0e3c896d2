"""A cuckoo filter over 64-bit keys: membership with insertion and deletion."""

from __future__ import annotations

import numpy as np

SLOTS = 4
KICKS = 500


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; spreads nearby keys over all bits."""
    x = x.astype(np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return x ^ (x >> np.uint64(29))


class CuckooFilter:
    """Buckets of four 16-bit marks; a key's mark lies in one of two buckets.

    A full filter doubles, so an insertion never fails, but marks cannot be moved to
    more buckets without their keys: ``insert`` then raises ``Full`` and the caller
    rebuilds from the exact table.
    """

    class Full(Exception):
        """No room; rebuild with more buckets."""

    def __init__(self, buckets: int, marks: bytes | None = None):
        self.buckets = buckets
        stored = np.zeros(buckets * SLOTS, np.uint16) if marks is None else np.frombuffer(marks, np.uint16).copy()
        self.marks = stored.reshape(buckets, SLOTS)

    @staticmethod
    def room_for(keys: int) -> int:
        """Buckets, a power of two, that hold ``keys`` at a load under 0.85."""
        return 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.85)))))

    def tobytes(self) -> bytes:
        return self.marks.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mixed = _mix(keys)
        mark = (mixed >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = (mixed & np.uint64(self.buckets - 1)).astype(np.int64)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ (_mix(mark) & np.uint64(self.buckets - 1)).astype(np.int64)

    def insert(self, keys: np.ndarray) -> None:
        for mark, first, second in zip(*self._places(np.asarray(keys))):
            self._insert(mark, int(first), int(second))

    def _insert(self, mark: np.uint16, first: int, second: int) -> None:
        for bucket in (first, second):
            free = np.flatnonzero(self.marks[bucket] == 0)
            if len(free):
                self.marks[bucket, free[0]] = mark
                return
        bucket = first
        for kick in range(KICKS):
            slot = kick % SLOTS
            self.marks[bucket, slot], mark = mark, self.marks[bucket, slot]
            bucket = int(self._other(np.array([bucket]), np.array([mark], np.uint16))[0])
            free = np.flatnonzero(self.marks[bucket] == 0)
            if len(free):
                self.marks[bucket, free[0]] = mark
                return
        raise self.Full

    def delete(self, keys: np.ndarray) -> None:
        """Remove keys that were inserted; each deletion clears one mark."""
        for mark, first, second in zip(*self._places(np.asarray(keys))):
            for bucket in (int(first), int(second)):
                held = np.flatnonzero(self.marks[bucket] == mark)
                if len(held):
                    self.marks[bucket, held[0]] = 0
                    break

    def might_hold(self, keys: np.ndarray) -> np.ndarray:
        """False only for keys that are not in the filter."""
        mark, first, second = self._places(np.asarray(keys))
        return ((self.marks[first] == mark[:, None]) | (self.marks[second] == mark[:, None])).any(axis=1)
