"""A compressed set of offsets that answers which one is the k-th."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable

import numpy as np

#: A container holds the offsets that share all bits above the lowest sixteen.
BITS = 16
#: Offsets up to which a container lists them; beyond, a bitmap takes less room.
LISTED = 4096


class Listed:
    """Lower bits of the offsets, in order: two bytes each."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class Bitmap:
    """One bit per offset in 1024 words, and how many bits stand before each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << BITS, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def select(self, k: int) -> int:
        # Words without a bit repeat the count before them; the last of equals is the one that holds the bit.
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        word = int(self.words[at])
        for _ in range(k - int(self.before[at])):
            word &= word - 1
        return at * 64 + (word & -word).bit_length() - 1


class Runs:
    """First offset of each run of neighbours, and how many offsets stand before the run."""

    def __init__(self, first: np.ndarray, before: np.ndarray):
        self.first, self.before = first.astype(np.uint16), before.astype(np.uint16)

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.first[at]) + k - int(self.before[at])


def container(low: np.ndarray) -> Listed | Bitmap | Runs:
    """The smallest form of at least one offset below 2^16, given in order."""
    begins = np.flatnonzero(np.concatenate([[True], np.diff(low) != 1]))
    if 4 * len(begins) < min(2 * len(low), 8192):
        return Runs(low[begins], begins)
    return Listed(low) if len(low) <= LISTED else Bitmap(low)


class BoundarySet:
    """Offsets in ascending order, given in blocks; ``select(k)`` is the one with k others below it."""

    def __init__(self, blocks: Iterable[np.ndarray]):
        self.high: list[int] = []
        self.containers: list[Listed | Bitmap | Runs] = []
        #: Offsets before each container.
        self.before: list[int] = []
        self.size = 0
        high, held = -1, []
        for block in blocks:
            if not len(block):
                continue
            if high >= 0 and int(block[-1]) >> BITS == high:
                held.append(block)
                continue
            cuts = np.flatnonzero(np.diff(block >> BITS)) + 1
            for part in np.split(block, cuts) if len(cuts) else [block]:
                own = int(part[0]) >> BITS
                if own != high and held:
                    self._close(high, held)
                    held = []
                high = own
                held.append(part)
        if held:
            self._close(high, held)

    def _close(self, high: int, parts: list[np.ndarray]) -> None:
        low = (parts[0] if len(parts) == 1 else np.concatenate(parts)) & ((1 << BITS) - 1)
        self.high.append(high)
        self.containers.append(container(low))
        self.before.append(self.size)
        self.size += len(low)

    def __len__(self) -> int:
        return self.size

    def select(self, k: int) -> int:
        if not 0 <= k < self.size:
            raise IndexError(k)
        at = bisect_right(self.before, k) - 1
        return (self.high[at] << BITS) + self.containers[at].select(k - self.before[at])
