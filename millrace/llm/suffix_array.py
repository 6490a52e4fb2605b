"""Two-stage suffix sorting in numpy, to a bounded depth."""

from __future__ import annotations

import numpy as np


#: Bytes sorted at once, at most.
LONGEST = (1 << 24) - 1


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one big-endian number; zeros follow the text."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    return np.ndarray((len(text),), ">u8", padded, 0, (1,))


def _sorted_directly(text: np.ndarray, chosen: np.ndarray, depth: int) -> np.ndarray:
    """``chosen`` positions in the order of their suffixes to ``depth`` bytes; those alike stand together.

    Eight bytes first, then five at a time, packed with the number of the group still tied.
    """
    if len(text) > LONGEST:
        raise ValueError(f"a text of more than {LONGEST} bytes must be sorted in parts")
    words = _words(text)
    key = words[chosen].astype(np.uint64)
    fine = np.argsort(key)
    order, key = chosen[fine], key[fine]
    opens = np.concatenate([[True], key[1:] != key[:-1]])
    for at in range(8, depth, 5):
        tied = np.flatnonzero(~(opens & np.concatenate([opens[1:], [True]])))
        if not len(tied):
            break
        rows = order[tied]
        ahead = rows + at
        key = np.where(ahead < len(text), words[np.minimum(ahead, len(text) - 1)].astype(np.uint64) >> np.uint64(24), np.uint64(0))
        key |= np.cumsum(opens)[tied].astype(np.uint64) << np.uint64(40)
        fine = np.argsort(key)
        order[tied], key = rows[fine], key[fine]
        opens[tied[1:]] |= key[1:] != key[:-1]
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` (bytes) in the order of their suffixes, compared over at least ``depth`` bytes.

    Suffixes smaller than the one that follows them are sorted directly. Any other suffix begins with
    a byte at least as large as its successor's first, so one scan over the buckets of first bytes, from the
    smallest, puts it right: it comes after its successor has been placed, in the successors' order.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    # Smaller than the successor: decided by the next different byte; the last suffix is larger than the empty one.
    differs = np.concatenate([text[1:] != text[:-1], [True]])
    rises = np.concatenate([text[1:] > text[:-1], [False]])
    where = np.flatnonzero(differs)
    small = np.repeat(rises[where], np.diff(np.concatenate([[-1], where])))
    direct = _sorted_directly(text, np.flatnonzero(small), depth)
    first = text[direct]
    bounds = np.searchsorted(first, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if not small[n - 1]:
        waiting[text[n - 1]].append(np.array([n - 1]))
    done = []
    for byte in range(256):
        level = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        levels = []
        while len(level):
            levels.append(level)
            before = level[level > 0] - 1
            level = before[(text[before] == byte) & ~small[before]]
        bucket = np.concatenate([*levels, direct[bounds[byte] : bounds[byte + 1]]])
        waiting[byte] = []
        if not len(bucket):
            continue
        done.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~small[before] & (text[before] > byte)]
        if len(before):
            by = text[before]
            before = before[np.argsort(by, kind="stable")]
            counts = np.bincount(by, minlength=256)
            at = np.cumsum(counts) - counts
            for b in np.flatnonzero(counts):
                waiting[b].append(before[at[b] : at[b] + counts[b]])
    return np.concatenate(done)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """How many bytes, ``depth`` at most, each position of ``order`` shares with the one before it (0 for the first)."""
    words, n = _words(text), len(text)
    shared = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for at in range(0, depth, 8):
        if not len(alive):
            break
        a, b = order[alive - 1] + at, order[alive] + at
        inside = (a < n) & (b < n)
        alive, a, b = alive[inside], a[inside], b[inside]
        mixed = words[a].astype(np.uint64) ^ words[b].astype(np.uint64)
        unlike = mixed.astype(">u8").view(np.uint8).reshape(-1, 8) != 0
        same = np.where(mixed == 0, 8, unlike.argmax(axis=1))
        same = np.minimum(same, np.minimum(n - a, n - b))
        shared[alive] += same
        alive = alive[same == 8]
    return np.minimum(shared, depth)
