"""Two-stage suffix sorting of a byte block, to a bounded depth, and adjacent common prefixes."""

from __future__ import annotations

import numpy as np


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """For each suffix whether it is smaller than its successor (the last one is not)."""
    n = text.size
    out = np.zeros(n, bool)
    if n < 2:
        return out
    change = np.flatnonzero(text[:-1] != text[1:])
    rises = np.append(text[change] < text[change + 1], False)
    out[:] = rises[np.searchsorted(change, np.arange(n))]
    return out


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in an order that is right for their first ``depth`` bytes.

    Only suffixes smaller than their successor are sorted directly, by their first ``depth``
    bytes. The others are induced by one scan over the buckets of first bytes: once a bucket is
    complete, the predecessors of its suffixes are appended, in the same order, to the buckets
    of their own first bytes. A bucket's own predecessors (runs of one byte) follow in waves.
    """
    n = text.size
    if not n:
        return np.zeros(0, np.int64)
    direct = np.flatnonzero(smaller_than_next(text))
    padded = np.concatenate((text, np.zeros(depth, np.uint8)))
    keys = np.lib.stride_tricks.sliding_window_view(padded, depth)[direct]
    direct = direct[np.argsort(np.ascontiguousarray(keys).view(f"S{depth}").ravel(), kind="stable")]
    starts = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[text[-1]].append(np.array([n - 1]))
    order = []
    for byte in range(256):
        wave = np.concatenate(induced[byte]) if induced[byte] else np.zeros(0, np.int64)
        bucket = []
        while wave.size:
            bucket.append(wave)
            before = wave[wave > 0] - 1
            wave = before[text[before] == byte]
        bucket.append(direct[starts[byte]: starts[byte + 1]])
        whole = np.concatenate(bucket)
        order.append(whole)
        before = whole[whole > 0] - 1
        first = text[before]
        before, first = before[first > byte], first[first > byte]
        if before.size:
            dealt = np.argsort(first, kind="stable")
            before, first = before[dealt], first[dealt]
            cut = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1])))
            for begin, part in zip(cut, np.split(before, cut[1:]), strict=True):
                induced[first[begin]].append(part)
    return np.concatenate(order)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """The common prefix of each suffix of ``order`` and the one after it, up to ``depth`` bytes."""
    padded = np.concatenate((text, np.zeros(depth + 8, np.uint8)))
    out = np.zeros(max(0, order.size - 1), np.int64)
    left = np.arange(out.size)
    for at in range(0, depth, 8):
        size = min(8, depth - at)
        steps = np.arange(at, at + size)
        same = padded[order[left][:, None] + steps] == padded[order[left + 1][:, None] + steps]
        whole = same.all(axis=1)
        out[left] += np.where(whole, size, same.argmin(axis=1))
        left = left[whole]
        if not left.size:
            break
    return out
