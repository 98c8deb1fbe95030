"""Canonical, length-limited Huffman codes for token ids, and coded runs of ids in numpy.

Code lengths come from the package-merge rule and depend on the counts alone;
codes are canonical (ordered by length, then id), so a table of lengths is all
that a reader needs.  A coded run is a row of bit offsets, one for every
``interval`` ids, and the bits.  Decoding looks up ``2 ** limit`` windows in a
table and steps through all checkpoints of a block side by side.
"""

from __future__ import annotations

import numpy as np

LIMIT = 16  # bits at most, so that a code that begins in one 16-bit word ends in the next
INTERVAL = 128


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code length of each symbol under ``limit`` bits (package-merge); counts are positive."""
    n = len(counts)
    if n == 0:
        return np.zeros(0, np.int64)
    if n == 1:
        return np.ones(1, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols have no prefix code of at most {limit} bits")
    order = np.argsort(counts, kind="stable")
    leaves = np.asarray(counts, np.int64)[order]
    merged, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        even = len(merged) // 2 * 2
        both = np.concatenate([leaves, merged[0:even:2] + merged[1:even:2]])
        rank = np.argsort(both, kind="stable")
        merged = both[rank]
        is_leaf.append(rank < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for level in reversed(is_leaf):
        own = int(level[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """A canonical code given by its symbols (ascending) and their lengths."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, limit: int = LIMIT):
        self.limit = limit
        symbols, lengths = np.asarray(symbols, np.int64), np.asarray(lengths, np.int64)
        order = np.lexsort((symbols, lengths))
        step = np.int64(1) << (limit - lengths[order])
        first = np.concatenate([[0], np.cumsum(step)[:-1]]) if len(step) else step
        size = int(symbols.max()) + 1 if len(symbols) else 0
        self.length, self.word = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.length[symbols[order]] = lengths[order]
        self.word[symbols[order]] = first >> (limit - lengths[order])
        self.window_symbol = np.zeros(1 << limit, np.uint32)
        self.window_length = np.zeros(1 << limit, np.int64)
        used = int(step.sum())
        self.window_symbol[:used] = np.repeat(symbols[order], step)
        self.window_length[:used] = np.repeat(lengths[order], step)

    def encode(self, runs: list[np.ndarray], interval: int = INTERVAL) -> list[tuple[bytes, bytes]]:
        """Per run of ids (bit offset of every ``interval``-th id as uint32, bits filled up to 16)."""
        sizes = np.array([len(r) for r in runs], np.int64)
        ids = np.concatenate(runs) if len(runs) else np.zeros(0, np.int64)
        length, word = self.length[ids], self.word[ids]
        last = np.cumsum(sizes)
        total = np.concatenate([[0], np.cumsum(length)])
        bits = total[last] - total[last - sizes]
        words = -(-bits // 16)
        first = np.cumsum(words) - words  # every run begins at a 16-bit word
        own = total[:-1] - np.repeat(total[last - sizes], sizes)  # bit offset in its run
        start = own + np.repeat(first, sizes) * 16
        shifted = word << (32 - length - (start & 15))  # at most 16 + 15 bits from the word on
        at, n = start >> 4, int(words.sum()) + 1
        out = (np.bincount(at, weights=shifted >> 16, minlength=n + 1)
               + np.bincount(at + 1, weights=shifted & 0xFFFF, minlength=n + 1)).astype(">u2").tobytes()
        own = own.astype("<u4")
        return [(own[e - s:e:interval].tobytes(), out[2 * f:2 * (f + w)])
                for s, e, f, w in zip(sizes.tolist(), last.tolist(), first.tolist(), words.tolist(), strict=True)]

    def decode(self, bits: bytes, starts: np.ndarray, sizes: np.ndarray, interval: int = INTERVAL) -> np.ndarray:
        """The ids of runs of ``sizes`` ids (at most ``interval`` each) that begin at bit ``starts``, in order."""
        half = np.frombuffer(bits + b"\0\0\0\0", ">u2").astype(np.int64)
        word = (half[:-1] << 16) | half[1:]
        low = (1 << self.limit) - 1
        at, out = starts.astype(np.int64), np.zeros((int(sizes.max(initial=0)), len(sizes)), np.uint32)
        lanes = np.argsort(-sizes, kind="stable")
        at, left = at[lanes], sizes[lanes]
        for step in range(len(out)):
            if left[-1] <= step:  # lanes are in falling order of size: those that have ended leave at the back
                live = int(np.searchsorted(-left, -step))
                at, left = at[:live], left[:live]
            window = (word[at >> 4] >> (32 - self.limit - (at & 15))) & low
            out[step, lanes[:len(at)]] = self.window_symbol[window]
            at = at + self.window_length[window]
        return out.T[np.arange(len(out)) < sizes[:, None]]
