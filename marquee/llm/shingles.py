"""Word shingles as 64-bit hashes, computed over Arrow text columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from marquee.llm.common import PrefixHash, blocks, mix64

SHINGLE_WORDS = 5
_WORD_HASH = PrefixHash(0x9E3779B97F4A7C15)
#: Odd multipliers, one for each word of a shingle.
_PLACE = np.array([(0xD1342543DE82EF95 * (2 * i + 1) ** 7 | 1) % 2**64 for i in range(SHINGLE_WORDS)], np.uint64)
_SHORT = np.uint64(0xA0761D6478BD642F)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges (i, j) with the sorted distinct shingle hashes of their rows,
    end to end, and the ends of each row's part.

    A-Z are lower-cased; a row with fewer words than a shingle has its whole
    sequence as the one shingle; a row without words has none."""
    for i, j in blocks(offsets):
        lo, hi = int(offsets[i]), int(offsets[j])
        b = data[lo:hi]
        b = b + np.where((b >= 65) & (b <= 90), np.uint8(32), np.uint8(0))
        starts_of_rows = offsets[i:j] - lo
        ends_of_rows = offsets[i + 1:j + 1] - lo
        inside = ~((b == 32) | ((b >= 9) & (b <= 13)))
        fresh = np.zeros(len(b) + 1, bool)  # a row begins here
        fresh[starts_of_rows] = True
        fresh[-1] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | fresh[1:-1]
        stop = inside.copy()
        stop[:-1] &= ~inside[1:] | fresh[1:-1]
        ws, we = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        h = _WORD_HASH.ranges(_WORD_HASH.sums(b), ws, we)
        first = np.searchsorted(ws, starts_of_rows)
        last = np.searchsorted(ws, ends_of_rows)
        n = len(h) - SHINGLE_WORDS + 1
        s = np.zeros(max(n, 0), np.uint64)
        for k in range(SHINGLE_WORDS):
            if n > 0:
                s += h[k:k + n] * _PLACE[k]
        s = mix64(s)
        parts, ends, total = [], np.zeros(j - i, np.int64), 0
        for r, (f, e) in enumerate(zip(first.tolist(), last.tolist())):
            m = e - f
            if m >= SHINGLE_WORDS:
                x = np.sort(s[f:e - SHINGLE_WORDS + 1])
                if len(x) > 1:
                    x = x[np.concatenate(([True], x[1:] != x[:-1]))]
                parts.append(x)
                total += len(x)
            elif m:
                parts.append(mix64((h[f:e] * _PLACE[:m]).sum(keepdims=True) + np.array([m], np.uint64) * _SHORT))
                total += 1
            ends[r] = total
        yield i, j, np.concatenate(parts) if parts else np.zeros(0, np.uint64), ends
