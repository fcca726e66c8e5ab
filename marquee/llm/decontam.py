"""Benchmark decontamination: approximate occurrences of test items in documents.

Texts are compared as UTF-8 bytes with A-Z lower-cased and each run of white
space made one space.  An item of L bytes may differ by ``budget(L)`` edits.
It is split into one piece more than that, so any occurrence holds at least
one piece unchanged.  Items under ``LEAST_ITEM_BYTES`` are one piece each: they
are found word for word, as whole words.  Documents are scanned once: a rolling hash of every
position is looked up in a table of piece hashes, each hit is compared byte by
byte, and the stretch around a whole piece is verified by Myers' bit-parallel
edit distance, with the item's bytes as the bits of one integer.

Test items are read in blocks of ``ITEM_BLOCK_BYTES``; what tasks receive is
one block, so its size is bounded, and every block passes over all documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import PrefixHash, blocks, text_buffers

ERROR_RATE = 0.05
#: Items with fewer bytes must stand unchanged and between word edges: with an edit in so few bytes they could be any phrase.
LEAST_ITEM_BYTES = 24
ITEM_BLOCK_BYTES = 4 << 20
_TABLE_BITS = 20
_HASH = PrefixHash(0xC2B2AE3D27D4EB4F)


def budget(length: int) -> int:
    """Edits allowed in an item of ``length`` bytes."""
    return int(ERROR_RATE * length) if length >= LEAST_ITEM_BYTES else 0


def _word_byte(c: int) -> bool:
    return c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A


def whole_words(b: np.ndarray, start: int, stop: int, begin: int, end: int) -> bool:
    """Whether no word goes on over either edge of bytes start to stop of the text begin to end."""
    return not (start > begin and _word_byte(b[start]) and _word_byte(b[start - 1])
                or stop < end and _word_byte(b[stop - 1]) and _word_byte(b[stop]))


def normalise(text: str | None) -> bytes:
    """The byte form that is compared (null: empty)."""
    b = (text or "").encode()
    return re.sub(rb"[\x20\x09-\x0D]+", b" ", b.translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))).strip(b" ")


def _normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``normalise`` for many texts at once (a space at either end may stay): bytes and offsets."""
    b = data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))
    space = (b == 32) | ((b >= 9) & (b <= 13))
    b[space] = 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    starts = offsets[:-1][offsets[:-1] < len(b)]
    keep[starts] = True
    before = np.concatenate(([0], np.cumsum(keep)))
    return b[keep], before[offsets]


def myers(item: bytes, text: bytes, most: int, masks: dict | None = None) -> tuple[int, int]:
    """Least edit distance of ``item`` to any substring of ``text``, and where that
    substring ends; (most + 1, -1) if it is above ``most``."""
    m = len(item)
    if masks is None:
        masks = item_masks(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, most + 1, -1
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
            if best == 0:
                break
    return best, end


def item_masks(item: bytes) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | (1 << i)
    return masks


class _Pieces:
    """Hash table of the first ``q`` bytes of pieces (item number, where it starts in the item, bytes)."""

    def __init__(self, pieces: list[tuple[int, int, bytes]]):
        self.q = min(len(p) for _, _, p in pieces)
        heads = np.frombuffer(b"".join(p[:self.q] for _, _, p in pieces), np.uint8)
        at = np.arange(len(pieces)) * self.q
        h = _HASH.ranges(_HASH.sums(heads), at, at + self.q)
        order = np.argsort(h, kind="stable")
        self.hashes, self.pieces = h[order], [pieces[i] for i in order]
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[h >> np.uint64(64 - _TABLE_BITS)] = True

    def hits(self, sums: np.ndarray) -> Iterator[tuple[int, tuple[int, int, bytes]]]:
        """(position, piece) of every piece whose hash occurs in the text of these prefix sums."""
        at = np.arange(max(len(sums) - self.q, 0))
        h = _HASH.ranges(sums, at, at + self.q)
        hits = np.flatnonzero(self.table[h >> np.uint64(64 - _TABLE_BITS)])
        lo, hi = np.searchsorted(self.hashes, h[hits], "left"), np.searchsorted(self.hashes, h[hits], "right")
        real = lo < hi
        for p, x, y in zip(hits[real].tolist(), lo[real].tolist(), hi[real].tolist()):
            for z in range(x, y):
                yield p, self.pieces[z]


class Matcher:
    """Piece tables of one block of test items: one for long items, one for each length of short ones."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.items = [(i, t) for i, t in items if t]
        tables: dict[int, list[tuple[int, int, bytes]]] = {}
        for k, (_, t) in enumerate(self.items):
            n = budget(len(t)) + 1
            cuts = [len(t) * x // n for x in range(n + 1)]
            tables.setdefault(min(len(t), LEAST_ITEM_BYTES), []).extend((k, a, t[a:b]) for a, b in zip(cuts, cuts[1:]))
        self.tables = [_Pieces(pieces) for _, pieces in sorted(tables.items())]
        self.masks: dict[int, dict] = {}

    def find(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(row, item number, distance, end byte in the normalised text), the best one for each row and item."""
        for i, j in blocks(offsets):
            b, offs = _normalised(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            sums = _HASH.sums(b)
            best: dict[tuple[int, int], tuple[int, int]] = {}
            tried: set[tuple[int, int, int]] = set()
            for p, (k, a, piece) in (hit for table in self.tables for hit in table.hits(sums)):
                r = int(np.searchsorted(offs, p, side="right")) - 1
                begin, stop = int(offs[r]), int(offs[r + 1])
                if p + len(piece) > stop or b[p:p + len(piece)].tobytes() != piece:
                    continue
                item = self.items[k][1]
                e = budget(len(item))
                start = p - a  # where the item starts if nothing was added or left out before the piece
                if best.get((r, k), (1,))[0] == 0 or (r, k, start) in tried:
                    continue
                tried.add((r, k, start))
                if len(item) < LEAST_ITEM_BYTES:
                    if whole_words(b, start, p + len(piece), begin, stop):
                        best[r, k] = (0, start + len(item) - begin)
                    continue
                if start >= begin and start + len(item) <= stop and b[start:start + len(item)].tobytes() == item:
                    best[r, k] = (0, start + len(item) - begin)
                    continue
                left, right = max(begin, start - e), min(stop, start + len(item) + e)
                d, end = myers(item, b[left:right].tobytes(), e, self.masks.setdefault(k, item_masks(item)))
                if d <= e and d < best.get((r, k), (e + 1,))[0]:
                    best[r, k] = (d, left + end - begin)
            for (r, k), (d, end) in sorted(best.items()):
                yield i + r, k, d, end


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[Matcher]:
    """The test items in blocks of ``ITEM_BLOCK_BYTES`` (an item larger than that is a block of its own)."""
    block, size = [], 0
    for item_id, text in benchmark.select(F.col(id_col).cast("long"), F.col(text_col)).toLocalIterator():
        t = normalise(text)
        if block and size + len(t) > ITEM_BLOCK_BYTES:
            yield Matcher(block)
            block, size = [], 0
        block.append((item_id, t))
        size += len(t)
    if block:
        yield Matcher(block)


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and test item found in it: doc_id, item_id, distance
    (edits, 0: word for word) and end (byte of the normalised text).

    Null and empty texts hold no item; items that are null, empty or only space
    are found nowhere; items under ``LEAST_ITEM_BYTES`` only word for word.  Repeated rows are reported once
    each.  Rows with a null id are reported with it.  Extra columns are ignored.
    """
    schema = "doc_id long, item_id long, distance int, end int"
    out = docs.sparkSession.createDataFrame([], schema)
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    for matcher in item_blocks(benchmark):
        def run(batches, matcher=matcher):
            for batch in batches:
                hits = list(matcher.find(*text_buffers(batch.column(1))))
                rows = pa.array([h[0] for h in hits], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), pa.array([matcher.items[h[1]][0] for h in hits], pa.int64()),
                     pa.array([h[2] for h in hits], pa.int32()), pa.array([h[3] for h in hits], pa.int32())],
                    ["doc_id", "item_id", "distance", "end"])
        out = out.unionAll(found.mapInArrow(run, schema))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no test item is found, all columns as they are.

    One narrow pass per block of items: no row is moved.  Rows with a null or
    empty text stay."""
    at = docs.columns.index(text_col)
    for matcher in item_blocks(benchmark):
        def run(batches, matcher=matcher):
            for batch in batches:
                keep = np.ones(len(batch), bool)
                for h in matcher.find(*text_buffers(batch.column(at))):
                    keep[h[0]] = False
                yield batch.filter(pa.array(keep))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
