"""Removal of repeated byte strings, by a run-length Burrows-Wheeler index over aligned contexts.

A byte goes if it lies in a string of ``LENGTH`` bytes (a window) that also
starts anywhere else.  A suffix index of a whole corpus does not fit one
machine, so the corpus is cut where repeats must line up:

1. Every window holds one minimizer: the leftmost of its ``GRAM``-byte strings
   with the least hash.  Equal windows have equal minimizers at equal
   offsets.  Windows that share a minimizer's place form a context of fewer
   than ``2 * LENGTH`` bytes; only minimizers that occur twice go on.
2. Equal contexts are counted; all their windows are repeated.
3. Different contexts of one minimizer are aligned at it and indexed by a
   positional Burrows-Wheeler transform: column by column they are kept in the
   order of their reversed prefixes.  Within a run of equal symbols order and
   matching statistics carry over, so only run ends are worked out anew, by a
   range maximum between them.  The statistics are streamed: after column x
   they say how far back each context agrees with its neighbours, and a
   window that ends there is repeated if that is its whole length.
4. A minimizer with more different contexts than one task should hold is not
   indexed: its contexts are cut into windows, and a window is repeated if
   another context has it at the same place, which partial counts tell.
5. Repeated windows of all documents are gathered per document, merged and
   cut out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import PrefixHash, blocks, stored, text_buffers

LENGTH = 200
GRAM = 80
#: Window starts that can share a minimizer.
REACH = LENGTH - GRAM + 1
#: Contexts indexed together; a minimizer's contexts are never parted, and one with more of them is counted by windows.
BATCH_ROWS = 20_000
_GRAM_HASH = PrefixHash(0x9FB21C651E98DF25)
_CONTEXT_HASH = PrefixHash(0xD6E8FEB86659FD93)


def minimizer_contexts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """row, start of the first window (byte of the row), windows, offset of the minimizer in the first window, its hash, hash of the context."""
    for i, j in blocks(offsets):
        base = int(offsets[i])
        b = data[base:int(offsets[j])]
        n = len(b) - LENGTH + 1
        if n <= 0:
            continue
        offs = offsets[i:j + 1] - base
        sums = _GRAM_HASH.sums(b)
        at = np.arange(len(b) - GRAM + 1)
        h = _GRAM_HASH.ranges(sums, at, at + GRAM)
        # least hash of REACH neighbours, by doubling
        low, span = h, 1
        while 2 * span <= REACH:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        low = np.minimum(low[:n], low[REACH - span:REACH - span + n])
        # a window and the next have different minimizers if the old one leaves or a lesser one enters
        leaves = h[:n] == low
        enters = np.zeros(n, bool)
        enters[:-1] = low[1:] < low[:-1]
        valid = np.zeros(n + 1, np.int32)
        starts, ends = offs[:-1], offs[1:] - LENGTH + 1  # window starts inside one row
        some = ends > starts
        np.add.at(valid, starts[some], 1)
        np.add.at(valid, ends[some], -1)
        valid = np.cumsum(valid[:-1]) > 0
        last = np.flatnonzero(valid & (leaves | enters | ~np.append(valid[1:], False)))
        row_start = starts[some]
        row = np.searchsorted(starts, last, side="right") - 1
        while len(row) and (bad := ~some[row]).any():  # rows without a window that begin at the same byte
            row[bad] -= 1
        first = np.concatenate(([0], last[:-1] + 1)) if len(last) else last
        # windows of a new row begin at its start
        first = np.maximum(first, starts[row])
        if len(row_start) == 0 or not len(last):
            continue
        place = np.where(leaves[last], last, -1)
        entered = np.zeros(len(last), bool)
        entered[1:] = enters[last[:-1]] & (first[1:] == last[:-1] + 1)
        todo = place < 0
        place[todo & entered] = first[todo & entered] + REACH - 1
        rest = np.flatnonzero(place < 0)
        for a in range(0, len(rest), 4096):
            r = rest[a:a + 4096]
            reach = first[r][:, None] + np.arange(REACH)
            place[r] = first[r] + (h[reach] == low[first[r]][:, None]).argmax(axis=1)
        contexts = _CONTEXT_HASH.sums(b)
        yield (i + row, first - starts[row], last - first + 1, place - first,
               h[place].view(np.int64), _CONTEXT_HASH.ranges(contexts, first, last + LENGTH).view(np.int64))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).select(
        F.coalesce("doc_id", F.xxhash64("text")).alias("doc"), F.hash("text").alias("version"), "doc_id", "text")


def contexts_of(docs: DataFrame) -> DataFrame:
    """anchor, context, rel, windows, doc, version, start of every minimizer context of ``docs`` (doc, version, text)."""
    def run(batches):
        for batch in batches:
            ids, versions = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, start, windows, rel, anchor, context in minimizer_contexts(*text_buffers(batch.column(2))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(context), pa.array(rel.astype(np.int16)), pa.array(windows.astype(np.int16)),
                     pa.array(ids[row]), pa.array(versions[row]), pa.array(start.astype(np.int32))],
                    ["anchor", "context", "rel", "windows", "doc", "version", "start"])

    return docs.select("doc", "version", "text").mapInArrow(
        run, "anchor long, context long, rel short, windows short, doc long, version int, start int")


def _packed(docs: DataFrame) -> DataFrame:
    """doc, version, doc_id and the text compressed, to be shuffled."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for a in range(0, len(batch), 512):
                some = batch.slice(a, 512)
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), some.column(2), pa.array(
                    [pack(t.as_buffer() if len(t.as_buffer()) else b"") for t in some.column(3).cast(pa.large_binary())], pa.binary())],
                    ["doc", "version", "doc_id", "packed"])

    return docs.select("doc", "version", "doc_id", "text").mapInArrow(run, "doc long, version int, doc_id long, packed binary")


def _context_bytes(wanted: DataFrame, packed: DataFrame) -> DataFrame:
    """Adds their bytes to the rows of ``wanted`` (anchor, context, rel, windows, copies, doc, version, start)."""
    lists = wanted.groupBy("doc", "version").agg(F.collect_list(F.struct("anchor", "context", "rel", "windows", "copies", "start")).alias("want"))

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for a in range(0, len(batch), 256):
                some = batch.slice(a, 256)
                columns, texts = [[] for _ in range(5)], []
                for p, want in zip(some.column(0), some.column(1)):
                    b = unpack(p.as_py())
                    w = want.values
                    fields = [w.field(k).to_pylist() for k in range(6)]
                    for c, f in zip(columns, fields):
                        c += f
                    texts += [b[s:s + n + LENGTH - 1] for s, n in zip(fields[5], fields[3])]
                kinds = (pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.int64())
                yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds)), pa.array(texts, pa.binary())],
                                                 ["anchor", "context", "rel", "windows", "copies", "bytes"])

    return lists.join(packed, ["doc", "version"]).select("packed", "want").mapInArrow(
        run, "anchor long, context long, rel short, windows short, copies long, bytes binary")


def repeated_windows(group: np.ndarray, rel: np.ndarray, windows: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Which windows (columns) of each context (rows) occur in another context of its group.

    ``group`` is sorted.  The contexts are aligned at their minimizer."""
    n, width = len(group), REACH - 1 + LENGTH
    symbols = np.zeros((n, width), np.uint16)  # 0: outside the context
    for k, t in enumerate(texts):
        begin = REACH - 1 - int(rel[k])
        symbols[k, begin:begin + len(t)] = np.frombuffer(t, np.uint8)[:width - begin].astype(np.uint16) + 1
    out = np.zeros((n, REACH), bool)
    order = np.arange(n)
    base = np.cumsum(np.concatenate(([0], group[1:] != group[:-1]))).astype(np.int64) << 9
    edge = np.concatenate(([True], base[1:] != base[:-1]))
    since = np.zeros(n + 1, np.int32)  # column from which a context agrees with the one before it in order
    for x in range(width):
        key = base + symbols[order, x]
        perm = np.argsort(key, kind="stable") if (key[1:] < key[:-1]).any() else None
        if perm is None:
            moved, now = since[:n].copy(), key
        else:
            now = key[perm]
            moved = since[perm]
            heads = np.flatnonzero(perm[1:] != perm[:-1] + 1) + 1  # run ends: the neighbour changes
            heads = heads[now[heads] == now[heads - 1]]
            if len(heads):
                pairs = np.column_stack([perm[heads - 1] + 1, perm[heads] + 1]).ravel()
                moved[heads] = np.maximum.reduceat(since, pairs)[::2]
            order = order[perm]
        fresh = edge.copy()
        fresh[1:] |= now[1:] != now[:-1]
        moved[fresh] = x + 1
        since[:n] = moved
        start = x - LENGTH + 1
        if start >= 0:
            near = since[:n] <= start
            near[:-1] |= (since[1:n] <= start) & ~edge[1:]
            row = order[near]
            window = start - (REACH - 1) + rel[row]
            fits = (window >= 0) & (window < windows[row])
            out[row[fits], window[fits]] = True
    return out


def _index(rows: DataFrame) -> DataFrame:
    """anchor, context, rel, windows and the ranges of repeated windows of contexts that occur once."""
    def solve(table: pa.Table) -> pa.RecordBatch:
        rel, windows, copies = (table.column(c).to_numpy().astype(np.int64) for c in ("rel", "windows", "copies"))
        hit = repeated_windows(table.column("anchor").to_numpy(), rel, windows, table.column("bytes").to_pylist())
        some = np.flatnonzero(hit.any(axis=1) & (copies < 2))
        padded = np.zeros((len(some), REACH + 2), np.int8)
        padded[:, 1:-1] = hit[some]
        change = np.diff(padded, axis=1)
        r, a = np.nonzero(change == 1)
        _, z = np.nonzero(change == -1)
        counts = np.bincount(r, minlength=len(some))
        ranges = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()),
                                          pa.StructArray.from_arrays([pa.array(a, pa.int32()), pa.array(z, pa.int32())], ["a", "z"]))
        picked = table.select(["anchor", "context", "rel", "windows"]).take(pa.array(some)).combine_chunks()
        return pa.RecordBatch.from_arrays([*(picked.column(k).combine_chunks() for k in range(4)), ranges], ["anchor", "context", "rel", "windows", "ranges"])

    def run(batches):
        held, count = [], 0
        for batch in batches:
            while len(batch):
                held.append(batch)
                count += len(batch)
                batch = batch.slice(len(batch))
            if count >= BATCH_ROWS:
                table = pa.Table.from_batches(held)
                anchors = table.column("anchor").to_numpy()
                cut = int(np.searchsorted(anchors, anchors[-1]))
                if cut:
                    yield solve(table.slice(0, cut))
                    held = table.slice(cut).to_batches()
                    count = len(table) - cut
        if count:
            yield solve(pa.Table.from_batches(held))

    return (rows.repartition("anchor").sortWithinPartitions("anchor", "context", "rel")
            .mapInArrow(run, "anchor long, context long, rel short, windows short, ranges array<struct<a:int,z:int>>"))


def _by_window(rows: DataFrame, most: int) -> DataFrame:
    """As ``_index``, for minimizers of any number of contexts: windows are compared by 128 bits of hash."""
    def run(batches):
        for batch in batches:
            for a in range(0, len(batch), 1024):
                some = batch.slice(a, 1024)
                data, offsets = text_buffers(some.column(5))
                windows = some.column(3).to_numpy().astype(np.int64)
                row = np.repeat(np.arange(len(some)), windows)
                window = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
                at = offsets[:-1][row] - offsets[0] + window
                b = data[offsets[0]:offsets[-1]]
                hashes = [pa.array(h.ranges(h.sums(b), at, at + LENGTH).view(np.int64)) for h in (_GRAM_HASH, _CONTEXT_HASH)]
                kept = some.select(range(5)).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*(kept.column(k) for k in range(5)), pa.array(window.astype(np.int16)), *hashes],
                                                 ["anchor", "context", "rel", "windows", "copies", "window", "h1", "h2"])

    name, key = ["anchor", "context", "rel", "windows"], ["anchor", "place", "h1", "h2"]
    cut = stored(rows.mapInArrow(run, "anchor long, context long, rel short, windows short, copies long, window short, h1 long, h2 long")
                 .withColumn("place", F.col("rel") - F.col("window")), "windows")
    # a context has one window at a place
    twice = stored(cut.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1"), "windows-twice")
    # windows of very many contexts are few: at most rows / most
    hot = F.broadcast(twice.where(F.col("n") > most).select(*key, F.lit(True).alias("hot")))
    once = cut.where("copies < 2").join(hot, key, "left")
    hit = (once.where("hot").select(*name, "window")
           .unionByName(once.where("hot is null").join(twice.where(F.col("n") <= most).select(*key), key).select(*name, "window")))
    at = F.col("at")
    edge = lambda step: F.filter(at, lambda w: ~F.array_contains(at, w + F.lit(step)))
    return (hit.groupBy(*name).agg(F.sort_array(F.collect_list(F.col("window").cast("int"))).alias("at"))
            .select(*name, F.zip_with(edge(-1), edge(1), lambda a, z: F.struct(a.alias("a"), (z + 1).alias("z"))).alias("ranges")))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc, version and the byte ranges (start, stop) covered by repeated windows; ``docs``: doc, version, doc_id, text.

    Minimizers of more than ``BATCH_ROWS`` different contexts are counted by windows, the others indexed."""
    most = BATCH_ROWS
    found = contexts_of(docs)
    many = stored(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    shared = stored(found.join(many, "anchor"), "shared")
    name = ["anchor", "context", "rel", "windows"]
    contexts = stored(shared.groupBy(*name).agg(F.count("*").alias("copies"), F.min(F.struct("doc", "version", "start")).alias("at")), "contexts")
    several = stored(contexts.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "several")
    packed = _packed(docs)

    def bytes_of(anchors: DataFrame) -> DataFrame:
        return _context_bytes(contexts.join(anchors, "anchor", "left_semi").select(*name, "copies", "at.doc", "at.version", "at.start"), packed)

    partly = stored(_index(bytes_of(several.where(F.col("n") <= most).select("anchor"))), "partly")
    large = several.where(F.col("n") > most).select("anchor")
    if not large.isEmpty():
        # at most contexts / most anchors
        partly = partly.unionByName(stored(_by_window(bytes_of(F.broadcast(large)), most), "partly-by-window"))
    wholly = contexts.where("copies > 1").select(*name, F.array(F.struct(F.lit(0).alias("a"), F.col("windows").cast("int").alias("z"))).alias("ranges"))
    return (shared.join(wholly.unionByName(partly), name)
            .select("doc", "version", F.explode(F.transform("ranges", lambda r: F.struct(
                (F.col("start") + r["a"]).alias("start"), (F.col("start") + r["z"] + (LENGTH - 1)).alias("stop")))).alias("s"))
            .groupBy("doc", "version").agg(F.collect_set("s").alias("spans")))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, spans (maximal
    removed byte ranges) and kept (the bytes that remain).

    Null and empty texts, and texts shorter than a window, lose nothing.  Rows
    that repeat a text of at least a window lose all of it.  Rows are told apart
    by doc_id and a hash of the text, so a doc_id that repeats with another text
    is a document of its own; a null doc_id is carried along.
    Extra columns are ignored; an empty table gives an empty result."""
    rows = _keyed(docs, id_col, text_col)
    spans = stored(repeated_spans(rows), "spans")

    def run(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for a in range(0, len(batch), 256):
                some = batch.slice(a, 256)
                sizes, removed, lists, kept = [], [], [], []
                for p, s in zip(some.column(1), some.column(2)):
                    b = unpack(p.as_py())
                    merged: list[list[int]] = []
                    if s.is_valid:
                        v = s.values
                        for x, y in sorted(zip(v.field(0).to_pylist(), v.field(1).to_pylist())):
                            y = min(y, len(b))
                            if merged and x <= merged[-1][1]:
                                merged[-1][1] = max(merged[-1][1], y)
                            elif x < y:
                                merged.append([x, y])
                    parts, last = [], 0
                    for x, y in merged:
                        parts.append(b[last:x])
                        last = y
                    parts.append(b[last:])
                    sizes.append(len(b))
                    removed.append(sum(y - x for x, y in merged))
                    lists.append([{"start": x, "stop": y} for x, y in merged])
                    kept.append(b"".join(parts))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(lists, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return _packed(rows).join(spans, ["doc", "version"], "left").select("doc_id", "packed", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, spans array<struct<start:int,stop:int>>, kept binary")


def repeats_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
