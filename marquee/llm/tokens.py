"""Token-ID files: byte-level BPE ids, compressed per shard by a Re-Pair grammar.

Documents are range-partitioned and sorted by doc_id; every task encodes its
range and writes shards of about ``SHARD_TOKENS`` ids.  A shard is one row of a
Parquet table (so a lost task writes it again and a failed one leaves nothing)
with a binary payload in the format below.

Re-Pair: frequent pairs of adjacent symbols are replaced by new symbols, in
rounds; a round counts all pairs and replaces every pair that occurs at least
``LEAST_PAIRS`` times, leftmost first where occurrences overlap.  No pair spans
two documents.  Rounds go on until no pair is left that often, or until the symbols
of the format are used up, the most frequent pairs first.  The payload holds the
rules, the length of each rule's expansion and, for each document, where its symbols
begin, so a document (or a range of its ids) is decoded without the rest of the shard.

Payload, little-endian: b"RPG1", uint32 base (first new symbol), uint32 rules,
uint32 documents, uint32 symbols; rules x (uint16 left, uint16 right); rules x
uint32 expansion length; documents x uint32 ids; (documents + 1) x uint32 first
symbol; symbols x uint16.  Vocabularies of 65 536 ids and more give b"RPG2", the
same with uint32 symbols in rules and sequence.
"""

from __future__ import annotations

import json
import os
import re
import string
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import blocks, stored, text_buffers

END_ID = 2
SHARD_TOKENS = 1 << 20
#: Text bytes per task.
TASK_BYTES = 24 << 20
LEAST_PAIRS = 24
#: Parts whose totals one task adds up.
PART_GROUP = 4096
#: Vocabularies below this have 16-bit symbols, others 32-bit ones.
_NARROW = 1 << 16
_CACHE_WORDS = 350_000
#: Text bytes that are encoded together.
_BLOCK_BYTES = 4 << 20
_PAIR_BITS = 18
_MAGIC, _WIDE_MAGIC = b"RPG1", b"RPG2"
#: Pieces that can be encoded many to a string, by group: one space and ASCII letters or digits; one space and
#: visible ASCII, Latin or Cyrillic letters; those without the space.
_PLAIN = re.compile(rb" (?:[A-Za-z]+|[0-9]+)()| (?:[!-~]|[\xc3-\xc9\xd0-\xd3][\x80-\xbf])+()|(?:[!-~]|[\xc3-\xc9\xd0-\xd3][\x80-\xbf])+()")
#: New pieces that are encoded in one string.
_JOINED = 64
#: Kinds of bytes: letters, digits, other visible ASCII characters, apostrophe, space, other white space, first
#: bytes of the letters above; 0 for all others.
_LETTER, _DIGIT, _SIGN, _QUOTE, _SPACE, _BREAK, _LEAD = range(1, 8)


def symbol_type(base: int) -> str:
    """Numpy type of the symbols of a shard whose first new symbol is ``base``."""
    return "<u2" if base < _NARROW else "<u4"



class Encoder:
    """Ids of whole texts, with the tokenizer run once for each different piece.

    Byte-level BPE never merges across the cut between a visible character and
    the white space after it, so texts are cut there and the ids of the pieces
    are joined.  A tokenizer that cuts by the byte-level rule alone is also given
    ASCII letters, digits and signs apart (``_kinds``).  Cuts are found in the UTF-8
    bytes of a block of texts and equal pieces of the block are looked up once.  At
    most two generations of ``_CACHE_WORDS`` pieces (and one block more) are known at
    a time."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Metaspace
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("byte_bpe_50k.json")
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.base = max(vocabulary.values()) + 1
        self.kind = symbol_type(self.base)
        # ids whose text begins with a space (byte-level vocabularies write it as U+0120)
        self.opens = np.zeros(self.base, bool)
        self.opens[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        self.kinds, self.words, self.between = _kinds(json.loads(self.tokenizer.to_str())), None, vocabulary.get("\u010a")
        if self.kinds is not None:
            # the same model; cuts before spaces and writes them as U+0120, all that the byte-level rule does to plain words
            self.words = Tokenizer(self.tokenizer.model)
            self.words.pre_tokenizer = Metaspace(replacement="\u0120", prepend_scheme="never", split=True)
        # two generations, so pieces still in use stay known
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _learn(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of new pieces.  Plain words go to the tokenizer many to a string.  Those that begin with a
        space, where byte-level BPE always cuts, and have no other are the ids from one that begins with
        a space to the next.  Others are parted by line feeds, if the byte-level rule cuts on both sides."""
        out: dict[bytes, bytes] = {}
        groups: list[list[bytes]] = [[], [], [], []]
        for p in pieces:
            form = _PLAIN.fullmatch(p)
            groups[form.lastindex if form else 0].append(p)
        _, simple, spaced, bare = groups
        self._joined(simple, self.words or self.tokenizer, out)
        self._joined(spaced, self.tokenizer, out)
        if self.kinds is not None and self.between is not None:
            self._joined(bare, self.tokenizer, out, b"\n")
        rest = pieces if not out else [p for p in pieces if p not in out]
        for a in range(0, len(rest), 4096):
            out.update(zip(rest[a:a + 4096], self._ids(rest[a:a + 4096], self.tokenizer)))
        return out

    def _joined(self, words: list[bytes], tokenizer, out: dict[bytes, bytes], glue: bytes = b"") -> None:
        width = np.dtype(self.kind).itemsize
        for a in range(0, len(words), 64 * _JOINED):
            part = words[a:a + 64 * _JOINED]
            raw = b"".join(self._ids([glue + glue.join(part[k:k + _JOINED]) for k in range(0, len(part), _JOINED)], tokenizer))
            ids = np.frombuffer(raw, self.kind)
            cut = np.flatnonzero(ids == self.between if glue else self.opens[ids]) * width
            if len(cut) == len(part):
                begin = (cut + width * len(glue)).tolist()
                out.update(zip(part, [raw[x:y] for x, y in zip(begin, [*cut[1:].tolist(), len(raw)])]))

    def _ids(self, texts: list[bytes], tokenizer) -> list[bytes]:
        code = "H" if self.kind == "<u2" else "I"
        return [array(code, e.ids).tobytes() for e in tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def _lookup(self, pieces: list[bytes]) -> list[bytes]:
        if len(self.known) > _CACHE_WORDS:
            self.older, self.known = self.known, {}
        found = list(map(self.known.get, pieces))
        names = [p for p, x in zip(pieces, found) if x is None]
        fresh = {p: x for p, x in zip(names, map(self.older.get, names)) if x is not None}
        fresh.update(self._learn([p for p in names if p not in fresh]))
        self.known.update(fresh)
        return [x or fresh[p] for p, x in zip(pieces, found)]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text with ``END_ID`` appended (null: only that)."""
        return list(self.encode_column(pa.array(texts, pa.string())))

    def encode_column(self, column: pa.Array) -> Iterator[np.ndarray]:
        """``encode`` of a string column, in blocks of bounded size."""
        data, offsets = text_buffers(column)
        for i, j in blocks(offsets, _BLOCK_BYTES):
            yield from self._block(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        if self.kinds is not None:
            _part(data, first, self.kinds)
        first[_cuts(data)] = True
        starts = np.flatnonzero(first[:-1])
        edges = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(data))])
        coded = pieces.dictionary_encode()
        held, edges = text_buffers(coded.dictionary)
        held, edges = held.tobytes(), edges.tolist()
        found = [*self._lookup([held[x:y] for x, y in zip(edges, edges[1:])]), np.array([END_ID], self.kind).tobytes()]
        ids = np.frombuffer(b"".join(found), self.kind)
        # a text has fewer than 2^31 bytes, and no more ids than that
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // np.int32(ids.itemsize)
        # the pieces in order, and the end id after the last one of each text
        order = np.insert(coded.indices.to_numpy(), np.searchsorted(starts, offsets[1:]), len(found) - 1)
        n = sizes[order]
        ends = np.cumsum(n, dtype=np.int32)
        begins = np.cumsum(sizes, dtype=np.int32)[order]
        begins -= ends
        at = np.repeat(begins, n)
        at += np.arange(len(at), dtype=np.int32)
        return np.split(ids[at], ends[np.flatnonzero(order == len(found) - 1)][:-1])


@lru_cache(maxsize=1)
def worker_encoder(path: str | None) -> Encoder:
    """One encoder per Python worker, so its tasks share what they have learnt."""
    return Encoder(path)


def _cuts(data: np.ndarray) -> np.ndarray:
    """Places in UTF-8 bytes between a visible character and space, tab, line feed or carriage return.

    A character of several bytes counts as visible if its first byte starts no Unicode space."""
    blank = np.zeros(256, bool)
    blank[[0x20, 0x09, 0x0A, 0x0D]] = True
    at = np.flatnonzero(blank[data])
    at = at[at > 0]
    before = data[at - 1]
    tail = lambda k: (before >= 0x80) & (before < 0xC0) & (at >= k)
    second, third = data[at - 2], data[np.maximum(at - 3, 0)]
    seen = (before > 0x20) & (before < 0x7F)
    seen |= tail(2) & (second >= 0xC3) & (second < 0xE0)
    seen |= tail(3) & (second >= 0x80) & (second < 0xC0) & (third >= 0xE4) & (third < 0xF0)
    return at[seen]


def _kinds(spec: dict) -> np.ndarray | None:
    """Kind of each byte for ``_part``, if the tokenizer cuts texts by the byte-level rule and nothing else; otherwise None.

    Bytes of added tokens, which are looked for before that rule, have no kind, except letters;
    added tokens that a plain word may hold or begin with, or that hold white space, rule this out."""
    rule, added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
    if (spec["normalizer"] or rule.get("type") != "ByteLevel" or not rule["use_regex"] or rule["add_prefix_space"]
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] or not re.match(r"[!-/:-@\[-`{-~]", t["content"]) or re.search(r"\s", t["content"])
                   for t in added)):
        return None
    kinds = np.zeros(256, np.uint8)
    kinds[0x21:0x7F] = _SIGN
    kinds[0xC3:0xCA] = kinds[0xD0:0xD4] = _LEAD
    for chars, kind in ((string.ascii_letters, _LETTER), (string.digits, _DIGIT), ("'", _QUOTE), (" ", _SPACE), ("\t\n\r", _BREAK)):
        kinds[list(chars.encode())] = kind
    bound = list("".join(t["content"] for t in added).encode())
    kinds[bound] = np.where(kinds[bound] == _LETTER, _LETTER, 0)
    return kinds


def _part(data: np.ndarray, first: np.ndarray, kinds: np.ndarray) -> None:
    """Adds to ``first`` (starts of texts) where the byte-level rule cuts between ASCII bytes that have a kind.

    It takes letters, digits and signs apart; an apostrophe may go with the letters after it, and
    a space with the one kind after it.  Of white space before a visible character the last
    character is cut off from those before it, and unless it is a space from that character too."""
    kind = kinds[data]
    pair = kind[:-1] * np.uint8(8) + kind[1:]
    led = _LED[pair] & ~first[1:-1]  # white space that ends a text leads nothing
    first[1:-1] |= _APART[pair]
    first[:-2] |= led


def _pairs(*pairs: tuple[int, int]) -> np.ndarray:
    out = np.zeros(64, bool)
    out[[8 * a + b for a, b in pairs]] = True
    return out


_APART = _pairs(*((_LETTER, b) for b in (_DIGIT, _SIGN, _QUOTE)), *((_DIGIT, b) for b in (_LETTER, _SIGN, _QUOTE)),
                (_SIGN, _LETTER), (_SIGN, _DIGIT), (_QUOTE, _DIGIT), *((_BREAK, b) for b in (_LETTER, _DIGIT, _SIGN, _QUOTE, _LEAD)))
_LED = _pairs(*((a, b) for a in (_SPACE, _BREAK) for b in (_LETTER, _DIGIT, _SIGN, _QUOTE, _LEAD)))


def repair(ids: np.ndarray, lengths: np.ndarray, base: int, least: int = LEAST_PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, first symbol of each document (and the end), rules (left, right); rule k is symbol base + k."""
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)  # ends a document
    last[np.cumsum(lengths) - 1] = True
    rules = np.zeros((0, 2), np.uint32)
    limit = np.iinfo(symbol_type(base)).max + 1
    # a pair is one number: two 16-bit symbols in 32 bits, wider ones in 64
    wide, bits, odd = (np.uint32, 16, 0x9E3779B1) if limit <= _NARROW else (np.uint64, 32, 0x9E3779B97F4A7C15)
    places = np.flatnonzero(~last[:-1])  # where a frequent pair may begin
    while limit > base + len(rules) and len(places):  # every round makes the sequence shorter
        code = seq[places].astype(wide)
        code <<= wide(bits)
        code |= seq[places + 1]
        slot = ((code * wide(odd)) >> wide(2 * bits - _PAIR_BITS)).astype(np.int64)
        often = np.bincount(slot, minlength=1 << _PAIR_BITS) >= least
        held = np.flatnonzero(often[slot])
        if not len(held):
            break
        at = places[held]
        coded = pa.array(code[held]).dictionary_encode()
        pairs, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        count = np.bincount(which)
        chosen = np.flatnonzero(count >= least)
        if not len(chosen):
            break
        chosen = chosen[np.argsort(-count[chosen], kind="stable")][:limit - base - len(rules)]
        number = np.full(len(pairs), -1, np.int32)
        number[chosen] = np.arange(len(chosen), dtype=np.int32)
        which = number[which]
        ours = which >= 0
        at, which = at[ours], which[ours]
        # of occurrences that overlap, every other one from the left
        step = np.arange(len(at), dtype=np.int32)
        begin = step.copy()
        begin[1:] *= at[1:] != at[:-1] + 1
        np.maximum.accumulate(begin, out=begin)
        take = (step - begin) & 1 == 0
        at, which = at[take], which[take]
        used = np.bincount(which, minlength=len(chosen)) > 0
        picked = pairs[chosen[used]]
        seq[at] = (np.cumsum(used, dtype=np.uint32) + np.uint32(base + len(rules) - 1))[which]
        last[at] = last[at + 1]
        rules = np.concatenate([rules, np.stack([picked >> wide(bits), picked & wide((1 << bits) - 1)], axis=1).astype(np.uint32)])
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, last = seq[keep], last[keep]
        # pairs without a symbol of this round were too rare or are all replaced, so only those beside one can be frequent
        at -= np.arange(len(at))
        beside = np.zeros(len(seq) + 1, bool)
        beside[at] = beside[at - 1] = True  # -1 is the spare place at the end
        places = np.flatnonzero(beside[:len(seq) - 1] & ~last[:-1])
    firsts = np.concatenate(([0], np.flatnonzero(last) + 1))
    return seq.astype(symbol_type(base)), firsts.astype("<u4"), rules.astype(symbol_type(base))


def rule_sizes(rules: np.ndarray, base: int) -> np.ndarray:
    """Length of each rule's expansion."""
    sizes: list[int] = []
    for left, right in rules.tolist():
        sizes.append((sizes[left - base] if left >= base else 1) + (sizes[right - base] if right >= base else 1))
    return np.array(sizes, "<u4")


def rule_expansions(rules: np.ndarray, base: int) -> np.ndarray:
    """All rules' expansions, end to end."""
    parts: list[bytes] = []
    for left, right in rules.tolist():
        parts.append((parts[left - base] if left >= base else left.to_bytes(4, "little"))
                     + (parts[right - base] if right >= base else right.to_bytes(4, "little")))
    return np.frombuffer(b"".join(parts), "<u4")


def pack(ids: list[np.ndarray], base: int) -> bytes:
    """A shard's payload; ``ids``: one array for each document, none empty."""
    lengths = np.array([len(x) for x in ids], "<u4")
    seq, firsts, rules = repair(np.concatenate(ids), lengths.astype(np.int64), base)
    sizes = rule_sizes(rules, base)
    return b"".join([_MAGIC if base < _NARROW else _WIDE_MAGIC, struct.pack("<4I", base, len(rules), len(ids), len(seq)), rules.tobytes(), sizes.tobytes(),
                     lengths.tobytes(), firsts.tobytes(), seq.tobytes()])


class Shard:
    """Random access to a payload."""

    def __init__(self, payload: bytes):
        if payload[:4] not in (_MAGIC, _WIDE_MAGIC):
            raise ValueError("not a token shard")
        kind = "<u2" if payload[:4] == _MAGIC else "<u4"
        width = np.dtype(kind).itemsize
        self.base, rules, docs, symbols = struct.unpack_from("<4I", payload, 4)
        at = 20
        take = lambda kind, n: np.frombuffer(payload, kind, n, at)
        rule = take(kind, 2 * rules).reshape(-1, 2)
        at += 2 * width * rules
        self.sizes = take("<u4", rules)
        at += 4 * rules
        self.lengths = take("<u4", docs)
        at += 4 * docs
        self.firsts = take("<u4", docs + 1)
        at += 4 * (docs + 1)
        self.symbols = take(kind, symbols)
        self.expanded = rule_expansions(rule, self.base)
        self.begin = np.concatenate(([0], np.cumsum(self.sizes, dtype=np.int64)))

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        symbols = symbols.astype(np.int64)
        rule = symbols >= self.base
        n = np.ones(len(symbols), np.int64)
        n[rule] = self.sizes[symbols[rule] - self.base]
        out = np.repeat(symbols.astype("<u4"), n)
        if rule.any():
            start = np.cumsum(n) - n
            n, start, source = n[rule], start[rule], self.begin[symbols[rule] - self.base]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(start, n) + step] = self.expanded[np.repeat(source, n) + step]
        return out

    def document(self, k: int) -> np.ndarray:
        """All ids of document ``k`` of the shard."""
        return self._expand(self.symbols[self.firsts[k]:self.firsts[k + 1]])

    def slice(self, k: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of document ``k``: only symbols that reach into the range are expanded."""
        symbols = self.symbols[self.firsts[k]:self.firsts[k + 1]].astype(np.int64)
        n = np.ones(len(symbols), np.int64)
        n[symbols >= self.base] = self.sizes[symbols[symbols >= self.base] - self.base]
        ends = np.cumsum(n)
        a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        skipped = int(ends[a - 1]) if a else 0
        return self._expand(symbols[a:b])[start - skipped:stop - skipped]

    def documents(self):
        """The ids of every document, expanded together."""
        every = self._expand(self.symbols)
        return np.split(every, np.cumsum(self.lengths[:-1], dtype=np.int64)) if len(self.lengths) else []


def token_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Shards in ascending doc_id order: part, number, doc_ids, n_tokens, payload.

    Null and empty texts are one end id.  Rows that repeat a doc_id are
    documents of their own, ordered by a hash of their text; null ids come
    first.  Extra columns are ignored; an empty table gives no shard."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # one number
    parts = max(1, -(-total // TASK_BYTES))
    # the hash lets a doc_id that many rows repeat be split; rows are dealt in order
    ordered = (rows.withColumn("h", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "h")
               .sortWithinPartitions("doc_id", "h").select("doc_id", "text"))

    def run(batches):
        from pyspark import TaskContext
        encoder, part, number = worker_encoder(tokenizer), TaskContext.get().partitionId(), 0
        names, ids, size = [], [], 0

        def shard():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([names], pa.list_(pa.int64())),
                 pa.array([size], pa.int64()), pa.array([pack(ids, encoder.base)], pa.binary())],
                ["part", "number", "doc_ids", "n_tokens", "payload"])

        for batch in batches:
            for d, x in zip(batch.column(0).to_pylist(), encoder.encode_column(batch.column(1))):
                names.append(d)
                ids.append(x)
                size += len(x)
                if size >= SHARD_TOKENS:
                    yield shard()
                    number, names, ids, size = number + 1, [], [], 0
        if ids:
            yield shard()

    return ordered.mapInArrow(run, "part int, number int, doc_ids array<long>, n_tokens long, payload binary")


def read_documents(shards: DataFrame) -> DataFrame:
    """part, number, k, doc_id, ids_before (in the shard), n_tokens, ids_crc32 of every document, decoded from the payloads."""
    def run(batches):
        for batch in batches:
            for part, number, names, payload in zip(*(batch.column(i) for i in range(4))):
                shard = Shard(payload.as_py())
                n = len(shard.lengths)
                crc = [zlib.crc32(x.astype("<u4", copy=False).tobytes()) for x in shard.documents()]
                before = np.cumsum(shard.lengths, dtype=np.int64) - shard.lengths
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * n, pa.int32()), pa.array([number.as_py()] * n, pa.int32()), pa.array(range(n), pa.int32()),
                     names.values, pa.array(before), pa.array(shard.lengths.astype(np.int64)), pa.array(crc, pa.int64())],
                    ["part", "number", "k", "doc_id", "ids_before", "n_tokens", "ids_crc32"])

    return shards.select("part", "number", "doc_ids", "payload").mapInArrow(
        run, "part int, number int, k int, doc_id long, ids_before long, n_tokens long, ids_crc32 long")


def write_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Writes the shards of ``docs`` under the shared folder and returns the table as read back."""
    return stored(token_shards(docs, id_col, text_col, tokenizer), "token-shards")


def token_digest(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in a table of shards, decoded from it.

    start counts the ids of all documents before it: running totals over the shards of
    a part, over the parts of a group of ``PART_GROUP``, and over the groups, so no task
    sees more than one row per group."""
    def before(df: DataFrame, within: list, order: str, out: str) -> DataFrame:
        w = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.coalesce(F.sum("n_tokens").over(w), F.lit(0)))

    held = shards.select("part", "number", "n_tokens")
    parts = held.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens")).withColumn("part_group", F.expr(f"part div {PART_GROUP}"))
    groups = before(parts.groupBy("part_group").agg(F.sum("n_tokens").alias("n_tokens")), [F.lit(0)], "part_group", "group_start")
    starts = (before(parts, ["part_group"], "part", "part_start").join(groups.drop("n_tokens"), "part_group")
              .select("part", (F.col("group_start") + F.col("part_start")).alias("part_start")))
    offsets = (before(held, ["part"], "number", "shard_start").join(starts, "part")
               .select("part", "number", (F.col("part_start") + F.col("shard_start")).alias("shard_start")))
    return (read_documents(shards).join(offsets, ["part", "number"])
            .select("doc_id", (F.col("shard_start") + F.col("ids_before")).alias("start"), "n_tokens", "ids_crc32"))
