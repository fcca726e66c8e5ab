"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text.
Both begin with the same sample of ordinary words; the toxic one goes on with
the windows that set toxic documents apart, the other with as many bytes of
other ordinary words.  A window is one lower-cased word, framed by a fixed
stretch of text on either side (the coder looks for no match in the
last bytes of its input).  Its gain is the number of bytes that the toxic
dictionary saves over the ordinary one.  A document's score is a logistic
function of its best gains, of how many windows gain, and of its number of
windows, calibrated on labelled documents that trained no dictionary.

The toxic windows are those words of toxic documents that hold a short byte
sequence found in several toxic and in no more than a stray ordinary document;
the other words of a toxic document are ordinary text.

Training takes a bounded sample: at most ``SAMPLE_DOCS`` documents of each
label, chosen by a hash of doc_id.  Scoring reads every whole text.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents of each class that training reads at most.
SAMPLE_DOCS = 3000
#: Of these, the share that calibrates.
CALIBRATION_SHARE = 0.4
#: Bytes of ordinary words that both dictionaries share, and of what each has besides, at most.
SHARED_BYTES, OWN_BYTES = 60_000, 8_000
#: What stands before and after a window; both dictionaries end with it (their very last bytes are not searched), so it costs the same in both.
BEFORE, AFTER = b"{<[0123456789:;=+*&^%$#@!~?>]}", b"]>?~!@#$%^&*+=;:9876543210[<{"
FRAME_END = BEFORE + AFTER + b" " * 16
#: Larger gains count as this.
MOST_GAIN = 9
THRESHOLD = 0.3
#: Bytes of the sequences that mark toxic windows, and toxic documents that must hold one.
GRAM_BYTES, LEAST_DOCS = 5, 3
#: A sequence marks toxic windows if its share of toxic documents is this many times its share of ordinary ones.
LIFT = 40.0
_CACHE_WINDOWS = 400_000


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def windows_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


class Model:
    """Both dictionaries and the calibration; small, and the same in every task."""

    def __init__(self, toxic: bytes, ordinary: bytes, weights: list[float]):
        self.toxic, self.ordinary, self.weights = toxic, ordinary, weights
        self._open()

    def __getstate__(self):
        return self.toxic, self.ordinary, self.weights

    def __setstate__(self, state):
        self.toxic, self.ordinary, self.weights = state
        self._open()

    def _open(self):
        import zstandard as z

        def compressor(raw: bytes):
            d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
            params = z.ZstdCompressionParameters(window_log=17, chain_log=17, hash_log=17, search_log=7, min_match=4, target_length=48,
                                                 strategy=z.STRATEGY_GREEDY, write_content_size=0, write_checksum=0, write_dict_id=0)
            d.precompute_compress(compression_params=params)
            return z.ZstdCompressor(dict_data=d, compression_params=params).compress

        self._both = compressor(self.toxic + FRAME_END), compressor(self.ordinary + FRAME_END)
        self._young: dict[str, int] = {}
        self._old: dict[str, int] = {}

    def _gain(self, window: str) -> int:
        b = b"".join((BEFORE, b" ", window.encode(), b" ", AFTER))
        toxic, ordinary = self._both
        return len(ordinary(b)) - len(toxic(b))

    def gains(self, windows: list[str]) -> list[int]:
        if len(self._young) > _CACHE_WINDOWS:
            self._old, self._young = self._young, {}
        young, old = self._young, self._old
        found = list(map(young.get, windows))
        if None in found:
            for k, g in enumerate(found):
                if g is None:
                    w = windows[k]
                    g = young.get(w)
                    if g is None:
                        g = old.get(w)
                        if g is None:
                            g = self._gain(w)
                        young[w] = g
                    found[k] = g
        return found

    def features(self, text: str | None) -> tuple[float, ...]:
        """The two best gains, logs of how many windows gain 2, 3, 4 and 5 bytes, and the log of their number."""
        g = self.gains(windows_of(text))
        if not g:
            return (0.0,) * 7
        counts = Counter(min(x, MOST_GAIN) for x in g)
        by_gain = sorted(counts, reverse=True)
        first = by_gain[0]
        second = first if counts[first] > 1 else by_gain[1] if len(by_gain) > 1 else 0
        return (float(first), float(second), *(math.log1p(sum(n for v, n in counts.items() if v >= least)) for least in (2, 3, 4, 5)), math.log1p(len(g)))

    def score(self, text: str | None) -> float:
        x = sum(w * f for w, f in zip(self.weights, (1.0, *self.features(text))))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, x))))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.3) -> list[float]:
    """Weighted logistic regression with a ridge on all but the intercept, by damped Newton steps; the intercept first."""
    x = np.column_stack([np.ones(len(x)), x])
    penalty = np.array([1e-6] + [ridge] * (x.shape[1] - 1))
    loss = lambda w: float(weight @ np.logaddexp(0, np.where(y > 0, -1, 1) * (x @ w)) + 0.5 * penalty @ w**2)
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + penalty * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9), g)
        t, now = 1.0, loss(w)
        while t > 1e-6 and loss(w - t * step) > now - 1e-4 * t * float(g @ step):
            t /= 2
        w = w - t * step
        if np.abs(t * step).max() < 1e-7:
            break
    return [float(v) for v in w]


def fit(rows: list[tuple[str | None, int]], totals: dict[int, int]) -> Model:
    """A model from labelled texts; ``totals``: labelled documents of each class in the whole table."""
    cut = {c: int(CALIBRATION_SHARE * sum(1 for _, y in rows if y == c)) for c in (0, 1)}
    seen, train, calibrate = Counter(), [], []
    for t, y in rows:
        (calibrate if seen[y] < cut[y] else train).append((t, y))
        seen[y] += 1
    grams = {0: Counter(), 1: Counter()}
    docs = Counter(y for _, y in train)
    words: dict[int, list[set[bytes]]] = {0: [], 1: []}
    cuts = lambda b: {b[i:i + GRAM_BYTES] for i in range(len(b) - GRAM_BYTES + 1)}
    for t, y in train:
        ws = {(" " + w).encode() for w in windows_of(t)}
        words[y].append(ws)
        grams[y].update({g for w in ws for g in cuts(w)})
    rate = lambda g, y, more=0.0: (grams[y][g] + more) / max(1, docs[y])
    marks = {g for g, n in grams[1].items() if n >= LEAST_DOCS and rate(g, 1) >= LIFT * rate(g, 0, 0.25)}
    # the most frequent windows last, where they are cheapest to refer to
    toxic = Counter(w for ws in words[1] for w in ws if cuts(w) & marks)
    toxic = b"".join(w for w, _ in sorted(toxic.items(), key=lambda x: (x[1], x[0])))[-OWN_BYTES:]
    # ordinary words in an order that does not depend on the documents' order
    ordinary = b"".join(sorted({w for ws in words[0] for w in ws}, key=zlib.crc32)[:100_000])
    shared, more = ordinary[:SHARED_BYTES], ordinary[SHARED_BYTES:SHARED_BYTES + len(toxic)]
    model = Model(shared + toxic, shared + more, [-3.0] + [0.0] * 7)
    y = np.array([y for _, y in calibrate], float)
    if len(y) and 0 < y.sum() < len(y):
        n = {c: sum(1 for _, k in calibrate if k == c) for c in (0, 1)}
        weight = np.array([totals.get(k, n[k]) / n[k] for _, k in calibrate])
        x = np.array([model.features(t) for t, _ in calibrate])
        model.weights = _logistic(x, y, weight * len(y) / weight.sum())
    return model


def training_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_DOCS) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """At most ``most`` labelled texts of each class that may be learned from, and how many there are in all."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    totals = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}  # two rows
    chosen = [usable.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for c in (0, 1)]
    ids = F.broadcast(chosen[0].unionAll(chosen[1]))  # 2 * most rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(ids, "doc_id")
    rows = texts.orderBy(F.xxhash64("doc_id"), "doc_id", "text").select("text", "toxic").collect()  # bounded by the sample
    return [(r["text"], r["toxic"]) for r in rows], totals


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts have no window and get the score of that.  Labels are
    read for training only, never those of held-out rows; with labels of one
    class only, every score is the same low one.  Repeated rows are scored
    alike; a null doc_id is not held out; extra columns are ignored."""
    model = fit(*training_sample(docs, labels))

    def run(batches):
        for batch in batches:
            scores = np.array([model.score(t) for t in batch.column(2).to_pylist()], float)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")
