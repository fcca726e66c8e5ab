"""The Merkle manifest against a plain tree built in Python, on awkward tables."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from marquee.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, idx string, node string, key string, n string"
EXTRA = ("x",) * 5


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(d, text, lang, source, n):
    return h(*map(field, (d, source, lang, n, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def proof(tree, i):
    steps = []
    for level in tree[:-1]:
        lo = i - i % 3
        steps.append((level[lo:i], level[i + 1:lo + 3]))
        i //= 3
    return steps


def plain(rows):
    rows = [r[:5] for r in rows]
    order = lambda r: (r[3] is not None, (r[3] or "").encode(), r[0] is not None, r[0] or 0, leaf(*r))
    groups = [list(g) for _, g in itertools.groupby(sorted(rows, key=order), key=lambda r: r[3])]
    trees = [levels([leaf(*r) for r in g]) for g in groups]
    top = levels([t[-1][0] for t in trees])
    out = []
    for s, (g, tree) in enumerate(zip(groups, trees)):
        for i, (d, text, lang, source, n) in enumerate(g):
            steps = proof(tree, i) + proof(top, s)
            cut = d is not None and zlib.crc32(str(d).encode()) % 2 == 0 and text is not None
            acc = leaf(d, text.replace("\n", "") if cut else text, lang, source, n)
            for l, r in steps:
                acc = h(*l, acc, *r)
            out.append((d, leaf(d, text, lang, source, n), tree[-1][0], top[-1][0], h(*[x for l, r in steps for x in l + r]), acc, acc == top[-1][0]))
    return sorted(out, key=repr)


def rows_of(n, sources, seed):
    rnd = random.Random(seed)
    texts = [None, "", "a\nb", "é\n\U0001f600", "line\n" * 40, "x" * 3000]
    return [(rnd.choice([None, i, i, i - 1]), rnd.choice(texts), rnd.choice([None, "en"]), rnd.choice(sources), rnd.choice([None, 3]), *EXTRA) for i in range(n)]


@pytest.mark.parametrize("n, sources", [(0, ["a"]), (1, [None]), (3, ["a"]), (4, ["a", "b", "c", "d", "e"]), (10, ["a"]), (28, ["a", None]),
                                        (130, ["z", "é", "Z", "", None, "\U0001f600", "ｚ"]), (90, [str(i) for i in range(60)] + ["hot"] * 40)])
def test_equals_a_plain_tree(spark, n, sources):
    rows = rows_of(n, sources, n)
    got = merkle.manifest_digest(spark.createDataFrame(rows, DOCS))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(rows)


def test_repeated_rows_and_one_changed_bit(spark):
    rows = [(7, "same\ntext", "en", "a", 1, *EXTRA)] * 100 + [(i, "t", "en", "b", 1, *EXTRA) for i in range(5)]
    docs = spark.createDataFrame(rows, DOCS)
    assert sorted(map(tuple, merkle.manifest_digest(docs).collect()), key=repr) == plain(rows)
    proofs = merkle.manifest(docs, claims={"other": merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.concat("text", F.lit("!")))})
    assert merkle.verify(proofs).where("not verified").count() == 0
    assert merkle.verify(proofs, "other").where("verified").count() == 0


def test_pointers_end_at_the_root_in_doubling_steps(spark):
    """A chain deep enough for four doublings (28 leaves below 40 sources: depth 4 + 4)."""
    rows = [(i, "t", None, "big", 1, *EXTRA) for i in range(60)] + [(i, "u", None, f"s{i}", 1, *EXTRA) for i in range(40)]
    depth = {r.key: r.n for r in merkle.manifest(spark.createDataFrame(rows, DOCS)).where("size(segment) > 4").select("key", F.size("segment").alias("n")).collect()}
    assert len(depth) == 60 and set(depth.values()) == {8}
