"""Merkle manifest of a table: every row's digest, inclusion proof and the root, by pointer jumping.

The tree has ``FANOUT`` children per node.  The rows of one group (a source)
form a tree over their leaves in key order, and the roots of the groups, in
group order, form the tree above them.

Method
------
1. A leaf is the digest of a row's fields.  Its position in its group comes
   from ranges of (group, key), so a group of any size covers many tasks.
2. Levels are built bottom-up: ``FANOUT`` neighbours meet in a group-by on
   position div ``FANOUT``.  The same row holds every child's siblings.
3. Proofs: each node points at its parent and holds the segment (the siblings
   on that step).  Round r joins the pointers with themselves: a pointer to a
   node that is not at a depth divisible by 2^r is replaced by that node's
   own pointer, and the two segments are concatenated, so the distance
   doubles.  Only leaves and nodes at such depths are carried on; the others
   are never looked up again.  After log2(depth) rounds all leaves point at the root.
4. A proof is checked by folding a leaf with its segments.

Everything is a join, a group-by or a column expression; digests travel as 32
bytes and are written as hex only where they are hashed or returned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.ranking import positions
from marquee.llm.common import stored

#: Children of a node (fixed by the manifest's format).
FANOUT = 3
#: Tree number of the tree over the groups' roots.
TOP = -1
_KEY = ("tree", "level", "idx")


def digest(text: Column) -> Column:
    """sha256 of a string's UTF-8 bytes, as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def hexed(node: Column) -> Column:
    return F.lower(F.hex(node))


def field(value: Column) -> Column:
    """A field as the leaf hashes it: ``-`` if null, else its UTF-8 length, ``:`` and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return digest(F.concat(*[field(f) for f in fields]))


def _height(n: Column) -> Column:
    """Levels above ``n`` leaves, in integers."""
    h, reach = F.when(n <= 1, 0), 1
    for level in range(1, 40):
        reach *= FANOUT
        h = h.when(n <= reach, level)
    return h


def build(leaves: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """(roots, levels) of the trees over ``leaves``: tree, idx (0, 1, ...), node, n (leaves of the tree, ``most`` at most).

    roots: tree, node.  levels[k]: one row per run of the k-th level: tree,
    idx (the parent's), node (the parent's digest), kids (the run's digests in
    order), n (nodes of the parent's level)."""
    level, levels, roots = leaves.select("tree", "idx", "node", "n"), [], []
    while most > 1:
        roots.append(level.where("n = 1").select("tree", "node"))
        kids = F.transform(F.sort_array(F.collect_list(F.struct("idx", "node"))), lambda k: k["node"])
        runs = (level.where("n > 1").groupBy("tree", F.expr(f"idx div {FANOUT}").alias("idx")).agg(kids.alias("kids"), F.first("n").alias("n"))
                .withColumn("n", F.expr(f"(n + {FANOUT - 1}) div {FANOUT}"))
                .withColumn("node", digest(F.array_join(F.transform("kids", hexed), ""))))
        level = stored(runs, "level")
        levels.append(level)
        most = -(-most // FANOUT)
    return reduce(DataFrame.unionAll, [*roots, level.select("tree", "node")]), levels


def edges(levels: list[DataFrame]) -> DataFrame:
    """Every node below a root: tree, level, idx, step (its siblings left and right of it)."""
    out = []
    for k, runs in enumerate(levels):
        at = runs.select("tree", F.col("idx").alias("run"), "kids", F.posexplode("kids").alias("nth", "node"))
        step = F.struct(F.array_join(F.transform(F.slice("kids", F.lit(1), F.col("nth")), hexed), "").alias("l"),
                        F.array_join(F.transform(F.slice("kids", F.col("nth") + 2, F.lit(FANOUT)), hexed), "").alias("r"))
        as_bytes = F.struct(F.unhex(step["l"]).alias("l"), F.unhex(step["r"]).alias("r"))
        out.append(at.select("tree", F.lit(k).alias("level"), (F.col("run") * FANOUT + F.col("nth")).alias("idx"), as_bytes.alias("step")))
    return reduce(DataFrame.unionAll, out)


def pointers(steps: DataFrame, heights: DataFrame, top_height: int) -> DataFrame:
    """Pointer of every node to its parent: tree, level, idx, depth, leaf, up (the parent's key), up_depth, segment.

    A group's root is named as the leaf of the top tree that it is; the only
    leaf of a group is such a root itself and takes that one's step."""
    h = steps.join(heights, "tree")
    is_top = F.col("tree") == TOP
    to_top = ~is_top & (F.col("level") + 1 == F.col("height"))
    depth = F.when(is_top, F.lit(top_height) - F.col("level")).otherwise(F.lit(top_height) + F.col("height") - F.col("level"))
    up = F.when(to_top, F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"))).otherwise(
        F.struct(F.col("tree"), (F.col("level") + 1).alias("level"), F.expr(f"idx div {FANOUT}").alias("idx")))
    nodes = h.select(*_KEY, depth.alias("depth"), (~is_top & (F.col("level") == 0)).alias("leaf"),
                     up.alias("up"), (depth - 1).alias("up_depth"), F.array("step").alias("segment"))
    alone = heights.where(f"height = 0 and tree <> {TOP}").select(F.col("tree").alias("idx"))
    only = (nodes.where(f"tree = {TOP} and level = 0").join(alone, "idx")
            .select(F.col("idx").alias("tree"), "level", F.lit(0).cast("long").alias("idx"), "depth", F.lit(True).alias("leaf"), "up", "up_depth", "segment"))
    return nodes.unionAll(only)


def jump(nodes: DataFrame, deepest: int) -> DataFrame:
    """Pointers to the root: repeated self-joins that double the distance of every pointer."""
    reach = 1
    while reach < deepest:
        far = 2 * reach
        kept = nodes.where(F.col("leaf") | (F.col("depth") % far == 0))
        there = F.col("up_depth") % far == 0
        via = nodes.where(~F.col("leaf")).select(F.struct(*_KEY).alias("up"), F.col("up").alias("next"), F.col("up_depth").alias("next_depth"),
                                                 F.col("segment").alias("rest"))
        on = (kept.where(~there).join(via, "up")
              .select(*_KEY, "depth", "leaf", F.col("next").alias("up"), F.col("next_depth").alias("up_depth"),
                      F.concat("segment", "rest").alias("segment")))
        nodes = stored(kept.where(there).select(*on.columns).unionAll(on), "pointers")
        reach = far
    return nodes


def fold(node: Column, segment: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(segment, node, lambda acc, s: digest(F.concat(hexed(s["l"]), hexed(acc), hexed(s["r"]))))


def proof_digest(segment: Column) -> Column:
    """sha256 (hex) of a proof's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(segment, lambda s: F.concat(hexed(s["l"]), hexed(s["r"]))), ""), 256)


def manifest(docs: DataFrame, group: str = "source", key: str = "doc_id", fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             claims: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: key, leaf, subroot, root (32 bytes each) and segment, the proof.

    The leaf covers ``fields``.  The groups' trees hold their leaves by
    ascending ``key`` (null first, ties by digest), the top tree holds the
    groups' roots by ascending group (null first, strings by UTF-8 bytes).  A
    segment is an array of (l, r), leaf to root: the siblings left and right
    on each step, as digests end to end.  A group of one row has its leaf as
    its root; a table of one group has that group's root as its root; then
    there are no siblings.  ``claims`` adds columns (name -> expression over
    ``docs``), for instance digests of copies to be checked.  Equal rows are
    rows of their own with equal leaves.  Other columns are not looked at; an
    empty table gives an empty result."""
    claims = claims or {}
    rows = stored(docs.select(F.col(key).alias("key"), F.col(group).alias("group"), leaf(*[F.col(f) for f in fields]).alias("node"),
                              *[c.alias(f"claim_{name}") for name, c in claims.items()]), "rows")
    placed = positions(rows, ["group"], [F.col("key").asc_nulls_first(), F.col("node")], "idx").drop("__range")
    sizes = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    trees = stored(positions(sizes, [], [F.col("group").asc_nulls_first()], "tree").drop("__range"), "trees")
    groups, most = trees.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    leaves = stored(placed.alias("p").join(trees.alias("t"), F.col("p.group").eqNullSafe(F.col("t.group")))
                    .select("p.key", "t.tree", "p.idx", "p.node", "t.n", *[f"p.claim_{name}" for name in claims]), "leaves")
    roots, levels = build(leaves, most)
    roots = stored(roots, "roots")
    top_leaves = roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), "node", F.lit(groups).cast("long").alias("n"))
    top_roots, top_levels = build(top_leaves, groups)
    root = F.lit((top_roots.first() or [None, None])[1]).cast("binary")
    none = F.expr("CAST(array() AS array<struct<l: binary, r: binary>>)")
    out = leaves.join(roots.withColumnRenamed("node", "subroot"), "tree")
    if levels or top_levels:
        heights = (trees.select("tree", _height(F.col("n")).alias("height"))
                   .unionAll(trees.sparkSession.range(1).select(F.lit(TOP).cast("long"), F.lit(len(top_levels)))))
        steps = reduce(DataFrame.unionAll, [edges(x) for x in (levels, top_levels) if x])
        nodes = stored(pointers(steps, heights, len(top_levels)), "pointers")
        ends = jump(nodes, len(levels) + len(top_levels)).where("leaf").select("tree", "idx", "segment")
        out = out.join(ends, ["tree", "idx"], "left")
    else:
        out = out.withColumn("segment", none)
    return out.select("key", F.col("node").alias("leaf"), "subroot", root.alias("root"), F.coalesce("segment", none).alias("segment"),
                      *[F.col(f"claim_{name}").alias(name) for name in claims])


def verify(proofs: DataFrame, claim: str = "leaf") -> DataFrame:
    """``proofs`` (as ``manifest`` gives them) with folded_root, what the column ``claim`` and the row's siblings give, and verified."""
    return (proofs.withColumn("folded_root", fold(F.col(claim), F.col("segment")))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def manifest_digest(docs: DataFrame) -> DataFrame:
    """Manifest of a documents table, and the check of copies in which every
    document with an even crc32 of its doc_id has lost its line feeds:
    doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.  A null
    doc_id or text is not tampered with."""
    cut = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    text = F.when(cut, F.translate(F.col("text"), "\n", "")).otherwise(F.col("text"))
    copy = leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    checked = verify(manifest(docs, claims={"copy": copy}), "copy")
    return checked.select(F.col("key").alias("doc_id"), *[hexed(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
                          proof_digest(F.col("segment")).alias("proof_sha256"), hexed(F.col("folded_root")).alias("folded_root"), "verified")
