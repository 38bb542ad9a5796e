"""A Merkle manifest of a dataset with a proof for every row.

A row's leaf is a hash of its columns.  The leaves of a group (``lang``) in
ascending order of id are a tree: every two consecutive nodes of a level are
hashed into one of the next, an odd last one alone.  The roots of the groups
are the leaves of one more tree, whose root stands for the table.

Levels are built ``LEVELS`` at a time: a group of ``2 ** LEVELS`` consecutive
nodes gives all nodes above it, up to one.  Proofs come from
pointer jumping: each node holds the sibling digests (a segment) on the way to
the ancestor that it points to, at first its parent; a self-join with the
table of the ancestors appends their segments and doubles the distance, until
leaves reach the root.  Only nodes of levels that a later round reads take
part, so all but the leaves are few.  Near the root many leaves point to the
same node: the ancestors' side is repeated for each block of leaves below it
and the join is by block, so no task gets more of a hot node than of others.

Null ids come first among a group's leaves; rows that repeat an id are ordered
by their digests; equal rows are equal leaves at places of their own.  A null
group is a tree of its own, the first.  An empty table has no rows and no root.
Texts may have any length, and other columns any name: they are no part of a
leaf.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.llm.tables import col, stage
from contactloom.operators.ordinals import ROW_BITS, dense_ordinal, placed

#: Levels that one pass builds, and the bits of a block of leaves.
LEVELS = 8
#: Columns of ``documents`` that a leaf covers, in order.
COVERED = ("doc_id", "source", "lang", "n_chars", "text")
#: Bytes of a step of a proof: the side of the sibling (0: there is none), and its digest.
STEP = 33
NONE, LEFT = 0, 1


def field(c: Column) -> Column:
    """A column's part of a leaf: ``-`` if null, else its length in bytes, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_of(*columns: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def _block_steps(levels: int, key: tuple, nodes: pa.Table) -> pa.Table:
    """A block of consecutive nodes and those above it, up to ``levels`` levels: each with the step to its parent.

    Only the topmost have a digest: the root, whose step is empty, or the node
    that the next pass goes on from, without a step.
    """
    tree, n, level, block = (k.as_py() for k in key)
    order = nodes.column("idx").to_numpy().argsort()
    row, at = nodes.column("digest").take(pa.array(order)).to_pylist(), block << levels
    out: dict[str, list] = {"level": [], "idx": [], "digest": [], "seg": []}
    for k in range(level, level + levels):
        if (n - 1) >> k == 0:
            step = [b""]
        else:
            raw, alone = [bytes.fromhex(d) for d in row], bytes(STEP)
            step = [b"\x01" + raw[i - 1] if i % 2 else b"\x02" + raw[i + 1] if i + 1 < len(raw) else alone for i in range(len(raw))]
        out["level"] += [k] * len(row)
        out["idx"] += range(at, at + len(row))
        out["digest"] += row if step == [b""] else [None] * len(row)
        out["seg"] += step
        if step == [b""]:
            break
        row, at = [hashlib.sha256("".join(row[i : i + 2]).encode()).hexdigest() for i in range(0, len(row), 2)], at >> 1
    else:
        out["level"].append(level + levels)
        out["idx"].append(at)
        out["digest"] += row
        out["seg"].append(None)
    same = {"tree": [tree] * len(out["idx"]), "n": [n] * len(out["idx"])}
    return pa.Table.from_pydict(same | out, pa.schema([("tree", pa.int64()), ("n", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.string()), ("seg", pa.binary())]))


def build(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """All nodes (tree, n, level, idx, digest, seg) over leaves (tree, n, idx, digest), n the tree's leaves."""
    top, made = leaves.withColumn("level", F.lit(0)), []
    while not top.isEmpty():
        blocks = top.select("tree", "n", "level", "idx", "digest").groupBy("tree", "n", "level", F.shiftright("idx", levels).alias("block"))
        nodes = stage(blocks.applyInArrow(lambda key, nodes: _block_steps(levels, key, nodes), "tree bigint, n bigint, level int, idx bigint, digest string, seg binary"), "nodes")
        made.append(nodes.where("seg is not null"))
        top = nodes.where("seg is null")
    return reduce(DataFrame.unionByName, made)


def roots(nodes: DataFrame) -> DataFrame:
    return nodes.where("digest is not null").select("tree", "digest")


def proofs(nodes: DataFrame, depth: int, levels: int = LEVELS) -> DataFrame:
    """For every leaf (tree, idx) the steps to its tree's root, ``proof``, by pointer jumping.

    ``depth`` is the greatest depth of a tree; distances double from 1 to it.
    """
    table, far = nodes.select("tree", "n", "level", "idx", "seg"), 1
    while far < depth:
        # after this round a level is read again only if twice the distance divides it
        ahead = table.where(F.col("level") % (2 * far) == far).select("tree", F.col("level").alias("to"), F.col("idx").alias("up"), F.col("seg").alias("more"), F.expr(f"shiftright(up << to, {levels})").alias("first"), F.expr(f"shiftright(least((up + 1) << to, n) - 1, {levels})").alias("last"))
        ahead = ahead.select("tree", "to", "up", "more", F.explode(F.sequence("first", "last")).alias("block"))
        here = table.where(F.col("level") % (2 * far) == 0).withColumns({"to": F.col("level") + far, "up": F.shiftright("idx", far), "block": F.expr(f"shiftright(idx << level, {levels})")})
        joined = here.join(ahead, ["tree", "to", "up", "block"], "left")
        table = stage(joined.select("tree", "n", "level", "idx", F.concat("seg", F.coalesce("more", F.lit(b""))).alias("seg")), "steps")
        far *= 2
    return table.where("level = 0").select("tree", "idx", F.col("seg").alias("proof"))


def steps_of(proof: Column) -> Column:
    """A packed proof as an array of (side, digest in hex)."""
    n = (F.octet_length(proof) / STEP).cast("int")
    at = lambda i: F.substring(proof, i * STEP + 1, F.lit(STEP))
    packed = F.transform(F.sequence(F.lit(0), n - 1), at)
    return F.when(n > 0, F.transform(packed, lambda p: F.struct(F.conv(F.hex(F.substring(p, 1, 1)), 16, 10).cast("int").alias("side"), F.lower(F.hex(F.substring(p, 2, 32))).alias("digest")))).otherwise(F.expr("array()").cast("array<struct<side:int,digest:string>>"))


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and the steps of its proof give."""
    return F.aggregate(steps, leaf, lambda acc, s: F.sha2(F.when(s["side"] == NONE, acc).when(s["side"] == LEFT, F.concat(s["digest"], acc)).otherwise(F.concat(acc, s["digest"])), 256))


def manifest(docs: DataFrame, tampered: Column | None = None, covered: tuple[str, ...] = COVERED, id_col: str = "doc_id", group_col: str = "lang", levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, steps, folded_root and verified of every row.

    ``tampered`` is the leaf of a row as it is found now, null where it is as
    it was; the proof holds if that leaf folds to the root.  ``steps`` is the
    proof: sides and digests from the leaf to the root.
    """
    now = F.lit(None).cast("string") if tampered is None else tampered
    leaves = docs.select(col(id_col).alias("doc_id"), col(group_col).isNotNull().alias("named"), F.coalesce(col(group_col).cast("string"), F.lit("")).alias("name"), leaf_of(*[col(c) for c in covered]).alias("leaf"), now.alias("found"))
    group = ["named", "name"]
    # written before it is dealt by ranges, as those are found in a pass of their own
    rows = placed(stage(leaves, "leaves"), [F.col(c) for c in (*group, "doc_id", "leaf")]).withColumn("part", F.shiftright("_at", ROW_BITS))

    # rows of a group follow each other: one row for each partition that it lies in
    parts = stage(rows.groupBy("part", *group).agg(F.min("_at").alias("least"), F.count(F.lit(1)).alias("rows")), "parts")
    trees = stage(dense_ordinal(parts.groupBy(*group).agg(F.sum("rows").alias("n")), "tree", [F.col(c) for c in group]), "trees")
    most, count = trees.agg(F.coalesce(F.max("n"), F.lit(0)), F.count(F.lit(1))).first()
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    plan = parts.withColumn("shift", F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("least")).join(trees, group)
    rows = stage(rows.join(plan.select("part", *group, "tree", "n", "shift"), ["part", *group]).select("tree", "n", (F.col("_at") + F.col("shift")).alias("idx"), "doc_id", "leaf", "found"), "places")
    if not count:
        none = F.lit(None).cast("string")
        return rows.select("doc_id", "leaf", none.alias("subroot"), none.alias("root"), none.alias("proof_sha256"), steps_of(F.lit(b"")).alias("steps"), none.alias("folded_root"), F.lit(None).cast("boolean").alias("verified"))

    nodes = build(rows.select("tree", "n", "idx", F.col("leaf").alias("digest")), levels)
    own = proofs(nodes, (most - 1).bit_length(), levels)
    # the tree over the groups
    subroots = roots(nodes)
    upper = build(subroots.select(F.lit(0).cast("bigint").alias("tree"), F.lit(count).cast("bigint").alias("n"), F.col("tree").alias("idx"), "digest"), levels)
    root = roots(upper).first()["digest"]
    above = proofs(upper, (count - 1).bit_length(), levels).select(F.col("idx").alias("tree"), F.col("proof").alias("above"))
    # what a whole group needs goes to each of its blocks, not to one task
    blocks = F.explode(F.sequence(F.lit(0).cast("bigint"), F.shiftright(F.col("n") - 1, levels)))
    shared = trees.select("tree", blocks.alias("block")).join(subroots.select("tree", F.col("digest").alias("subroot")).join(above, "tree"), "tree")
    found = rows.drop("n").join(own, ["tree", "idx"]).withColumn("block", F.shiftright("idx", levels)).join(shared, ["tree", "block"])
    read = found.select("doc_id", "leaf", "found", "subroot", steps_of(F.concat("proof", "above")).alias("steps"))
    held = F.array_join(F.transform(F.filter("steps", lambda s: s["side"] != NONE), lambda s: s["digest"]), "")
    folded = read.select("doc_id", "leaf", "subroot", F.lit(root).alias("root"), F.sha2(held, 256).alias("proof_sha256"), "steps", fold(F.coalesce("found", "leaf"), F.col("steps")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
