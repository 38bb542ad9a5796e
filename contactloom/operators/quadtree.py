"""Repulsion of many bodies in the plane by a tree of cells.

A square around all nodes is halved in both directions level by level.  A cell
belongs to the tree if the one above it has more than ``leaf`` nodes; cells
that have no more are leaves.  Forces are found for blocks, the largest cells of
few nodes.  A cell far from a block, its side less than OPENING times the
distance, acts on the block's nodes from its centre of mass; others are opened,
and of leaves that are near the nodes act one by one.

Counts and sums of cells are an aggregation, a few levels at a time: deeper ones
take up only the nodes of cells that have too many.  The tree goes to all tasks:
its leaves grow with the number of nodes beyond LEAVES, so it has at most a
bounded number of cells on each level, however many nodes there are and wherever
they lie.  Blocks lie in groups, larger cells; a node is sent to its own group
and to those that its leaf is near to, so a group and its near leaves are of
bounded size.  Nodes that lie together even on the last level act as one and are
dealt to several groups, so they are no large group either.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.session import TASKS_PER_CORE

#: Levels below the square, nodes of a leaf at least, and leaves from which on leaves have more.
DEPTH, LEAF, LEAVES = 20, 16, 20_000
#: Cells that reach the driver in a step, but where one level has more.
CELLS = 1 << 16
#: Nodes of a block, which meet the same cells, and of a group at least, and groups from which on groups have more.
BLOCK, GROUP, GROUPS = 256, 512, 128
#: Side of a cell over its distance below which it acts as one.
OPENING = 0.5
#: Strength of the repulsion; close by it is limited.
REPULSION, SOFT = 10.0, 1.0


def places(nodes: DataFrame, box: tuple[float, float, float]) -> DataFrame:
    """Add ``px``, ``py``: the cell of the last level; ``box`` has the least coordinates and the side."""
    x0, y0, side = box
    at = lambda c, low: F.least(F.floor((F.col(c) - F.lit(low)) / F.lit(side) * float(1 << DEPTH)), F.lit((1 << DEPTH) - 1)).cast("bigint")
    return nodes.withColumns({"px": at("x", x0), "py": at("y", y0)})


def tree_cells(placed: DataFrame, leaf: int) -> DataFrame:
    """The tree's cells: level, cx, cy, n, mass, and the sums mx, my of mass times place."""
    each = placed.select("px", "py", "mass", "x", "y", F.explode(F.sequence(F.lit(0), F.lit(DEPTH))).alias("level"))
    cell = lambda c: F.shiftright(F.col(c), 1)
    at = lambda c: F.expr(f"shiftright({c}, {DEPTH} - level)")
    sums = each.groupBy("level", at("px").alias("cx"), at("py").alias("cy")).agg(F.count(F.lit(1)).alias("n"), F.sum("mass").alias("mass"), F.sum(F.col("mass") * F.col("x")).alias("mx"), F.sum(F.col("mass") * F.col("y")).alias("my"))
    above = sums.where(F.col("n") > leaf).select((F.col("level") + 1).alias("level"), F.col("cx").alias("ax"), F.col("cy").alias("ay"))
    inside = sums.join(above, (sums["level"] == above["level"]) & (cell("cx") == F.col("ax")) & (cell("cy") == F.col("ay")), "left_semi")
    return sums.where("level = 0").unionByName(inside)


@dataclass
class Tree:
    """The cells as arrays, children in rows of four (-1: none), and the leaves in the order of their places."""

    box: tuple[float, float, float]
    level: np.ndarray
    corner: np.ndarray
    count: np.ndarray
    mass: np.ndarray
    centre: np.ndarray
    above: np.ndarray
    children: np.ndarray
    #: the least place in each cell
    begin: np.ndarray
    #: leaves whose nodes act one by one
    single: np.ndarray
    leaves: np.ndarray
    starts: np.ndarray

    def side(self, k: np.ndarray) -> np.ndarray:
        return self.box[2] / (1 << self.level[k]).astype(np.float64)

    def leaf_of(self, place: np.ndarray) -> np.ndarray:
        """The number of the leaf that each place lies in."""
        return np.searchsorted(self.starts, place, side="right") - 1

    def blocks(self, most: int) -> np.ndarray:
        """The largest cells of at most so many nodes, or leaves, in the order of their places."""
        small = (self.count <= most) | (self.children.max(axis=1) < 0)
        own = np.flatnonzero(small & ~(small[self.above] & (self.level > 0)))
        return own[self.begin[own].argsort()]

    def around(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Cells that act on a leaf as one, and leaves whose nodes act one by one."""
        (_, far), (_, near) = self.around_all(np.array([number]))
        return far, near

    def around_all(self, numbers: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """As ``around`` for many leaves, level by level: which of them, in order, and the cell that acts on it."""
        return self.around_cells(self.leaves[numbers])

    def around_cells(self, own: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """As ``around_all`` for any cells; what is near to a cell is near to the one above it too."""
        low = self.corner[own]
        high = low + self.side(own)[:, None]
        far, near = [], []
        on, cell = np.arange(len(own)), np.zeros(len(own), np.int64)
        while len(cell):
            gap = np.maximum(np.maximum(low[on] - self.centre[cell], self.centre[cell] - high[on]), 0.0)
            apart = self.side(cell) < OPENING * np.sqrt((gap * gap).sum(axis=1))
            ends = self.children[cell].max(axis=1) < 0
            one = apart | (ends & ~self.single[cell])
            far.append((on[one], cell[one]))
            near.append((on[ends & ~one], cell[ends & ~one]))
            below, on = self.children[cell[~one & ~ends]].ravel(), np.repeat(on[~one & ~ends], 4)
            on, cell = on[below >= 0], below[below >= 0]

        def sorted_pairs(found):
            on, cell = (np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in (0, 1))
            order = on.argsort(kind="stable")
            return on[order], cell[order]

        return sorted_pairs(far), sorted_pairs(near)


def _interleaved(px: np.ndarray, py: np.ndarray) -> np.ndarray:
    out = np.zeros(len(px), np.int64)
    for b in range(DEPTH):
        out |= (px >> b & 1) << (2 * b) | (py >> b & 1) << (2 * b + 1)
    return out


def _every_other(place: np.ndarray) -> np.ndarray:
    out = np.zeros(len(place), np.int64)
    for b in range(DEPTH):
        out |= (place >> (2 * b) & 1) << b
    return out


def around_nodes() -> list:
    """The sums that ``square`` is made of, for an aggregation of the nodes."""
    return [F.min("x"), F.max("x"), F.min("y"), F.max("y"), F.count(F.lit(1))]


def square(nodes: DataFrame, found: tuple | None = None) -> tuple[tuple[float, float, float], int]:
    """The square around the nodes, and their number; ``found`` has ``around_nodes`` where that is known."""
    x0, x1, y0, y1, n = found or nodes.agg(*around_nodes()).first()
    return (x0, y0, max(x1 - x0, y1 - y0, 1e-6)) if n else (0.0, 0.0, 1.0), n


def _place(batch: pa.RecordBatch, box: tuple[float, float, float]) -> np.ndarray:
    """``places`` in one number, the digits of both directions in turn, so that its first digits are the cells above."""
    at = [np.minimum(np.floor((batch.column(c).to_numpy() - low) / box[2] * (1 << DEPTH)), (1 << DEPTH) - 1).astype(np.int64) for c, low in (("x", box[0]), ("y", box[1]))]
    return _interleaved(*at)


def _sums(cell: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each cell once, in order, and the sums of its rows."""
    order = cell.argsort(kind="stable")
    cell = cell[order]
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]][: len(cell)])
    return cell[first], np.add.reduceat(values[order], first) if len(cell) else values


def _summed(nodes: DataFrame, box: tuple[float, float, float], level: int, above: tuple[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The cells of a level within cells ``above`` (level, numbers in order), and for each n, mass, mx and my."""
    sent = nodes.sparkSession.sparkContext.broadcast(above)

    def sums(batches):
        up, within = sent.value
        for b in batches:
            place, mass, x, y = _place(b, box), *(b.column(c).to_numpy() for c in ("mass", "x", "y"))
            over = place >> (2 * (DEPTH - up))
            some = within[np.minimum(np.searchsorted(within, over), len(within) - 1)] == over
            cell, v = _sums(place[some] >> (2 * (DEPTH - level)), np.stack([np.ones(len(mass)), mass, mass * x, mass * y], axis=1)[some])
            yield pa.RecordBatch.from_arrays([pa.array(cell), *(pa.array(v[:, k].copy()) for k in range(4))], names=["cell", "n", "mass", "mx", "my"])

    values = ("n", "mass", "mx", "my")
    t = nodes.select("mass", "x", "y").mapInArrow(sums, "cell bigint, n double, mass double, mx double, my double").groupBy("cell").agg(*[F.sum(v).alias(v) for v in values]).toArrow()
    sent.unpersist()
    return _sums(t.column("cell").to_numpy(), np.stack([t.column(v).to_numpy() for v in values], axis=1))


def _cells(nodes: DataFrame, n: int, box: tuple[float, float, float], leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``tree_cells`` as arrays: levels, numbers and sums, in order.

    Cells of one level are summed, those above are their sums.  Nodes of cells
    that have too many are summed again deeper down, by as many levels as CELLS
    allows.
    """
    levels, cells, sums = [], [], []
    up, within = 0, np.zeros(1, np.int64)
    while len(within) and up < DEPTH:
        first = up + 1 if levels else 0
        last = DEPTH if n <= CELLS else min(DEPTH, up + max(1, ((CELLS // len(within)).bit_length() - 1) // 2))
        steps = [_summed(nodes, box, last, (up, within))]
        for _ in range(first, last):
            steps.insert(0, _sums(steps[0][0] >> 2, steps[0][1]))
        for level, (cell, v) in enumerate(steps, first):
            # of the first cells of a step, all lie in cells that have too many
            inside = np.isin(cell >> 2, within) if level > first else np.ones(len(cell), bool)
            cell, v = cell[inside], v[inside]
            more = v[:, 0] > leaf
            levels.append(np.full(len(cell), level))
            cells.append(cell)
            sums.append(v)
            within, n = cell[more], v[more, 0].sum()
        up = last
    return np.concatenate(levels), np.concatenate(cells), np.concatenate(sums)


def quadtree(nodes: DataFrame, found: tuple | None = None) -> Tree | None:
    """The tree over nodes (mass, x, y); none if there are no nodes."""
    box, n = square(nodes, found)
    if not n:
        return None
    leaf = max(LEAF, n // LEAVES)
    return _tree(box, leaf, *_cells(nodes, n, box, leaf))


def _tree(box: tuple[float, float, float], leaf: int, level: np.ndarray, cell: np.ndarray, sums: np.ndarray) -> Tree:
    begin = cell << (2 * (DEPTH - level))
    key = level << (2 * DEPTH) | begin
    # the cell above has the same place without its last two bits
    up = 2 * (DEPTH - np.maximum(level - 1, 0))
    above = np.searchsorted(key, np.maximum(level - 1, 0) << (2 * DEPTH) | begin >> up << up)
    children = np.full((len(key), 4), -1, np.int64)
    children[above[1:], (cell & 3)[1:]] = np.arange(1, len(key))
    ends = np.flatnonzero(children.max(axis=1) < 0)
    ends = ends[begin[ends].argsort()]
    width = box[2] / (1 << level).astype(np.float64)
    at = np.stack([_every_other(cell), _every_other(cell >> 1)], axis=1)
    count, mass = sums[:, 0].astype(np.int64), sums[:, 1]
    return Tree(box, level, np.array(box[:2]) + at * width[:, None], count, mass, sums[:, 2:] / mass[:, None], above, children, begin, count <= leaf, ends, begin[ends])


#: Forces between so many pairs are found at once.
AT_ONCE = 1 << 16


@cache
def _room() -> np.ndarray:
    """Four times AT_ONCE numbers, kept in a process: their memory is not asked for again."""
    return np.empty((4, AT_ONCE))


def _pushes(at: np.ndarray, mass: np.ndarray, sources: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The repulsion that each node feels from all sources."""
    out, room = np.zeros_like(at), _room()
    x, y = np.ascontiguousarray(sources.T)
    for i in range(0, len(at), BLOCK):
        some = slice(i, min(i + BLOCK, len(at)))
        step = AT_ONCE // (some.stop - i)
        for k in range(0, len(x), step):
            by = slice(k, min(k + step, len(x)))
            dx, dy, push, other = room[:, : (some.stop - i) * (by.stop - k)].reshape(4, some.stop - i, -1)
            np.subtract(at[some, 0, None], x[by], out=dx)
            np.subtract(at[some, 1, None], y[by], out=dy)
            np.multiply(dx, dx, out=push)
            np.multiply(dy, dy, out=other)
            push += other
            push += SOFT
            np.divide(weights[by], push, out=push)
            out[some, 0] += np.vecdot(push, dx)
            out[some, 1] += np.vecdot(push, dy)
    return out * (REPULSION * mass)[:, None]


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    size = high - low
    return np.arange(size.sum()) + np.repeat(low - (size.cumsum() - size), size)


@dataclass
class Deal:
    """Groups of cells, and where nodes go: a leaf's own group of ``parts`` numbers from ``first``, and the numbers ``to`` that it is near to."""

    tree: Tree
    cells: np.ndarray
    first: np.ndarray
    parts: np.ndarray
    group_of: np.ndarray
    upto: np.ndarray
    to: np.ndarray
    #: blocks, and the first leaf of each and one beyond the last
    blocks: np.ndarray
    bounds: np.ndarray

    def group(self, number: int) -> int:
        return int(np.searchsorted(self.first, number, side="right") - 1)


def _deal(tree: Tree) -> Deal:
    most = max(GROUP, int(tree.count[0]) // GROUPS)
    cells = tree.blocks(most)
    alone = (tree.children[cells].max(axis=1) >= 0) | tree.single[cells]
    parts = np.where(alone, 1, -(-tree.count[cells] // most))
    first = parts.cumsum() - parts
    numbers = np.full(len(tree.level), -1, np.int64)
    numbers[tree.leaves] = np.arange(len(tree.leaves))
    group_of = np.searchsorted(tree.begin[cells], tree.starts, side="right") - 1
    on, cell = tree.around_cells(cells)[1]
    leaf = numbers[cell]
    on, leaf = on[group_of[leaf] != on], leaf[group_of[leaf] != on]
    leaf, to = np.repeat(leaf, parts[on]), _ranges(first[on], first[on] + parts[on])
    order = leaf.argsort(kind="stable")
    upto = np.searchsorted(leaf[order], np.arange(len(tree.leaves) + 1))
    blocks = tree.blocks(min(BLOCK, most))
    bounds = np.r_[np.searchsorted(tree.starts, tree.begin[blocks]), len(tree.leaves)]
    return Deal(tree, cells, first, parts, group_of, upto, to[order], blocks, bounds)


def repulsion(nodes: DataFrame, tree: Tree) -> DataFrame:
    """Add ``rx``, ``ry``, the repulsion by all other nodes."""
    spark = nodes.sparkSession
    deal = _deal(tree)
    sent = spark.sparkContext.broadcast(deal)
    columns = nodes.columns

    # rows go to their groups in pieces, a column's values as one array
    def pieces(to, own, values):
        order = to.argsort(kind="stable")
        to = to[order]
        first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]][: len(to)])
        ends = pa.array(np.r_[first, len(to)], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, v.take(pa.array(order))) if v is not None else pa.nulls(len(first), pa.list_(k)) for v, k in values]
        return pa.RecordBatch.from_arrays([pa.array(to[first]), pa.array(np.full(len(first), own)), *lists], names=["group", "own", "leaf", *columns])

    def dealt(batches):
        d = sent.value
        for b in batches:
            leaf = d.tree.leaf_of(_place(b, d.tree.box))
            group = d.group_of[leaf]
            low, high = d.upto[leaf], d.upto[leaf + 1]
            yield pieces(d.first[group] + b.column("salt").to_numpy() % d.parts[group], True, [(pa.array(leaf), pa.int64()), *((b.column(c), b.column(c).type) for c in columns)])
            rows = np.repeat(np.arange(len(leaf)), high - low)
            yield pieces(d.to[_ranges(low, high)], False, [(pa.array(leaf[rows]), pa.int64()), *((b.column(c).take(pa.array(rows)) if c in ("mass", "x", "y") else None, b.column(c).type) for c in columns)])

    def forces(key, rows):
        d = sent.value
        t = d.tree
        flat = lambda t, c: pc.list_flatten(t.column(c)).combine_chunks()
        here, other = rows.filter(rows.column("own")), rows.filter(pc.invert(rows.column("own")))
        own = flat(here, "leaf").to_numpy().argsort(kind="stable")
        here = pa.Table.from_arrays([flat(here, c).take(pa.array(own)) for c in ("leaf", *columns)], names=["leaf", *columns])
        mine = [here.column(c).to_numpy() for c in ("x", "y", "mass", "leaf")]
        both = [np.r_[v, flat(other, c).to_numpy()] for v, c in zip(mine, ("x", "y", "mass", "leaf"), strict=True)]
        order = both[3].argsort(kind="stable")
        x, y, weight, by_leaf = (v[order] for v in both)
        by, at, mass, leaf = np.stack([x, y], axis=1), np.stack(mine[:2], axis=1), mine[2], mine[3]
        push = np.zeros_like(at)
        cell = d.cells[d.group(key[0].as_py())]
        low, high = np.searchsorted(t.begin[d.blocks], [t.begin[cell], t.begin[cell] + (1 << (2 * (DEPTH - int(t.level[cell]))))])
        blocks, bounds = d.blocks[low:high], d.bounds[low : high + 1]
        (far_on, far), (near_on, near) = t.around_cells(blocks)
        numbers = np.searchsorted(t.starts, t.begin[near])
        low, high = np.searchsorted(by_leaf, numbers, "left"), np.searchsorted(by_leaf, numbers, "right")
        upto = np.arange(len(blocks) + 1)
        ends, far_ends, near_ends = np.searchsorted(leaf, bounds), np.searchsorted(far_on, upto), np.searchsorted(near_on, upto)
        for k in range(len(blocks)):
            mine, cells, some = slice(ends[k], ends[k + 1]), far[far_ends[k] : far_ends[k + 1]], slice(near_ends[k], near_ends[k + 1])
            singly = _ranges(low[some], high[some])
            push[mine] = _pushes(at[mine], mass[mine], np.concatenate([t.centre[cells], by[singly]]), np.concatenate([t.mass[cells], weight[singly]]))
        return pa.Table.from_arrays([*(here.column(c) for c in columns), pa.array(push[:, 0].copy()), pa.array(push[:, 1].copy())], names=[*columns, "rx", "ry"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields)
    salted = nodes.withColumn("salt", F.shiftrightunsigned(F.xxhash64(*columns), 1))
    lists = ", ".join(f"`{f.name}` array<{f.dataType.simpleString()}>" for f in nodes.schema.fields)
    rows = salted.mapInArrow(dealt, f"group bigint, own boolean, leaf array<bigint>, {lists}")
    # few bytes and much work: a given number of tasks, as Spark would join them by their bytes
    tasks = min(int(deal.parts.sum()), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    return rows.repartition(tasks, "group").groupBy("group").applyInArrow(forces, f"{kinds}, rx double, ry double")
