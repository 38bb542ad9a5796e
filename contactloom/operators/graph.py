"""Weighted contig graph, grouping, and layout."""

from __future__ import annotations

import logging
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.operators.quadtree import around_nodes, quadtree, repulsion
from contactloom.session import stage

log = logging.getLogger(__name__)

#: Strength of the pull to the middle.
GRAVITY = 0.5


def weight_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Contacts over the mean number of sites of both ends."""
    n = nodes.select("node_id", "site_count")
    a, b = n.select(F.col("node_id").alias("src"), F.col("site_count").alias("a")), n.select(F.col("node_id").alias("dst"), F.col("site_count").alias("b"))
    return edges.join(a, "src").join(b, "dst").select("src", "dst", (F.col("contacts") / ((F.col("a") + F.col("b")) / 2.0)).alias("weight"))


def assign_nearest(coords: DataFrame, centers: DataFrame) -> DataFrame:
    """The nearest centre of every node, the least id on ties.

    Centres are as many as groups; they travel as one array column.
    """
    listed = centers.agg(F.sort_array(F.collect_list(F.struct("group_id", "x", "y"))).alias("c"))
    near = F.array_min(F.transform("c", lambda c: F.struct(((F.col("x") - c["x"]) * (F.col("x") - c["x"]) + (F.col("y") - c["y"]) * (F.col("y") - c["y"])).alias("d2"), c["group_id"].alias("group_id"))))
    return coords.join(F.broadcast(listed)).select(near["group_id"].cast("int").alias("group_id"), "node_id")


#: Units of a coordinate in the sums of k-means, and candidates for first centres per group.
UNITS, CANDIDATES = 1_000_000, 64


def _first_centers(points: DataFrame, k: int, seed: int) -> list[tuple[int, int]]:
    """Of the candidates of least hash the first, then always the one farthest from those chosen."""
    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("node_id").cast("string")).cast("binary"))
    rows = points.orderBy(drawn, "node_id").limit(CANDIDATES * k).collect()
    chosen: list[tuple[int, int]] = []
    least = [math.inf] * len(rows)
    while rows and len(chosen) < k:
        at = 0 if not chosen else min(range(len(rows)), key=lambda i: (-least[i], rows[i]["node_id"]))
        if chosen and least[at] == 0:
            break
        cx, cy = rows[at]["x"], rows[at]["y"]
        chosen.append((cx, cy))
        least = [min(d, float(r["x"] - cx) ** 2 + float(r["y"] - cy) ** 2) for d, r in zip(least, rows, strict=True)]
    return chosen


def kmeans_groups(coords: DataFrame, k: int, seed: int = 806, max_iter: int = 100) -> tuple[DataFrame, DataFrame]:
    """Group members (group_id, node_id) and centres (group_id, x, y).

    Lloyd's rounds until no centre moves.  Coordinates are whole millionths,
    so that sums do not depend on the order of rows and every run gives the
    same groups.  Centres start from a bounded sample of nodes that a hash
    draws, each the farthest from those before it; they are fewer than ``k``
    where nodes lie at fewer places.  Only the centres, k rows, reach the driver
    and all tasks.
    """
    spark = coords.sparkSession
    unit = lambda c: F.floor(F.col(c) * UNITS).cast("bigint").alias(c)
    points = stage(coords.select("node_id", unit("x"), unit("y")), "points")
    centers = _first_centers(points, k, seed)
    nearest = None
    for _ in range(max_iter if centers else 0):
        far = lambda c, at: (F.col(c) - F.lit(at)).cast("double") * (F.col(c) - F.lit(at)).cast("double")
        nearest = F.array_min(F.array(*[F.struct((far("x", cx) + far("y", cy)).alias("d2"), F.lit(g).alias("g")) for g, (cx, cy) in enumerate(centers)]))["g"]
        whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
        sums = points.groupBy(nearest.alias("g")).agg(whole("x"), whole("y"), F.count(F.lit(1)).alias("n")).collect()
        moved = dict(enumerate(centers)) | {r["g"]: (int(r["x"]) // r["n"], int(r["y"]) // r["n"]) for r in sums}
        if list(moved.values()) == centers:
            break
        centers = list(moved.values())
    found = spark.createDataFrame([(g, cx / UNITS, cy / UNITS) for g, (cx, cy) in enumerate(centers)], "group_id int, x double, y double")
    return points.select((F.lit(None) if nearest is None else nearest).cast("int").alias("group_id"), "node_id"), found


def group_contents(members: DataFrame, nodes: DataFrame) -> DataFrame:
    return members.join(nodes.select("node_id", "name", "site_count", "length"), "node_id").select("group_id", "node_id", "name", "site_count", "length")


def group_sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("group_id").agg(F.count(F.lit(1)).alias("n_contigs"))


def _start(node, seed: int):
    unit = lambda k: (F.pmod(F.xxhash64(node, F.lit(seed), F.lit(k)), F.lit(1 << 20)) / float(1 << 20) - 0.5) * 1000.0
    return unit(1), unit(2)


def force_layout(nodes: DataFrame, weighted_edges: DataFrame, seed: int = 806, change_per_node: float = 2.0, max_iter: int = 1000, start: DataFrame | None = None) -> DataFrame:
    """A force-directed layout in the plane: node_id, x, y.

    Edges attract by weight times distance, nodes repel by the product of their
    masses (degree plus one) over the distance, and gravity draws each to the
    middle by its mass times the distance.  The repulsion comes from a tree of
    cells (``quadtree``).  The speed follows the published rule: the graph's is
    the ratio of traction (forces that go on) to swing (forces that turn),
    growing by half a round at most, and a node that swings is slower.  The
    layout ends when a node moves less than ``change_per_node`` on average.
    The log says after how many rounds, and warns where ``max_iter`` ended it
    before.  The forces of every round are written to the shared folder, so its
    lineage is one file scan.  ``start`` (node_id, x, y) are places to go on
    from; nodes without one begin where a hash puts them.
    """
    links = weighted_edges.where("src <> dst")
    ends = links.select(F.explode(F.array(F.struct(F.col("src").alias("a"), F.col("dst").alias("b"), "weight"), F.struct(F.col("dst").alias("a"), F.col("src").alias("b"), "weight"))).alias("e")).select("e.a", "e.b", "e.weight")
    ends = stage(ends, "ends")
    degree = ends.groupBy(F.col("a").alias("node_id")).agg(F.count(F.lit(1)).alias("degree"))
    x, y = _start(F.col("node_id"), seed)
    state = nodes.select("node_id").distinct().join(degree, "node_id", "left").withColumns({"x": x, "y": y})
    if start is not None:
        earlier = start.select("node_id", F.col("x").alias("x0"), F.col("y").alias("y0"))
        state = state.join(earlier, "node_id", "left").withColumns({"x": F.coalesce("x0", "x"), "y": F.coalesce("y0", "y")})
    state = stage(state.select("node_id", (F.coalesce("degree", F.lit(0)) + 1).cast("double").alias("mass"), "x", "y", F.lit(0.0).alias("fx"), F.lit(0.0).alias("fy")), "layout")
    speed, moved, found = 1.0, None, None
    for k in range(max_iter):
        tree = quadtree(state, found)
        if tree is None:
            return state.select("node_id", "x", "y")
        other = state.select(F.col("node_id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"))
        pull = ends.join(other, "b").groupBy(F.col("a").alias("node_id")).agg(F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("bx")).alias("wx"), F.sum(F.col("weight") * F.col("by")).alias("wy"))
        # written, so that Spark knows its size: where few nodes have edges, the nodes are not sorted to meet it
        pulled = state.join(stage(pull, "pull"), "node_id", "left")
        force = lambda c: F.coalesce(F.col(f"w{c}") - F.col("w") * F.col(c), F.lit(0.0)) - F.lit(GRAVITY) * F.col("mass") * F.col(c)
        pushed = repulsion(pulled.select("node_id", "mass", "x", "y", F.col("fx").alias("gx"), F.col("fy").alias("gy"), force("x").alias("ax"), force("y").alias("ay")), tree)
        new = stage(pushed.select("node_id", "mass", "x", "y", (F.col("ax") + F.col("rx")).alias("fx"), (F.col("ay") + F.col("ry")).alias("fy"), "gx", "gy"), "layout")
        swing, traction = F.hypot(F.col("fx") - F.col("gx"), F.col("fy") - F.col("gy")), F.hypot(F.col("fx") + F.col("gx"), F.col("fy") + F.col("gy")) / 2
        total = new.agg(F.sum(F.col("mass") * swing), F.sum(F.col("mass") * traction)).first()
        speed = min(total[1] / max(total[0], 1e-9), 1.5 * speed if k else 1.0)
        # taken from an array by a column: a number alone would be compiled into the plans, anew in every round
        now = F.element_at(F.array(F.lit(float(speed)), F.lit(0.0)), F.when(F.col("mass") > 0, 1).otherwise(2))
        step = now / (1 + F.sqrt(now * swing))
        state = new.select("node_id", "mass", (F.col("x") + F.col("fx") * step).alias("x"), (F.col("y") + F.col("fy") * step).alias("y"), "fx", "fy", (F.hypot("fx", "fy") * step).alias("moved"))
        # one look at the new places tells how far they are, and the square that the next tree is in
        moved, *found = state.agg(F.avg("moved"), *around_nodes()).first()
        state = state.drop("moved")
        # the first round only has forces, none to compare them with
        if k and moved < change_per_node:
            log.info("layout converged: %d rounds, mean displacement %.3f", k + 1, moved)
            break
    else:
        log.warning("layout not converged: %d rounds, mean displacement %s", max_iter, moved)
    return state.select("node_id", "x", "y")
