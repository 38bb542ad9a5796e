import random

import numpy as np
import pytest

from contactloom.operators import quadtree as qt


def points(n, clusters=True):
    rnd = random.Random(n)
    middle = [(rnd.gauss(0, 400), rnd.gauss(0, 400), 10 ** rnd.uniform(-1, 2)) for _ in range(6)]
    out = []
    for k in range(n):
        x, y, s = rnd.choice(middle) if clusters else (0, 0, 300)
        out.append((k, float(rnd.randrange(1, 9)), rnd.gauss(x, s), rnd.gauss(y, s)))
    return out


def all_pairs(rows):
    a = np.array([r[1:] for r in rows])
    d = a[:, None, 1:] - a[None, :, 1:]
    push = qt.REPULSION * a[:, None, 0] * a[None, :, 0] / ((d * d).sum(axis=2) + qt.SOFT)
    return (push[:, :, None] * d).sum(axis=1)


def computed(spark, rows):
    nodes = spark.createDataFrame(rows, "node_id bigint, mass double, x double, y double").repartition(3)
    got = sorted(tuple(r) for r in qt.repulsion(nodes, qt.quadtree(nodes)).collect())
    assert [r[:4] for r in got] == sorted(rows)
    return np.array([r[4:] for r in got])


@pytest.mark.parametrize("clusters", [True, False])
def test_mean_error_is_small(spark, clusters):
    """The tree against all pairs on 2,000 nodes in clusters of very different sizes, and in one."""
    rows = points(2000, clusters)
    want, got = all_pairs(rows), computed(spark, rows)
    assert np.linalg.norm(got - want, axis=1).mean() < 0.02 * np.linalg.norm(want, axis=1).mean()


def test_few_and_equal_places(spark, monkeypatch):
    assert qt.quadtree(spark.createDataFrame([], "node_id bigint, mass double, x double, y double")) is None
    assert (computed(spark, [(1, 2.0, 3.0, 3.0)]) == 0).all()
    # nodes at one place act as one on each other, and on others as many
    rows = [(k, 1.0, 5.0, 5.0) for k in range(100)] + [(100, 1.0, 25.0, 5.0)]
    got = computed(spark, rows)
    assert np.allclose(got, all_pairs(rows), rtol=0.02, atol=1e-6)


def test_larger_leaves_are_as_near(spark, monkeypatch):
    monkeypatch.setattr(qt, "LEAVES", 8)
    rows = points(600)
    want = all_pairs(rows)
    assert np.linalg.norm(computed(spark, rows) - want, axis=1).mean() < 0.02 * np.linalg.norm(want, axis=1).mean()


def test_leaves_together_are_surrounded_as_each_alone(spark):
    """Many leaves are opened at once, and find what a walk from the root finds for each."""
    tree = qt.quadtree(spark.createDataFrame(points(1500), "node_id bigint, mass double, x double, y double"))
    (far_on, far), (near_on, near) = tree.around_all(np.arange(len(tree.leaves)))
    for k, own in enumerate(tree.leaves):
        low = tree.corner[own]
        high = low + tree.side(own)
        want_far, want_near, held = set(), set(), [0]
        while held:
            c = held.pop()
            gap = np.maximum(np.maximum(low - tree.centre[c], tree.centre[c] - high), 0.0)
            below = [b for b in tree.children[c] if b >= 0]
            if tree.side(c) < qt.OPENING * np.hypot(*gap) or (not below and not tree.single[c]):
                want_far.add(c)
            elif not below:
                want_near.add(c)
            held += below if c not in want_far else []
        assert set(far[far_on == k]) == want_far and set(near[near_on == k]) == want_near


@pytest.mark.parametrize("at_once", [1 << 16, 64])
def test_cells_summed_in_steps_are_the_tree(spark, monkeypatch, at_once):
    """Cells that are summed a few levels at a time are those of ``tree_cells``, over nodes as dense as the last level."""
    monkeypatch.setattr(qt, "CELLS", at_once)
    rows = [*points(1500), *[(2000 + k, 2.0, 7.0 + k * 1e-9, 7.0) for k in range(40)], (3000, 1.0, 5e4, -5e4)]
    nodes = spark.createDataFrame(rows, "node_id bigint, mass double, x double, y double").repartition(3)
    tree = qt.quadtree(nodes)
    want = qt.tree_cells(qt.places(nodes, qt.square(nodes)[0]), qt.LEAF).orderBy("level", "cx", "cy").toPandas()
    place = qt._interleaved(want["cx"].to_numpy(), want["cy"].to_numpy())
    order = np.lexsort((place, want["level"]))
    assert tree.level.max() == qt.DEPTH and tree.level.tolist() == want["level"].to_numpy()[order].tolist()
    assert (tree.begin >> 2 * (qt.DEPTH - tree.level)).tolist() == place[order].tolist() and tree.count.tolist() == want["n"].to_numpy()[order].tolist()
    for got, c in ((tree.mass, "mass"), (tree.centre[:, 0] * tree.mass, "mx"), (tree.centre[:, 1] * tree.mass, "my")):
        assert np.allclose(got, want[c].to_numpy()[order], rtol=1e-9, atol=1e-6)


def shuffled_rows(spark):
    sc = spark.sparkContext
    jvm = sc._jvm
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = sc._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, sc._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return {stages.apply(k).stageId(): stages.apply(k).shuffleWriteRecords() for k in range(stages.size())}


def test_a_round_shuffles_few_rows_a_node(spark):
    """Neither a row for each level above a node, nor its columns again and again."""
    nodes = spark.createDataFrame(points(4000), "node_id bigint, mass double, x double, y double").repartition(3).localCheckpoint()
    earlier = shuffled_rows(spark)
    assert qt.repulsion(nodes, qt.quadtree(nodes)).count() == 4000
    assert sum(n for k, n in shuffled_rows(spark).items() if k not in earlier) < 3 * 4000


def test_nodes_at_one_place_are_dealt_to_several_groups(spark, monkeypatch):
    monkeypatch.setattr(qt, "GROUP", 64)
    rows = [*[(k, 1.0, 5.0, 5.0) for k in range(900)], *[(900 + k, 2.0, 5.0 + 0.001 * k, 9.0) for k in range(200)]]
    nodes = spark.createDataFrame(rows, "node_id bigint, mass double, x double, y double").repartition(3)
    tree = qt.quadtree(nodes)
    sizes = [n for n, in nodes.sparkSession.createDataFrame(qt.repulsion(nodes, tree).rdd.mapPartitions(lambda part: [(sum(1 for _ in part),)]), "n int").collect()]
    assert sum(sizes) == 1100 and max(sizes) < 700
    want = all_pairs(rows)
    assert np.linalg.norm(computed(spark, rows) - want, axis=1).mean() < 0.02 * np.linalg.norm(want, axis=1).mean()
