import logging
import random

from contactloom import catalog
from contactloom.operators import graph


def test_weights_groups_and_contents(spark, rows):
    nodes = spark.createDataFrame([(0, "a", 2, 10), (1, "b", 4, 20), (2, "c", 1, 5)], "node_id bigint, name string, site_count bigint, length bigint")
    edges = spark.createDataFrame([(0, 1, 6), (1, 1, 4)], "src bigint, dst bigint, contacts bigint")
    assert rows(graph.weight_edges(edges, nodes)) == [(0, 1, 2.0), (1, 1, 1.0)]
    coords = spark.createDataFrame([(0, 0.0, 0.0), (1, 1.0, 0.0), (2, 9.0, 9.0)], "node_id bigint, x double, y double")
    centers = spark.createDataFrame([(3, 2.0, 0.0), (1, 0.0, 0.0), (2, 9.0, 8.0)], "group_id int, x double, y double")
    members = graph.assign_nearest(coords, centers)
    assert rows(members) == [(1, 0), (1, 1), (2, 2)]  # a tie goes to the least id
    assert rows(graph.group_sizes(members)) == [(1, 2), (2, 1)]
    assert rows(graph.group_contents(members, nodes), "group_id", "name", "site_count", "length") == [(1, "a", 2, 10), (1, "b", 4, 20), (2, "c", 1, 5)]


def test_layout_repeats_and_pulls_neighbours_together(spark, rows):
    rnd = random.Random(1)
    links = [(a, b, 5.0) for g in (0, 10) for a in range(g, g + 10) for b in range(a + 1, g + 10) if rnd.random() < 0.8]
    nodes = spark.createDataFrame([(k,) for k in range(21)], "node_id bigint")
    edges = spark.createDataFrame(links, "src bigint, dst bigint, weight double")
    one = rows(graph.force_layout(nodes, edges, max_iter=6))
    two = rows(graph.force_layout(nodes, edges, max_iter=6))
    assert len(one) == 21 and all(abs(a - b) < 1e-6 for r, s in zip(one, two, strict=True) for a, b in zip(r, s, strict=True))
    at = {n: (x, y) for n, x, y in rows(graph.force_layout(nodes, edges))}
    dist = lambda a, b: ((at[a][0] - at[b][0]) ** 2 + (at[a][1] - at[b][1]) ** 2) ** 0.5
    mean = lambda p: sum(dist(a, b) for a, b in p) / len(p)
    assert 4 * mean([(a, b) for a in range(10) for b in range(a)]) < mean([(a, b) for a in range(10) for b in range(10, 20)])


def test_kmeans_covers_all_nodes(spark, rows):
    coords = spark.createDataFrame([(k, float(k // 10) * 100, float(k % 10)) for k in range(30)], "node_id bigint, x double, y double")
    members, centers = graph.kmeans_groups(coords, 3)
    got = rows(members)
    assert [n for _, n in sorted(got, key=lambda r: r[1])] == list(range(30)) and centers.count() == 3
    assert len({(g, n // 10) for g, n in got}) == 3


def test_kmeans_against_plain_rounds(spark):
    """Groups are nearest centres and centres are means: one more plain round changes nothing."""
    rnd = random.Random(6)
    points = {k: (rnd.gauss(100 * (k % 4), 8), rnd.gauss(70 * (k % 3), 8)) for k in range(600)}
    coords = spark.createDataFrame([(k, *p) for k, p in points.items()], "node_id bigint, x double, y double")
    members, centers = graph.kmeans_groups(coords, 12)
    at = {r["group_id"]: (r["x"], r["y"]) for r in centers.collect()}
    group = {r["node_id"]: r["group_id"] for r in members.collect()}
    d2 = lambda p, c: (p[0] - c[0]) ** 2 + (p[1] - c[1]) ** 2
    assert all(d2(points[k], at[g]) <= min(d2(points[k], c) for c in at.values()) + 1e-6 for k, g in group.items())
    for g, c in at.items():
        own = [points[k] for k, h in group.items() if h == g]
        assert all(abs(sum(p[j] for p in own) / len(own) - c[j]) < 0.5 for j in (0, 1))


def test_layout_query_runs_to_its_stop_rule(spark, rows, monkeypatch, caplog):
    rnd = random.Random(1)
    links = [(a, b, 5.0) for g in (0, 10) for a in range(g, g + 10) for b in range(a + 1, g + 10) if rnd.random() < 0.8]
    nodes = spark.createDataFrame([(k,) for k in range(20)], "node_id bigint").coalesce(1)
    edges = spark.createDataFrame(links, "src bigint, dst bigint, weight double").coalesce(1)
    monkeypatch.setattr(catalog, "_graph", lambda *_: (nodes, edges))
    with caplog.at_level(logging.INFO, graph.__name__):
        at = {n: (x, y) for n, x, y in rows(catalog.force_layout(spark, ""))}
        assert "layout converged" in caplog.text
        graph.force_layout(nodes, edges, max_iter=1)
        assert "layout not converged: 1 rounds" in caplog.text
    dist = lambda a, b: ((at[a][0] - at[b][0]) ** 2 + (at[a][1] - at[b][1]) ** 2) ** 0.5
    mean = lambda p: sum(dist(a, b) for a, b in p) / len(p)
    inside, between = mean([(a, b) for a in range(10) for b in range(a)]), mean([(a, b) for a in range(10) for b in range(10, 20)])
    assert 4 * inside < between


def test_layout_goes_on_from_a_table(spark, rows):
    nodes = spark.createDataFrame([(k,) for k in range(6)], "node_id bigint")
    edges = spark.createDataFrame([(0, 1, 1.0), (2, 3, 2.0)], "src bigint, dst bigint, weight double")
    start = spark.createDataFrame([(k, float(k), -2.5 * k) for k in range(4)] + [(99, 0.0, 0.0)], "node_id bigint, x double, y double")
    fresh, placed = rows(graph.force_layout(nodes, edges, max_iter=0)), rows(graph.force_layout(nodes, edges, max_iter=0, start=start))
    assert placed == rows(start)[:4] + fresh[4:]


def test_kmeans_does_not_depend_on_the_order_of_rows(spark, rows):
    rnd = random.Random(8)
    points = [(k, rnd.gauss(0, 50), rnd.gauss(0, 50)) for k in range(500)] + [(500 + k, 1e7, -3e7) for k in range(3)]
    found = []
    for parts in (1, 7):
        rnd.shuffle(points)
        members, centers = graph.kmeans_groups(spark.createDataFrame(points, "node_id bigint, x double, y double").repartition(parts), 7)
        found.append((rows(members, "node_id", "group_id"), rows(centers)))
    assert found[0] == found[1]
    few = spark.createDataFrame([(1, 2.0, 2.0), (2, 2.0, 2.0)], "node_id bigint, x double, y double")
    assert rows(graph.kmeans_groups(few, 3)[0], "node_id", "group_id") == [(1, 0), (2, 0)]
    assert rows(graph.kmeans_groups(few.limit(0), 3)[0]) == []


def test_graph_is_made_without_sorting_the_alignments(spark, rows, monkeypatch):
    """Contacts are counts, so no row needs a number; the weights are those of the counted edges."""
    d = "/root/testdata/sf0.001"
    counted = rows(graph.weight_edges(catalog.edge_counts(spark, d), catalog._nodes(spark, d)))
    monkeypatch.setattr(catalog.pairs, "coordinate_sort", lambda *_: 1 / 0)
    nodes, edges = catalog._graph(spark, d)
    assert rows(edges) == counted and len(counted) > 0 and nodes.count() == len(rows(catalog._nodes(spark, d)))
