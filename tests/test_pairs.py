import random

from contactloom.operators import pairs

ALN = "aln_id bigint, read_name string, flag int, ref_id int, pos bigint, mapq int, next_ref_id int, next_pos bigint, node_id bigint, next_node_id bigint"


def model(rows):
    """Pair mates one after another."""
    pending, out = {}, []
    for a, name, _, ref, pos, _, nref, npos, node, _ in sorted(rows):
        if name not in pending:
            pending[name] = (a, ref, pos, nref, npos, node, False)
            continue
        b, r, p, nr, np_, n, used = pending[name]
        if not used and r == nref and nr == ref and p == npos and np_ == pos:
            out.append((name, b, a, n, node))
            pending[name] = (b, r, p, nr, np_, n, True)
    return sorted(out)


def test_first_row_wins(spark, rows):
    rnd = random.Random(5)
    data = []
    for k in range(600):
        a, p, b, q = rnd.randrange(3), rnd.randrange(3), rnd.randrange(3), rnd.randrange(3)
        data.append((k, f"r{rnd.randrange(80)}", 0, a, p, 50, b, q, a, b))
    # a mate that is missing, a pair at one place, a wrong first row
    data += [(900, "x", 0, 0, 1, 50, 1, 2, 0, 1), (901, "y", 0, 1, 5, 50, 1, 5, 1, 1), (902, "y", 0, 1, 5, 50, 1, 5, 1, 1), (903, "y", 0, 1, 5, 50, 1, 5, 1, 1)]
    data += [(904, "z", 0, 0, 9, 50, 0, 9, 0, 0), (905, "z", 0, 0, 1, 50, 1, 2, 0, 1), (906, "z", 0, 1, 2, 50, 0, 1, 1, 0)]
    df = spark.createDataFrame(data, ALN)
    found = pairs.pair_mates(df)
    assert rows(found) == model(data)
    edges = rows(pairs.count_edges(found))
    assert all(s <= d for s, d, _ in edges) and sum(n for *_, n in edges) == len(model(data))
    reduced = pairs.reduced_alignments(df, found)
    assert reduced.count() == 2 * len(model(data))
    summary = pairs.filter_summary(df, reduced, spark.range(4))
    assert rows(summary) == [(len(data), 2 * len(model(data)), 4)]


def test_filters_and_ends_of_windows(spark, rows):
    aln = spark.createDataFrame([(0, "a", 0, 0, 10, 40, 1, 5), (1, "b", 256, 0, 20, 39, -1, -1), (2, "c", 272, 1, 21, 60, 0, 3), (3, "d", 16, 0, 9, 41, 7, 1)], ALN.rsplit(", node_id", 1)[0])
    assert rows(pairs.filter_mapq(aln), "aln_id") == [(0,), (2,), (3,)]
    assert rows(pairs.drop_secondary(aln), "aln_id") == [(0,), (3,)]
    references = spark.createDataFrame([(0, "u"), (1, "v"), (7, "w")], "ref_id int, ref_name string")
    nodes = spark.createDataFrame([(4, "u"), (2, "v"), (9, "v")], "node_id bigint, name string")
    known = pairs.map_refs_to_nodes(references, nodes)
    assert rows(known, "ref_id", "node_id") == [(0, 4), (1, 2), (7, None)]
    kept = pairs.filter_known_refs(aln, known)
    assert rows(kept, "aln_id", "node_id", "next_node_id") == [(0, 4, 2), (2, 2, 4)]
    windows = spark.createDataFrame([(4, 10, 20), (2, 990, 2100)], "node_id bigint, win_start bigint, win_end bigint")
    at = spark.createDataFrame([(4, p) for p in (9, 10, 20, 21)] + [(2, p) for p in (989, 990, 1500, 2100, 2101)], "node_id bigint, pos bigint")
    assert rows(pairs.filter_near_site(at, windows)) == [(2, 990), (2, 1500), (2, 2100), (4, 10), (4, 20)]


def test_coordinate_order(spark, rows):
    rnd = random.Random(2)
    data = [(f"r{k}", rnd.choice([0, 16]), r, -1 if r < 0 else rnd.randrange(200000), 0, 0, 0) for k in range(300) for r in [rnd.choice([-1, 0, 1, 2])]]
    df = spark.createDataFrame(data, "read_name string, flag int, ref_id int, pos bigint, mapq int, next_ref_id int, next_pos bigint")
    want = sorted(data, key=lambda x: (x[2] < 0, x[2], x[3], x[1] & 16, x[0]) if x[2] >= 0 else (True, x[2], x[3], x[0][:8] and x[1] & 16, x[0]))
    got = [tuple(r)[1:] for r in pairs.coordinate_sort(df).orderBy("aln_id").collect()]
    assert [g for g in got if g[2] >= 0] == [w for w in want if w[2] >= 0]
    assert all(g[2] < 0 for g in got[len([w for w in want if w[2] >= 0]) :])


def test_windows_become_disjoint_spans(spark, rows):
    """Positions of random overlapping windows, and one row per tile with spans apart from each other."""
    import random

    from pyspark.sql import functions as F

    rnd = random.Random(2)
    windows = [(rnd.randrange(3), a, a + rnd.randrange(0, 2500)) for a in (rnd.randrange(20_000) for _ in range(60))]
    w = spark.createDataFrame(windows, "node_id bigint, win_start bigint, win_end bigint")
    tiles = pairs.covered_tiles(w)
    assert tiles.groupBy("w_node", "w_tile").count().where("count > 1").count() == 0
    for _, _, spans in rows(tiles):
        assert all(x["b"] + 1 < y["a"] for x, y in zip(spans, spans[1:], strict=False))
    places = spark.range(3).select(F.col("id").alias("node_id"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(23_000).cast("bigint"))).alias("pos"))
    want = {(n, p) for n, a, b in windows for p in range(a, b + 1)}
    assert set(rows(pairs.filter_near_site(places, w))) == want


def test_row_numbers_take_one_shuffle(spark):
    """What reads the sorted rows has no exchange of them, only the broadcast of one row per partition."""
    df = spark.range(1000).selectExpr("concat('r', id) as read_name", "0 as flag", "cast(id % 7 as int) - 1 as ref_id", "id % 50 as pos", "60 as mapq", "-1 as next_ref_id", "cast(-1 as bigint) as next_pos")
    out = pairs.coordinate_sort(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 1
    assert sorted(r[0] for r in out.select("aln_id").collect()) == list(range(1000))


def test_coordinate_order_of_odd_places(spark):
    """Nulls, negative and very large references and positions: the number that leads the sort never parts from the order."""
    from pyspark.sql import functions as F

    rnd = random.Random(4)
    refs, places = [None, -(2**31), -5, -1, 0, 1, 2**31 - 1], [None, -(2**40), -2, -1, 0, 1, 2**30 - 3, 2**30 - 2, 2**30 - 1, 2**30, 2**40]
    data = [(f"r{k}", rnd.choice([0, 16]), rnd.choice(refs), rnd.choice(places), 0, 0, 0) for k in range(600)]
    df = spark.createDataFrame(data, "read_name string, flag int, ref_id int, pos bigint, mapq int, next_ref_id int, next_pos bigint")
    unmapped = F.when(F.col("ref_id") < 0, 1).otherwise(0)
    want = [r[0] for r in df.orderBy(unmapped, "ref_id", "pos", F.col("flag").bitwiseAND(F.lit(16)), "read_name").select("read_name").collect()]
    assert [r["read_name"] for r in pairs.coordinate_sort(df).orderBy("aln_id").collect()] == want


def test_sort_carries_two_columns_more(spark, monkeypatch):
    """Columns that the order names are not shuffled twice."""
    from contactloom.operators import ordinals

    plans, stage = [], ordinals.stage
    monkeypatch.setattr(ordinals, "stage", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or stage(df, name))
    df = spark.createDataFrame([("a", 0, 0, 1, 9, 0, 2), ("b", 16, -1, 1, 9, 0, 2)], "read_name string, flag int, ref_id int, pos bigint, mapq int, next_ref_id int, next_pos bigint")
    assert pairs.coordinate_sort(df).count() == 2
    assert {k for k in range(9) if f"_o{k}#" in plans[0]} == {0, 3}


def test_only_nodes_with_alignments_get_windows(spark, rows):
    refs = spark.createDataFrame([(k, f"c{k}", k) for k in range(50)] + [(50, "none", None)], "ref_id int, ref_name string, node_id bigint")
    nodes = spark.range(50).selectExpr("id as node_id", "id as contig_ord")
    data = [(0, "a", 0, 3, 10, 60, 7, 20, 3, 7), (1, "b", 0, 3, 99, 60, 7, 20, 3, 7), (2, "c", 0, 50, 10, 60, 7, 20, 0, 7), (3, "d", 0, 7, 20, 60, 3, 10, 7, 3)]
    df = spark.createDataFrame(data, ALN).drop("node_id", "next_node_id")
    asked = []

    def windows(own):
        asked.extend(r["node_id"] for r in own.collect())
        return own.selectExpr("node_id", "cast(5 as bigint) as win_start", "cast(30 as bigint) as win_end")

    near = pairs.near_sites(df, refs, nodes, windows)
    assert sorted(asked) == [3, 7]
    assert rows(near, "aln_id", "node_id", "next_node_id") == [(0, 3, 7), (3, 7, 3)]
    # what follows reads these rows only, once for each step, with no join of the sorted ones left in its plan
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "near-" in plan and "Join" not in plan


def test_pairs_by_compared_rows_are_those_of_numbers(spark, rows):
    """Ties, rows that mirror themselves, nulls, and references that occur twice: the same contacts, and nothing is sorted."""
    from pyspark.sql import functions as F

    rnd = random.Random(8)
    data = [(f"r{rnd.randrange(120)}", rnd.choice([0, 16, 32]), a := rnd.randrange(3), rnd.choice([1, 5, 9]), 60, rnd.choice([a, 0, 1, 2]), rnd.choice([1, 5, 9, None])) for _ in range(900)]
    mirrored = [(n, flag ^ 16, r2, p2, q, r1, p1) for n, flag, r1, p1, q, r2, p2 in data[:300]]
    df = spark.createDataFrame(data + data[:200] + mirrored, "read_name string, flag int, ref_id int, pos bigint, mapq int, next_ref_id int, next_pos bigint").repartition(5)
    refs = spark.createDataFrame([(0, "a", 0), (1, "b", 1), (1, "b", 1), (2, "c", 2)], "ref_id int, ref_name string, node_id bigint")

    def contacts(keyed):
        pairs_ = pairs.pair_mates(pairs.filter_known_refs(keyed, refs))
        return rows(pairs.count_edges(pairs_), "src", "dst", "contacts"), pairs_.agg(F.count(F.lit(1))).first()[0]

    keyed = pairs.coordinate_keys(df)
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "rangepartitioning" not in plan
    want = contacts(pairs.coordinate_sort(df))
    assert want[1] > 20 and contacts(keyed) == want
