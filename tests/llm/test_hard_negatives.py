import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from contactloom.llm import hard_negatives
from contactloom.llm.hard_negatives import mine_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def model(rows, k=5, m=3):
    """Every pair scored; rows are told apart by place."""
    used = []
    for at, (i, v, label) in enumerate(rows):
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            used.append((at, i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v]))
    best = lambda s: sorted(s, key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[2]))
    out = []
    for at, i, label, v in used:
        if i is None or i % 50:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=False)), j, other, lab) for other, j, lab, w in used if other != at]
        for p in best([s for s in scored if s[3] == label])[:k]:
            near = best([s for s in scored if s[3] != label and 50 * p[0] <= 100 * s[0] <= 95 * p[0]])[:m]
            out += [(i, p[1], rank + 1, n[1], p[0], n[0]) for rank, n in enumerate(near)]
    return sorted(out, key=str)


def run(spark, rows, schema=SCHEMA, **more):
    out = mine_negatives(spark.createDataFrame(rows, schema).repartition(3), **more)
    return sorted((tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str)


def made(n, dim=8, seed=3, spread=0.3):
    r = random.Random(seed)
    middle = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(10)]
    return [(k * 5, [float(np.float32(middle[k % 10 if r.random() < 0.6 else r.randrange(10)][d] + r.gauss(0, spread))) for d in range(dim)], k % 10) for k in range(n)]


def test_equal_to_all_pairs(spark):
    rows = made(400)
    want = model(rows)
    assert len(want) > 100
    assert run(spark, rows) == want


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 7)
    monkeypatch.setattr(hard_negatives, "CELLS", 11)
    rows = made(120, spread=0.05)
    assert run(spark, rows) == model(rows)


def test_equal_vectors_and_labels(spark):
    """Ties of all rows: the least ids come first."""
    rows = [(k * 10, [0.5, 0.25], 1) for k in range(60)] + [(1000 + k, [0.35, 0.17], 2) for k in range(60)]
    assert run(spark, rows) == model(rows)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = made(60) + [
        (None, [1.0] * 8, 1), (None, [0.5] * 8, 2), (50, None, 1), (100, [1.0] * 8, None), (150, [nan] * 8, 1), (200, [inf] + [0.0] * 7, 1), (250, [1.0, None] + [0.0] * 6, 3),
        (300, [], 4), (350, [0.0] * 8, 5), (400, [-0.3] * 3, 6), (400, [-0.3] * 3, 6), (450, [30000.0] * 8, 7), (-50, [0.1] * 8, -3), (-100, [0.1] * 20, 2**31 - 1), (-350, [0.2] * 9, 2**31 - 1),
    ]
    df_extra = [r + (1, 2, "x") for r in rows]
    assert run(spark, df_extra, SCHEMA + ", row int, norm int, `a.b` string") == model(rows)


def test_empty_table_and_no_anchor(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [1.0], 1), (2, [0.5], 2)]) == []


def test_large_components_are_exact_or_an_error(spark):
    big = float(2**20)
    rows = [(0, [big, 1.0], 1), (1, [big, 0.5], 1), (2, [big * 0.75, 0.25], 2), (3, [big * 0.5, 1.0], 3)]
    assert run(spark, rows) == model(rows) != []
    with pytest.raises(Exception, match="beyond 64 bits"):
        run(spark, [(0, [1e30], 0), (1, [1e30], 1)])


def test_pairs_are_left_out():
    """The bounds hold for all pairs, and leave out a part of them where vectors lie in clusters."""
    rows = made(300, spread=0.02)
    v = np.array([np.floor(256 * np.array(r[1], np.float64)) for r in rows])
    refs = v[:12] / np.linalg.norm(v[:12], axis=1)[:, None]
    norm = np.linalg.norm(v, axis=1)
    b = hard_negatives.Block.__new__(hard_negatives.Block)
    b.row, b.norm, b.angles = np.arange(len(v)), norm, hard_negatives._angles(v, norm, refs)
    low, high = hard_negatives.bounds(b, slice(0, len(v)), b)
    exact = v @ v.T
    assert (low <= exact).all() and (exact <= high).all()
    fifth = np.sort(low, axis=1)[:, -6]
    assert (high >= fifth[:, None]).mean() < 0.7


def test_column_types(spark):
    out = mine_negatives(spark.createDataFrame([], SCHEMA))
    assert dict(out.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    assert mine_negatives(spark.createDataFrame(made(20), SCHEMA).withColumn("vec_id", F.col("vec_id").cast("int"))).count() >= 0
