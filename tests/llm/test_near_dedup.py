import random
import re

import numpy as np
import pytest

from contactloom.llm import near_dedup as nd
from contactloom.llm.components import connected_components


def shingles(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if x]
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def model(pairs):
    ids = [i for i, _ in pairs]
    sets = dict((i, shingles(t)) for i, t in pairs)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def families(rnd, groups, size, words=120):
    out = []
    for _ in range(groups):
        base = [f"w{rnd.randrange(3000)}" for _ in range(words)]
        for _ in range(size):
            w = list(base)
            for _ in range(rnd.randrange(0, 8)):
                w[rnd.randrange(len(w))] = f"w{rnd.randrange(3000)}"
            out.append(" ".join(w).upper() if rnd.random() < 0.2 else " ".join(w))
    return out


@pytest.mark.parametrize("block", [500, 7])
def test_components_against_all_pairs(documents, monkeypatch, block):
    """Small blocks make every large bucket a comparison of blocks."""
    monkeypatch.setattr(nd, "BLOCK", block)
    rnd = random.Random(16)
    texts = families(rnd, 6, 25) + families(rnd, 30, 2) + [" ".join(f"x{rnd.randrange(9)}" for _ in range(rnd.randrange(1, 7))) for _ in range(60)]
    pairs = [(1000 - k, t) for k, t in enumerate(texts)] + [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "É a b c d"), (7, "é a b c d")]
    got = sorted(tuple(r) for r in nd.near_duplicates(documents(pairs, clash=True)).collect())
    assert got == model(pairs)


def test_edges(documents, edge_pairs):
    rows = nd.near_duplicates(documents(edge_pairs)).collect()
    assert len(rows) == len(edge_pairs)
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[4]["component_id"] == 3 and not by[4]["kept"] and by[5]["kept"] and by[1]["n_shingles"] == 0 and by[1]["component_id"] == 1
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert nd.near_duplicates(documents([])).count() == 0


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(1)
    common = rng.integers(0, 2**63, 600, np.int64).astype(np.uint64)
    errors = []
    for share in (0.2, 0.5, 0.75, 0.9):
        n = int(600 * share)
        extra = (600 - n) // 2
        a, b = (np.unique(np.r_[common[:n], rng.integers(0, 2**63, extra, np.int64).astype(np.uint64)]) for _ in range(2))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append(abs((nd.signature(a) == nd.signature(b)).mean() - true))
    assert max(errors) < 0.15


def test_connected_components(spark):
    rnd = random.Random(17)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)] + [(None, 5), (7, None)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in list(root)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
