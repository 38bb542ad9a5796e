import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from contactloom.llm.merkle import leaf_of, manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    i, source, lang, n, text = row
    return H(*map(part, (i, source, lang, None if n is None else n + more, text)))


def tree(nodes):
    """The root, and for every node its siblings level by level with its own place in the run."""
    paths, under = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        above, members = [], []
        for i in range(0, len(nodes), 2):
            run = nodes[i : i + 2]
            for j in range(len(run)):
                for m in under[i + j]:
                    paths[m].append((run[:j], run[j + 1 :]))
            above.append(H(*run))
            members.append(sum(under[i : i + 2], []))
        nodes, under = above, members
    return nodes[0], paths


def model(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = [sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in langs]
    below = [tree([leaf(r) for r in g]) for g in groups]
    root, upper = tree([b[0] for b in below])
    out = []
    for g, (subroot, paths), up in zip(groups, below, upper, strict=True):
        for r, path in zip(g, paths, strict=True):
            acc = leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0)
            for left, right in path + up:
                acc = H(*left, acc, *right)
            out.append((r[0], leaf(r), subroot, root, H(*(s for left, right in path + up for s in left + right)), acc, acc == root))
    return sorted(out, key=str)


def run(df, **more):
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars").cast("decimal(20,0)") + 1, F.col("text")))
    return sorted((tuple(r) for r in manifest(df, changed, **more).select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("sizes", [(1,), (2,), (1, 1), (3, 1, 2), (5, 8, 7, 1, 600), (257, 1, 256, 513), (1025,)])
def test_equal_to_the_model(spark, sizes):
    rows = [(1000 * g + k, f"src{k % 3}", None if g == 1 else f"l{9 - g}", None if k % 11 == 3 else k, f"text {k} é") for g, n in enumerate(sizes) for k in range(n)]
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(4)) == model(rows)


def test_edge_cases(spark, edge_pairs):
    rows = [(i, None, "en" if (i or 0) % 2 else None if i else "é", len(t) if t else None, t) for i, t in edge_pairs] + [(2**63 - 1, "s", "z", 2**63 - 1, "long id")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(2) for c in ("tree", "n", "idx", "level", "seg", "leaf", "found", "name", "named", "_at", "part", "root", "block", "a.b")})
    assert run(df) == model(rows)


def test_empty_table(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []


def test_small_blocks_give_the_same(spark):
    """Many blocks and passes, and ancestors that many blocks share."""
    rows = [(k, "s", "en" if k < 300 else "de", k, f"t{k}") for k in range(345)]
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(4), levels=2) == model(rows)


def test_only_what_was_changed_fails(spark):
    rows = [(k, "s", "en", k, f"t{k}") for k in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = F.when(F.col("doc_id") == 17, leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.lit("other")))
    out = manifest(df, found)
    assert [r["doc_id"] for r in out.where("not verified").collect()] == [17]
    assert manifest(df).where("not verified").count() == 0
    assert out.select("root").distinct().count() == 1
