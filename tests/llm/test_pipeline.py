import os

import duckdb
import pytest

import corpus_pipeline as cp
from contactloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for t in ("documents", "conversations", "labels", "embeddings"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    norm = lambda rows: sorted(tuple(sorted((k, str(v)) for k, v in r.items())) for r in rows)
    cur = duck.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    got = norm(r.asDict() for r in queries.queries()[name](spark, SF).collect())
    assert got == norm(dict(zip(columns, r, strict=True)) for r in cur.fetchall()) and got


def test_stages_follow_each_other(spark, duck):
    """Every stage against a plain version on what the one before it kept."""
    from test_near_dedup import model as near_model

    from contactloom.llm.pii import find_spans
    from contactloom.llm.pii_tagger import trained
    from contactloom.llm.tables import stage

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    steps = {}
    for name, f in cp.STAGES:
        docs = stage(f(spark, docs, SF), "step")
        steps[name] = {r["doc_id"]: r for r in docs.collect()} if name != "packing" else docs.collect()
        if name != "packing":
            assert docs.columns == columns
    quality = dict(duck.execute("select doc_id, quality from labels").fetchall())
    text = dict(duck.execute("select doc_id, text from documents").fetchall())
    judged = steps["quality classifier"]
    assert sum((i in judged) == bool(q) for i, q in quality.items()) / len(quality) > 0.97
    best = {}
    for i in judged:
        best[text[i]] = max(i, best.get(text[i], i))
    assert set(steps["exact dedup"]) == set(best.values())
    kept = {i for i, _, _, stays in near_model([(i, text[i]) for i in sorted(steps["exact dedup"])]) if stays}
    assert set(steps["near dedup"]) == kept
    ids = sorted(kept)
    for i, (_, spans) in zip(ids, find_spans([text[i] for i in ids], trained()), strict=True):
        row = steps["personal data"][i]
        assert (row["text"] == text[i]) == (not spans) and row["n_chars"] == len(row["text"])
    packed = steps["packing"]
    assert {r["doc_id"] for r in packed} == kept
    ends = {}
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048
    assert cp.run(spark, SF).count() == len(packed)


#: Names that stages and operators use inside.
INSIDE = ("d", "i", "h", "g", "s", "b", "no", "n", "n0", "k", "t", "x0", "spans", "base_spans", "new", "best", "kept", "component_id", "length", "piece", "_new", "_kept_id", "a.b")


@pytest.mark.parametrize("step", [f for _, f in cp.STAGES], ids=[n for n, _ in cp.STAGES])
def test_stages_take_edges(spark, documents, edge_pairs, tmp_path, step):
    """Null and repeated ids, null texts, ties, empty tables and clashing names, at every stage."""
    from pyspark.sql import functions as F

    spark.createDataFrame([(3, 1, 0), (7, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for pairs in (edge_pairs, []):
        docs = documents(pairs).withColumns({c: F.lit(k) for k, c in enumerate(INSIDE)})
        out = step(spark, docs, str(tmp_path))
        rows = out.collect()
        assert len(rows) <= max(len(pairs), 200) and (len(rows) > 0) == (len(pairs) > 0)
        if step is not cp.pack_sequences:
            assert out.columns == docs.columns
            assert all(r[c] == k for r in rows for k, c in enumerate(INSIDE))


def test_rows_are_told_apart_by_id_and_text(spark, documents, tmp_path):
    twice = documents([(5, "again"), (5, "again"), (4, "again"), (None, None), (None, None), (None, "other"), (5, "different")])
    pairs = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    assert pairs(cp.drop_copies(spark, twice, str(tmp_path))) == sorted([(5, "again"), (5, "different"), (None, None), (None, "other")], key=str)
    words = " ".join(f"w{k}" for k in range(60))
    near = documents([(None, words), (None, words + " more"), (9, words + " end"), (9, "nothing like it"), (9, "nothing like it"), (1, None), (2, "")])
    assert pairs(cp.drop_near_copies(spark, near, str(tmp_path))) == sorted([(9, words + " end"), (9, "nothing like it"), (1, None), (2, "")], key=str)
    # good and bad texts under null ids get verdicts of their own
    good = [" ".join(f"word{(a * 7 + b) % 97}" for b in range(120)) for a in range(40)]
    bad = ["### !!! $$$ " * 60 + str(a) for a in range(40)]
    docs = documents([(k, t) for k, t in enumerate(good + bad)] + [(None, good[0] + " so"), (None, bad[0] + " so")])
    spark.createDataFrame([(k, int(k < 40), 0) for k in range(80)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = pairs(cp.judge_quality(spark, docs, str(tmp_path)))
    assert [t for i, t in kept if i is None] == [good[0] + " so"] and len(kept) == 41
