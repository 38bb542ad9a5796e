import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from contactloom.llm.mixing import LEAST_QUALITY, mix_sources, taken_texts

SCHEMA = "doc_id bigint, text string, source string"


def targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight, what is beyond a source's bound shared again, one round after the other."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = sum(weight[s] for s in names if s not in full)
        share = {s: (total - sum(most * sizes[f] for f in full)) * weight[s] / rest for s in names if s not in full} if rest else {}
        more = {s for s, t in share.items() if t > most * sizes[s]}
        if not more:
            return {s: share.get(s, float(most * sizes[s])) for s in names}
        full |= more


def model(rows, seed=806):
    """Sources, targets and takes by lists and loops."""
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    target, out = targets(sizes), []
    for s, size in sizes.items():
        budget, keyed = math.floor(target[s] + 0.5), []
        for i, t, src in rows:
            if src == s:
                text = t or ""
                lines = text.split("\n")
                worth = max(sum(c.isalpha() for c in text) / max(len(text), 1) * (len(set(lines)) / len(lines)), LEAST_QUALITY)
                drawn = int(hashlib.md5(f"{seed}:{'-' if i is None else i}:{text}".encode()).hexdigest()[:13], 16)
                keyed.append((-math.log((drawn + 0.5) / 2**52) / worth, i is not None, i or 0, len(words(t))))
        left = budget - (budget // size if size else 0) * size
        for _, known, i, n in sorted(keyed):
            some = min(n, left)
            left -= some
            out.append((i if known else None, n, size, target[s], (budget // size if size else 0) * n + some))
    return out


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def run(df, **more):
    return by_id([(r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in mix_sources(df, **more).collect()])


def made():
    """Sources of very different sizes, so that some are full at once and others in a later round."""
    return [(100 * k + j, " ".join(f"w{(j * 7 + x) % 90}" for x in range(1 + (j * j + 3 * k) % 40)) + ("\nline\nline" if j % 5 == 0 else ""), f"s{k}") for k, n in enumerate((120, 1, 2, 30, 4, 9)) for j in range(n)]


def test_equal_to_the_model_with_full_sources(spark):
    rows = made()
    want = by_id(model(rows))
    got = run(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert [(a[0], a[1], a[2], a[4]) for a in got] == [(a[0], a[1], a[2], a[4]) for a in want]
    assert [a[3] for a in got] == pytest.approx([a[3] for a in want])
    full = {a[2] for a in got if a[3] == 3 * a[2]}
    assert 0 < len(full) < 6
    for size in {a[2] for a in got}:
        assert abs(sum(a[4] for a in got if a[2] == size) - next(a[3] for a in got if a[2] == size)) <= 0.5
    assert all(a[4] <= 3 * a[1] for a in got)


def test_reruns_agree_however_rows_are_dealt(spark):
    df = spark.createDataFrame(made(), SCHEMA)
    assert run(df.repartition(7)) == run(df.coalesce(1))
    assert run(df, seed=5) != run(df, seed=6)


def test_edge_cases(spark, edge_pairs):
    rows = [(i, t, None if (i or 0) % 3 == 2 else "b" if (i or 0) % 2 else "") for i, t in edge_pairs]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("size", "key", "part", "taken", "target", "_at", "no_source", "a.b")})
    got = run(df)
    assert len(got) == len(rows)
    assert [(a[0], a[1], a[4]) for a in got] == [(a[0], a[1], a[4]) for a in by_id(model(rows))]


def test_empty_table_and_tables_without_words(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []
    assert run(spark.createDataFrame([(1, None, "a"), (2, "  ", None)], SCHEMA)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_better_documents_come_sooner(spark):
    """Of two kinds of equal size, the one with three times the weight is sampled more often."""
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.format_string("text %d", "id").alias("text"), F.when(F.col("id") < 3000, "a").otherwise("b").alias("source"))
    out = mix_sources(df, weight=F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0)).where("source = 'a'")
    even, odd = (out.where(f"doc_id % 2 = {k}").agg(F.sum("taken")).first()[0] for k in (0, 1))
    assert even > 1.5 * odd


def test_texts_that_are_taken(spark):
    df = spark.createDataFrame([("a  b\nc", 7), ("a  b\nc", 3), ("a  b\nc", 2), ("", 0), ("x y", 0)], "text string, taken bigint")
    got = [r[0] for r in df.select(taken_texts(F.col("text"), F.col("taken"))).collect()]
    assert got == [["a  b\nc", "a  b\nc", "a"], ["a  b\nc"], ["a b"], [], []]


def test_no_python_on_the_way(spark):
    plan = mix_sources(spark.createDataFrame(made(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
