import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from contactloom.llm.quality_classifier import classify_quality, fit_logistic, strength


def corpus(rnd, n):
    """Prose and three kinds of junk, each host with its own share."""
    rows, labels = [], []
    for k in range(n):
        host = rnd.choice(["good", "mixed", "bad"])
        junk = rnd.random() < {"good": 0.02, "mixed": 0.3, "bad": 0.9}[host]
        words = ["".join(rnd.choices("abcdefghijklmnop", k=rnd.randrange(2, 9))) for _ in range(rnd.randrange(40, 120))]
        if junk:
            kind = rnd.randrange(3)
            words = [w + "###" for w in words] if kind == 0 else [w.upper() + "!!" for w in words] if kind == 1 else words[:5] * 20
        rows.append((k, " ".join(words), rnd.choice(["en", "de"]), host))
        labels.append((k, int(not junk)))
    return rows, labels


def test_held_out_accuracy(spark):
    rnd = random.Random(20)
    rows, labels = corpus(rnd, 1200)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    known = spark.createDataFrame(labels[:400] + [(None, 1), (7, None), (9999, 0)], "doc_id bigint, quality int")
    out = {r["doc_id"]: r for r in classify_quality(docs, known).collect()}
    held = labels[400:]
    assert len(out) == 1200
    assert sum(out[i]["kept"] == bool(y) for i, y in held) / len(held) > 0.98
    rate = lambda h: np.mean([out[r[0]]["site_rate"] for r in rows if r[3] == h])
    assert rate("good") > rate("mixed") > rate("bad")


def plain_features(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    n, chars = max(1, len(words)), max(1, sum(map(len, words)))
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    again = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
    scaled = lambda x: math.log1p(20 * x) / 3
    parts = re.split("[\x20\x09-\x0d]+", text)
    return [
        scaled(len(re.findall("[#*$%&|<>]", text)) / chars),
        scaled((len(lines) - len(set(lines))) / max(1, len(lines))),
        scaled(len(again) / n),
        scaled(sum(map(len, words)) / n),
        scaled(sum(c.isupper() for c in text) / chars),
        scaled(sum(c in "!?" for c in text) / n),
        min(1.0, len(set(parts)) / n),
        math.log(n) / 10,
    ]


def plain_model(rows, labels):
    """Newton steps, then shrunken host and path rates, in loops; probability by id."""
    x = {i: [*plain_features(t), 1.0] for i, t, _, _ in rows}
    known = dict(labels)
    ids = [i for i in x if i in known]
    w = [0.0] * 9
    sigmoid = lambda z: 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
    ridge = [1e-2] * 8 + [1e-6]
    for _ in range(40):
        grad, hess = np.array(ridge) * w, np.diag(ridge)
        for i in ids:
            v = np.array(x[i])
            p = sigmoid(float(v @ w))
            grad += (p - known[i]) * v
            hess += (p * (1 - p) + 1e-9) * np.outer(v, v)
        w = list(np.array(w) - np.linalg.solve(hess, grad))
    p = {i: sigmoid(max(-12.0, min(12.0, float(np.dot(x[i], w))))) for i in x}
    hosts, paths = defaultdict(list), defaultdict(list)
    for i, _, path, host in rows:
        hosts[host].append(p[i])
        paths[host, path].append(p[i])
    mean = (sum(p.values()) + 1) / (len(p) + 2)

    def prior(groups, center):
        n = sum(map(len, groups.values()))
        v = sum(len(g) * (sum(g) / len(g) - center(k)) ** 2 for k, g in groups.items()) / n - len(groups) * mean * (1 - mean) / n
        return min(max(mean * (1 - mean) / v - 1, 2.0), 1000.0) if v > 0 else 1000.0

    k0 = prior(hosts, lambda k: mean)
    rate = {h: (sum(g) + k0 * mean) / (len(g) + k0) for h, g in hosts.items()}
    k1 = prior(paths, lambda k: rate[k[0]])
    logit = lambda q: math.log(q / (1 - q))
    out = {}
    for i, _, path, host in rows:
        g = paths[host, path]
        site = min(max((sum(g) - p[i] + k1 * rate[host]) / (len(g) - 1 + k1), 1e-6), 1 - 1e-6)
        out[i] = 1 / (1 + math.exp(-(logit(p[i]) + logit(site) - logit(mean))))
    return out


def test_against_a_plain_model(spark):
    rows, labels = corpus(random.Random(22), 500)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r["doc_id"]: r for r in classify_quality(docs, spark.createDataFrame(labels[:200], "doc_id bigint, quality int")).collect()}
    want = plain_model(rows, labels[:200])
    assert max(abs(got[i]["probability"] - q) for i, q in want.items()) < 1e-5
    assert all(got[i]["kept"] == (q >= 0.5) for i, q in want.items() if abs(q - 0.5) > 1e-4)


def test_labels_left_out_of_the_fit(spark):
    """Accuracy on labelled documents of the test tables that the fit has not seen."""
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    seen, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    out = classify_quality(spark.read.parquet(f"{folder}/documents.parquet"), seen)
    right = held.join(out, "doc_id").selectExpr("avg(cast(kept = (quality = 1) as int)) as a", "count(*) as n").first()
    print("left-out accuracy:", right)
    assert right["n"] > 100 and right["a"] > 0.95


def test_sparse_sites_lean_on_the_rest(spark):
    rnd = random.Random(21)
    rows, labels = corpus(rnd, 600)
    rows.append((5000, rows[0][1], "en", "new"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    out = {r["doc_id"]: r for r in classify_quality(docs, spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()}
    mean = np.mean([r["evidence"] for r in out.values()])
    assert abs(out[5000]["site_rate"] - mean) < 0.15


def test_edges(spark, documents, edge_pairs):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    out = classify_quality(documents(edge_pairs, clash=True), none).collect()
    assert len(out) == len(edge_pairs) and all(r["kept"] and r["evidence"] == 0.5 for r in out)
    assert classify_quality(documents([]), none).count() == 0
    some = spark.createDataFrame([(3, 1), (7, 0), (7, 0)], "doc_id bigint, quality int")
    assert classify_quality(documents(edge_pairs), some).count() == len(edge_pairs)


def test_fit_and_strength():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((2000, 2))
    y = (rng.random(2000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))).astype(float)
    w = fit_logistic(x, y)
    assert np.abs(w - [2, -1, 0.5]).max() < 0.3
    assert strength(None, 0.5) == strength(-1.0, 0.5) == 1000.0 and strength(0.2, 0.5) == 2.0 and abs(strength(0.05, 0.5) - 4) < 1e-9
