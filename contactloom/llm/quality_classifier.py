"""Document quality from a classifier and from where a document stands.

A logistic classifier on counts of the text gives each document its own
evidence.  Hosts, and paths within hosts, get posterior rates of good documents
by empirical Bayes: grouped sums of the evidence, shrunk toward the level above
with a strength taken from how much the groups differ.  A document's verdict
adds the two on the log scale, its own evidence left out of its site's.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.llm.quality_rules import base_counts, ratios
from contactloom.llm.tables import col, stage

#: Labelled documents at most that the classifier is fitted on, the lowest by a hash of the id.
FIT_ROWS = 5000
FEATURES = ("symbol_ratio", "dup_line_ratio", "repeat_ratio", "word_length", "upper_ratio", "mark_ratio", "distinct_ratio", "size")


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace the text by the array ``x`` of FEATURES; all counts are taken of the whole text."""
    others = [c for c in docs.columns if c != text_col]
    t = F.coalesce(col(text_col).cast("string"), F.lit(""))
    gone = lambda pattern: (F.length(t) - F.length(F.regexp_replace(t, pattern, ""))).cast("double")
    more = docs.select(*[col(c) for c in others], t.alias("_text"), gone("\\p{Lu}+").alias("_upper"), gone("[!?]+").alias("_marks"), F.size(F.array_distinct(F.split(t, "[\\x20\\x09-\\x0D]+"))).alias("_distinct"))
    counted = base_counts(more, "_text")
    one = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    own = {
        "upper_ratio": F.col("_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
        "mark_ratio": F.col("_marks") / one,
        "distinct_ratio": F.least(F.col("_distinct") / one, F.lit(1.0)),
        "size": F.log(one) / 10,
    }
    every = ratios() | own
    # ratios differ most near zero
    scaled = [every[k] if k in ("distinct_ratio", "size") else F.log1p(20 * every[k]) / 3 for k in FEATURES]
    return counted.select(*[col(c) for c in others], F.array(*[c.cast("double") for c in scaled]).alias("x"))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Weights, the constant last, by Newton steps on the penalised likelihood."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + ridge, x.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def strength(between: float | None, mean: float) -> float:
    """Pseudo-counts of a Beta prior whose groups have this variance of means."""
    spread = mean * (1 - mean)
    if not between or between <= 0 or spread <= 0:
        return 1000.0
    return float(min(max(spread / between - 1, 2.0), 1000.0))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str | Column = "lang", label_id_col: str = "doc_id", label_col: str = "quality", threshold: float = 0.5, fit_rows: int = FIT_ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """A row per document: ``id_col``, ``carry`` columns, ``evidence``, ``site_rate``, ``probability``, ``kept``.

    Labels are 1 for good and 0 for bad; others, and null ids, are ignored.
    Without two kinds of labels the evidence is a half for all and everything
    stays.  Null texts count as empty, null hosts and paths are groups of
    their own; repeated rows are judged alike and counted each; a probability
    at the threshold keeps; an empty table gives none.  A text of any length is
    counted whole.  Only the named columns are read.
    """
    path = col(path_col) if isinstance(path_col, str) else path_col
    carried = [(f"x{k}", name) for k, name in enumerate(carry)]
    xs = [x for x, _ in carried]
    rows = docs.select(col(id_col).alias("i"), *[col(n).alias(x) for x, n in carried], col(host_col).alias("host"), path.alias("path"), col(text_col).alias("t"))
    rows = stage(features(rows, "t"), "features")
    known = labels.select(col(label_id_col).alias("i"), col(label_col).cast("double").alias("y")).where("y in (0, 1) and i is not null").dropDuplicates(["i"])
    sample = rows.join(known, "i").orderBy(F.xxhash64("i"), "i").select("x", "y").limit(fit_rows).toPandas()
    weights = np.zeros(len(FEATURES) + 1)
    if sample["y"].nunique() == 2:
        weights = fit_logistic(np.stack(sample["x"].to_numpy()), sample["y"].to_numpy())
    z = F.lit(float(weights[-1]))
    for k, w in enumerate(weights[:-1]):
        z = z + F.lit(float(w)) * F.col("x")[k]
    # a document's own evidence is bounded, so that a site can speak as well
    rows = rows.select("i", *xs, "host", "path", (1 / (1 + F.exp(-F.greatest(F.lit(-12.0), F.least(F.lit(12.0), z))))).alias("p"))

    paths = stage(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mean = (total["s"] + 1) / (total["n"] + 2) if total["n"] else 0.5

    def between(groups: DataFrame, center: Column) -> float | None:
        """Variance of group rates around their centre, less what chance gives."""
        chance = F.lit(mean * (1 - mean))
        got = groups.agg(F.sum(F.col("n") * (F.col("s") / F.col("n") - center) ** 2).alias("v"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("g"), F.first(chance).alias("c")).first()
        return got["v"] / got["n"] - got["g"] * got["c"] / got["n"] if got["n"] else None

    k0 = strength(between(hosts, F.lit(mean)), mean)
    host = hosts.select(F.col("host").alias("h"), ((F.col("s") + k0 * mean) / (F.col("n") + k0)).alias("rate"))
    sites = paths.join(host, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    k1 = strength(between(sites, F.col("rate")), mean)
    sites = sites.select(F.col("host").alias("h"), F.col("path").alias("q"), "n", "s", "rate")
    joined = rows.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q")))
    site = (F.col("s") - F.col("p") + k1 * F.col("rate")) / (F.col("n") - 1 + k1)
    site = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), site))
    both = _logit(F.col("p")) + _logit(site) - float(np.log(mean / (1 - mean)))
    judged = joined.select("i", *xs, "p", site.alias("site"), (1 / (1 + F.exp(-both))).alias("post"))
    return judged.select(F.col("i").alias(id_col), *[F.col(x).alias(n) for x, n in carried], F.col("p").alias("evidence"), F.col("site").alias("site_rate"), F.col("post").alias("probability"), (F.col("post") >= threshold).alias("kept"))
