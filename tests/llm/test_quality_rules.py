import random
import re
from collections import Counter

from contactloom.llm.quality_rules import base_counts, limits, merge, quality_rules, quantiles, sketch


def counts_model(text):
    text = text or ""
    w = [x for x in re.split("[\x20\x09-\x0d]+", text) if x]
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {k + d for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_against_a_loop(documents, edge_pairs):
    rnd = random.Random(7)
    texts = ["".join(rnd.choices(["a", "b", " ", " ", "\n", "é", "#", "|", "\x0b", "\u2003"], k=rnd.randrange(0, 120))) for _ in range(200)]
    pairs = [p for p in edge_pairs if p[0] not in (None, 5)] + [(100 + k, t) for k, t in enumerate(texts)]
    got = {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in base_counts(documents(pairs).select("doc_id", "text")).collect()}
    assert got == {i: counts_model(t) for i, t in pairs}


def prose(rnd, n):
    return " ".join("".join(rnd.choices("abcdefghij", k=rnd.randrange(3, 8))) for _ in range(n))


def test_limits_follow_the_group(spark):
    rnd = random.Random(9)
    rows = [(k, prose(rnd, 80), "en", "plain") for k in range(260)]
    # a source where every text has symbols keeps such texts, elsewhere they go
    rows += [(1000 + k, " ".join(w + "#" * rnd.randrange(0, 2) for w in prose(rnd, 80).split()), "en", "marked") for k in range(260)]
    rows += [(2000, " ".join(w + "#" for w in prose(rnd, 80).split()), "en", "plain"), (2001, "short text", "en", "plain"), (2002, ("one two three. " * 30), None, None)]
    out = {r["doc_id"]: r for r in quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")).collect()}
    assert len(out) == len(rows)
    # limits cut off the far ends of a source's own spread, no more
    assert all(out[k]["kept"] for k in range(260)) and sum(out[1000 + k]["kept"] for k in range(260)) >= 247
    assert not out[2000]["kept"] and not out[2000]["base_failed"]
    assert out[2001]["base_failed"] and not out[2001]["kept"] and out[2002]["base_failed"]


def test_sketches_merge_and_are_near(spark):
    rnd = random.Random(10)
    df = spark.createDataFrame([(k % 3, rnd.randrange(1, 1000)) for k in range(3000)], "g int, word_chars bigint")
    from pyspark.sql import functions as F

    rows = df.withColumns({"n_words": F.lit(1), "n_symbols": F.lit(0), "n_dup_lines": F.lit(0), "n_lines": F.lit(1), "n_repeat_words": F.lit(0)})
    at = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    whole = {r["metric"]: r for r in quantiles(merge(sketch(rows, ("g",)), ()), (), at).collect()}
    direct = {r["metric"]: r for r in quantiles(sketch(rows, ()), (), at).collect()}
    assert whole == direct
    values = sorted(r["word_chars"] for r in df.collect())
    for name, place in (("q1", 749), ("q2", 1499), ("q3", 2249)):
        assert abs(whole["word_length"][name] / values[place] - 1) <= 0.0101
    assert whole["symbol_ratio"]["q3"] == 0


def test_no_size_switches_a_limit(spark):
    """A group's limits move from those of its language to its own as it grows, step by step."""
    from pyspark.sql import functions as F

    def high(n):
        rows = [("en", "a", 100) for _ in range(3000)] + [("en", "b", 200 + k % 10) for k in range(n)]
        df = spark.createDataFrame(rows, "g1 string, g2 string, word_chars bigint")
        df = df.withColumns({c: F.lit(v) for c, v in (("n_words", 25), ("n_symbols", 0), ("n_dup_lines", 0), ("n_lines", 4), ("n_repeat_words", 0))})
        return next(r for r in limits(sketch(df, ("g1", "g2"))).collect() if r["g2"] == "b")["word_length_high"]

    found = [high(n) for n in (1, 10, 40, 160, 200, 240)]
    assert found == sorted(found) and found[0] < 4.5 and found[-1] > 7
    assert max(b - a for a, b in zip(found[3:], found[4:], strict=False)) < 0.3


def test_edges(documents, edge_pairs):
    out = quality_rules(documents(edge_pairs, clash=True)).collect()
    assert len(out) == len(edge_pairs)
    assert all(r["base_failed"] and not r["kept"] for r in out if r["n_words"] < 50)
    assert quality_rules(documents([])).count() == 0
