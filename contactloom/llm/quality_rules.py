"""Quality rules whose limits adapt to language and source.

Everything is DataFrame functions.  Base counts are written once; quantile
sketches of four ratios and of the sizes of texts are taken per (language,
source) as counts of logarithmic bins of 1 % relative error, which merge by
addition up to the language and to the corpus.

A group's own limit lies beyond its 90 % quantile by six times the way there
from the median, and by three more events (symbols, lines, windows) in a text
of its median size.  As more than a tenth of a small group may be bad, the
distance from the median is at most four times that of the level above plus
twice the median.  Limits are then shrunk toward the level above in proportion
to the group's size; no size switches anything.  They are joined back to the
counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.llm.tables import col, stage

ACCURACY = 0.01
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]+"
#: ratio -> the size it is a share of, and how much of that three events are
SIZES = {"symbol_ratio": ("word_chars", 3.0), "dup_line_ratio": ("n_lines", 3.0), "repeat_ratio": ("n_words", 9.0), "word_length": (None, 0.0)}
#: ratios that are also limited from below
BOTH_SIDES = ("word_length",)
#: quantiles between which a group's spread is taken
LOW, MIDDLE, HIGH = 0.1, 0.5, 0.9
#: how many times the distance from the median to them lies beyond them
REACH = 6.0
#: how much wider than the level above a group may be, and how wide in medians of its own
WIDER, OWN_MEDIANS = 4.0, 2.0
#: documents at which a group counts as much as the level above
PRIOR_DOCS = 50.0


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace the text by n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Three-word windows are compared by 64-bit hashes within a text.  Each
    ``select`` makes arrays that the next one refers to more than once.
    """
    others = [c for c in docs.columns if c != text_col]
    keep = [col(c) for c in others]
    t = F.coalesce(col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    one = docs.select(*keep, t.alias("_t"), F.array_remove(F.split(t, SPACE), "").alias("_w"), lines.alias("_l"))
    w = F.col("_w")
    windows = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    two = one.select(
        *keep,
        F.size("_w").cast("bigint").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        F.size("_l").cast("bigint").alias("n_lines"),
        F.when(F.size("_w") > 2, F.slice(windows, F.lit(1), F.size("_w") - 2)).otherwise(F.expr("array()").cast("array<bigint>")).alias("_h"),
    )
    counts = [*keep, *(F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines"))]
    # most texts repeat no window; only the others are sorted
    pairs = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    three = two.select(*counts, F.when(F.size(F.array_distinct("_h")) < F.size("_h"), pairs).alias("_s"))
    s = F.col("_s")
    same = lambda e, o: F.coalesce(e["h"] == F.get(s, o)["h"], F.lit(False))
    four = three.select(*counts, F.sort_array(F.transform(F.filter(s, lambda e, i: same(e, i - 1) | same(e, i + 1)), lambda e: e["i"])).alias("_p"))
    p = F.col("_p")
    covered = F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0), lambda a, b: a + b)
    return four.select(*counts, F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def ratios() -> dict[str, Column]:
    least_one = lambda c: F.greatest(F.col(c), F.lit(1)).cast("double")
    return {
        "symbol_ratio": F.col("n_symbols") / least_one("word_chars"),
        "dup_line_ratio": F.col("n_dup_lines") / least_one("n_lines"),
        "repeat_ratio": F.col("n_repeat_words") / least_one("n_words"),
        "word_length": F.col("word_chars") / least_one("n_words"),
    }


def sketch(rows: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Counts of logarithmic bins: ``by``, metric, bin, n.  Null bin: zero."""
    measured = ratios() | {size: F.col(size).cast("double") for size, _ in SIZES.values() if size}
    metrics = F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), v.alias("x")) for k, v in measured.items()]))
    flat = rows.select(*by, metrics.alias("m")).select(*by, "m.metric", F.when(F.col("m.x") > 0, F.ceil(F.log(F.col("m.x")) / F.lit(math.log(GAMMA)))).alias("bin"))
    return flat.groupBy(*by, "metric", "bin").agg(F.count(F.lit(1)).alias("n"))


def merge(sketches: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return sketches.groupBy(*by, "metric", "bin").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, by: tuple[str, ...], at: dict[str, float]) -> DataFrame:
    """``by``, metric, size and the lower quantiles ``at`` of each sketch."""
    w = Window.partitionBy(*by, "metric").orderBy(F.col("bin").asc_nulls_first())
    whole = Window.partitionBy(*by, "metric")
    value = F.when(F.col("bin").isNull(), F.lit(0.0)).otherwise(F.pow(F.lit(GAMMA), F.col("bin")) * F.lit(2 / (GAMMA + 1)))
    run = sketches.withColumns({"upto": F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)), "size": F.sum("n").over(whole), "x": value})
    return run.groupBy(*by, "metric").agg(F.max("size").alias("size"), *[F.min(F.when(F.col("upto") >= q * F.col("size"), F.col("x"))).alias(name) for name, q in at.items()])


def _per_group(sketches: DataFrame, by: tuple[str, ...], level: str) -> DataFrame:
    """A row per group: its size, and of each ratio the median and the distances of its own limits from it."""
    q = quantiles(sketches, by, {"low": LOW, "middle": MIDDLE, "high": HIGH})
    value = lambda metric, c: F.max(F.when(F.col("metric") == metric, F.col(c)))
    out = [F.max("size").cast("double").alias(f"{level}_size")]
    for m, (size, events) in SIZES.items():
        more = F.lit(events) / F.greatest(value(size, "middle"), F.lit(1.0)) if size else F.lit(0.0)
        out.append(value(m, "middle").alias(f"{level}_{m}"))
        out.append(((1 + REACH) * (value(m, "high") - value(m, "middle")) + more).alias(f"{level}_{m}_up"))
        out.append(((1 + REACH) * (value(m, "middle") - value(m, "low"))).alias(f"{level}_{m}_down"))
    return q.groupBy(*by).agg(*out)


def _shrunk(table: DataFrame, level: str, above: str) -> DataFrame:
    """Bound the distances by those of the level above, and move median and distances toward it by the group's size."""
    size = F.col(f"{level}_size")
    cols = {}
    for m in SIZES:
        own = F.col(f"{level}_{m}")
        toward = lambda x, y: (size * x + PRIOR_DOCS * y) / (size + PRIOR_DOCS)
        cols[f"{level}_{m}"] = toward(own, F.col(f"{above}_{m}"))
        for way in ("up", "down"):
            theirs = F.col(f"{above}_{m}_{way}")
            cols[f"{level}_{m}_{way}"] = toward(F.least(F.col(f"{level}_{m}_{way}"), WIDER * theirs + OWN_MEDIANS * own), theirs)
    return table.withColumns(cols)


def limits(sketches: DataFrame) -> DataFrame:
    """A row per (g1, g2) of sketches by these: of each ratio the lower (if it has one) and the upper limit."""
    by_lang = merge(sketches, ("g1",))
    # one row each, however large the corpus
    whole = F.broadcast(_per_group(merge(by_lang, ()), (), "all"))
    lang = _shrunk(_per_group(by_lang, ("g1",), "lang").join(whole), "lang", "all").withColumnRenamed("g1", "l1")
    own = _per_group(sketches, ("g1", "g2"), "own").join(lang, F.col("g1").eqNullSafe(F.col("l1")))
    own = _shrunk(own, "own", "lang")
    ends = []
    for m in SIZES:
        middle = F.col(f"own_{m}")
        ends.append((middle + F.col(f"own_{m}_up")).alias(f"{m}_high"))
        ends.append((middle - F.col(f"own_{m}_down") if m in BOTH_SIDES else F.lit(None).cast("double")).alias(f"{m}_low"))
    return own.select("g1", "g2", *ends)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """A row per document: ``id_col``, counts, ``base_failed`` and ``kept``.

    A document fails the base rules with under 50 words or with over half its
    words in repeated windows, and the method's with a ratio beyond the limits
    of its language and source; a ratio at a limit passes.  A null text has no
    words; null languages and sources are groups of their own; repeated rows
    are judged alike and counted each; an empty table gives none.  A text of any
    length is counted whole, within its row.  Only the named columns are read.
    """
    rows = docs.select(col(id_col).alias("i"), col(lang_col).alias("g1"), col(source_col).alias("g2"), col(text_col).alias("t"))
    rows = stage(base_counts(rows, "t"), "counts")
    table = limits(stage(sketch(rows, ("g1", "g2")), "sketches")).withColumnsRenamed({"g1": "k1", "g2": "k2"})
    joined = rows.join(table, F.col("g1").eqNullSafe(F.col("k1")) & F.col("g2").eqNullSafe(F.col("k2")), "left")
    outside = F.lit(False)
    for m, x in ratios().items():
        outside = outside | (x > F.col(f"{m}_high")) | F.coalesce(x < F.col(f"{m}_low"), F.lit(False))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return joined.select(F.col("i").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~outside).alias("kept"))
