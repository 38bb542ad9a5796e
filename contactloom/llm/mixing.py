"""Mix sources to target weights by weighted sampling without replacement.

Everything is DataFrame functions.  A source's target is its share of all words
by its weight, at most ``most`` times its own words; what it cannot take is
shared anew among the others.  Its documents are taken whole as often as the
target holds all of them (complete epochs).  The rest comes from Efraimidis and
Spirakis' sample: the documents in ascending order of an exponential variate
over their quality weight, as far as their words fit; the one that the target
ends in is taken in part, by its first words.

The variates come from a hash of seed, id and text, so reruns agree.  Texts are
read once and not shuffled: what is sorted is a row of a few numbers for each
document, by ranges of (source, key), so a source of any size is spread; sums
before a row are those within its partition and source plus those of earlier
partitions.

Null texts have no words; they and empty ones are in the result with nothing
taken.  Rows of a null source are one source, the last.  Rows with null or
repeated ids are documents of their own; where id and text repeat too, either
may be the one taken in part.  An empty table gives an empty result, and so few
words that targets end inside a document are met all the same.  Texts may have
any length, other columns any name.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.llm.tables import col, stage
from contactloom.operators.ordinals import ROW_BITS, dense_ordinal, placed

log = logging.getLogger(__name__)

WORD = "[^\\x20\\x09-\\x0D]+"
#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (1, 2, 3)
#: How many times a source's words its target may be.
MOST = 3
#: No document's quality weighs less.
LEAST_QUALITY = 0.01
#: Values of the uniform variate: 52 bits of the hash.
STEPS = 1 << 52


def quality(text: Column) -> Column:
    """The share of letters among characters times that of distinct lines among lines."""
    lines = F.split(text, "\n")
    letters = F.length(F.regexp_replace(text, "\\P{L}+", "")) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(letters * (F.size(F.array_distinct(lines)) / F.size(lines)), F.lit(LEAST_QUALITY))


def sampling_key(identity: Column, text: Column, weight: Column, seed: int) -> Column:
    """An exponential variate over the weight; the smallest keys are the sample."""
    drawn = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(identity.cast("string"), F.lit("-")), text).cast("binary"))
    unit = (F.conv(F.substring(drawn, 1, 13), 16, 10).cast("double") + 0.5) / float(STEPS)
    return -F.log(unit) / weight


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``target`` to a table of (no_source, source, source_size), one row per source.

    Each round shares what the sources at their bound leave among the others by
    weight and finds those that are now beyond; two numbers reach the driver.
    """
    ranked = dense_ordinal(sources, "rank", [F.col("no_source"), F.col("source")])
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int")).cast("bigint")
    table = stage(ranked.select("no_source", "source", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("bound")), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    beyond, full, share = F.lit(False), -1, F.lit(0.0)
    while True:
        n, taken, rest = table.agg(F.count_if(beyond), F.coalesce(F.sum(F.when(beyond, F.col("bound"))), F.lit(0)), F.coalesce(F.sum(F.when(~beyond, F.col("weight"))), F.lit(0))).first()
        if not rest or n == full:
            break
        share = F.lit(total - taken).cast("double") * F.col("weight") / F.lit(float(rest))
        beyond, full = F.col("bound") < share, n
    log.info("%d sources at %d times their size", max(full, 0), most)
    return table.select("no_source", "source", "source_size", F.when(beyond, F.col("bound").cast("double")).otherwise(share).alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 806, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight: Column | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: how many words of each document the mix takes.

    ``taken div size`` are whole copies, ``taken % size`` the first words of
    one more.  ``weight`` is a column of positive quality weights, by default
    that of ``quality``.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    read = docs.select(col(id_col).alias("doc_id"), col(source_col).cast("string").alias("source"), text.alias("text"), *([] if weight is None else [weight.cast("double").alias("given")]))
    worth = quality(F.col("text")) if weight is None else F.greatest(F.coalesce("given", F.lit(0.0)), F.lit(LEAST_QUALITY))
    sized = read.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("source"), F.col("source").isNull().alias("no_source"),
        F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("size"), sampling_key(F.col("doc_id"), F.col("text"), worth, seed).alias("key"),
    )
    # written before it is dealt by ranges, as those are found in a pass of their own
    rows = placed(stage(sized, "sized"), [F.col(c) for c in ("no_source", "source", "key", "doc_id")])
    rows = rows.withColumn("part", F.shiftright("_at", ROW_BITS))

    group = ["no_source", "source"]
    parts = stage(rows.groupBy("part", *group).agg(F.sum("size").alias("words")), "parts")
    targets = source_targets(parts.groupBy(*group).agg(F.sum("words").alias("source_size")), weights, most)
    # a row for each partition that the source lies in
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.round("target").cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0).cast("bigint")
    plan = parts.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).join(targets, group)
    plan = plan.withColumn("budget", budget).withColumn("epochs", epochs)
    plan = plan.select("part", *group, "source_size", "target", "epochs", (F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("before")).alias("left"))

    within = Window.partitionBy("part", *group).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("sum", F.coalesce(F.sum("size").over(within), F.lit(0)))
    some = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("sum")))
    out = summed.join(plan, ["part", *group])
    return out.select("doc_id", F.when(~F.col("no_source"), F.col("source")).alias("source"), "size", "source_size", "target", (F.col("epochs") * F.col("size") + some).cast("bigint").alias("taken"))


def taken_texts(text: Column, taken: Column) -> Column:
    """The texts that ``taken`` words of a text are: whole copies, then the first words of one more, a space between."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    size = F.greatest(F.size(words), F.lit(1))
    rest = (taken % size).cast("int")
    return F.concat(F.array_repeat(text, (taken / size).cast("int")), F.filter(F.array(F.array_join(F.slice(words, F.lit(1), rest), " ")), lambda _: rest > 0))
