"""Dense global row numbers without a window over many rows."""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.session import stage

#: ``monotonically_increasing_id`` has the partition above, the row within it below.
ROW_BITS = 33
#: More partitions than this are refused: their running totals go to every task.
MOST_PARTS = 1 << 20


def placed(df: DataFrame, order: list[Column | str], name: str = "ordered") -> DataFrame:
    """The rows range-partitioned by ``order``, sorted, and written once with ``_at``, their place.

    The whole order is the key of the partitions, so equal values in its first
    columns are spread.  Columns by their name are sorted where they are, others
    are carried along.  ``_at`` has the partition above ``ROW_BITS`` bits and
    the row within it below.
    """
    made = {f"_o{k}": o for k, o in enumerate(order) if not isinstance(o, str)}
    keys = [f"`{o}`" if isinstance(o, str) else f"_o{k}" for k, o in enumerate(order)]
    marked = df.select(*[F.col(f"`{c}`") for c in df.columns], *[o.alias(k) for k, o in made.items()])
    sorted_rows = marked.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*made)
    return stage(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), name)


def dense_ordinal(df: DataFrame, name: str, order: list[Column | str]) -> DataFrame:
    """Add ``name``: the place of each row from 0 in the given order; nulls come first.

    The rows are shuffled once, by ranges of the whole order, so a key of any
    size is spread; what is added are running totals of one row per partition.
    ``order`` should tell all rows apart that differ.
    """
    return numbered(placed(df, order), name)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Turn ``_at``, consecutive within partitions that follow each other, into dense numbers.

    The first number of each partition goes to all tasks as a table of one row
    per partition, at most ``MOST_PARTS``; no row is moved for it.
    """
    part = F.shiftright("_at", ROW_BITS)
    counts = sorted((r["p"], r["n"]) for r in df.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).limit(MOST_PARTS + 1).collect())
    if len(counts) > MOST_PARTS:
        raise ValueError(f"the rows lie in more than {MOST_PARTS} partitions")
    before = [0, *accumulate(n for _, n in counts)]
    # an Arrow table needs no Python worker
    firsts = df.sparkSession.createDataFrame(pa.table({"_part": pa.array([p for p, _ in counts], pa.int64()), "_first": pa.array(before[:-1], pa.int64())}))
    joined = df.join(F.broadcast(firsts), part == F.col("_part"))
    return joined.select((F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))).cast("bigint").alias(name), *[F.col(f"`{c}`") for c in df.columns if c != "_at"])
