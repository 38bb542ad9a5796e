"""Exact duplicate removal by composable polynomial fingerprints.

Each text's UTF-8 bytes are cut into chunks; the chunks of a text are hashed
independently, as rows of one matrix, and their hashes combine by
length-shifted arithmetic, ``H(a + b) = H(a) * x ** len(b) + H(b)``, modulo two
31-bit primes.  Rows whose fingerprint and length occur once are done.  The
others are compared chunk by chunk while their sorted partition streams by.

Plan: one scan for fingerprints (small rows are written), one aggregation, a
second scan that ships only the texts whose fingerprint occurs more than once
(a Bloom filter of fixed size keeps the others out of the shuffle).  Rows of
hot fingerprints are salted by their place, whatever their ids, into as many
parts as the largest group's root; each part leaves one text per distinct
content for a second comparison.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.llm.tables import Bloom, col, field_type, leaving_little, stage

PRIMES = (2147483647, 2147483629)
BASES = (1103515249, 1540483483)
CHUNK = 1 << 15
#: Copies of one fingerprint that one task compares; larger groups are salted.
GROUP_ROWS = 1000


@cache
def powers(k: int) -> np.ndarray:
    """x ** (CHUNK - 1) ... x ** 0 modulo the k-th prime."""
    p, x = PRIMES[k], BASES[k]
    out = np.ones(CHUNK, np.uint64)
    filled = 1
    while filled < CHUNK:
        take = min(filled, CHUNK - filled)
        out[filled : filled + take] = out[:take] * np.uint64(pow(x, filled, p)) % np.uint64(p)
        filled += take
    return out[::-1].copy()


def combine(left: int, right: int, right_length: int, k: int = 0) -> int:
    """The hash of a + b from the hashes of a and b and the length of b."""
    return (left * pow(BASES[k], right_length, PRIMES[k]) + right) % PRIMES[k]


def chunk_hashes(data: np.ndarray, k: int) -> tuple[np.ndarray, int]:
    """Hashes of the whole chunks of ``data`` and of its rest."""
    whole = len(data) // CHUNK
    pw, p = powers(k), np.uint64(PRIMES[k])
    full = (data[: whole * CHUNK].reshape(whole, CHUNK).astype(np.uint64) + np.uint64(1)) @ pw % p
    rest = data[whole * CHUNK :]
    last = int((rest.astype(np.uint64) + np.uint64(1)) @ pw[CHUNK - len(rest) :] % p) if len(rest) else 0
    return full, last


def fingerprint(data: np.ndarray) -> tuple[int, int]:
    """Both hashes of a text's bytes, from the hashes of its chunks."""
    out = []
    for k in (0, 1):
        h = 0
        # a few chunks at a time, so that a huge text needs little memory
        for at in range(0, max(len(data), 1), 64 * CHUNK):
            part = data[at : at + 64 * CHUNK]
            full, last = chunk_hashes(part, k)
            for x in full:
                h = combine(h, int(x), CHUNK, k)
            h = combine(h, last, len(part) % CHUNK, k)
        out.append(h)
    return out[0], out[1]


def binary_views(values: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each value of a string or binary array, without a copy."""
    large = pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)
    offsets = np.frombuffer(values.buffers()[1], np.int64 if large else np.int32)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    for i in range(len(values)):
        yield data[offsets[i] : offsets[i + 1]]


def _hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(texts)
    h1, h2, size = (np.zeros(n, np.int64) for _ in range(3))
    for i, data in enumerate(binary_views(texts)):
        size[i] = len(data)
        h1[i], h2[i] = fingerprint(data)
    return h1, h2, size


def _with_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        h1, h2, size = _hashes(b.column("t"))
        cols = {n: b.column(n) for n in b.schema.names if n != "t"}
        yield pa.RecordBatch.from_pydict(cols | {"h1": h1, "h2": h2, "n": size})


def _candidates(repeated, large):
    def run(batches):
        for b in batches:
            h1, h2, size = _hashes(b.column("t"))
            mask, hot = pa.array(repeated.value.has(h1, h2)), large.value.has(h1, h2)
            cols = {n: b.column(n) for n in b.schema.names}
            cols |= {"h1": pa.array(h1), "h2": pa.array(h2), "n": pa.array(size), "hot": pa.array(hot)}
            cols["salt"] = pa.array(np.where(hot, b.column("salt").to_numpy(), 0).astype(np.int32))
            yield pa.RecordBatch.from_pydict(cols).filter(mask)

    return run


def equal_by_chunks(a: np.ndarray, b: np.ndarray) -> bool:
    """Compare two texts of the same length, a chunk at a time."""
    return len(a) == len(b) and all(np.array_equal(a[i : i + CHUNK], b[i : i + CHUNK]) for i in range(0, len(a), CHUNK))


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h1, h2, n, salt, i): number the distinct texts of each key.

    Memory holds the distinct texts of one key only, one unless hashes collide.
    """
    key, texts, last = None, [], []
    for b in batches:
        keys = list(zip(*(b.column(c).to_pylist() for c in ("h1", "h2", "n", "salt")), strict=True))
        ids = b.column("i").to_pylist()
        number, again, first = np.zeros(len(keys), np.int32), np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        for r, data in enumerate(binary_views(b.column("t"))):
            if keys[r] != key:
                key, texts, last = keys[r], [], []
            for c, known in enumerate(texts):
                if equal_by_chunks(known, data):
                    break
            else:
                c = len(texts)
                texts.append(data.copy())
                last.append(object())
                first[r] = True
            number[r] = c
            again[r] = not first[r] and last[c] == ids[r]
            last[c] = ids[r]
        cols = {n: b.column(n) for n in b.schema.names}
        # the text of a class travels on only where salted parts must still be compared
        send = first & b.column("hot").to_numpy(zero_copy_only=False)
        cols["t"] = pa.array([b.column("t")[r].as_py() if x else None for r, x in enumerate(send.tolist())], b.column("t").type)
        yield pa.RecordBatch.from_pydict(cols | {"c": pa.array(number), "again": pa.array(again)})


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), bloom_bits: int = 1 << 23) -> DataFrame:
    """Group rows by identical text; in each group the row with the largest id stays.

    Returns one row per input row: ``id_col``, the ``carry`` columns,
    ``keep_id``, ``group_size``, ``kept``.  A null text counts as empty.  Of
    rows that repeat both the id and the text one stays.  Null ids lose against
    any other id; a group of null ids keeps one of them.  A huge text is hashed
    and compared a few chunks at a time.  An empty table gives none.  Only the
    named columns are read, so other columns may have any name.
    """
    spark = docs.sparkSession
    carried = [(f"x{k}", name) for k, name in enumerate(carry)]
    xs = [x for x, _ in carried]
    src = docs.select(col(id_col).alias("i"), *[col(n).alias(x) for x, n in carried], F.coalesce(col(text_col).cast("string"), F.lit("")).alias("t"))
    kinds = ", ".join([f"i {field_type(docs, id_col)}", *[f"{x} {field_type(docs, n)}" for x, n in carried]])
    fp = ["h1", "h2", "n"]
    rows = stage(src.mapInArrow(leaving_little(_with_hashes), f"{kinds}, h1 bigint, h2 bigint, n bigint"), "fingerprints")
    twice = stage(rows.groupBy(*fp).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1"), "repeated")
    single = rows.join(twice, fp, "left_anti").select("i", *xs, F.col("i").alias("k"), F.lit(1).cast("bigint").alias("g"), F.lit(True).alias("s"))

    repeated = spark.sparkContext.broadcast(Bloom.build(twice, "h1", "h2", bloom_bits))
    large = spark.sparkContext.broadcast(Bloom.build(twice.where(F.col("cnt") > GROUP_ROWS), "h1", "h2", bloom_bits))
    # a salt spreads the copies of a hot key; parts are as many as the rows of one
    key = [*fp, "salt"]
    salts = math.isqrt(twice.agg(F.coalesce(F.max("cnt"), F.lit(1))).first()[0] - 1) + 1
    salted = src.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int"))
    texts = salted.mapInArrow(leaving_little(_candidates(repeated, large)), f"{kinds}, t string, salt int, h1 bigint, h2 bigint, n bigint, hot boolean")
    ordered = texts.repartition(*key).sortWithinPartitions(*key, "i")
    members = stage(ordered.mapInArrow(leaving_little(_classes), f"{kinds}, t string, salt int, h1 bigint, h2 bigint, n bigint, hot boolean, c int, again boolean"), "members")

    # the inner join drops what the filter let through in vain
    local = members.groupBy(*key, "c").agg(F.count(F.lit(1)).alias("g"), F.max("i").alias("k")).join(twice, fp)
    heads = members.where(F.col("t").isNotNull()).select(*fp, F.lit(0).alias("salt"), F.lit(False).alias("hot"), F.lit(0).alias("i"), "t", F.col("salt").alias("s0"), F.col("c").alias("c0"))
    across = (
        heads.repartition(*fp).sortWithinPartitions(*fp, "s0", "c0")
        .mapInArrow(_classes, "h1 bigint, h2 bigint, n bigint, salt int, hot boolean, i int, t string, s0 int, c0 int, c int, again boolean")
        .select(*fp, F.col("s0").alias("salt"), F.col("c0").alias("c"), F.col("c").alias("class"))
    )
    local = local.join(across, [*key, "c"], "left").withColumn("class", F.coalesce("class", "c"))
    # of the parts that hold the largest id the first keeps it
    total = local.groupBy(*fp, "class").agg(F.sum("g").alias("g"), F.max(F.struct("k", (-F.col("salt")).alias("s"))).alias("best"))
    group = local.select(*key, "c", "class").join(total, [*fp, "class"]).select(*key, "c", "g", F.col("best.k").alias("k"), (F.col("salt") == -F.col("best.s")).alias("first"))
    many = members.drop("t").join(group, [*key, "c"]).select("i", *xs, "k", "g", (F.col("i").eqNullSafe(F.col("k")) & F.col("first") & ~F.col("again")).alias("s"))
    return single.unionByName(many).select(F.col("i").alias(id_col), *[F.col(x).alias(n) for x, n in carried], F.col("k").alias("keep_id"), F.col("g").alias("group_size"), F.col("s").alias("kept"))
