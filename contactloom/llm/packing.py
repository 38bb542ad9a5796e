"""Best-fit packing of tokenized documents after dominance reduction.

Only the histogram of piece lengths, at most ``capacity`` rows whatever the
corpus, decides the packing.  On it the driver

1. fixes sets that provably dominate all alternatives (Martello and Toth) and
   removes them from the instance,
2. packs what remains best fit, longest first, many equal bins at a time,

and gets a plan of at most a few slots per length.  Pieces then look up their
place by their rank among the pieces of the same length; ranks come from a
window over (length, bucket) plus bucket totals, and there are as many buckets
as the pieces need, so that no length, however frequent, is ordered in one task.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contactloom.llm.tables import col, field_type, leaving_little, stage
from contactloom.llm.tokens import WordEncoder

#: Buckets into which the pieces of one length are cut for ranking: so many at least, and one for so many pieces.
BUCKETS, BUCKET_ROWS = 256, 100_000


# ---------------------------------------------------------------- the plan
def _remove(left: dict[int, int], sizes: list[int], used: list[int], times: int) -> None:
    for s in used:
        left[s] -= times
        if not left[s]:
            del left[s]
            sizes.pop(bisect.bisect_left(sizes, s))


def reduce_instance(left: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Fix dominating sets; ``left`` (size -> count) keeps the rest.

    A set with the item j dominates another feasible set with j if the other's
    items can be put, in groups, in place of single items of the first.  Sets
    of up to three items are tried:

    * {j} if nothing fits beside j,
    * {j, k} for the largest k beside j if k fills the bin exactly, if only one
      more item fits, or if only two more fit and no pair exceeds k,
    * {j, k, s} if only two more fit, s is the largest beside j and k, and no
      two items above s fit beside j.

    Each test stays true while its items last, as the alternatives only shrink,
    so equal sets are fixed together.
    """
    sizes = sorted(left)
    fixed: list[tuple[int, tuple[int, ...]]] = []
    at = len(sizes) - 1
    while at >= 0:
        j = sizes[at]
        room = capacity - j

        def count(s: int, j: int = j) -> int:
            return left[s] - (s == j)

        def smallest(k: int, above: int = 0, count=count) -> int:
            """The sum of the k smallest items beside j that exceed ``above``."""
            total, need = 0, k
            for s in sizes[bisect.bisect_right(sizes, above) :]:
                take = min(need, count(s))
                total, need = total + take * s, need - take
                if not need:
                    return total
            return capacity + 1

        def largest(most: int, without: int = 0, count=count) -> int:
            """The largest item of at most ``most`` beside j and ``without``."""
            i = bisect.bisect_right(sizes, most) - 1
            while i >= 0 and count(sizes[i]) - (sizes[i] == without) < 1:
                i -= 1
            return sizes[i] if i >= 0 else 0

        k = largest(room)
        used: list[int] | None = None
        if not k:
            used = [j]
        elif k == room or smallest(2) > room:
            used = [j, k]
        elif smallest(3) > room:
            # the best pair within the room, by two pointers over the sizes
            there = [s for s in sizes[: bisect.bisect_right(sizes, room)] if count(s)]
            best, lo, hi = 0, 0, len(there) - 1
            while lo <= hi:
                a, b = there[lo], there[hi]
                if a + b > room:
                    hi -= 1
                    continue
                if a < b or count(a) > 1:
                    best = max(best, a + b)
                lo += 1
            s = largest(room - k, k)
            if best <= k:
                used = [j, k]
            elif s and smallest(2, s) > room:
                used = [j, k, s]
        if used is None:
            at -= 1
            continue
        need = defaultdict(int)
        for s in used:
            need[s] += 1
        times = min(left[s] // n for s, n in need.items())
        fixed.append((times, tuple(sorted(used, reverse=True))))
        _remove(left, sizes, used, times)
        at = min(at, len(sizes) - 1)
        while at + 1 < len(sizes) and sizes[at] < j:
            at += 1
        at = min(bisect.bisect_right(sizes, j) - 1, len(sizes) - 1)
    return fixed


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Best fit, longest first; bins with the same content are kept as one row with a count."""
    bins: dict[int, list[list]] = defaultdict(list)  # room -> [count, content]
    rooms: list[int] = []

    def put(room: int, count: int, content: tuple) -> None:
        if count:
            if not bins[room]:
                bisect.insort(rooms, room)
            bins[room].append([count, content])

    for s in sorted(left, reverse=True):
        n = left[s]
        while n:
            i = bisect.bisect_left(rooms, s)
            if i < len(rooms):
                room = rooms[i]
                count, content = bins[room].pop()
                if not bins[room]:
                    rooms.pop(i)
            else:
                # new bins, as many as the rest of this size needs
                room, count, content = capacity, -(-n // (capacity // s)), ()
            each = room // s  # one by one, best fit would fill the same bin until s no longer fits
            full = min(count, n // each)
            put(room - each * s, full, (*content, (s, each)))
            n, count = n - full * each, count - full
            if count and n:
                put(room - n * s, 1, (*content, (s, n)))
                n, count = 0, count - 1
            if content:
                put(room, count, content)
    return [(c, content) for room in rooms for c, content in bins[room]]


def plan_packing(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, dict]:
    """Slots (length, first rank, first sequence, copies a bin, offset), sorted, and totals.

    The rank r of a length belongs to the last slot with first rank <= r; with
    q = r - first rank it goes to sequence ``first + q // copies`` at
    ``offset + q % copies * length``.
    """
    left = {int(s): int(n) for s, n in histogram.items() if n}
    fixed = reduce_instance(left, capacity)
    groups = []
    for times, used in fixed:
        content: list[list[int]] = []
        for s in used:
            if content and content[-1][0] == s:
                content[-1][1] += 1
            else:
                content.append([s, 1])
        groups.append((times, tuple((s, c) for s, c in content)))
    reduced = sum(t for t, _ in groups)
    groups += best_fit(left, capacity)
    ranks: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for times, content in groups:
        offset = 0
        for s, copies in content:
            rows.append((s, ranks[s], sequence, copies, offset))
            ranks[s] += times * copies
            offset += s * copies
        sequence += times
    slots = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return slots, {"sequences": sequence, "fixed": reduced, "tokens": sum(s * n for s, n in histogram.items())}


# ---------------------------------------------------------------- Spark side
def token_pieces(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Tokenize every document, add ``end_id``, cut what exceeds ``capacity``.

    Returns a row per piece: ``id_col``, ``piece``, ``start``, ``length``,
    ``ids_crc32`` (of the unsigned little-endian 32-bit ids) and, if asked for,
    ``ids``.  A null text counts as empty, so it is the piece ``[end_id]``.
    Null ids are kept, repeated rows give pieces of their own, an empty table
    none.  Only the two named columns are read.
    """
    end = np.array([end_id], "<u4").tobytes()
    unit = 4 * capacity

    def run(batches):
        encode = WordEncoder.of(tokenizer_file)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                rows, piece, start, length, crc, values = [], [], [], [], [], []
                for r, ids in enumerate(encode(part.column("t").to_pylist())):
                    ids += end
                    for k in range(0, len(ids), unit):
                        cut = ids[k : k + unit]
                        rows.append(r)
                        piece.append(k // unit)
                        start.append(k // 4)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                        if keep_ids:
                            values.append(np.frombuffer(cut, "<i4"))
                out = {"i": part.column("i").take(pa.array(rows, pa.int64())), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "crc": pa.array(crc, pa.int64())}
                if keep_ids:
                    out["ids"] = pa.array(values, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(out)

    src = docs.select(col(id_col).alias("i"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("t"))
    out = src.mapInArrow(leaving_little(run, lambda: WordEncoder.of(tokenizer_file).rest()), f"i {field_type(docs, id_col)}, piece int, start bigint, length bigint, crc bigint" + ", ids array<int>" * keep_ids)
    return out.select(F.col("i").alias(id_col), "piece", "start", "length", F.col("crc").alias("ids_crc32"), *["ids"] * keep_ids)


def pack(pieces: DataFrame, capacity: int = 2048, length_col: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of 1 to ``capacity`` tokens.

    The pieces are written once, as ranks must not change when a task is
    repeated.  Only the length is read, and all columns are kept; one that is
    called like a new one is an error, other names do not matter.  Pieces of
    equal length are interchangeable, equal rows are pieces of their own, a
    null length is an error, and an empty table packs into nothing.
    """
    if clash := {"sequence_id", "offset"} & set(pieces.columns):
        raise ValueError(f"columns in the way: {sorted(clash)}")
    given = [(f"x{k}", name) for k, name in enumerate(pieces.columns)]
    rows = pieces.select(*[col(n).alias(x) for x, n in given], col(length_col).cast("bigint").alias("s"), F.monotonically_increasing_id().alias("no"))
    rows = stage(rows, "pieces")
    histogram = {r["s"]: r["n"] for r in rows.groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(s is None or not 1 <= s <= capacity for s in histogram):
        raise ValueError("a piece must have 1 to capacity tokens")
    slots, _ = plan_packing(histogram, capacity)
    shared = rows.sparkSession.sparkContext.broadcast(slots)
    buckets = max(BUCKETS, -(-sum(histogram.values()) // BUCKET_ROWS))
    rows = rows.withColumn("b", F.pmod(F.xxhash64("no"), F.lit(buckets)))
    counts = rows.groupBy("s", "b").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, -1))
    before = counts.select(F.col("s").alias("s1"), F.col("b").alias("b1"), F.coalesce(earlier, F.lit(0)).alias("n0"))
    within = F.row_number().over(Window.partitionBy("s", "b").orderBy("no"))
    ranked = rows.withColumn("within", within).join(before, (F.col("s") == F.col("s1")) & (F.col("b") == F.col("b1")))
    ranked = ranked.select(*[x for x, _ in given], "s", (F.col("within") - 1 + F.col("n0")).cast("bigint").alias("r"))

    def place(batches):
        table = shared.value
        # a slot is found by one search on (length, rank)
        key = table[:, 0] << 48 | table[:, 1]
        for b in batches:
            s, r = b.column("s").to_numpy(), b.column("r").to_numpy()
            found = table[np.searchsorted(key, s << 48 | r, side="right") - 1]
            q = r - found[:, 1]
            cols = {n: b.column(n) for n in b.schema.names if n not in ("s", "r")}
            yield pa.RecordBatch.from_pydict(cols | {"sequence_id": pa.array(found[:, 2] + q // found[:, 3]), "offset": pa.array(found[:, 4] + q % found[:, 3] * s)})

    kinds = StructType(ranked.schema.fields[: len(given)] + StructType.fromDDL("sequence_id bigint, offset bigint").fields)
    return ranked.mapInArrow(place, kinds).select(*[F.col(x).alias(n) for x, n in given], "sequence_id", "offset")
