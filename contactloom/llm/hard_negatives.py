"""Hard negatives by angular triangle filtering.

Every vector is rounded to integers and stored with its norm and its angles to
a few reference directions.  The angle between two vectors lies between the
difference and the sum of their angles to any reference, so the least of the
sums and the greatest of the differences give an interval of cosines, and, by
the norms, bounds of the score.  Angles are widened by more than the rounding
errors of their making, and bounds rounded outwards, so they are safe.  Only
pairs whose bounds reach into what is looked for get an integer inner product.

The anchors are compared with all rows in blocks: a task has one block of
anchors and one of rows, at most ``BLOCK`` of each, whatever their labels and
however many vectors are equal, and gives a few best rows for each anchor.  A
first pass finds the positives, the second the negatives in the window that
each positive's score opens.  The best of all blocks are taken by rank.

A row with a null label, a null vector or a null or non-finite component takes
no part.  Rows are told apart by place, so those that repeat an id, or all of
a row, are rows of their own; a null id is no anchor and comes last among equal
scores.  Missing components of shorter vectors count as zero; an empty vector
or one of zeros has score zero with all.  Scores beyond 64 bits raise an error.
An empty table gives an empty result; other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom.llm.tables import col, stage

#: Rows of a block, and anchors of a block.
BLOCK = 50_000
#: Blocks that the rows are dealt into at least, so that there is work for all.
LEAST_BLOCKS = 32
#: Reference directions: the first vectors by a hash.
REFERENCES = 12
#: Radians by which an interval of angles is widened: angles are kept in 32 bits, and a cosine's rounding moves one by 1e-7 at most.
ANGLE_SLACK = 2e-6
#: Cells of the arrays of bounds that a task makes at a time.
CELLS = 1 << 21
FOUND = "anchor bigint, positive bigint, row bigint, id bigint, score bigint"


def _matrix(column: pa.ChunkedArray | pa.Array, width: int, kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _angles(v: np.ndarray, norm: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Angles to the references (unit rows); a zero vector's are a right angle."""
    with np.errstate(divide="ignore", invalid="ignore"):
        unit = np.where(norm[:, None] > 0, v / norm[:, None], 0.0)
    return np.arccos(np.clip(unit @ refs.T, -1.0, 1.0)).astype(np.float32)


def _floor_256(x: Column) -> Column:
    """floor(256 * x) as a double; 64-bit integers are too small for large components."""
    y = x * 256.0
    return F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)


def prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, label_shift: tuple[int, int]) -> tuple[DataFrame, int]:
    """The rows that take part (row, id, label, anchor, v, norm, angles), and the number of components."""
    every, classes = label_shift
    whole = F.forall(col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != math.inf))
    usable = vectors.where(col(label_col).isNotNull() & F.coalesce(whole, F.lit(False)))
    label = col(label_col).cast("bigint")
    moved = F.when(col(id_col) % every == 0, (label + 1) % classes).otherwise(label)
    scaled = F.transform(col(vector_col), lambda x: _floor_256(x.cast("double")))
    rows = usable.select(F.monotonically_increasing_id().alias("row"), col(id_col).cast("bigint").alias("id"), moved.alias("label"), scaled.alias("x"))
    rows = stage(rows, "rounded")
    width = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    picked = rows.where(F.exists("x", lambda x: x != 0)).orderBy(F.xxhash64("id", "x"), "row").limit(REFERENCES).select("x").collect()
    refs = np.zeros((len(picked), max(width, 1)))
    for k, r in enumerate(picked):
        x = np.array(r["x"]) / np.abs(r["x"]).max()
        refs[k, : len(x)] = x / np.linalg.norm(x)

    def measured(batches):
        for b in batches:
            xs = b.column("x")
            lengths = np.diff(xs.offsets.to_numpy())
            v = np.zeros((b.num_rows, max(width, 1)))
            v[np.arange(v.shape[1]) < lengths[:, None]] = xs.flatten().to_numpy()
            norm = np.linalg.norm(v, axis=1)
            angles = _angles(v, norm, refs)
            yield pa.RecordBatch.from_pydict({"row": b.column("row"), "id": b.column("id"), "label": b.column("label"), "v": pa.array([x.tobytes() for x in v], pa.binary()), "norm": norm, "angles": pa.array([x.tobytes() for x in angles], pa.binary())})

    return stage(rows.mapInArrow(measured, "row bigint, id bigint, label bigint, v binary, norm double, angles binary"), "measured"), max(width, 1)


class Block:
    """Vectors of a block with their norms and angles, as arrays."""

    def __init__(self, t: pa.Table, width: int):
        self.row, self.label = t.column("row").to_numpy(), t.column("label").to_numpy()
        self.id = t.column("id")
        #: nulls sort last
        self.order = self.id.fill_null(np.iinfo(np.int64).max).to_numpy()
        self.v, self.norm = _matrix(t.column("v"), width), t.column("norm").to_numpy()
        n_refs = len(t.column("angles")[0].as_py()) // 4
        self.angles = _matrix(t.column("angles"), n_refs, np.float32) if n_refs else np.zeros((t.num_rows, 0), np.float32)

    def largest(self) -> float:
        return float(np.abs(self.v).max(initial=0.0))


def bounds(a: Block, rows: slice, b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each pair of an anchor and a row can have."""
    shape = (len(a.row[rows]), len(b.row))
    near, far = np.zeros(shape, np.float32), np.full(shape, np.pi, np.float32)
    for p, q in zip(a.angles[rows].T, b.angles.T, strict=True):
        np.maximum(near, np.abs(p[:, None] - q), out=near)
        both = p[:, None] + q
        np.minimum(far, np.minimum(both, np.float32(2 * np.pi) - both), out=far)
    size = a.norm[rows][:, None] * b.norm
    slack = 1.0 + 1e-9 * size
    low = np.floor(size * np.cos(np.minimum(far.astype(np.float64) + ANGLE_SLACK, np.pi)) - slack)
    high = np.ceil(size * np.cos(np.maximum(near.astype(np.float64) - ANGLE_SLACK, 0.0)) + slack)
    # a norm beyond the range of doubles bounds nothing
    return np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)


def scores(anchor: np.ndarray, v: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products: in doubles where no sum can pass 2**53, else in Python's integers."""
    if exact:
        return (v @ anchor).astype(np.int64)
    a = [int(x) for x in anchor]
    made = [sum(int(x) * y for x, y in zip(r, a, strict=True)) for r in v]
    if any(not -(1 << 63) <= s < 1 << 63 for s in made):
        raise ValueError("a score is beyond 64 bits")
    return np.array(made, np.int64)


def _top(score: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best by score, then by id."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= least)
    else:
        some = np.arange(len(score))
    return some[np.lexsort((order[some], -score[some]))[:k]]


def _kth(values: np.ndarray, k: int) -> float:
    """The ``k``-th greatest value, or minus infinity."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -math.inf


def _search(width: int, look: Callable) -> Callable:
    """A function of a block of anchors and one of rows: ``look`` gives for one anchor (positive, places, scores)."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: dict[str, list] = {n: [] for n in ("anchor", "positive", "row", "id", "score")}
        if anchors.num_rows and rows.num_rows:
            a, b = Block(anchors, width), Block(rows, width)
            exact = a.largest() * b.largest() * width < 1 << 53
            windows = anchors.column("windows").to_pylist() if "windows" in anchors.column_names else None
            at_once = max(1, CELLS // len(b.row))
            for start in range(0, len(a.row), at_once):
                part = slice(start, start + at_once)
                low, high = bounds(a, part, b)
                for k in range(len(low)):
                    at = start + k
                    for positive, places, score in look(a, at, b, low[k], high[k], exact, windows[at] if windows else None):
                        out["anchor"].append(np.full(len(places), a.row[at]))
                        out["positive"].append(np.full(len(places), positive))
                        out["row"].append(b.row[places])
                        out["id"].append(b.id.take(pa.array(places)).combine_chunks())
                        out["score"].append(score)
        ids = out.pop("id")
        made = {n: pa.array(np.concatenate(c) if c else [], pa.int64()) for n, c in out.items()}
        made["id"] = pa.chunked_array(ids, pa.int64()).combine_chunks() if ids else pa.array([], pa.int64())
        return pa.Table.from_pydict({n: made[n] for n in ("anchor", "positive", "row", "id", "score")})

    return run


def _positives(k: int) -> Callable:
    def look(a, at, b, low, high, exact, _):
        same = np.flatnonzero((b.label == a.label[at]) & (b.row != a.row[at]))
        if len(same):
            maybe = same[high[same] >= _kth(low[same], k)]
            score = scores(a.v[at], b.v[maybe], exact)
            best = _top(score, b.order[maybe], k)
            yield -1, maybe[best], score[best]

    return look


def _negatives(k: int) -> Callable:
    def look(a, at, b, low, high, exact, windows):
        other = b.label != a.label[at]
        spans = [(w["positive"], w["least"], w["most"]) for w in windows or () if w["least"] <= w["most"]]
        reach = []
        for _, least, most in spans:
            inside = other & (low >= least) & (high <= most)
            # k rows that surely lie in the window leave no place for those that are surely below them
            reach.append(other & (high >= max(least, _kth(low[inside], k))) & (low <= most))
        if not spans:
            return
        maybe = np.flatnonzero(np.logical_or.reduce(reach))
        score = scores(a.v[at], b.v[maybe], exact)
        for positive, least, most in spans:
            fits = np.flatnonzero((score >= least) & (score <= most))
            best = fits[_top(score[fits], b.order[maybe[fits]], k)]
            if len(best):
                yield positive, maybe[best], score[best]

    return look


def _in_blocks(anchors: DataFrame, rows: DataFrame, width: int, look: Callable, n_rows: int, n_anchors: int) -> DataFrame:
    """Every block of anchors with every block of rows."""
    of, by = max(LEAST_BLOCKS, -(-n_rows // BLOCK)), max(1, -(-n_anchors // BLOCK))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    mine = F.pmod(F.xxhash64("row"), F.lit(by)).cast("int").alias("ab")
    # columns of their own: the two sides come from one table
    a = anchors.select(*[F.col(c).alias(c) for c in anchors.columns], mine).select("*", each(of).alias("rb"))
    b = rows.select("*", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(of)).cast("int").alias("rb")).select("*", each(by).alias("ab"))
    return a.groupBy("ab", "rb").cogroup(b.groupBy("ab", "rb")).applyInArrow(_search(width, look), FOUND)


def mine_negatives(
    vectors: DataFrame, anchor_every: int = 50, positives: int = 5, negatives: int = 3, floor_percent: int = 50, ceiling_percent: int = 95,
    label_shift: tuple[int, int] = (7, 10), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id ``anchor_every`` divides; their positives the
    best ``positives`` other rows of their label; the negatives of both the
    best ``negatives`` rows of other labels whose score is from
    ``floor_percent`` to ``ceiling_percent`` of the positive's.  Where
    ``label_shift[0]`` divides an id, its label first becomes the next one of
    ``label_shift[1]``.
    """
    rows, width = prepared(vectors, id_col, vector_col, label_col, label_shift)
    anchors = rows.where(F.col("id") % anchor_every == 0)
    n_rows, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if(F.col("id") % anchor_every == 0)).first()
    best = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row"))

    first = _in_blocks(anchors, rows, width, _positives(positives), n_rows, n_anchors).withColumn("k", best("anchor")).where(F.col("k") <= positives)
    first = stage(first.select("anchor", F.col("row").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # the least and the greatest score s with floor * p <= 100 * s <= ceiling * p
    least, most = F.ceil(F.col("positive_score").cast("decimal(38,0)") * floor_percent / 100), F.floor(F.col("positive_score").cast("decimal(38,0)") * ceiling_percent / 100)
    windows = first.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("positive", least.cast("bigint").alias("least"), most.cast("bigint").alias("most"))).alias("windows"))
    with_windows = stage(anchors.join(windows, "row"), "windows")
    second = _in_blocks(with_windows, rows, width, _negatives(negatives), n_rows, n_anchors).withColumn("rank", best("anchor", "positive")).where(F.col("rank") <= negatives)
    named = second.join(first, ["anchor", "positive"]).join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return named.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
