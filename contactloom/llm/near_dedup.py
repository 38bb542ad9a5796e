"""Near-duplicate classes by MinHash, banding, verification and components.

1. A scan hashes each text's set of word shingles, takes the minima of 128
   universal hash functions and 32 band keys of four minima each.
2. Equal sets become one class, so copies cost nothing further.
3. In every band bucket all classes are paired with the least and the greatest
   of the bucket; pairs whose signatures cannot belong to similar sets go, the
   rest is confirmed on the full sets from the texts.  This joins the members
   of large groups without all their pairs.
4. Buckets that still hold several components are searched exactly, in blocks
   of bounded size: every pair across components whose signatures agree enough
   is compared on the full sets unless it has been joined
   meanwhile.  A block returns a tree of links, never its pairs.

A pair at the threshold misses all bands with probability (1 - 0.75**4)**32,
about 5e-6, and fails the signature test (55 % of the minima, over five
standard deviations below 75 %) with about 1e-6.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.llm.components import connected_components
from contactloom.llm.exact_dedup import binary_views
from contactloom.llm.tables import Bloom, col, field_type, leaving_little, stage

HASHES, ROWS = 128, 4
BANDS = HASHES // ROWS
#: Members of a bucket block; larger buckets are compared block by block.
BLOCK = 500
#: Words a worker remembers the hash of.
MOST_WORDS = 500_000


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


@cache
def family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    a, b = (rng.integers(0, 2**64, HASHES, np.uint64) for _ in range(2))
    return (a | np.uint64(1))[:, None], b[:, None]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


_known = _WordHashes()


def _forget() -> None:
    _known.clear()


def shingle_set(data: bytes, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word windows of a text in UTF-8.

    ASCII letters are lower-cased, words end at ASCII white space; fewer words
    than ``width`` make one shingle, none make an empty set.
    """
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_known) > MOST_WORDS:
        _known.clear()
    h = np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))
    take = min(width, len(words))
    n = len(words) - take + 1
    out = np.full(n, take, np.uint64)
    for k in range(take):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    return np.unique(mix(out))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minima of the hash family ``x -> high half of a * x + b``."""
    a, b = family()
    low = np.full(HASHES, 2**64 - 1, np.uint64)
    for at in range(0, len(shingles), 1024):
        v = a * shingles[at : at + 1024]
        v += b
        np.minimum(low, v.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[k::ROWS].astype(np.uint64))
    return key.view(np.int64)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 1024):
            part = b.slice(at, 1024)
            n, s1, s2, keys, small = [], [], [], [], []
            for data in binary_views(part.column("t")):
                sh = shingle_set(data.tobytes())
                n.append(len(sh))
                d = hashlib.blake2b(sh.tobytes(), digest_size=16).digest()
                s1.append(int.from_bytes(d[:8], "little", signed=True))
                s2.append(int.from_bytes(d[8:], "little", signed=True))
                if len(sh):
                    sig = signature(sh)
                    keys.append(band_keys(sig))
                    small.append(sig.astype(np.uint8).tobytes())
                else:
                    keys.append(np.zeros(0, np.int64))
                    small.append(b"")
            yield pa.RecordBatch.from_pydict({"i": part.column("i"), "n": pa.array(n, pa.int64()), "s1": pa.array(s1, pa.int64()), "s2": pa.array(s2, pa.int64()), "bands": pa.array(keys, pa.list_(pa.int64())), "sig": pa.array(small, pa.binary())})


def agreeing(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, percent: int) -> np.ndarray:
    """Pairs that may be similar: 20 points below the threshold in their minima, sizes within it."""
    near = (x == y).sum(axis=-1) * 100 >= (percent - 20) * HASHES
    return near & (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny))


def _signatures(values: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist()), np.uint8).reshape(len(values), HASHES)


def _promising(percent):
    def run(batches):
        for b in batches:
            keep = agreeing(_signatures(b.column("sa")), _signatures(b.column("sb")), b.column("na").to_numpy(), b.column("nb").to_numpy(), percent)
            yield b.select(["a", "b"]).filter(pa.array(keep))

    return run


def _groups(batches, columns, binary):
    """Rows sorted by (key, p, q), a group at a time, as arrays (lists for the ``binary`` columns)."""
    held = None
    for b in _then_none(batches):
        if b is not None:
            rows = {c: b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "p", "q", *columns)}
            rows |= {"sig": _signatures(b.column("sig"))}
            rows |= {c: [x.tobytes() for x in binary_views(b.column(c))] for c in binary}
            held = rows if held is None else {c: held[c] + rows[c] if c in binary else np.concatenate([held[c], rows[c]]) for c in held}
        if held is None:
            return
        change = np.flatnonzero((np.diff(held["key"]) != 0) | (np.diff(held["p"]) != 0) | (np.diff(held["q"]) != 0)) + 1
        cuts = [0, *change.tolist(), *([len(held["key"])] if b is None else [])]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            yield {c: v[lo:hi] for c, v in held.items()}
        held = {c: v[cuts[-1] :] for c, v in held.items()}


def _open_pairs(rows: dict, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Pairs of a group that may be similar and are in different components: a row and its partners."""
    n, comp, block, sig = rows["n"], rows["c"], rows["block"], rows["sig"]
    within = rows["p"][0] == rows["q"][0]
    for x in range(len(n) - 1):
        rest = slice(x + 1, None)
        apart = comp[rest] != comp[x]
        if not within:
            apart &= block[rest] != block[x]
        ys = np.flatnonzero(apart)
        if len(ys):
            ys += x + 1
            ys = ys[agreeing(sig[x], sig[ys], n[x], n[ys], percent)]
            if len(ys):
                yield x, ys


def _needed(percent):
    """The rows of every group that have a partner to be compared with."""

    def run(batches):
        for rows in _groups(batches, ("block", "c", "n", "i"), ()):
            hit = np.zeros(len(rows["n"]), bool)
            for x, ys in _open_pairs(rows, percent):
                hit[x] = True
                hit[ys] = True
            if hit.any():
                cols = {c: pa.array(rows[c][hit]) for c in ("key", "p", "q", "block", "c", "n", "i")}
                yield pa.RecordBatch.from_pydict(cols | {"sig": pa.array([x.tobytes() for x in rows["sig"][hit]], pa.binary())})

    return run


def _resolved(percent):
    """Links between the components of a group, compared on full sets.

    The shingles of a group are numbered, so that one gather and one sum give a
    row's intersections with all others.  What is joined already is not
    compared again: a group of similar texts gives a tree of links.
    """

    def run(batches):
        for rows in _groups(batches, ("block", "c", "n", "i"), ("t",)):
            # rows of one component begin joined
            _, root = np.unique(rows["c"], return_inverse=True)
            if root.max() == 0:
                continue
            sets = [shingle_set(t) for t in rows["t"]]
            sizes = np.array([len(x) for x in sets])
            names, flat = np.unique(np.concatenate(sets), return_inverse=True)
            starts = np.r_[0, np.cumsum(sizes)[:-1]]
            mark = np.zeros(len(names), np.int32)
            out = []
            for x, ys in _open_pairs(rows, percent):
                ys = ys[root[ys] != root[x]]
                if not len(ys):
                    continue
                own = flat[starts[x] : starts[x] + sizes[x]]
                mark[own] = 1
                both = np.add.reduceat(mark[flat], starts)[ys]
                mark[own] = 0
                for y in ys[100 * both >= percent * (sizes[x] + sizes[ys] - both)].tolist():
                    if root[x] != root[y]:
                        out.append(sorted((int(rows["i"][x]), int(rows["i"][y]))))
                        root[root == root[y]] = root[x]
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _then_none(batches):
    yield from batches
    yield None


def _confirmed(percent):
    """Rows (a, b, x, y) sorted by a: the pairs whose texts x and y have similar full sets."""

    def run(batches):
        last, known = None, None
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            left = b.column("a").to_pylist()
            for r, (x, y) in enumerate(zip(binary_views(b.column("x")), binary_views(b.column("y")), strict=True)):
                if left[r] != last:
                    last, known = left[r], shingle_set(x.tobytes())
                other = shingle_set(y.tobytes())
                both = len(np.intersect1d(known, other, assume_unique=True))
                keep[r] = 100 * both >= percent * (len(known) + len(other) - both) and both > 0
            yield b.select(["a", "b"]).filter(pa.array(keep))

    return run


def _listed(bloom):
    def run(batches):
        for b in batches:
            yield b.select(["i", "t"]).filter(pa.array(bloom.value.has(b.column("h1").to_numpy(), b.column("h2").to_numpy())))

    return run


def _texts_of(ids: DataFrame, src: DataFrame) -> DataFrame:
    """(i, t) of the listed ids, without shuffling the texts of most others."""
    halves = [F.pmod(F.xxhash64("i"), F.lit(2147483647)).alias("h1"), F.pmod(F.xxhash64(F.lit(1), "i"), F.lit(2147483647)).alias("h2")]
    bloom = src.sparkSession.sparkContext.broadcast(Bloom.build(ids.select("i").distinct().select(*halves), "h1", "h2"))
    return src.select("i", "t", *halves).mapInArrow(leaving_little(_listed(bloom)), "i bigint, t string").dropDuplicates(["i"])


def _confirm(pairs: DataFrame, src: DataFrame, percent: int) -> DataFrame:
    """Check pairs of ids on their texts."""
    one = _texts_of(pairs.select(F.col("a").alias("i")).union(pairs.select(F.col("b").alias("i"))), src)
    full = pairs.join(one.select(F.col("i").alias("b"), F.col("t").alias("y")), "b").join(one.select(F.col("i").alias("a"), F.col("t").alias("x")), "a")
    return full.select("a", "b", "x", "y").sortWithinPartitions("a").mapInArrow(leaving_little(_confirmed(percent), _forget), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75) -> DataFrame:
    """A row per input row: ``id_col``, ``n_shingles``, ``component_id``, ``kept``.

    Rows are linked when 100 * intersection >= percent * union of their sets of
    5-word shingles; a component's id is its least document id.  Texts without
    words, null ones too, are linked with nothing.  Full sets are compared by
    64-bit hashes of their shingles.  Ids are integers; rows that share an id
    must share the text (the pipeline's stage numbers its rows), repeated rows
    are kept alike.  A null id is its own component.  An empty table gives none.
    Of a text of any length all shingles are read.  Only the two named columns
    are read.
    """
    src = docs.select(col(id_col).cast("bigint").alias("i"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("t"))
    rows = stage(src.mapInArrow(leaving_little(_described, _forget), "i bigint, n bigint, s1 bigint, s2 bigint, bands array<bigint>, sig binary"), "described")
    real = rows.where("n > 0 and i is not null")
    classes = real.groupBy("s1", "s2").agg(F.min("i").alias("i"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    classes = stage(classes, "classes")
    texts = src.where("i is not null")
    signed = classes.select("i", "n", "sig").dropDuplicates(["i"])

    in_bands = classes.select("i", F.explode("bands").alias("key"))
    shared = in_bands.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("i").alias("lo"), F.max("i").alias("hi")).where("lo < hi")
    buckets = stage(in_bands.join(shared, "key"), "buckets")

    def screened(pairs: DataFrame) -> DataFrame:
        side = lambda s: signed.select(F.col("i").alias(s), F.col("n").alias(f"n{s}"), F.col("sig").alias(f"s{s}"))
        return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_promising(percent), "a bigint, b bigint")

    stars = buckets.select(F.col("lo").alias("a"), F.col("i").alias("b")).union(buckets.select(F.col("i").alias("a"), F.col("hi").alias("b"))).where("a < b").distinct()
    tested = stage(screened(stars), "stars")
    links = stage(_confirm(tested, texts, percent), "links")
    first = connected_components(links)

    labelled = buckets.join(first.withColumnRenamed("node", "i"), "i", "left").select("key", "i", "m", F.coalesce("component", "i").alias("c"))
    labelled = stage(labelled, "labelled")
    unsettled = labelled.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select("key")
    parts = F.expr(f"cast(m div {BLOCK} + 1 as int)")
    rest = labelled.join(unsettled, "key").join(signed, "i").withColumn("block", F.pmod(F.xxhash64("i"), parts).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))).withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other"))
    group = ["key", "p", "q"]
    rest = rest.select(*group, "block", "c", "n", "i", "sig").repartition(*group).sortWithinPartitions(*group)
    needed = stage(rest.mapInArrow(_needed(percent), "key bigint, p int, q int, block int, c bigint, n bigint, i bigint, sig binary"), "needed")
    found = links
    if needed.limit(1).count():
        with_text = needed.join(_texts_of(needed, texts), "i").select(*group, "block", "c", "n", "i", "sig", "t")
        found = links.unionByName(with_text.repartition(*group).sortWithinPartitions(*group).mapInArrow(leaving_little(_resolved(percent), _forget), "a bigint, b bigint"))
    final = connected_components(found).withColumnRenamed("node", "i")
    by_set = classes.select("s1", "s2", "i").join(final, "i", "left").select("s1", "s2", F.coalesce("component", "i").alias("c"))
    out = rows.select("i", "n", "s1", "s2").join(by_set, ["s1", "s2"], "left")
    component = F.when((F.col("n") > 0) & F.col("i").isNotNull(), F.col("c")).otherwise(F.col("i"))
    return out.select(F.col("i").cast(field_type(docs, id_col)).alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("i")).alias("kept"))
