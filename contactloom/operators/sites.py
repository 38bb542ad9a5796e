"""Restriction sites in contigs, and the windows around them."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contactloom.operators.ordinals import dense_ordinal
from contactloom.session import ship_package, spread, stage

SMALL_CONTIG = 1000


def _hits(text: str, motif: str) -> np.ndarray:
    """Where the motif begins in a text, overlaps too, in code points."""
    coded = (lambda x: np.frombuffer(x.encode(), np.uint8)) if text.isascii() and motif.isascii() else (lambda x: np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32))
    a, m = coded(text), coded(motif)
    n = len(a) - len(m) + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    at = a[:n] == m[0]
    for k in range(1, len(m)):
        at &= a[k : n + k] == m[k]
    return np.flatnonzero(at)


def _overlaps_itself(motif: str) -> bool:
    return any(motif[k:] == motif[:-k] for k in range(1, len(motif)))


#: Runs of matches that overlap from which on they are looked at together.
FEW_RUNS = 8


def _leftmost(places: np.ndarray, free: int, step: int) -> tuple[np.ndarray, int]:
    """Matches from the left that do not overlap, the first at ``free`` or later, and where the last ends.

    Runs of matches that overlap are looked at together: in each round all of
    them take their first match that is free.
    """
    places = places[np.searchsorted(places, free) :]
    if not len(places):
        return places, free
    if (places[1:] - places[:-1] >= step).all():
        return places, max(free, int(places[-1]) + step)
    first = np.flatnonzero(np.r_[True, places[1:] - places[:-1] >= step])
    ends, at, taken = np.r_[first[1:], len(places)], first, np.zeros(len(places), bool)
    while len(at) > FEW_RUNS:
        taken[at] = True
        at = np.searchsorted(places, places[at] + step)
        ends, at = ends[at < ends], at[at < ends]
    # of few runs, which may be long, each match by itself
    for a, b in zip(at.tolist(), ends.tolist(), strict=True):
        after = 0
        for k, p in enumerate(places[a:b].tolist(), a):
            if p >= after:
                taken[k], after = True, p + step
    chosen = places[taken]
    return chosen, max(free, int(chosen[-1]) + step)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    """A list of numbers in each row."""
    offsets = np.cumsum([0, *(len(a) for a in arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays]).astype(np.int64)))


#: Matches that a batch of rows has at about the most.
MATCHES = 1 << 20


def _searched(motif: str) -> Callable:
    """For each sequence the places of leftmost matches that do not overlap."""
    overlaps, step = _overlaps_itself(motif), len(motif)

    def run(batches):
        for b in batches:
            seqs, first, held, n = b.column("seq"), 0, [], 0
            for k in range(b.num_rows):
                places = _hits(seqs[k].as_py() or "", motif)
                held.append(_leftmost(places, 0, step)[0] if overlaps else places)
                n += len(held[-1])
                if n >= MATCHES or k + 1 == b.num_rows:
                    part = b.slice(first, len(held))
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("contig_ord", "name", "length")), _lists(held)], names=["contig_ord", "name", "length", "places"])
                    first, held, n = k + 1, [], 0

    return run


def find_sites(contigs: DataFrame, motif: str) -> DataFrame:
    """Leftmost non-overlapping matches: contig_ord, name, length, site_ord, pos (from 0).

    A sequence is searched where it is; nothing is shuffled.
    """
    ship_package(contigs.sparkSession)
    rows = contigs.select(F.col("contig_ord").cast("bigint").alias("contig_ord"), "name", F.col("length").cast("bigint").alias("length"), "seq")
    found = rows.mapInArrow(_searched(motif), "contig_ord bigint, name string, length bigint, places array<bigint>")
    each = found.select("contig_ord", "name", "length", F.posexplode("places").alias("site_ord", "pos"))
    return each.select("contig_ord", "name", "length", F.col("site_ord").cast("bigint").alias("site_ord"), "pos")


def _packed(places: np.ndarray) -> bytes:
    """Ascending places in a chunk as steps of four bytes each, which compress well."""
    return np.diff(places, prepend=0).astype("<u4").tobytes()


def _unpacked(places: bytes, more: list[int] | None) -> np.ndarray:
    """Places in a chunk, with those of ``more`` after them."""
    found = np.cumsum(np.frombuffer(places, "<u4"), dtype=np.int64)
    return np.r_[found, np.array(more, np.int64)] if more else found


def _scanned(motif: str) -> Callable:
    """For each chunk its size, its ends of a motif's length less one, and where the motif begins in it, overlaps too, packed."""
    edge = len(motif) - 1

    def run(batches):
        for b in batches:
            seqs = b.column("seq").to_pylist()
            found = [_packed(_hits(seq, motif)) for seq in seqs]
            ends = [(s[:edge], s[max(len(s) - edge, 0) :] if edge else "") for s in seqs]
            yield pa.RecordBatch.from_pydict({
                "contig_ord": b.column("contig_ord"), "start": b.column("start"), "size": pa.array([len(s) for s in seqs], pa.int64()),
                "head": pa.array([h for h, _ in ends], pa.string()), "tail": pa.array([t for _, t in ends], pa.string()), "places": pa.array(found, pa.binary()),
            })

    return run


def _transitions(step: int) -> Callable:
    """How many bases after a chunk's end are covered by a match, for each number of bases covered at its start."""

    def run(batches):
        for b in batches:
            made = []
            for size, places, more in zip(*(b.column(c).to_pylist() for c in ("size", "places", "more")), strict=True):
                at = _unpacked(places, more)
                made.append([max(0, _leftmost(at, d, step)[1] - size) for d in range(step)])
            yield pa.RecordBatch.from_pydict({"contig_ord": b.column("contig_ord"), "start": b.column("start"), "next": pa.array(made, pa.list_(pa.int32()))})

    return run


def _entered(rows: pa.Table) -> pa.Table:
    """The bases covered at the start of each chunk of a contig: its transitions applied one after the other."""
    rows, covered, out = rows.sort_by("start"), 0, []
    for after in rows.column("next").to_pylist():
        out.append(covered)
        covered = after[covered]
    return pa.Table.from_pydict({"contig_ord": rows.column("contig_ord"), "start": rows.column("start"), "covered": pa.array(out, pa.int32())})


def _chosen(step: int) -> Callable:
    """The places that are matches, packed, and their number."""

    def run(batches):
        for b in batches:
            made = [_leftmost(_unpacked(*row), covered, step)[0] for *row, covered in zip(*(b.column(c).to_pylist() for c in ("places", "more", "covered")), strict=True)]
            yield pa.RecordBatch.from_pydict({"contig_ord": b.column("contig_ord"), "start": b.column("start"), "n": pa.array([len(a) for a in made], pa.int64()), "places": pa.array([_packed(a) for a in made], pa.binary())})

    return run


def _listed(batches):
    """Packed places as lists from the contig's start, with the number of the first."""
    for b in batches:
        for k in range(b.num_rows):
            places = _unpacked(b.column("places")[k].as_py(), None) + b.column("start")[k].as_py()
            for at in range(0, len(places), MATCHES):
                before = b.column("before")[k].as_py() + at
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(k, 1) for c in ("contig_ord", "name", "length")), pa.array([before], pa.int64()), _lists([places[at : at + MATCHES]])], names=["contig_ord", "name", "length", "before", "places"])


def find_sites_in_chunks(contigs: DataFrame, chunks: DataFrame, motif: str) -> DataFrame:
    """As ``find_sites``, of contigs (contig_ord, name, length) whose sequence is in chunks (contig_ord, start, seq).

    Chunks are searched where they are.  Matches across their borders are found
    in the ends of neighbours, short strings that are gathered per contig.  A
    motif that can overlap itself is matched from the left over the whole
    contig: for each chunk there is a table from the bases covered at its start
    to those covered after its end; applied in order they say where the
    matching goes on in each chunk.  What is gathered per contig is a row of a
    few numbers for each chunk.
    """
    ship_package(contigs.sparkSession)
    step = len(motif)
    scanned = stage(chunks.select("contig_ord", "start", "seq").mapInArrow(_scanned(motif), "contig_ord bigint, start bigint, size bigint, head string, tail string, places binary"), "scanned")
    in_order = Window.partitionBy("contig_ord").orderBy("start")
    chunk = ["contig_ord", "start"]
    found = spread(scanned.select("contig_ord", "start", "size", "places"), *chunk)
    if step > 1:
        after = F.array_join(F.collect_list("head").over(in_order.rowsBetween(1, step - 1)), "")
        pairs = scanned.select("contig_ord", "start", "size", "tail", F.concat("tail", F.substring(after, 1, step - 1)).alias("both"))
        n = F.length("tail")
        here = F.filter(F.sequence(F.lit(0), n - 1), lambda k: F.substring(F.col("both"), k + 1, F.lit(step)) == motif)
        across = pairs.where(n > 0).select("contig_ord", "start", F.transform(here, lambda k: F.col("size") - n + k).alias("more")).where(F.size("more") > 0)
        found = found.join(across, chunk, "left")
    else:
        found = found.withColumn("more", F.lit(None).cast("array<bigint>"))
    if _overlaps_itself(motif):
        found = stage(found, "matches")
        steps = found.mapInArrow(_transitions(step), "contig_ord bigint, start bigint, next array<int>")
        entered = steps.groupBy("contig_ord").applyInArrow(_entered, "contig_ord bigint, start bigint, covered int")
        found = spread(found, *chunk).join(entered, chunk)
    else:
        found = found.withColumn("covered", F.lit(0))
    taken = found.select("contig_ord", "start", "places", "more", "covered").mapInArrow(_chosen(step), "contig_ord bigint, start bigint, n bigint, places binary")
    taken = stage(taken.where("n > 0"), "sites")
    before = F.coalesce(F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = taken.select("contig_ord", "start", before.alias("before")).join(contigs.select("contig_ord", "name", "length"), "contig_ord")
    rows = spread(taken, *chunk).join(counted, chunk).select("contig_ord", "name", "length", "start", "before", "places")
    each = rows.mapInArrow(_listed, "contig_ord bigint, name string, length bigint, before bigint, places array<bigint>")
    each = each.select("contig_ord", "name", "length", "before", F.posexplode("places").alias("k", "pos"))
    return each.select("contig_ord", "name", "length", (F.col("before") + F.col("k")).cast("bigint").alias("site_ord"), "pos")


def count_sites(sites: DataFrame) -> DataFrame:
    """Nodes: contigs with a site, numbered in contig order."""
    counted = sites.groupBy("contig_ord", "name", "length").agg(F.count(F.lit(1)).alias("site_count"))
    numbered = dense_ordinal(counted, "node_id", [F.col("contig_ord")])
    return numbered.select("node_id", "contig_ord", "name", "site_count", "length")


def site_windows(sites: DataFrame, nodes: DataFrame, motif_length: int, flank: int = 500) -> DataFrame:
    """What counts as near each site, both ends included; windows are not merged."""
    pos, end = F.col("pos"), F.col("length")
    start = F.when(end < SMALL_CONTIG, 0).when(pos < flank, 0).otherwise(pos - flank)
    stop = (
        F.when(end < SMALL_CONTIG, end)
        .when(pos < flank, pos + motif_length + flank)
        .when(pos + motif_length > end - flank, end)
        .otherwise(pos + flank)
    )
    near = sites.select("contig_ord", "name", "site_ord", start.cast("bigint").alias("win_start"), stop.cast("bigint").alias("win_end"))
    return near.join(nodes.select("contig_ord", "node_id"), "contig_ord").select("node_id", "name", "site_ord", "win_start", "win_end")
