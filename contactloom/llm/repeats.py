"""Removal of long repeated byte strings by depth-limited radix passes.

Every window of ``length`` bytes belongs to one place in it, chosen by content:
the least hash of the 128-byte strings that begin in its first half (winnowing),
so equal windows have their place at the same distance.  Only these places,
about one byte in 65, stand for suffixes; they are told apart digit by digit,
most significant first, and classes of one go after each pass:

1. The first digit of a place is its 128 bytes.  A scan counts them; places
   alone in their class are unique.
2. The second digit is the suffix up to the depth that all windows of a place
   have in common (272 bytes for 400), the third all that its own windows
   cover.  Places equal in all three have every window repeated.
3. Places that share the suffix but not what their windows cover are told apart
   by zones of 8 windows: again by what the windows of a zone have in common,
   then by all that they cover.
4. What is still open in a zone is told apart window by window, at full depth.
   Equal groups are exactly the repeated windows.

Passes ship digits as 64-bit hashes with a place, 40 to 60 bytes; each is
compared only within the class that the digits before made.  Every count
combines before its shuffle and every join back is on the digit alone, so a
class of any size is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.llm.exact_dedup import binary_views
from contactloom.llm.near_dedup import mix
from contactloom.llm.tables import Bloom, col, field_type, stage

GRAM = 128
#: A shared string of so many bytes always holds a common place.
REACH = 256
#: Windows of a zone.
ZONE = 8
#: Below the length of 1,024 at which polynomials modulo 2**64 begin to have systematic collisions.
MOST = 720
BASE = 0x9E3779B97F4A7C15 | 1
#: Bytes hashed at a time; longer texts are scanned in overlapping tiles.
SLICE = 1 << 18
#: Bits of the filters that keep unique places and texts out of shuffles, 4 MB each.
BLOOM_BITS = 1 << 25


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, BASE, np.uint64)
    down = np.full(n + 1, pow(BASE, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Hashed:
    """Hashes of any substring of a byte array."""

    def __init__(self, data: np.ndarray):
        size = SLICE * 2
        while size < len(data):
            size *= 2
        up, self.down = powers(size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def salted(hashes: np.ndarray, *numbers: np.ndarray) -> np.ndarray:
    """Hashes that also tell small numbers apart."""
    for n in numbers:
        hashes = mix(hashes + (n.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    return hashes


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """The least (np.minimum) or greatest (np.maximum) of every ``width`` values in a row."""
    n = len(x)
    fill = np.uint64(2**64 - 1) if pick is np.minimum else np.uint64(0)
    padded = np.full(-(-n // width) * width, fill, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    behind = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[: n - width + 1], ahead[width - 1 : n])


class Places:
    """Content-chosen places of some texts.

    ``low`` to ``high`` are the distances from the starts of the windows that a
    place owns; a place without any has high < low.
    """

    def __init__(self, texts: list[np.ndarray], length: int):
        self.length, self.reach = length, min(REACH, length)
        self.width = width = self.reach - GRAM + 1
        margin = 2 * length
        tiles, parts, base = [], [], 0  # (text, first byte in it, place in data, bytes, core)
        for r, t in enumerate(texts):
            for lo in range(0, len(t), SLICE) if len(t) >= self.reach else ():
                hi = min(lo + SLICE, len(t))
                a, z = max(0, lo - margin), min(len(t), hi + margin)
                tiles.append((r, a, base, z - a, lo, hi, len(t)))
                parts.append(t[a:z])
                base += z - a
        none = np.zeros(0, np.int64)
        self.text = self.pos = self.low = self.high = self.at = none
        self.first = none.view(np.uint64)
        self.data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        if not tiles:
            return
        self.hashed = Hashed(self.data)
        grams = self.hashed.of(slice(0, base - GRAM + 1), slice(GRAM, base + 1))
        low = sliding(grams, width, np.minimum)  # the least of every window's first half
        for _, _, b, size, *_ in tiles:
            low[max(b, b + size - self.reach + 1) : b + size] = 0  # windows that leave the text
        top = np.zeros(len(grams) + width - 1, np.uint64)
        top[width - 1 : width - 1 + len(low)] = low
        at = np.flatnonzero(sliding(top, width, np.maximum) == grams)
        first = grams[at]
        # a window belongs to the leftmost of its least strings: runs of windows with one least value
        begin = np.r_[0, np.flatnonzero(low[1:] != low[:-1]) + 1]
        end = np.r_[begin[1:] - 1, len(low) - 1]
        same = np.r_[False, (first[1:] == first[:-1]) & (np.diff(at) < width)]
        since = np.maximum(at - width + 1, np.where(same, np.r_[0, at[:-1] + 1], 0))
        run = np.searchsorted(begin, since, side="right") - 1
        while True:
            on = (run < len(begin) - 1) & (low[begin[run]] != first)
            on &= begin[np.minimum(run + 1, len(begin) - 1)] <= at
            if not on.any():
                break
            run[on] += 1
        from_, upto = np.maximum(since, begin[run]), np.minimum(at, end[run])
        upto = np.where(low[begin[run]] == first, upto, from_ - 1)
        t = np.array(tiles, np.int64)
        tile = t[np.searchsorted(t[:, 2], at, side="right") - 1]
        shift = tile[:, 1] - tile[:, 2]
        pos, size = at + shift, tile[:, 6]
        self.low = pos - np.minimum(upto + shift, size - length)
        self.high = pos - np.maximum(from_ + shift, 0)
        ok = (pos >= tile[:, 4]) & (pos < tile[:, 5]) & (upto >= from_)
        self.text, self.pos, self.low, self.high, self.at, self.first = (x[ok] for x in (tile[:, 0], pos, self.low, self.high, at, first))

    def suffix(self, which: np.ndarray) -> np.ndarray:
        """The second digit: what all windows of a place have in common, whichever it owns."""
        at = self.at[which]
        return self.hashed.of(at, at + self.length - self.width + 1)

    def covered(self, which: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """All that the windows at distances ``low`` to ``high`` cover."""
        at = self.at[which]
        return salted(self.hashed.of(at - high, at - low + self.length), low, high)


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    held, size, at = [], 0, 0
    for r, t in enumerate(binary_views(batch.column("t"))):
        if held and size + len(t) > SLICE:
            yield at, held
            held, size, at = [], 0, r
        held.append(t)
        size += len(t)
    if held:
        yield at, held


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as disjoint runs; touching ones join."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
    return start[new], end[np.r_[new[1:] - 1, len(end) - 1]] if len(start) else end


def _row(columns: dict) -> pa.RecordBatch:
    """Hashes travel as signed integers."""
    return pa.RecordBatch.from_pydict({c: pa.array(v.view(np.int64) if v.dtype == np.uint64 else v.astype(np.int64)) for c, v in columns.items()})


def _first_digits(length):
    """(d1, c): the first digits of each slice and how often they occur there."""

    def run(batches):
        for b in batches:
            for _, texts in _slices(b):
                d1, c = np.unique(Places(texts, length).first, return_counts=True)
                yield _row({"d1": d1, "c": c})

    return run


PLACES = "k1 bigint, k2 bigint, p bigint, low bigint, high bigint, d1 bigint, d2 bigint, d3 bigint, c bigint"


def _places(length, shared):
    """Places whose first digit occurs again, with the next two.

    Of places equal in all digits within a slice, as in periodic text, one goes
    on with their number; what the others' windows cover is given as runs, low
    to high, with c = 0.
    """

    def run(batches):
        for b in batches:
            k1, k2 = b.column("k1").to_numpy(), b.column("k2").to_numpy()
            for base, texts in _slices(b):
                x = Places(texts, length)
                which = np.flatnonzero(shared.value.has(*_probe(x.first.view(np.int64)))) if len(x.pos) else x.pos
                if not len(which):
                    continue
                owns = x.high[which] >= x.low[which]
                d2, d3 = np.zeros(len(which), np.uint64), np.zeros(len(which), np.uint64)
                own = which[owns]
                d2[owns], d3[owns] = x.suffix(own), x.covered(own, x.low[own], x.high[own])
                _, one, number, count = np.unique(salted(mix(x.first[which] ^ d2) + d3, owns), return_index=True, return_inverse=True, return_counts=True)
                head = which[one]
                row = base + x.text[head]
                yield _row({"k1": k1[row], "k2": k2[row], "p": x.pos[head], "low": x.low[head], "high": x.high[head], "d1": x.first[head], "d2": d2[one], "d3": d3[one], "c": count})
                again = count[number] > 1
                for r in np.unique(x.text[which[again]]):
                    here = which[again & (x.text[which] == r)]
                    known = here[x.high[here] >= x.low[here]]
                    a, z = merged(x.pos[known] - x.high[known], x.pos[known] - x.low[known] + length) if len(known) else (x.pos[here[:1]], x.pos[here[:1]])
                    none = np.zeros(len(a), np.int64)
                    yield _row({"k1": none + k1[base + r], "k2": none + k2[base + r], "p": a, "low": a, "high": z, "d1": none, "d2": none, "d3": none, "c": none})

    return run


def _probe(*values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 31-bit hashes of rows of integers, for a Bloom filter."""
    h = np.zeros(len(values[0]), np.uint64)
    for v in values:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + v.view(np.uint64))
    return (h & np.uint64(0x7FFFFFFF)).astype(np.int64), (h >> np.uint64(33)).astype(np.int64)


def _probed(*names):
    def run(batches):
        for b in batches:
            p1, p2 = _probe(*(b.column(c).to_numpy() for c in names))
            yield pa.RecordBatch.from_pydict({"p1": pa.array(p1), "p2": pa.array(p2)})

    return run


def _bloom(rows: DataFrame, *names: str):
    keys = rows.select(*names).mapInArrow(_probed(*names), "p1 bigint, p2 bigint")
    return rows.sparkSession.sparkContext.broadcast(Bloom.build(keys, "p1", "p2", BLOOM_BITS))


#: Numbers by which zones and windows are counted: of a place of its own, and of one with copies.
ALONE, COPIES = 1, 2


def _zones(length, texts_wanted, wanted, alone):
    """Of every slice of the wanted texts: its places, and the zones of those that are wanted.

    Places with copies of all their windows are here for the others to be
    compared with; of their zones one of a kind is enough for a slice.
    """

    def run(batches):
        for b in batches:
            b = b.filter(pa.array(texts_wanted.value.has(*_probe(b.column("k1").to_numpy(), b.column("k2").to_numpy()))))
            k1, k2 = b.column("k1").to_numpy(), b.column("k2").to_numpy()
            for base, texts in _slices(b):
                x = Places(texts, length)
                which = np.flatnonzero(x.high >= x.low)
                if len(which):
                    probes = _probe(x.first[which].view(np.int64), x.covered(which, x.low[which], x.high[which]).view(np.int64))
                    own, keep = alone.value.has(*probes), wanted.value.has(*probes)
                    which, own = which[keep], own[keep]
                if not len(which):
                    continue
                n = x.high[which] // ZONE - x.low[which] // ZONE + 1
                at, own = np.repeat(which, n), np.repeat(own, n)
                zone = x.low[at] // ZONE + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                near, far = zone * ZONE, np.minimum(zone * ZONE + ZONE, x.width) - 1
                low, high = np.maximum(near, x.low[at]), np.minimum(far, x.high[at])
                d4, d5 = salted(x.hashed.of(x.at[at] - near, x.at[at] - far + length), zone), x.covered(at, low, high)
                copies = np.flatnonzero(~own)
                _, one = np.unique(mix(d4[copies]) ^ d5[copies], return_index=True)
                keep = np.r_[np.flatnonzero(own), copies[one]]
                row = base + x.text[at[keep]]
                found = {"k1": k1[row], "k2": k2[row], "p": x.pos[at[keep]], "low": low[keep], "high": high[keep], "d4": d4[keep], "d5": d5[keep], "c": np.where(own[keep], ALONE, COPIES)}
                yield x, at[keep], found

    return run


def _open_zones(*wanted):
    """What the windows of a zone have in common, and all that its owned ones cover."""
    found = _zones(*wanted)
    return lambda batches: (_row(columns) for _, _, columns in found(batches))


def _open_windows(zones_wanted, length, *wanted):
    """The single windows of the wanted zones."""
    found = _zones(length, *wanted)

    def run(batches):
        for x, at, z in found(batches):
            keep = np.flatnonzero(zones_wanted.value.has(*_probe(z["d4"].view(np.int64), z["d5"].view(np.int64))))
            n = z["high"][keep] - z["low"][keep] + 1
            r = np.repeat(keep, n)
            d = z["low"][r] + np.arange(len(r)) - np.repeat(np.cumsum(n) - n, n)
            start = x.at[at[r]] - d
            yield _row({c: z[c][r] for c in ("k1", "k2", "p", "d4", "c")} | {"a": z["p"][r] - d, "w": salted(x.hashed.of(start, start + length), d)})

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
        size, removed, spans, kept = [], [], [], []
        runs = b.column("runs").to_pylist()
        for r, t in enumerate(binary_views(b.column("t"))):
            size.append(len(t))
            if not runs[r]:
                removed.append(0)
                spans.append(0)
                kept.append(t.tobytes())
                continue
            start, end = merged(*np.array([(x["a"], x["z"]) for x in runs[r]], np.int64).T)
            removed.append(int((end - start).sum()))
            spans.append(len(start))
            edges = [0, *np.stack([start, end], axis=1).ravel().tolist(), len(t)]
            kept.append(b"".join(t[x:y].tobytes() for x, y in zip(edges[::2], edges[1::2], strict=True)))
        yield pa.RecordBatch.from_pydict({"i": b.column("i"), "n": pa.array(size, pa.int64()), "removed": pa.array(removed, pa.int64()), "spans": pa.array(spans, pa.int64()), "places": b.column("places"), "kept": pa.array(kept, pa.binary())})


def _sharing(bloom):
    """Rows whose text may share something."""

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(bloom.value.has(*_probe(b.column("k1").to_numpy(), b.column("k2").to_numpy()))))

    return run


def _untouched(bloom):
    """The result for all other rows."""

    def run(batches):
        for b in batches:
            b = b.filter(pa.array(~bloom.value.has(*_probe(b.column("k1").to_numpy(), b.column("k2").to_numpy()))))
            kept = b.column("t").cast(pa.binary())
            none = pa.array(np.zeros(b.num_rows, np.int64))
            yield pa.RecordBatch.from_pydict({"i": b.column("i"), "n": pc.binary_length(kept).cast(pa.int64()), "removed": none, "spans": none, "places": none, "kept": kept})

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """Cut out every byte of a ``length``-byte string that also starts elsewhere.

    Returns ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans``, ``n_shared`` and
    ``kept_bytes`` (binary, as a cut may split a character), a row per input
    row.  ``n_shared`` counts the content-chosen places whose first digit, 128
    bytes, occurs elsewhere too: a shared passage of 256 bytes or more always
    shows there, though nothing is cut below ``length``.

    A null text counts as empty.  Rows are named by 128 bits of their id and
    text, so null and repeated ids are no special case; repeated rows are
    elsewhere to one another, so from ``length`` bytes on they lose everything.
    Ties need no rule, as every copy is cut.  An empty table gives none.  Texts
    may have any length up to a row's.  Only the two named columns are read.  Strings are judged on the input.
    """
    if not GRAM < length <= MOST:
        raise ValueError(f"length must be over {GRAM} and at most {MOST}")
    t = F.coalesce(col(text_col).cast("string"), F.lit(""))
    src = docs.select(col(id_col).alias("i"), F.xxhash64(col(id_col)).alias("k1"), F.xxhash64(t).alias("k2"), t.alias("t"))
    texts = src.select("k1", "k2", "t")
    key, some = ["k1", "k2"], F.count(F.lit(1))
    seen = texts.mapInArrow(_first_digits(length), "d1 bigint, c bigint").groupBy("d1").agg(F.sum("c").alias("c"))
    places = stage(texts.mapInArrow(_places(length, _bloom(seen.where("c > 1"), "d1")), PLACES), "places")
    digits = stage(places.where("c > 0").groupBy("d1", "d2", "d3").agg(F.sum("c").alias("c")), "digits")
    again = stage(digits.groupBy("d1").agg(F.sum("c").alias("c1")).where("c1 > 1").select("d1"), "again")
    classes = digits.where("d3 <> 0").groupBy("d1", "d2").agg(some.alias("m"), F.min("c").alias("least")).where("m > 1 and least = 1").select("d1", "d2", F.lit(True).alias("open"))
    marked = digits.join(again, "d1").join(stage(classes, "classes"), ["d1", "d2"], "left").select("d1", "d2", "d3", (F.col("c") > 1).alias("full"), "open")
    marked = stage(marked, "marked")
    shared = places.where("c > 0").join(marked, ["d1", "d2", "d3"]).select(*key, "p", "low", "high", (F.col("full") & (F.col("low") <= F.col("high"))).alias("full"), "open")
    shared = stage(shared, "shared")

    run = lambda a, z: F.struct(a.alias("a"), z.alias("z"))
    covers = run(F.col("p") - F.col("high"), F.col("p") - F.col("low") + length)
    known = shared.select(*key, "p", F.when(F.col("full"), covers).alias("run"))
    local = places.where("c = 0").select(*key, "p", F.when(F.col("low") < F.col("high"), run(F.col("low"), F.col("high"))).alias("run"))

    # places alone in what their windows cover, and those they must be compared with
    wanted = (length, _bloom(shared.where("open"), *key), _bloom(marked.where("open"), "d1", "d3"), _bloom(marked.where("open and not full"), "d1", "d3"))
    zones = stage(texts.mapInArrow(_open_zones(*wanted), "k1 bigint, k2 bigint, p bigint, low bigint, high bigint, d4 bigint, d5 bigint, c bigint"), "zones")
    pairs = stage(zones.groupBy("d4", "d5").agg(F.sum("c").alias("c")), "pairs")
    narrow = stage(pairs.groupBy("d4").agg(some.alias("m"), F.min("c").alias("least")).where("m > 1 and least = 1").select("d4"), "narrow")
    of_zones = _bloom(pairs.join(narrow, "d4"), "d4", "d5")
    whole = zones.where(F.col("c") == ALONE).join(pairs.where("c > 1").select("d4", "d5"), ["d4", "d5"]).select(*key, "p", covers.alias("run"))
    windows = stage(texts.mapInArrow(_open_windows(of_zones, *wanted), "k1 bigint, k2 bigint, p bigint, d4 bigint, c bigint, a bigint, w bigint"), "windows")
    twice = stage(windows.groupBy("d4", "w").agg(F.sum("c").alias("c")).where("c > 1").select("d4", "w"), "twice")
    single = windows.where(F.col("c") == ALONE).join(twice, ["d4", "w"]).select(*key, "p", run(F.col("a"), F.col("a") + length).alias("run"))
    every = known.unionByName(local).unionByName(whole).unionByName(single)
    runs = stage(every.groupBy(*key).agg(F.collect_set("run").alias("runs"), F.size(F.collect_set("p")).cast("bigint").alias("places")), "runs")

    # only texts that share something are shuffled
    cut = _bloom(runs, *key)
    kind = f"i {field_type(docs, id_col)}"
    result = f"{kind}, n bigint, removed bigint, spans bigint, places bigint, kept binary"
    sharing = src.mapInArrow(_sharing(cut), f"{kind}, k1 bigint, k2 bigint, t string").join(runs, key, "left")
    some = sharing.select("i", "t", "runs", F.coalesce("places", F.lit(0)).cast("bigint").alias("places")).mapInArrow(_cut, result)
    out = src.mapInArrow(_untouched(cut), result).unionByName(some)
    return out.select(F.col("i").alias(id_col), F.col("n").alias("n_bytes"), F.col("removed").alias("n_removed"), F.col("spans").alias("n_spans"), F.col("places").alias("n_shared"), F.col("kept").alias("kept_bytes"))
