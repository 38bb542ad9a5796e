"""BAM files as a Spark data source, and a writer of them.

A file is read in ranges of compressed bytes.  An index is made first: a task
for each range looks at the first blocks in it and finds the place of the first
record by the shape of those that follow; so little is read that the index of
a terabyte takes seconds.  The data source's partitions are the stretches
between these places.  A task that reads a stretch must arrive exactly at the
next one's first record, so a wrong place is an error and never a wrong row.

Only the columns that are asked for are decoded, the fixed fields of all
records of a batch at once.  Ranges of numeric columns are tested before
anything of variable length is decoded.  Where the header says that the
file is sorted by coordinate, stretches that cannot hold a wanted ``ref_id`` and
``pos`` are not read at all, as the index has the coordinates of their ends.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from contactloom.session import ship_package, stage
from contactloom.sources.storage import Parts, listed, located, new_folder, opened, splits

ALIGNMENT = {"read_name": "string", "flag": "int", "ref_id": "int", "pos": "bigint", "mapq": "int", "next_ref_id": "int", "next_pos": "bigint", "tlen": "int", "cigar": "string", "seq": "string", "qual": "string"}
#: Compressed bytes of a range.
SPLIT = 32 << 20
#: Data that a task decodes at a time.
BATCH = 4 << 20
#: Records in a row that must look right where a file is entered.
SURE_RECORDS = 20

# fixed values: the first bytes of a compressed block with the kind of its extra field, its empty last block, and the first bytes of the data
BLOCK_MARK, BLOCK_KIND = b"\x1f\x8b\x08\x04", b"BC\x02\x00"
END_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
MAGIC = b"BAM\x01"
# fixed values: the letters of packed bases and of alignment steps
BASES, STEPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
# fixed values: the fields of a record before its name
FIXED = np.dtype([("size", "<i4"), ("ref_id", "<i4"), ("pos", "<i4"), ("name_len", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("steps", "<u2"), ("flag", "<u2"), ("length", "<i4"), ("next_ref_id", "<i4"), ("next_pos", "<i4"), ("tlen", "<i4")])
#: Reference of unmapped records in the order of coordinates.
LAST = 1 << 31
#: Least and greatest value of numeric columns, both included.
Ranges = dict[str, tuple[int, int]]
LEAST, MOST = -(1 << 40), 1 << 40


# ------------------------------------------------------------ blocks and records
def _block_size(held: bytes, at: int) -> int:
    """The length of the block that begins at ``at``, 0 if its first bytes are not there yet."""
    if len(held) - at < 18:
        return 0
    if held[at : at + 4] != BLOCK_MARK or held[at + 12 : at + 16] != BLOCK_KIND:
        raise ValueError("a compressed block was expected")
    return struct.unpack_from("<H", held, at + 16)[0] + 1


def blocks(file, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """Offset and data of the blocks from the one at ``at`` to the file's end."""
    file.seek(at)
    held, k = b"", 0
    while at + k < size:
        n = _block_size(held, k)
        if not n or len(held) - k < n:
            more = file.read(1 << 20)
            if not more:
                raise ValueError("a compressed block is cut off")
            held, at, k = held[k:] + more, at + k, 0
            continue
        yield at + k, zlib.decompress(held[k : k + n], 31)
        k += n


def _first_block(file, start: int, size: int) -> int:
    """The first block that begins at ``start`` or later: its mark, and that of its successor, are where they should be."""
    file.seek(start)
    held = file.read(1 << 18)
    at = -1
    while (at := held.find(BLOCK_MARK, at + 1)) >= 0:
        if held[at + 12 : at + 16] == BLOCK_KIND and len(held) >= at + 18:
            after = at + _block_size(held, at)
            if start + after == size or held[after : after + 4] == BLOCK_MARK:
                return start + at
    return size


def _plausible(data: bytes, at: int, n_ref: int) -> int:
    """Where the record at ``at`` ends if it looks like one, -1 if not, 0 if the data end before that is clear."""
    if at + 36 > len(data):
        return 0
    size, ref, pos, name_len, _, _, steps, _, length, next_ref, next_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    fits = name_len > 0 and length >= 0 and 32 + name_len + 4 * steps + (length + 1) // 2 + length <= size < 1 << 28
    if not (fits and -1 <= ref < n_ref and -1 <= next_ref < n_ref and pos >= -1 and next_pos >= -1):
        return -1
    name = data[at + 36 : at + 36 + name_len]
    if len(name) == name_len and (name[-1] or not all(32 < c < 127 for c in name[:-1])):
        return -1
    return at + 4 + size


def _chain(data: bytes, start: int, n_ref: int) -> tuple[bool, int]:
    """Whether the records from ``start`` look right as far as the data go, and how many do."""
    at, seen = start, 0
    while seen < SURE_RECORDS:
        end = _plausible(data, at, n_ref)
        if end <= 0:
            return end == 0, seen
        at, seen = end, seen + 1
        if at >= len(data):
            break
    return True, seen


class Stretch:
    """Data of consecutive blocks; knows which block a place lies in."""

    def __init__(self, file, at: int, size: int):
        self.more, self.size = blocks(file, at, size), size
        self.data, self.marks, self.ended = bytearray(), [], False

    def grow(self) -> bool:
        """Add a block; false at the file's end."""
        found = next(self.more, None)
        if found is None:
            self.ended = True
            return False
        self.marks.append((len(self.data), found[0]))
        self.data += found[1]
        return True

    def block_of(self, place: int) -> tuple[int, int]:
        """Offset of the block that the byte at ``place`` lies in, and the byte's place in it."""
        while len(self.data) <= place and self.grow():
            pass
        if place >= len(self.data):
            return self.size, 0
        at, offset = next(m for m in reversed(self.marks) if m[0] <= place)
        return offset, place - at


class Header:
    """A file's header, each of its bytes looked at once: its text, the bytes of its references, their number, and where records begin."""

    def __init__(self, path: str, size: int):
        with opened(path) as f:
            s = self.read = Stretch(f, 0, size)
            self.path = path
            self._upto(8)
            if s.data[:4] != MAGIC:
                raise ValueError("not a BAM file")
            (n,) = struct.unpack_from("<i", s.data, 4)
            self._upto(12 + n)
            self.text = s.data[8 : 8 + n].rstrip(b"\0").decode()
            (self.count,) = struct.unpack_from("<i", s.data, 8 + n)
            self.start = at = 12 + n
            lengths, unpack = s.data, struct.Struct("<i").unpack_from
            for _ in range(self.count):
                if at + 4 > len(lengths):
                    self._upto(at + 4)
                at += 8 + unpack(lengths, at)[0]
            self._upto(at)
            self.references = bytes(s.data[self.start : at])
            self.block, self.at = s.block_of(at)

    def _upto(self, n: int) -> None:
        while len(self.read.data) < n:
            if not self.read.grow():
                raise ValueError(f"{self.path}: the header is cut off")

    def listed(self) -> Iterator[tuple[str, int]]:
        """Names and lengths of the references."""
        at, unpack = 0, struct.Struct("<i").unpack_from
        for _ in range(self.count):
            (n,) = unpack(self.references, at)
            yield self.references[at + 4 : at + 3 + n].decode(), unpack(self.references, at + 4 + n)[0]
            at += 8 + n


# ------------------------------------------------------------------------ index
def _first_of(row: tuple[str, int, int, int], n_ref: int, block: int, at: int) -> tuple[int, int, int, int] | None:
    """Block, place, reference and position of the first record that begins in a range; none if no record does.

    ``block`` and ``at`` are the first record's; ranges up to there that do not
    begin the file have none of their own.
    """
    path, size, start, end = row
    if 0 < start <= block:
        return None
    with opened(path) as f:
        first = _first_block(f, start, size) if start else block
        if first >= (end if start else size):
            return None
        s = Stretch(f, first, size)
        if start == 0:
            place = at
        else:
            place = 0
            while True:
                # a place is sure where enough records follow it, or all to the end of the file
                while len(s.data) < place + 64 and s.grow():
                    pass
                if place >= len(s.data):
                    return None
                fits, seen = _chain(s.data, place, n_ref)
                while fits and seen < SURE_RECORDS and not s.ended:
                    for _ in range(16):
                        s.grow()
                    fits, seen = _chain(s.data, place, n_ref)
                if fits and seen:
                    break
                place += 1
        block, at = s.block_of(place)
        if block >= size or (start and block >= end):
            return None
        while len(s.data) < place + 12 and s.grow():
            pass
        if len(s.data) < place + 12:
            raise ValueError(f"{path}: a record is cut off")
        return block, at, *struct.unpack_from("<ii", s.data, place + 4)


def _heads(batches):
    """Of each file the number of its references, a hash of them, whether it is sorted, and where its first record begins."""
    for b in batches:
        out = []
        for path, size in zip(b.column("path").to_pylist(), b.column("size").to_pylist(), strict=True):
            h = Header(path, size)
            head = re.search("^@HD.*", h.text, re.M)
            by_place = bool(head) and "SO:coordinate" in head[0].split("\t")
            out.append((path, h.count, zlib.crc32(h.references), by_place, h.block, h.at))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), HEADS.types, strict=True)], schema=HEADS) if out else pa.RecordBatch.from_pylist([], HEADS)


HEADS = pa.schema([("path", pa.string()), ("n_ref", pa.int32()), ("mark", pa.int64()), ("by_place", pa.bool_()), ("first_block", pa.int64()), ("first_at", pa.int64())])
LISTED = pa.schema([("ref_id", pa.int32()), ("ref_name", pa.string()), ("ref_length", pa.int64())])


def _references(batches):
    """The references of files, in their order."""
    for b in batches:
        for path, size in zip(b.column("path").to_pylist(), b.column("size").to_pylist(), strict=True):
            rows = enumerate(Header(path, size).listed())
            while some := list(islice(rows, 1 << 16)):
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in some], pa.int32()), pa.array([r[0] for _, r in some], pa.string()), pa.array([r[1] for _, r in some], pa.int64())], schema=LISTED)


def index_bam(spark: SparkSession, paths: str | list[str], split_bytes: int = SPLIT) -> tuple[DataFrame, DataFrame]:
    """The references, and a row for each stretch of records: (path, size, by_place, block, at, ref_id, pos), in file order within a path."""
    ship_package(spark)
    files = listed(spark, paths)
    kind = "path string, size bigint"
    many = spark.createDataFrame(files, kind).repartition(max(1, min(len(files), 1000)))
    heads = stage(many.mapInArrow(_heads, "path string, n_ref int, mark bigint, by_place boolean, first_block bigint, first_at bigint"), "heads")
    kinds = heads.agg(F.count_distinct("mark", "n_ref"), F.max("n_ref")).first()
    if kinds[0] > 1:
        raise ValueError("the files have different references")
    n_ref = kinds[1] or 0
    ranges = splits(files, split_bytes)
    rows = spark.createDataFrame(ranges, "path string, size bigint, start bigint, `end` bigint").join(heads, "path").repartition(max(1, len(ranges)), "path", "start")

    def found(batches):
        for b in batches:
            each = [(r, _first_of((r["path"], r["size"], r["start"], r["end"]), n_ref, r["first_block"], r["first_at"])) for r in b.to_pylist()]
            each = [(r, p) for r, p in each if p is not None]
            made = {n: [r[n] for r, _ in each] for n in ("path", "size", "by_place")} | {n: [p[k] for _, p in each] for k, n in enumerate(("block", "at", "ref_id", "pos"))}
            yield pa.RecordBatch.from_pydict({n: pa.array(v, pa.string() if n == "path" else pa.bool_() if n == "by_place" else pa.int64()) for n, v in made.items()})

    index = rows.mapInArrow(found, "path string, size bigint, by_place boolean, block bigint, at bigint, ref_id bigint, pos bigint")
    references = spark.createDataFrame(files[:1], kind).mapInArrow(_references, "ref_id int, ref_name string, ref_length bigint")
    return references, stage(index, "index")


# ----------------------------------------------------------------------- decoding
def _gather(a: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all pieces one after the other, and where each begins."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return a[np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], lengths)], offsets


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def _or_star(a: np.ndarray, begin: np.ndarray, lengths: np.ndarray, absent: np.ndarray, value) -> pa.Array:
    """Strings whose characters ``value`` makes of (record, place in it); one star where absent."""
    lengths = np.where(absent, 1, lengths)
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    rec = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(offsets[-1]) - offsets[rec]
    star = absent[rec]
    out = np.full(offsets[-1], ord("*"), np.uint8)
    out[~star] = value(rec[~star], inside[~star])
    return _strings(out, offsets)


LETTERS = np.frombuffer(BASES.encode(), np.uint8)


def decoded(data: bytes, starts: list[int], columns: tuple[str, ...], where: Ranges) -> pa.RecordBatch:
    """The asked-for columns of the records at ``starts`` whose numbers lie in all of the ranges."""
    a, at = np.frombuffer(data, np.uint8), np.array(starts, np.int64)
    fixed = a[at[:, None] + np.arange(FIXED.itemsize)].copy().view(FIXED).ravel() if len(at) else np.zeros(0, FIXED)
    for c, (least, most) in where.items():
        keep = (fixed[c].astype(np.int64) >= least) & (fixed[c].astype(np.int64) <= most)
        at, fixed = at[keep], fixed[keep]
    name = at + FIXED.itemsize
    steps = name + fixed["name_len"]
    seq = steps + 4 * fixed["steps"].astype(np.int64)
    length = fixed["length"].astype(np.int64)
    qual = seq + (length + 1) // 2
    out = []
    for c in columns:
        if c == "read_name":
            out.append(_strings(*_gather(a, name, fixed["name_len"].astype(np.int64) - 1)))
        elif c == "cigar":
            packed, ends = _gather(a, steps, 4 * fixed["steps"].astype(np.int64))
            n, k = packed.view("<u4") >> 4, packed.view("<u4") & 15
            words = [f"{x}{STEPS[y]}" for x, y in zip(n.tolist(), k.tolist(), strict=True)]
            out.append(pa.array(["".join(words[i // 4 : j // 4]) or "*" for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.string()))
        elif c == "seq":
            out.append(_or_star(a, seq, length, length == 0, lambda r, i: LETTERS[a[seq[r] + (i >> 1)] >> (4 * (1 - (i & 1))).astype(np.uint8) & 15]))
        elif c == "qual":
            none = length == 0
            none[~none] = a[qual[~none]] == 255
            out.append(_or_star(a, qual, length, none, lambda r, i: a[qual[r] + i] + 33))
        else:
            out.append(pa.array(fixed[c].astype(np.int64 if ALIGNMENT[c] == "bigint" else np.int32)))
    return pa.RecordBatch.from_arrays(out, names=list(columns))


# -------------------------------------------------------------------- data source
class Piece(InputPartition):
    def __init__(self, stretches: list[tuple]):
        self.stretches = stretches


class BamReader(DataSourceReader):
    def __init__(self, columns: tuple[str, ...], where: Ranges, index: str, split_bytes: int):
        self.columns, self.where, self.index, self.split_bytes = columns, where, index, split_bytes

    def _may_hold(self, first: tuple, last: tuple) -> bool:
        """Whether records from coordinate ``first`` to ``last`` can pass, in a sorted file."""
        r0, r1 = self.where.get("ref_id", (-1, LAST))
        p0, p1 = self.where.get("pos", (-1, np.inf))
        if r0 > r1 or p0 > p1:
            return False
        # unmapped records, -1, come last
        if r0 < 0 and last[0] >= LAST:
            return True
        r0 = max(r0, 0)
        if r0 == r1:
            return (r0, p0) <= last and (r1, p1) >= first
        return r0 <= last[0] and r1 >= first[0]

    def partitions(self) -> list[Piece]:
        import pyarrow.dataset as ds

        store, path = located(self.index)
        rows = sorted(ds.dataset(path, filesystem=store, format="parquet").to_table().to_pylist(), key=lambda r: (r["path"], r["block"], r["at"]))
        pieces, held, size = [], [], 0
        place = lambda r: (LAST if r["ref_id"] < 0 else r["ref_id"], r["pos"])
        for k, r in enumerate(rows):
            after = rows[k + 1] if k + 1 < len(rows) and rows[k + 1]["path"] == r["path"] else None
            if r["by_place"] and not self._may_hold(place(r), place(after) if after else (np.inf, np.inf)):
                continue
            end = (after["block"], after["at"]) if after else (r["size"], 0)
            if held and size + end[0] - r["block"] > self.split_bytes:
                pieces.append(Piece(held))
                held, size = [], 0
            held.append((r["path"], r["size"], r["block"], r["at"], *end))
            size += end[0] - r["block"]
        return [*pieces, Piece(held)] if held else pieces or [Piece([])]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        for path, size, block, at, end_block, end_at in partition.stretches:
            with opened(path) as f:
                held, cut = bytearray(), at
                for offset, data in blocks(f, block, size):
                    if offset > end_block or (offset == end_block and not end_at):
                        break
                    held += data[cut : end_at if offset == end_block else len(data)]
                    cut = 0
                    if len(held) >= BATCH:
                        yield from self._whole(held)
                yield from self._whole(held)
                if held:
                    raise ValueError(f"{path}: records do not follow each other up to the block at {end_block}")

    def _whole(self, held: bytearray) -> Iterator[pa.RecordBatch]:
        """Decode the whole records at the front and take them off."""
        starts, at, n = [], 0, len(held)
        unpack = struct.Struct("<i").unpack_from
        while at + 4 <= n:
            (size,) = unpack(held, at)
            if size < 32:
                raise ValueError("a record was expected")
            if at + 4 + size > n:
                break
            starts.append(at)
            at += 4 + size
        if starts:
            yield decoded(bytes(held[:at]), starts, self.columns, self.where)
            del held[:at]


class BamSource(DataSource):
    """Options: ``columns``, ``where``, ``index`` (a table of ``index_bam``), ``split``; for writing ``path``, ``references``, ``sorted``."""

    @classmethod
    def name(cls) -> str:
        return "contactloom_bam"

    def schema(self) -> str:
        return ", ".join(f"{c} {ALIGNMENT[c]}" for c in self.options["columns"].split(","))

    def reader(self, schema) -> BamReader:
        return BamReader(tuple(schema.names), {c: tuple(r) for c, r in json.loads(self.options["where"]).items()}, self.options["index"], int(self.options["split"]))

    def writer(self, schema, overwrite: bool) -> BamWriter:
        return BamWriter(self.options["path"], self.options["references"], self.options["sorted"] == "true")


def read_bam(spark: SparkSession, paths: str | list[str], columns: tuple[str, ...] | None = None, where: dict[str, tuple[int | None, int | None]] | None = None, split_bytes: int = SPLIT) -> tuple[DataFrame, DataFrame]:
    """References and alignments of BAM files that share one dictionary.

    ``columns`` are those that are decoded; ``where`` has the least and the
    greatest value, both included, of numeric columns, None for no bound.  Both
    are arguments, as Spark 4.1 prunes no columns of a Python data source, and
    its pushed filters stay with the frame: the next query of it that pushes
    none would still be filtered.

    Spark lists the files; tasks open them with pyarrow, so they must lie in a
    store that it knows (local, S3, GCS, HDFS).
    """
    ranges = {c: (LEAST if a is None else a, MOST if b is None else b) for c, (a, b) in (where or {}).items()}
    if unknown := (set(ranges) - set(FIXED.names) & set(ALIGNMENT)) | (set(columns or ()) - set(ALIGNMENT)):
        raise ValueError(f"no such columns: {sorted(unknown)}")
    references, index = index_bam(spark, paths, split_bytes)
    spark.dataSource.register(BamSource)
    (folder,) = {f.rpartition("/")[0] for f in index.inputFiles()} or {""}
    chosen = [c for c in ALIGNMENT if columns is None or c in columns]
    return references, spark.read.format("contactloom_bam").options(columns=",".join(chosen), where=json.dumps(ranges), index=folder, split=str(split_bytes)).load()


# ------------------------------------------------------------------------ writing
# fixed value: bytes of data of a block, so that it fits also where nothing can be compressed
BLOCK = 65_280


def _compressed(data: bytes) -> bytes:
    """A block of at most BLOCK bytes of data."""
    c = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    return BLOCK_MARK + b"\0\0\0\0\0\xff\x06\0" + BLOCK_KIND + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


CODES = bytes(BASES.find(chr(c)) if chr(c) in BASES else 15 for c in range(256))


def _packed_seq(seq: str) -> bytes:
    codes = np.frombuffer(seq.encode("latin-1").translate(CODES) + b"\0" * (len(seq) % 2), np.uint8)
    return (codes[::2] << 4 | codes[1::2]).astype(np.uint8).tobytes()


def _tails(cols: dict, n: int) -> tuple[list[bytes], list[int], list[int]]:
    """Steps, bases and qualities of each record, the number of its steps and of its bases."""
    text = {c: cols[c].to_pylist() if c in cols else ["*"] * n for c in ("cigar", "seq", "qual")}
    cigars = [[(int(k) << 4 | STEPS.index(s)) for k, s in re.findall(r"(\d+)([MIDNSHP=X])", x)] for x in text["cigar"]]
    seqs = [b"" if s == "*" else _packed_seq(s) for s in text["seq"]]
    lengths = [0 if s == "*" else len(s) for s in text["seq"]]
    quals = [b"\xff" * k if q == "*" else bytes(x - 33 for x in q.encode()) for q, k in zip(text["qual"], lengths, strict=True)]
    return [struct.pack(f"<{len(c)}I", *c) + s + q for c, s, q in zip(cigars, seqs, quals, strict=True)], [len(c) for c in cigars], lengths


def _joined(*columns) -> bytes:
    """The bytes of columns, row by row."""
    made = pc.binary_join_element_wise(*[pa.scalar(c, pa.large_binary()) if isinstance(c, bytes) else c.cast(pa.large_binary()) for c in columns], pa.scalar(b"", pa.large_binary()))
    return b"".join(_bytes_of(x) for x in (made.chunks if isinstance(made, pa.ChunkedArray) else [made]))


def _bytes_of(a: pa.Array) -> bytes:
    if not len(a) or a.buffers()[2] is None:
        return b""
    ends = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    return a.buffers()[2][int(ends[0]) : int(ends[-1])].to_pybytes()


def _numbers(a: np.ndarray) -> pa.Array:
    """The bytes of each element."""
    return pa.Array.from_buffers(pa.large_binary(), len(a), [None, pa.py_buffer(np.arange(len(a) + 1, dtype=np.int64) * a.itemsize), pa.py_buffer(np.ascontiguousarray(a).tobytes())])


def encoded(b: pa.RecordBatch) -> bytes:
    """The records of a batch; absent columns are those of an unaligned read."""
    n, cols = b.num_rows, {c: b.column(c) for c in b.schema.names}
    names = (cols["read_name"] if "read_name" in cols else pa.array(["*"] * n, pa.string())).cast(pa.large_binary())
    if names.null_count:
        raise ValueError("a record has no name")
    fixed = np.zeros(n, FIXED)
    for c, absent in (("ref_id", -1), ("pos", -1), ("mapq", 0), ("flag", 4), ("next_ref_id", -1), ("next_pos", -1), ("tlen", 0)):
        fixed[c] = cols[c].to_numpy(zero_copy_only=False) if c in cols else absent
    name_len, tails, size = pc.binary_length(names).to_numpy(zero_copy_only=False) + 1, [], 0
    if {"cigar", "seq", "qual"} & cols.keys():
        each, fixed["steps"], fixed["length"] = _tails(cols, n)
        tails, size = [pa.array(each, pa.large_binary())], np.array([len(t) for t in each], np.int64)
    if (name_len > 255).any():
        raise ValueError("a read name has over 254 bytes")
    fixed["name_len"], fixed["size"] = name_len, FIXED.itemsize - 4 + name_len + size
    return _joined(_numbers(fixed), names, b"\0", *tails)


class Written(WriterCommitMessage):
    def __init__(self, name: str | None):
        self.name = name


class BamWriter(DataSourceArrowWriter):
    def __init__(self, path: str, references: str, by_place: bool):
        self.parts, self.references, self.by_place = Parts(path, ".bam"), references, by_place

    def _head(self) -> bytes:
        import pyarrow.dataset as ds

        store, path = located(self.references)
        refs = ds.dataset(path, filesystem=store, format="parquet").to_table().sort_by("ref_id").combine_chunks()
        name, length = refs.column("ref_name").cast(pa.large_binary()), refs.column("ref_length")
        text = f"@HD\tVN:1.6\tSO:{'coordinate' if self.by_place else 'unsorted'}\n".encode() + _joined(b"@SQ\tSN:", name, b"\tLN:", length.cast(pa.large_string()), b"\n")
        sizes = _numbers((pc.binary_length(name).to_numpy() + 1).astype("<i4")), _numbers(length.to_numpy().astype("<i4"))
        names = _joined(pa.chunked_array([sizes[0]]), name, b"\0", pa.chunked_array([sizes[1]]))
        return MAGIC + struct.pack("<i", len(text)) + text + struct.pack("<i", len(refs)) + names

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        out, name = self.parts.open(TaskContext.get().partitionId())
        with out:
            held = bytearray(self._head())
            for b in batches:
                held += encoded(b)
                whole = len(held) - len(held) % BLOCK
                self._blocks(out, held, whole)
                del held[:whole]
            # a task without rows has the whole header left
            self._blocks(out, held, len(held))
            out.write(END_BLOCK)
        return Written(name)

    def _blocks(self, out, held: bytearray, upto: int) -> None:
        for k in range(0, upto, BLOCK):
            out.write(_compressed(bytes(held[k : min(k + BLOCK, upto)])))

    def commit(self, messages: list) -> None:
        self.parts.commit([m.name for m in messages if m is not None])

    def abort(self, messages: list) -> None:
        self.parts.abort()


def write_bam(alignments: DataFrame, references: DataFrame, path: str, by_place: bool = False) -> None:
    """A folder of BAM files, one for each task; with ``by_place`` ranges of coordinates, each sorted.

    ``references`` has ref_id (0, 1, ...), ref_name and ref_length; columns of
    ``alignments`` that are missing count as absent.
    """
    spark = alignments.sparkSession
    ship_package(spark)
    new_folder(spark, path)
    refs = stage(references.select("ref_id", "ref_name", F.col("ref_length").cast("bigint").alias("ref_length")), "references")
    rows = alignments.select(*[F.col(c).cast(kind).alias(c) for c, kind in ALIGNMENT.items() if c in alignments.columns])
    if by_place:
        order = [F.when(F.col("ref_id") < 0, LAST).otherwise(F.col("ref_id")).alias("_r"), F.col("pos"), F.col("read_name"), F.col("flag")]
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    spark.dataSource.register(BamSource)
    (folder,) = {f.rpartition("/")[0] for f in refs.inputFiles()}
    rows.write.format("contactloom_bam").mode("append").options(path=path, references=folder, sorted=str(by_place).lower(), columns=",".join(rows.columns)).save()
