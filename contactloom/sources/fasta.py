"""FASTA as a table of chunks: a Spark data source that reads files by ranges of bytes.

Two passes read the files; nothing else moves a sequence.  In the first, a task
for each range counts the bases of the records in it.  What a range alone
cannot tell, whether its first bytes belong to a header, which record they
continue and at which base, follows from a scan over one row per range.  In the
second, tasks know that and cut each record at the borders of ranges and after
``CHUNK`` bases at most, so a record of any length is read by many tasks, also
where it stands on one line.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from contactloom.operators.ordinals import dense_ordinal
from contactloom.session import ship_package, stage
from contactloom.sources.storage import listed, located, opened, splits

#: Bytes of a range, and bases of a chunk at most.
SPLIT, CHUNK = 8 << 20, 1 << 20
#: White space that is trimmed at line ends.
SPACE = b" \t\n\x0b\f\r"
#: What a range says of the line that is open at its end.
HEADER, SEQUENCE = 1, 0


class Slice:
    """A range of a file's bytes, with what lies around it where lines cross its borders."""

    def __init__(self, file, start: int, end: int, size: int):
        self.file, self.start, self.end, self.size = file, start, end, size
        file.seek(max(start - 1, 0))
        data = file.read(end - max(start - 1, 0))
        #: whether the first byte begins a line
        self.fresh = start == 0 or data[:1] == b"\n"
        self.data = data if start == 0 else data[1:]

    def header_rest(self) -> bytes:
        """The bytes after the range up to the end of the line."""
        out, at = b"", self.end
        while at < self.size:
            self.file.seek(at)
            more = self.file.read(4096)
            cut = more.find(b"\n")
            if cut >= 0:
                return out + more[:cut]
            out, at = out + more, at + len(more)
        return out

    def ends_line(self) -> bool:
        """Whether only white space follows up to the end of the line."""
        at = self.end
        while at < self.size:
            self.file.seek(at)
            more = self.file.read(4096)
            rest = more.lstrip(b" \t\x0b\f\r")
            if rest:
                return rest[:1] == b"\n"
            at += len(more)
        return True

    def pieces(self, in_header: bool) -> Iterator[tuple[bytes | None, bytes]]:
        """Name and bases of each record's part: the one that goes on from before first, its name None."""
        data = self.data
        at = (data.find(b"\n") + 1 or len(data)) if in_header else 0
        marks, look = [0] if self.fresh and data[:1] == b">" else [], max(at - 1, 0)
        while (k := data.find(b"\n>", look)) >= 0:
            marks.append(k + 1)
            look = k + 1
        yield None, self._bases(data[at : marks[0] if marks else len(data)], not marks)
        for m, after in zip(marks, [*marks[1:], None], strict=False):
            cut = data.find(b"\n", m)
            if cut < 0:
                yield data[m + 1 :] + self.header_rest(), b""
            else:
                yield data[m + 1 : cut], self._bases(data[cut + 1 : after], after is None)

    def _bases(self, text: bytes, last: bool) -> bytes:
        lines = text.split(b"\n")
        kept = [x.rstrip(SPACE) for x in lines]
        # white space at the range's end may lie inside a line
        if last and lines and lines[-1] != kept[-1] and not self.ends_line():
            kept[-1] = lines[-1]
        return b"".join(kept)

    def open_line(self) -> int | None:
        """The kind of line that is open at the end; None if no line begins here, SEQUENCE too if the next begins right after."""
        cut = self.data.rfind(b"\n")
        if cut < 0 and not self.fresh:
            return None
        return HEADER if self.data[cut + 1 : cut + 2] == b">" else SEQUENCE


def _counted(batches):
    """For each range and record in it: its name, if it begins there, and its bases; ``k`` is 0 for the one that goes on.

    Where a range does not begin with a line, the bases of that one are given
    for both cases, that its first bytes belong to a header and that they do not.
    """
    for b in batches:
        out: list[tuple] = []
        for r in b.to_pylist():
            with opened(r["path"]) as f:
                s = Slice(f, r["start"], r["end"], r["size"])
                for in_header in (False,) if s.fresh else (False, True):
                    found = [(r["path"], r["start"], k, name and name.rstrip(SPACE).decode(), len(bases), in_header, s.open_line()) for k, (name, bases) in enumerate(s.pieces(in_header))]
                    out += found[:1] if in_header else found
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), COUNTED.values(), strict=True)], names=list(COUNTED)) if out else pa.RecordBatch.from_pylist([], pa.schema(list(COUNTED.items())))


COUNTED = {"path": pa.string(), "start": pa.int64(), "k": pa.int64(), "name": pa.string(), "bases": pa.int64(), "in_header": pa.bool_(), "open_line": pa.int32()}
ENTRY = "path string, size bigint, start bigint, `end` bigint, in_header boolean, going_on boolean, record bigint, at bigint, empty_before bigint, is_empty boolean, last_is_empty boolean"


def _entries(ranges: list[tuple], counts: dict[tuple, dict]) -> list[list]:
    """What holds where each range begins, from the counts of each in file order; rows of ``ENTRY``.

    ``record`` is the last record that has begun, over all files;
    ``going_on`` says that it is of this file, ``at`` how many bases it has so
    far.  ``empty_before`` counts records before it without any base, and
    ``is_empty`` says whether it has none itself, which later ranges may tell;
    ``last_is_empty`` is that of the last record that begins in the range.
    """
    out: list[list] = []
    record, at, empty_before, header, path, since = -1, 0, 0, False, None, 0

    def close() -> int:
        """The last record has ended: tell the ranges since it began."""
        for row in out[since:]:
            row[-2] = at == 0
        out[since - 1][-1] = at == 0
        return int(at == 0)

    for file, size, start, end in ranges:
        if file != path:
            if record >= 0:
                empty_before += close()
            path, header, at, going, since = file, False, 0, False, len(out)
        c = counts[file, start]
        out.append([file, size, start, end, header, going, record, at, empty_before, False, False])
        if going:
            at += c["header_bases"] if header else c["bases"]
        if c["begun"]:
            if going:
                empty_before += close()
            empty_before += c["empty"]
            record, at, going, since = record + c["begun"], c["tail"], True, len(out)
        if c["open_line"] is not None:
            header = c["open_line"] == HEADER
    if record >= 0:
        close()
    return out


class Read(InputPartition):
    def __init__(self, entries: list[dict]):
        self.entries = entries


def _rows(e: dict, keep_empty: bool) -> Iterator[tuple]:
    """The chunks of a range: contig_ord, name where a record begins, start, seq, and whether the record ends with it."""
    with opened(e["path"]) as f:
        parts = list(Slice(f, e["start"], e["end"], e["size"]).pieces(e["in_header"]))
    skipped, last = e["empty_before"], len(parts) - 1
    for k, (name, bases) in enumerate(parts):
        if k == 0 and not e["going_on"]:
            continue
        if k == 1:
            skipped += e["is_empty"] and e["going_on"]
        empty = e["is_empty"] if k == 0 else e["last_is_empty"] if k == last else not bases
        if keep_empty or not empty:
            first, ends = e["at"] if k == 0 else 0, k < last or e["end"] == e["size"]
            # an empty part is told of only where a record begins
            for at in range(0, len(bases), CHUNK) or ([0] if k else []):
                yield e["record"] + k - (0 if keep_empty else skipped), name.rstrip(SPACE).decode() if k and not at else None, first + at, bases[at : at + CHUNK].decode("ascii"), ends and at + CHUNK >= len(bases)
        if 0 < k < last:
            skipped += not bases


CHUNKS = pa.schema([("contig_ord", pa.int64()), ("name", pa.string()), ("start", pa.int64()), ("seq", pa.string()), ("ends", pa.bool_())])


class FastaReader(DataSourceReader):
    def __init__(self, index: str, keep_empty: bool):
        self.index, self.keep_empty = index, keep_empty

    def partitions(self) -> list[Read]:
        """A task for each range, or for as many short ones as are SPLIT bytes together."""
        import pyarrow.dataset as ds

        store, path = located(self.index)
        rows = sorted(ds.dataset(path, filesystem=store, format="parquet").to_table().to_pylist(), key=lambda r: (r["path"], r["start"]))
        tasks: list[list[dict]] = [[]]
        held = 0
        for r in rows:
            size = r["end"] - r["start"]
            if tasks[-1] and held + size > SPLIT:
                tasks.append([])
                held = 0
            tasks[-1].append(r)
            held += size
        return [Read(t) for t in tasks]

    def read(self, partition: Read) -> Iterator[pa.RecordBatch]:
        for e in partition.entries:
            if rows := list(_rows(e, self.keep_empty)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), CHUNKS.types, strict=True)], schema=CHUNKS)


class FastaSource(DataSource):
    """Options: ``index``, a table of ranges and what holds where they begin; ``keep_empty``."""

    @classmethod
    def name(cls) -> str:
        return "contactloom_fasta"

    def schema(self) -> str:
        return "contig_ord bigint, name string, start bigint, seq string, ends boolean"

    def reader(self, schema) -> FastaReader:
        return FastaReader(self.options["index"], self.options["keep_empty"] == "true")


def first_word(name):
    return F.get(F.split(name, "[ \\t]"), F.lit(0))


def _read(spark: SparkSession, path: str | list[str], keep_empty: bool, split_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Records (contig_ord, name, length) and the source's rows."""
    ship_package(spark)
    ranges = splits(listed(spark, path), split_bytes)
    rows = spark.createDataFrame(ranges, "path string, size bigint, start bigint, `end` bigint").repartition(max(1, sum(b - a for _, _, a, b in ranges) // SPLIT))
    counted = stage(rows.mapInArrow(_counted, "path string, start bigint, k bigint, name string, bases bigint, in_header boolean, open_line int"), "counted")
    last = F.max_by(F.struct("bases", "k"), "k")
    known = F.col("k") > 0
    # a row for each range, of which there are at most 100,000
    each = counted.groupBy("path", "start").agg(
        F.coalesce(F.max(F.when(~known & ~F.col("in_header"), F.col("bases"))), F.lit(0)).alias("bases"), F.coalesce(F.max(F.when(~known & F.col("in_header"), F.col("bases"))), F.lit(0)).alias("header_bases"),
        F.max("k").alias("begun"), last["bases"].alias("tail"), F.count_if(known & (F.col("bases") == 0)).alias("zeros"), F.max("open_line").alias("open_line"),
    )
    counts = {(r["path"], r["start"]): r.asDict() for r in each.collect()}
    for c in counts.values():
        # the last record of a range may go on in the next
        c["empty"] = c["zeros"] - (c["begun"] > 0 and c["tail"] == 0)
    entries = stage(spark.createDataFrame(_entries(ranges, counts), ENTRY).coalesce(1), "entries")
    parts = counted.join(F.broadcast(entries.select("path", "start", "record", "going_on", F.col("in_header").alias("begins_in_header"))), ["path", "start"])
    parts = parts.where(known | (F.col("going_on") & (F.col("in_header") == F.col("begins_in_header"))))
    records = parts.groupBy((F.col("record") + F.col("k")).alias("record")).agg(F.max("name").alias("name"), F.sum("bases").alias("length"))
    if keep_empty:
        records = records.withColumnRenamed("record", "contig_ord")
    else:
        records = dense_ordinal(records.where("length > 0"), "contig_ord", [F.col("record")]).drop("record")
    spark.dataSource.register(FastaSource)
    folder = entries.inputFiles()[0].rpartition("/")[0]
    return records.select("contig_ord", "name", "length"), spark.read.format("contactloom_fasta").options(index=folder, keep_empty=str(keep_empty).lower()).load()


def read_chunks(spark: SparkSession, path: str | list[str], keep_empty: bool = True, first_token: bool = False, split_bytes: int = SPLIT) -> tuple[DataFrame, DataFrame]:
    """Contigs (contig_ord, name, length) in file order, and their chunks (contig_ord, start, seq).

    A record begins with ``>`` at a line start and its name is the rest of that
    line; lines are trimmed at their ends and joined.  Text before a file's
    first record is ignored.  ``keep_empty=False`` drops records without a
    sequence, ``first_token`` ends names at their first white space.
    """
    records, rows = _read(spark, path, keep_empty, split_bytes)
    return records.withColumn("name", first_word("name") if first_token else F.col("name")), rows.where("seq <> ''").select("contig_ord", "start", "seq")


def read_fasta(spark: SparkSession, path: str | list[str], keep_empty: bool = True, first_token: bool = False, split_bytes: int = SPLIT) -> DataFrame:
    """Contigs with their whole sequence as one value: contig_ord, name, seq, length.

    For records that fit into a row; ``read_chunks`` has no such bound.  Only
    the parts of records that cross the borders of ranges are shuffled.
    """
    _, rows = _read(spark, path, keep_empty, split_bytes)
    whole = F.col("ends") & F.col("name").isNotNull()
    parts = F.transform(F.sort_array(F.collect_list(F.struct("start", "seq"))), lambda x: x["seq"])
    cut = rows.where(~whole).groupBy("contig_ord").agg(F.max("name").alias("name"), F.array_join(parts, "").alias("seq"))
    made = rows.where(whole).select("contig_ord", "name", "seq").unionByName(cut)
    if not keep_empty:
        made = made.where("seq <> ''")
    return made.select("contig_ord", first_word("name").alias("name") if first_token else "name", "seq", F.length("seq").cast("bigint").alias("length"))
