"""Edge records of 16 bytes as a Spark data source, and a writer of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from contactloom.session import ship_package, stage
from contactloom.sources.storage import Parts, listed, located, new_folder, opened, splits

EDGES = "src bigint, dst bigint, contacts bigint"
# fixed values: the fields of a record
RECORD = np.dtype([("start", "<i4"), ("end", "<i4"), ("count", "<u8")])
#: Bytes of a range, and of a batch; multiples of a record.
SPLIT, BATCH = 64 << 20, 1 << 20


class Range(InputPartition):
    def __init__(self, row: tuple[str, int, int]):
        self.row = row


class EdgeReader(DataSourceReader):
    def __init__(self, index: str):
        self.index = index

    def partitions(self) -> list[Range]:
        import pyarrow.dataset as ds

        store, path = located(self.index)
        rows = ds.dataset(path, filesystem=store, format="parquet").to_table().to_pylist()
        return [Range((r["path"], r["start"], r["end"])) for r in rows] or [Range(("", 0, 0))]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        path, at, end = partition.row
        if at == end:
            return
        with opened(path) as f:
            f.seek(at)
            while at < end:
                data = f.read(min(BATCH, end - at))
                if not data or len(data) % RECORD.itemsize:
                    raise ValueError(f"{path} is not made of whole records")
                e = np.frombuffer(data, RECORD)
                a, b = e["start"].astype(np.int64), e["end"].astype(np.int64)
                yield pa.RecordBatch.from_pydict({"src": np.minimum(a, b), "dst": np.maximum(a, b), "contacts": e["count"].astype(np.int64)})
                at += len(data)


class Written(WriterCommitMessage):
    def __init__(self, name: str):
        self.name = name


class EdgeWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.parts = Parts(path, ".edge")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        out, name = self.parts.open(TaskContext.get().partitionId())
        with out:
            for b in batches:
                src, dst, contacts = (b.column(c).to_numpy() for c in ("src", "dst", "contacts"))
                records = np.zeros(b.num_rows, RECORD)
                # the larger id comes first
                records["start"], records["end"], records["count"] = np.maximum(src, dst), np.minimum(src, dst), contacts
                out.write(records.tobytes())
        return Written(name)

    def commit(self, messages: list) -> None:
        self.parts.commit([m.name for m in messages if m is not None])

    def abort(self, messages: list) -> None:
        self.parts.abort()


class EdgeSource(DataSource):
    """Options: ``index``, a table of byte ranges; for writing ``path``."""

    @classmethod
    def name(cls) -> str:
        return "contactloom_edges"

    def schema(self) -> str:
        return EDGES

    def reader(self, schema) -> EdgeReader:
        return EdgeReader(self.options["index"])

    def writer(self, schema, overwrite: bool) -> EdgeWriter:
        return EdgeWriter(self.options["path"])


def read_edges(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """16-byte records of two 32-bit ids and a 64-bit count, as src <= dst.

    A task reads a range of bytes and hands on Arrow columns; no record is a
    Python object.
    """
    ship_package(spark)
    ranges = spark.createDataFrame([(f, a, b) for f, _, a, b in splits(listed(spark, paths), SPLIT)], "path string, start bigint, `end` bigint")
    index = stage(ranges.coalesce(1), "ranges")
    spark.dataSource.register(EdgeSource)
    return spark.read.format("contactloom_edges").option("index", index.inputFiles()[0].rpartition("/")[0]).load()


def write_edges(edges: DataFrame, path: str) -> None:
    """A folder of record files, one for each task."""
    spark = edges.sparkSession
    ship_package(spark)
    new_folder(spark, path)
    spark.dataSource.register(EdgeSource)
    edges.selectExpr("cast(src as bigint) as src", "cast(dst as bigint) as dst", "cast(contacts as bigint) as contacts").write.format("contactloom_edges").mode("append").option("path", path).save()
