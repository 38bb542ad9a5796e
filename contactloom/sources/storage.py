"""Files that tasks open by themselves: listed by Spark, opened by pyarrow."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def listed(spark: SparkSession, paths: str | list[str]) -> list[tuple[str, int]]:
    """Path and size of each file, in the order of paths; their content is not read."""
    rows = spark.read.format("binaryFile").load(paths).select("path", "length")
    return sorted((r["path"], r["length"]) for r in rows.collect())


def located(uri: str):
    """A pyarrow file system and a path in it; Hadoop's spelling of local and S3 paths is understood."""
    from pyarrow import fs

    uri = re.sub("^s3[an]:", "s3:", re.sub("^file:/+", "file:///", uri))
    return fs.FileSystem.from_uri(uri)


def opened(uri: str):
    store, path = located(uri)
    return store.open_input_file(path)


def splits(files: list[tuple[str, int]], size: int, most: int = 100_000) -> list[tuple[str, int, int, int]]:
    """(file, file's size, start, end) of ranges of about ``size`` bytes, longer if there were more than ``most``."""
    size = max(size, -(-sum(n for _, n in files) // most))
    return [(f, n, a, min(a + size, n)) for f, n in files for a in range(0, n, size)]


class Parts:
    """Files of a folder written by tasks: they get their names when all tasks are done."""

    def __init__(self, folder: str, suffix: str):
        self.folder, self.suffix, self.job = folder.rstrip("/"), suffix, uuid.uuid4().hex

    def open(self, part: int):
        """A new file of a task, and its name; a task that is run again writes another one."""
        name = f"part-{part:05d}-{uuid.uuid4().hex}{self.suffix}"
        store, path = located(f"{self.folder}/_temporary-{self.job}")
        store.create_dir(path, recursive=True)
        return store.open_output_stream(f"{path}/{name}"), name

    def commit(self, names: list[str]) -> None:
        store, to = located(self.folder)
        store.create_dir(to, recursive=True)
        for name in names:
            store.move(f"{to}/_temporary-{self.job}/{name}", f"{to}/{name}")
        self.abort()

    def abort(self) -> None:
        store, path = located(f"{self.folder}/_temporary-{self.job}")
        if store.get_file_info(path).type.name == "Directory":
            store.delete_dir(path)


def new_folder(spark: SparkSession, path: str) -> None:
    """Refuse to write where something is, as Spark's own writers do."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        raise FileExistsError(path)


