"""Session helpers: shipping the package, tables between steps."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once per application.

    Needed where the package is not installed on every machine.
    """
    sc = spark.sparkContext
    if getattr(sc, "_contactloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="contactloom-")) / "contactloom.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._contactloom_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or what ``setCheckpointDir`` named.

    Where neither is set, a temporary folder serves a local master; elsewhere
    other machines would not see it, so that is an error.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = getattr(sc, "_own_shared_dir", None)
    if own is None:
        own = sc._own_shared_dir = "file://" + tempfile.mkdtemp(prefix="spark-")
    return own


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it again.

    This cuts the lineage: after the loss of an executor only files are read,
    and every consumer sees the same rows.  ``drop_stages`` removes the tables.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _staged(spark).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tasks for each core where rows are spread.
TASKS_PER_CORE = 4


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows that are few bytes but much work, dealt by their keys to several tasks a core.

    Spark joins small partitions by their bytes, which would leave such rows to
    a few tasks; it keeps a given number.
    """
    return df.repartition(TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism, *keys)


def _staged(spark: SparkSession) -> list[str]:
    sc = spark.sparkContext
    if not hasattr(sc, "_contactloom_staged"):
        sc._contactloom_staged = []
    return sc._contactloom_staged


def staged_so_far(spark: SparkSession) -> int:
    return len(_staged(spark))


def drop_stages(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Delete the tables that ``stage`` wrote in this application, but for the first ``since`` and the last ``keep``.

    Call it when results are written, as they may still read them.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = _staged(spark)
    end = len(paths) - keep
    old = paths[since:end] if end > since else []
    del paths[since : since + len(old)]
    dropped = 0
    for name in old:
        path = jvm.org.apache.hadoop.fs.Path(name)
        dropped += path.getFileSystem(conf).delete(path, True)
    return dropped
