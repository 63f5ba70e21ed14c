"""Tables that a query writes for itself, in a folder that all executors see."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder that all executors see: under spark.checkpoint.dir, or local where all of Spark runs on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="seqlake-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Spark drops the shuffle files of a query when it ends, in place of some time after the driver has forgotten the query.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Writes in here leave no shuffle files, so the disk holds those of one write at a time."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def store(df: DataFrame, path: str) -> None:
    """Write ``df`` to ``path``, and leave nothing else of it on disk."""
    with cleaned(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table on disk: computed once, and read by all that follows."""
    return written_in_parts([df], label)


def written_in_parts(parts: Iterable[DataFrame], label: str) -> DataFrame:
    """The rows of ``parts``, which are of one schema, as one table on disk, written one after the other."""
    path = None
    for i, df in enumerate(parts):
        path = path or scratch(df.sparkSession, label)
        store(df, f"{path}/{i}")
    return df.sparkSession.read.schema(df.schema).option("recursiveFileLookup", "true").parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Take away a folder of :func:`scratch` that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
