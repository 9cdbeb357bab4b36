"""Tables between two steps: Parquet files in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    A local folder, one for each application, is used only where the session names none and runs in one
    process (single-machine tests).
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
    return tempfile.gettempdir()


_MADE: set[str] = set()
_OPEN: list[list[str]] = []


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one; it is deleted when the driver ends."""
    path = f"{shared_dir(spark)}/tessella-{spark.sparkContext.applicationId}"
    if path not in _MADE:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _MADE.add(path)
    return path


#: With it Spark deletes a job's shuffle files when the job ends, else when the driver happens to collect its garbage.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """Jobs that write inside leave no shuffle files behind."""
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_GO)
        else:
            spark.conf.set(_SHUFFLES_GO, before)


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage, keeps no executor-local state, and gives later steps a
    table with statistics and column pruning.  The shuffle files of the write go with it.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    with without_shuffle_files(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`stored` that no later step reads."""
    for df in tables:
        delete(df.sparkSession, df._scratch)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables that :func:`stored` writes inside are deleted at the end, but for those given to what this yields.

    Those belong to the surrounding ``passing``, if there is one.
    """
    paths: list[str] = []
    kept: set[str] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(df._scratch)
        return df

    _OPEN.append(paths)
    try:
        yield keep
    finally:
        _OPEN.pop()
        for path in paths:
            if path not in kept:
                delete(spark, path)
            elif _OPEN:
                _OPEN[-1].append(path)
