"""Intermediate tables in a folder that all executors share."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_open: list[list[str]] = []  # paths of written(), by the erased_after() that is open


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the session names. Only on one machine does the warehouse stand in where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return folder


def written(df: DataFrame) -> DataFrame:
    """df written as Parquet and read back, so that what is behind it runs once.

    The folder goes when the innermost erased_after() around the call ends, else when the driver does.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(path)
    df.write.parquet(path)
    hadoop, files = _file_system(spark, path)
    files.deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows of an input that has less than a split for each core, dealt out to all cores.

    A scan can't part a file's row groups, so what is computed next to it would run
    on few cores. An input of more splits than cores, by its size, is left as it is:
    it needs no exchange, and one would cost more the larger it is.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores) if 1 < cores and size < cores * split else df


@contextlib.contextmanager
def erased_after(spark: SparkSession) -> Iterator[None]:
    """Erase at the end what written() has made within, as a long stream of runs would fill the folder."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            hadoop, files = _file_system(spark, path)
            files.delete(hadoop, True)
            files.cancelDeleteOnExit(hadoop)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
