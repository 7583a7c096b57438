"""Helpers that several training-data operators share."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage. Only on one machine does the warehouse stand in where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return found or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"


def written(df: DataFrame, partition: str | None = None) -> DataFrame:
    """Write df to the shared folder as Parquet, in folders by `partition` if given, and read it back.

    Lineage ends there, so a lost executor costs one reread, and the size of
    the table is known to the planner. The folder goes with erase() or when the
    driver ends.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    (df.write.partitionBy(partition) if partition else df.write).parquet(path)
    hadoop, files = _file_system(spark, path)
    files.deleteOnExit(hadoop)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def erase(*tables: DataFrame) -> None:
    """Delete tables of written() that nothing reads any more, and let Spark drop shuffle files that nothing refers to."""
    for df in tables:
        hadoop, files = _file_system(df.sparkSession, df.written_path)
        files.delete(hadoop, True)
    if tables:
        tables[0].sparkSession.sparkContext._jvm.System.gc()  # its cleaner follows the driver's garbage collector


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def packed(values: np.ndarray) -> bytes:
    """An array as bytes: type, length, and the values' bytes by place, compressed."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    head = values.dtype.str.encode().ljust(4) + len(values).to_bytes(8, "little")
    return head + pa.Codec("zstd", compression_level=1).compress(planes, asbytes=True)


def unpacked(data) -> np.ndarray:
    data = memoryview(data)
    kind, n = np.dtype(bytes(data[:4]).decode().strip()), int.from_bytes(data[4:12], "little")
    planes = pa.Codec("zstd").decompress(data[12:], n * kind.itemsize, asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T.copy().view(kind).reshape(n)


#: Rows of texts that Spark hands to Python at once. Its default of 10,000 takes executors hundreds of MB outside the heap.
TEXTS_AT_ONCE = 1_000


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_before: dict[str, str] = {}  # the session's own number, by application


def small_batches(df: DataFrame) -> DataFrame:
    """df, with the session's Arrow batches set to TEXTS_AT_ONCE rows where they are larger. Plans read this when they run; own_batches() undoes it."""
    spark = df.sparkSession
    now = spark.conf.get(_BATCH)
    if int(now) <= 0 or int(now) > TEXTS_AT_ONCE:
        _before[spark.sparkContext.applicationId] = now
        spark.conf.set(_BATCH, str(TEXTS_AT_ONCE))
    return df


def own_batches(spark: SparkSession) -> None:
    """Give the session back the size of Arrow batches that it had before small_batches()."""
    before = _before.pop(spark.sparkContext.applicationId, None)
    if before is not None:
        spark.conf.set(_BATCH, before)


def crc_mod(name: str, n: int) -> Column:
    """crc32 of the value as text, modulo n (a null value counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % n


def kept(name: str, make):
    """What a Python worker keeps from task to task: the last asked for, under its name (a cache that is cheap to lose)."""
    import sys
    import types

    holder = sys.modules.setdefault("_gridlode_kept", types.ModuleType("_gridlode_kept"))
    if getattr(holder, "name", None) != name:
        holder.name, holder.value = name, make()  # workers serve many operators, so theirs don't add up
    return holder.value


def shared(spark: SparkSession, value):
    """Broadcast a value; the function that is returned gives it back, on workers without the package too."""
    data = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get():
        from pyspark import cloudpickle

        return cloudpickle.loads(data.value)

    return get
