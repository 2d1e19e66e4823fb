"""Intermediate tables in the shared folder, and small frame helpers.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir``, which every
executor can read; a task lost later is recomputed from those files. The
folder of a session is deleted when the driver ends, or earlier by ``release``.
"""

from __future__ import annotations

import atexit
import ctypes
import functools

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from martlet.session import scratch_path

_made: dict[str, list[str]] = {}


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    app = spark.sparkContext.applicationId
    if app not in _made:
        _made[app] = []
        atexit.register(release, spark)
    _made[app].append(path)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the session's intermediate tables; frames that read them are then void."""
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _made.pop(spark.sparkContext.applicationId, []):
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
    except Exception as e:                      # at exit the JVM may be gone already
        if spark.sparkContext._jsc is not None:
            print(f"intermediate tables not deleted: {type(e).__name__}")


def remainder(column: str, mod: int):
    """crc32 of a column as text, modulo ``mod``; a null counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % mod


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def task(run):
    """A function of record batches that returns freed memory to the system at its end; workers live on for other tasks."""
    @functools.wraps(run)
    def wrapped(batches):
        yield from run(batches)
        trim()
    return wrapped


def trim() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:                      # a C library without it
        pass
