"""Helpers that the operators of this subpackage share.

Intermediate tables live in the folder that the cluster names in
``spark.checkpoint.dir``, so that a lost executor never takes results with it. Where
that setting is absent a local session, as in tests, gets a folder of its own; a
cluster without it is an error, as executors don't see the driver's disk.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that one Arrow batch may hold. Texts may be long, so batches are short.
ARROW_ROWS = 256

#: Up to so many keys of documents (some 60 bytes each in a task's table) are broadcast.
BROADCAST_KEYS = 500_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of the folder ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def configure(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for whole, long texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors and the driver share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    set_already = spark.sparkContext.getCheckpointDir()
    if not set_already:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tilewright-"))
        set_already = spark.sparkContext.getCheckpointDir()
    return set_already.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release() -> None:
    """Give memory that a worker no longer needs back to the system: workers are used again by other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()  # Arrow's allocator is its own
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    Smaller on disk than a checkpoint, for tables that grow with the input. The
    files go when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def semi_join(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose id and text (as XXH64, a null one is empty) are in the written table ``keys`` (__id, __th), or are not.

    Up to BROADCAST_KEYS keys are broadcast, so that texts stay where they are; beyond that the join shuffles them.
    """
    some = keys.select("__id", "__th")
    few = some.count() <= BROADCAST_KEYS
    th = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return docs.join(F.broadcast(some) if few else some, docs[id_col].eqNullSafe(F.col("__id")) & (th == F.col("__th")), how)


def lower_ascii(column: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(column, _UPPER, _UPPER.lower())
