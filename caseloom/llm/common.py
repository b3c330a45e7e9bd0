"""Shared plumbing of the training-data operators: table access, shared work folders, hash folds."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Work folders of this process, in the order in which they were asked for.
_made: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder that the driver and all executors can reach.

    It lies under ``spark.checkpoint.dir``. Only where that is unset and the master is local (tests) is a
    local temporary folder taken, and then recorded in the session so that later calls agree; on a
    cluster without that setting a ValueError is raised, as executors would write to their own disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="caseloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    made = f"{base.rstrip('/')}/caseloom/{uuid.uuid4().hex}"
    _made.append(made)
    return made


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in whatever store it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


@contextmanager
def sweep(spark: SparkSession) -> Iterator[None]:
    """Delete the work folders that were asked for inside, once all that was made from them has been written elsewhere."""
    before = len(_made)
    yield
    for path in _made[before:]:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    del _made[before:]


def settle(df: DataFrame, path: str) -> DataFrame:
    """Cut lineage: write to the shared folder and read back, so a lost executor costs no recomputation."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pack(docs: DataFrame) -> DataFrame:
    """row (all columns as they are), doc_id, text: so that no column's name can clash with an operator's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")


def fold(column: Column, mod: int) -> Column:
    """crc32 of the value as text, modulo ``mod``; a null value counts as the empty text (remainder 0)."""
    return F.coalesce(F.crc32(column.cast("string")) % mod, F.lit(0)).cast("int")


def gapless(df: DataFrame, part: list[str], order: list[str], out: str, buckets: int) -> DataFrame:
    """Add ``out``, a 0-based index without gaps in each group of ``part``, without one task per group.

    Rows go to (group, hash bucket); each bucket is numbered alone and shifted by the counts of the
    buckets before it. ``buckets`` grows with the input, so a group that holds a third of all rows is
    still numbered by many tasks. Equal rows get different indexes.
    """
    from pyspark.sql import Window as W

    df = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(max(1, buckets))).cast("int"))
    keys = [*part, "_b"]
    before = W.partitionBy(*part).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    shift = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    local = df.withColumn("_i", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return local.join(shift, keys).withColumn(out, (F.col("_shift") + F.col("_i") - 1).cast("long")).drop("_b", "_i", "_shift")


def slices(batch: pa.RecordBatch, text: int, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``size`` bytes of text in column ``text``, one row at least, so that a worker's arrays stay bounded."""
    total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + size, "right")))
        yield batch.slice(at, end - at)
        at = end


def give_back() -> None:
    """Return freed memory to the system at the end of a Python task: the worker lives on idle beside its executor's JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
