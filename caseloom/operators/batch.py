"""Work selection, splitting and idempotent sinks for restartable batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def remaining(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return work.join(done.select(key).distinct(), key, "left_anti")


def merge_manifest(existing: DataFrame, new: DataFrame, key: str = "doc_id") -> DataFrame:
    """New rows replace old ones of the same key."""
    return existing.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def first_write(existing: DataFrame, new: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``new`` to append: with text, and of a key not written before."""
    return remaining(new.where(F.length(F.col(text)) > 0), existing, key)


def split_errors(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and the error side output."""
    return results.where("error IS NULL").drop("error"), results.where("error IS NOT NULL")


def _numbered(df: DataFrame, order: str, settle=None) -> DataFrame:
    """A 0-based position in the whole order: sorted range partitions, each numbered alone, shifted by those before it.

    ``settle`` may write the numbered ranges to shared storage, so that positions and shifts come from the
    same ranges even when tasks are repeated.
    """
    ranged = df.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_m", F.monotonically_increasing_id())
    ranged = settle(ranged) if settle else ranged
    part = F.shiftright("_m", 33)
    sizes = ranged.groupBy(part.alias("_p")).count()
    shift = sizes.select("_p", F.coalesce(F.sum("count").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_s"))  # a row a partition
    place = F.col("_s") + F.col("_m").bitwiseAND((1 << 33) - 1)
    return ranged.join(F.broadcast(shift), part == F.col("_p")).withColumn("_k", place).drop("_p", "_m", "_s")


def split_even(df: DataFrame, n: int, total: int, order: str = "doc_id", settle=None) -> DataFrame:
    """``n`` contiguous parts, the remainder spread over the first, as ``chunk``."""
    size, extra = divmod(total, n)
    k = F.col("_k")
    big = extra * (size + 1)
    part = F.when(k < big, F.floor(k / (size + 1))).otherwise(extra + F.floor((k - big) / max(size, 1)))
    return _numbered(df, order, settle).withColumn("chunk", part.cast("long")).drop("_k")


def split_ceil(df: DataFrame, n: int, total: int, order: str = "doc_id", settle=None) -> DataFrame:
    """Contiguous parts of ceil(total / n); the last may be short or absent."""
    return _numbered(df, order, settle).withColumn("chunk", F.floor(F.col("_k") / max(1, -(-total // n))).cast("long")).drop("_k")


def split_round_robin(df: DataFrame, n: int, order: str = "doc_id", settle=None) -> DataFrame:
    return _numbered(df, order, settle).withColumn("chunk", (F.col("_k") % n).cast("long")).drop("_k")
