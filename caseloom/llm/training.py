"""Labelled rows for the classifiers: a bounded sample, chosen by hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, held_out: int, most: int) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled documents outside the held-out fold.

    Of the labels that have a document, those with the least hashes of doc_id are taken, so the sample is
    the same in each run and labels without a document use up nothing of the bound. A doc_id with several
    labels counts with the largest, one with several texts with the least text; null labels are ignored.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), mod) != held_out))
    known = usable.select("doc_id", F.col(label).cast("int").alias("label")).join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = known.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id", F.lit(label)), "doc_id").limit(most)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
