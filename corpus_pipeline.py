"""A corpus pipeline over documents: toxicity, exact dedup, near-dedup, mixing, BPE encoding.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns
of documents, but for the last, which returns the encoded documents. Stages behave alike at every size.

Defined results, for every stage: a null text counts as empty; texts of any length are read whole; an empty
table gives an empty result; other columns come along as they are, whatever their names. Repeated rows
stay as many as they are in toxicity, mixing and BPE; the two dedups leave one of them. Ties: in toxicity a
score of exactly 0.7 is toxic; in exact dedup, of rows equal in text and doc_id any one stays, they being
equal in what is compared; in near-dedup a similarity of exactly 0.8 joins, and of the least doc_id's
rows one stays; in mixing equal ranks are taken in the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseloom.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from caseloom.llm.common import pack, settle, shared_dir, sweep, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7, by a classifier trained on the labelled ones among them."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scores(pack(docs), model).where(F.col("toxic_score") < toxicity.TOXIC).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest doc_id."""
    return exact_dedup.keep_one(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document, that with the least doc_id."""
    groups = near_dedup.near_duplicates(spark, docs, carry=True)
    # One text stays per group, and one row of that text: both are chosen by ids and digests, before texts move.
    best = groups.groupBy("group_id").agg(F.min(F.struct("id", "digest")).alias("best")).select(F.col("best.digest").alias("kept"))
    best = settle(best, f"{shared_dir(spark)}/kept")
    marked = pack(docs).withColumn("key", F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))).drop("text")
    first = F.row_number().over(W.partitionBy("key").orderBy(F.col("doc_id").asc_nulls_last()))
    return marked.join(best, F.col("key") == F.col("kept"), "left_semi").withColumn("n", first).where("n = 1").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: a document taken twice comes twice, one not taken not at all."""
    taken = mixing.mix(spark, pack(docs).withColumn("source", F.col("row.source")), carry=["row"])
    return taken.where("copies > 0").select("_c_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("_c_row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document of the mix."""
    return bpe.encode_documents(docs, bpe.default_vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL can express neither a trained classifier nor consistent sampling; a test holds run() against plain versions of the stages, the
#: trained weights being those of the operator.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over documents, each written as Parquet and read again."""
    work = shared_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with sweep(spark):  # what a stage's operators wrote goes when its result is written
            docs = settle(stage(spark, docs, sf_dir), f"{work}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
