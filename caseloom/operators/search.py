"""Vector and keyword search, their fusion, and the question-answering surface over them."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, IntegerType

from . import graph


def _blocks(df: DataFrame, key: str, rows: int) -> tuple[DataFrame, int]:
    """``df`` with the number ``_block`` of a row's block of about ``rows`` rows, and how many blocks there are."""
    n = max(1, -(-df.count() // rows))
    return df.withColumn("_block", F.pmod(F.xxhash64(key), F.lit(n)).cast("int")), n


def vector_topk(vectors: DataFrame, queries: DataFrame, k: int = 20, by: str | None = None, rows: int = 16384) -> DataFrame:
    """For each of ``queries`` (query_id, query) the ``k`` nearest of ``vectors`` (vec_id, embedding, ...) by cosine.

    Columns: query_id, vec_id, [by,] sim and rank, over all or within each value of ``by``; ties by vec_id.
    Blocks of queries meet blocks of vectors, each pair of blocks gives its ``k`` best by a matrix product in
    double precision, and only these meet again: rows grow with queries times blocks, not times vectors.
    A task's Python holds one pair of blocks at a time, as arrays of numbers, and the products of 128 queries.
    Null, zero and non-finite vectors, and those of another length, are near to nothing.
    """
    kind, qkind = (df.schema[c].dataType.simpleString() for df, c in ((vectors, "vec_id"), (queries, "query_id")))
    label = vectors.schema[by].dataType.simpleString() if by else "int"
    fields = [to_arrow_type(t) for t in (queries.schema["query_id"].dataType, vectors.schema["vec_id"].dataType, vectors.schema[by].dataType if by else IntegerType(), DoubleType())]
    # Floats are shuffled as they are, half as wide.
    numbers = lambda df, c: F.col(c) if df.schema[c].dataType.simpleString() == "array<float>" else F.col(c).cast("array<double>")
    side = vectors.select(F.col("vec_id").alias("id"), (F.col(by) if by else F.lit(0)).alias("label"), numbers(vectors, "embedding").alias("v")).where("v IS NOT NULL")
    asked = queries.select(F.col("query_id").alias("id"), numbers(queries, "query").alias("v")).where("v IS NOT NULL")
    (left, n), (right, m) = _blocks(asked, "id", rows // 4), _blocks(side, "id", rows)
    each = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    left = left.select(F.col("id").alias("id"), F.col("v").alias("v"), F.col("_block").alias("_q"), each(m).alias("_x"))
    right = right.select(F.col("id").alias("id"), "label", F.col("v").alias("v"), each(n).alias("_q"), F.col("_block").alias("_x"))

    def parts(t):
        """(dimension, places, unit vectors) of the vectors of each length that have a direction."""
        import numpy as np

        v = t["v"].combine_chunks()
        size = np.diff(v.offsets.to_numpy())
        flat, start = v.values.to_numpy(zero_copy_only=False).astype(float), v.offsets.to_numpy()[:-1]
        for dim in np.unique(size[size > 0]):
            at = np.flatnonzero(size == dim)
            x = flat[start[at][:, None] + np.arange(dim)]
            good = np.isfinite(x).all(1) & x.any(1)
            yield dim, at[good], x[good] / np.linalg.norm(x[good], axis=1, keepdims=True)

    def meet(q, x):
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        out = [[], [], [], []]
        if len(q) and len(x):
            theirs = {dim: (at, u) for dim, at, u in parts(x)}
            names, every, kinds = q["id"].to_pylist(), np.array(x["id"].to_pylist()), np.array(x["label"].to_pylist())
            for dim, ours, units in parts(q):
                if dim not in theirs or not len(ours) or not len(theirs[dim][0]):
                    continue
                at, u = theirs[dim]
                ids, labels = every[at], kinds[at]
                places = [np.flatnonzero(labels == value) for value in pd.unique(labels)] if by else [np.arange(len(at))]
                for a in range(0, len(ours), 128):
                    sims = np.round(units[a : a + 128] @ u.T, 6)
                    for place in places:
                        some = sims[:, place]
                        least = np.partition(some, len(place) - k, axis=1)[:, len(place) - k] if len(place) > k else np.full(len(some), -np.inf)
                        for i, row in enumerate(some):
                            near = np.flatnonzero(row >= least[i])  # the k nearest and what ties with the last
                            near = near[np.lexsort((ids[place[near]], -row[near]))[:k]]
                            out[0] += [names[ours[a + i]]] * len(near)
                            for column, found in zip(out[1:], (ids[place[near]], labels[place[near]], row[near])):
                                column += found.tolist()
        return pa.table({c: pa.array(values, t) for c, values, t in zip(("query_id", "vec_id", "label", "sim"), out, fields)})

    # A pair of blocks is one group: no task has several of them in memory at once.
    found = left.groupBy("_q", "_x").cogroup(right.groupBy("_q", "_x")).applyInArrow(meet, f"query_id {qkind}, vec_id {kind}, label {label}, sim double")
    part = W.partitionBy("query_id", "label").orderBy(F.desc("sim"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k)
    return best.withColumnRenamed("label", by) if by else best.drop("label")


def term_index(docs: DataFrame) -> DataFrame:
    """Inverted index: token, doc_id, tf, n (tokens of the document)."""
    w = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{Nd}]+"), lambda x: x != "")
    tokens = docs.select("doc_id", F.size(w).alias("n"), F.explode(w).alias("token"))
    return tokens.groupBy("token", "doc_id", "n").agg(F.count(F.lit(1)).alias("tf"))


def keyword_search(docs: DataFrame, terms: list[str], k: int = 20, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """BM25 over the documents that hold a term: doc_id, score of the k best."""
    w = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{Nd}]+"), lambda x: x != "")
    sized = docs.select("doc_id", w.alias("w")).select("doc_id", F.size("w").alias("n"), F.filter("w", lambda x: x.isin(*terms)).alias("hits"))
    totals = sized.agg(F.count(F.lit(1)).alias("docs"), F.avg("n").alias("mean"))
    hits = sized.select("doc_id", "n", F.explode("hits").alias("token")).groupBy("token", "doc_id", "n").agg(F.count(F.lit(1)).alias("tf"))
    df = hits.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    j = hits.join(F.broadcast(df), "token").crossJoin(F.broadcast(totals))  # one row of totals
    idf = F.log(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    score = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("n") / F.col("mean")))
    return j.groupBy("doc_id").agg(F.round(F.sum(score), 6).alias("score")).orderBy(F.desc("score"), "doc_id").limit(k)


def fuse(left: DataFrame, right: DataFrame, key: str | list[str], c: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of two ranked lists (key, rank)."""
    return fuse_all([left, right], [key] if isinstance(key, str) else key, c)


def fuse_all(legs: list[DataFrame], key: list[str], c: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of any number of ranked lists: the sum of 1 / (c + rank) for each key, and how many lists have it."""
    every = reduce(DataFrame.unionByName, [leg.select(*key, "rank") for leg in legs])
    return every.groupBy(*key).agg(F.round(F.sum(1 / (c + F.col("rank"))), 8).alias("score"), F.count(F.lit(1)).cast("int").alias("legs"))


def graph_leg(edges: DataFrame, seeds: DataFrame, hops: int = 3, k: int = 20) -> DataFrame:
    """(key, rank) of the ``k`` nodes nearest to ``seeds`` (key) over ``edges``, by hops, then key; seeds aren't in it."""
    near = graph.expand(edges, seeds, hops).where("hop > 0").orderBy("hop", "key").limit(k)
    return near.select("key", F.row_number().over(W.orderBy("hop", "key")).alias("rank"))  # k rows


#: Question forms and the SQL they stand for; names in braces are parameters of the SQL.
TEMPLATES = [
    (re.compile(r"who (?:participated in|attended) (?P<event>.+?)\??$", re.I), "SELECT src_key AS answer FROM edges WHERE rel = 'PARTICIPATED_IN' AND dst_key = :event"),
    (re.compile(r"where did (?P<event>.+?) (?:occur|happen|take place)\??$", re.I), "SELECT dst_key AS answer FROM edges WHERE rel = 'OCCURRED_AT' AND src_key = :event"),
    (re.compile(r"which documents mention (?P<name>.+?)\??$", re.I), "SELECT dst_key AS answer FROM edges WHERE rel = 'MENTIONED_IN' AND src_key = :name"),
    (re.compile(r"who is associated with (?P<name>.+?)\??$", re.I), "SELECT dst_key AS answer FROM edges WHERE rel = 'ASSOCIATED_WITH' AND src_key = :name UNION SELECT src_key FROM edges WHERE rel = 'ASSOCIATED_WITH' AND dst_key = :name"),
]


def to_sql(question: str) -> tuple[str, dict[str, str]]:
    """SQL over the view ``edges`` and its parameters; ValueError for a question of no known form."""
    for form, sql in TEMPLATES:
        if m := form.match(question.strip()):
            return sql, m.groupdict()
    raise ValueError(f"no template for: {question}")


def answer(spark: SparkSession, edges: DataFrame, question: str) -> DataFrame:
    sql, args = to_sql(question)
    return spark.sql(sql.replace("FROM edges", "FROM {edges}"), args=args, edges=edges)


def engine(spark: SparkSession, edges: DataFrame, docs: DataFrame, question: str, hops: int = 3, k: int = 20, least: int = 2) -> dict[str, DataFrame]:
    """answer, sources, patterns and graph_context of a question: search, then expansion, then patterns.

    ``edges`` has src_key, rel, dst_label, dst_key; ``docs`` has doc_id, text. The answer comes from the
    question's template, or is empty where it has none; sources are the documents that the answers are
    mentioned in and those that the question's words find, fused by rank; the context is what lies within
    ``hops`` of the names in the question and the answers; patterns are the answers with ``least`` documents.
    """
    try:
        found, names = answer(spark, edges, question).distinct(), list(to_sql(question)[1].values())
    except ValueError:
        found, names = spark.createDataFrame([], "answer string"), []
    words = sorted({w for w in re.split(r"[^\w]+", question.lower()) if len(w) > 3})
    cited = edges.where("rel = 'MENTIONED_IN'").join(F.broadcast(found.limit(k)), F.col("src_key") == F.col("answer"))
    counted = cited.groupBy(F.col("dst_key").alias("doc")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "doc").limit(k)
    by_graph = counted.select("doc", F.row_number().over(W.orderBy(F.desc("n"), "doc")).alias("rank"))  # k rows
    by_words = keyword_search(docs, words, k).select(F.col("doc_id").cast("string").alias("doc"), F.row_number().over(W.orderBy(F.desc("score"), "doc_id")).alias("rank"))
    seeds = found.select(F.col("answer").alias("key")).union(spark.createDataFrame([(n,) for n in names], "key string")).distinct()
    context = graph.expand(edges.select(F.col("src_key").alias("src"), F.col("dst_key").alias("dst")), seeds, hops)
    patterns = cited.groupBy("answer").agg(F.count_distinct("dst_key").alias("n_docs")).where(F.col("n_docs") >= least)
    return {"answer": found, "sources": fuse_all([by_graph, by_words], ["doc"]), "patterns": patterns, "graph_context": context}
