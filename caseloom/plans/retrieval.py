"""Queries of the search layer. Queries of a search are the vectors whose id is divisible by 20, against all vectors."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import providers
from ..operators import search
from .catalogue import _BM25, keyword_search
from .registry import query
from .registry import table as _t

_SIM = """SELECT q.vec_id AS query_id, e.vec_id, e.label, round(list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 6) AS sim
FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id % 20 = 0) q"""


def _nearest(spark, d, k, by=None):
    vectors = _t(spark, d, "embeddings")
    asked = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return search.vector_topk(vectors, asked, k, by)


@query(f"SELECT query_id, vec_id, sim, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id)::INTEGER AS rank FROM ({_SIM})) WHERE rank <= 20")
def vector_topk(spark, d):
    return _nearest(spark, d, 20)


@query(f"SELECT query_id, vec_id, label, sim, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id, label ORDER BY sim DESC, vec_id)::INTEGER AS rank FROM ({_SIM})) WHERE rank <= 3")
def vector_topk_by_label(spark, d):
    return _nearest(spark, d, 3, "label")


_LEGS = f"""{_BM25}, kw AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM bm),
ve AS (SELECT query_id, vec_id AS doc_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rank FROM ({_SIM})) WHERE rank <= 20),
legs AS (SELECT query_id, kw.doc_id, kw.rank FROM kw, (SELECT DISTINCT query_id FROM ve) UNION ALL SELECT * FROM ve)
"""


@query(_LEGS + "SELECT query_id, doc_id, round(sum(1 / (60 + rank)::DOUBLE), 8) AS score, count(*)::INTEGER AS legs FROM legs GROUP BY query_id, doc_id")
def hybrid_rrf(spark, d):
    """The keyword list of 20 documents fused with the 20 nearest of each query vector."""
    ve = vector_topk(spark, d).select("query_id", F.col("vec_id").alias("doc_id"), "rank")
    return search.fuse_all([_keyword_leg(spark, d, ve), ve], ["query_id", "doc_id"])


def _keyword_leg(spark, d, asked):
    kw = keyword_search(spark, d).select("doc_id", F.row_number().over(W.orderBy(F.desc("score"), "doc_id")).alias("rank"))
    return asked.select("query_id").distinct().crossJoin(F.broadcast(kw))  # 20 rows


@query(_LEGS + """, g AS (SELECT k.query_id, dd.doc_id, row_number() OVER (PARTITION BY k.query_id ORDER BY dd.doc_id) AS rank FROM (SELECT v.query_id, s.source FROM ve v JOIN documents s USING (doc_id) WHERE v.rank = 1) k JOIN documents dd USING (source)),
every AS (SELECT * FROM legs UNION ALL SELECT query_id, doc_id, rank FROM g WHERE rank <= 20)
SELECT query_id, doc_id, round(sum(1 / (60 + rank)::DOUBLE), 8) AS score, count(*)::INTEGER AS legs FROM every GROUP BY query_id, doc_id""")
def hybrid_graph(spark, d):
    """With a third leg over the graph: the 20 first documents that share the source of a query's nearest document."""
    ve = vector_topk(spark, d).select("query_id", F.col("vec_id").alias("doc_id"), "rank")
    docs = _t(spark, d, "documents").select("doc_id", "source")
    # The 20 first of each source are found before queries meet them, by partial lists of each bucket.
    bucket = docs.withColumn("_b", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    first = lambda df, *part: df.withColumn("rank", F.row_number().over(W.partitionBy(*part).orderBy("doc_id"))).where("rank <= 20")
    heads = first(first(bucket, "source", "_b").drop("rank"), "source").drop("_b")
    near = ve.where("rank = 1").join(docs, "doc_id").select("query_id", "source")
    return search.fuse_all([_keyword_leg(spark, d, ve), ve, near.join(heads, "source").select("query_id", "doc_id", "rank")], ["query_id", "doc_id"])


@query(r"SELECT conv_id, turn, m.word AS mention, m.k::INTEGER AS place FROM (SELECT conv_id, turn, unnest(list_transform(regexp_extract_all(text, '[A-Z][a-z]{3,}'), lambda x, i: {'word': x, 'k': i - 1})) AS m FROM conversations)")
def mention_udtf(spark, d):
    """One text to many rows by a table function: capitalised words of four letters and more, in order."""
    providers.register_mentions(spark)
    _t(spark, d, "conversations").createOrReplaceTempView("caseloom_turns")
    return spark.sql("SELECT conv_id, turn, m.mention, m.place FROM caseloom_turns, LATERAL caseloom_mentions(text) m")


@query("SELECT event_type, count(DISTINCT user_id) AS users, true AS near FROM events GROUP BY event_type")
def approximate_users(spark, d):
    """Distinct users exactly and by a sketch; near says that the sketch is within 6 % of the exact number."""
    # A sketch of each user would stand beside each key of a plan that counts both at once; of distinct rows, a type has one.
    g = _t(spark, d, "events").select("event_type", "user_id").distinct().groupBy("event_type").agg(F.count("user_id").alias("users"), F.approx_count_distinct("user_id", 0.02).alias("sketch"))
    return g.select("event_type", "users", (F.abs(F.col("sketch") - F.col("users")) <= 0.06 * F.col("users")).alias("near"))


@query("SELECT user_id, array_to_string(list_sort(list_transform(map_entries(histogram(event_type)), lambda e: e.key || '=' || e.value)), ',') AS counts, count(*) AS n FROM events GROUP BY user_id")
def event_maps(spark, d):
    """Counts by type as a map for each user, made from a list of entries."""
    g = _t(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n")).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"), F.sum("n").alias("n"))
    shown = F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return g.select("user_id", F.array_join(F.array_sort(shown), ",").alias("counts"), "n")
