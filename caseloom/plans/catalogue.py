"""Named queries over the standard tables, each with its oracle SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import providers, text as T
from ..operators import batch, duplicates, graph, patterns, quality, schema, search
from ..streaming import sessions as streaming
from .registry import ORACLES, QUERIES, query  # noqa: F401 the lists are read from here
from .registry import table as _t

EVENT_TYPES = ["signup", "error", "click", "view"]
TERMS = ["the", "ention", "ble"]


_Q = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents),
w AS (SELECT *, CASE WHEN n >= 20 THEN list_transform(range(0, n - 10, greatest(1, n // 100)), lambda i: substr(t, i + 1, 10)) END AS win,
 list_filter(regexp_split_to_array(lower(t), '\s+'), lambda x: x <> '') AS words, regexp_replace(t, '[ .\n]', '', 'g') AS rest FROM d),
m AS (SELECT doc_id, t, n, CASE WHEN n < 20 THEN 0.0 ELSE (len(win) - len(list_distinct(win)))::DOUBLE / len(win) END AS rep,
 CASE WHEN len(words) < 10 THEN 0.0 ELSE len(list_distinct(words))::DOUBLE / len(words) END AS uniq,
 length(rest) > 0 AND length(regexp_replace(rest, '\P{Nd}', '', 'g'))::DOUBLE / greatest(length(rest), 1) > 0.8 AS seq FROM w),
i AS (SELECT *, list_filter([CASE WHEN length(regexp_replace(t, '^\s+|\s+$', '', 'g')) < 20 THEN 'too_short' END, CASE WHEN rep > 0.5 THEN 'repetition' END, CASE WHEN uniq > 0 AND uniq < 0.3 THEN 'low_diversity' END, CASE WHEN seq THEN 'number_sequence' END,
 CASE WHEN (n - length(replace(t, E'object\nobject\nobject', ''))) // 20 > 3 THEN 'loop_phrase_0' END, CASE WHEN (n - length(replace(t, 'Do not change the text', ''))) // 22 > 3 THEN 'loop_phrase_1' END, CASE WHEN (n - length(replace(t, 'a blue bottle, a white bottle', ''))) // 29 > 3 THEN 'loop_phrase_2' END, CASE WHEN (n - length(replace(t, '\n\n\n\n\n', ''))) // 10 > 3 THEN 'loop_phrase_3' END], lambda x: x IS NOT NULL) AS iss FROM m),
report AS (SELECT doc_id, len(iss) = 0 AS is_valid, round(greatest(0.0, 1.0 - 0.2 * len(iss)), 6)::DOUBLE AS confidence_score, array_to_string(iss, ',') AS issues, n::BIGINT AS text_length, round(uniq, 6) AS unique_word_ratio, round(rep, 6) AS repetition_ratio FROM i)
"""


@query(_Q + "SELECT * FROM report")
def quality_report(spark, d):
    return quality.quality_report(_t(spark, d, "documents"))


@query(_Q + "SELECT count(*) AS total, count(*) FILTER (is_valid) AS valid, count(*) FILTER (NOT is_valid) AS invalid, round(count(*) FILTER (is_valid)::DOUBLE / count(*), 6) AS success_rate FROM report")
def quality_summary(spark, d):
    return quality.quality_summary(quality.quality_report(_t(spark, d, "documents")))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
k AS (SELECT *, regexp_replace(line, '^\s+|\s+$', '', 'g') AS s FROM l), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, s ORDER BY pos) AS nth FROM k)
SELECT doc_id, md5(string_agg(line, chr(10) ORDER BY pos) FILTER (length(s) < 20 OR nth <= 3)) AS text_md5, count(*) FILTER (length(s) >= 20 AND nth > 3) AS removed FROM r GROUP BY doc_id""")
def repetition_clean_stats(spark, d):
    return quality.cap_lines(_t(spark, d, "documents")).select("doc_id", F.md5("text").alias("text_md5"), "removed")


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
p AS (SELECT doc_id, pos, CASE WHEN length(line) >= 500 THEN string_split(regexp_replace(line, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) ELSE [line] END AS parts FROM l),
s AS (SELECT doc_id, pos, len(parts) AS n, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM p), t AS (SELECT *, regexp_replace(part, '^\s+|\s+$', '', 'g') AS key FROM s),
r AS (SELECT *, n >= 6 AND length(key) > 20 AND row_number() OVER (PARTITION BY doc_id, pos, key ORDER BY k) > 3 AS out FROM t),
w AS (SELECT doc_id, pos, count(*) FILTER (out) AS removed, string_agg(part, ' ' ORDER BY k) FILTER (NOT out) AS capped FROM r GROUP BY doc_id, pos)
SELECT doc_id, sum(removed)::BIGINT AS removed, md5(string_agg(CASE WHEN removed > 0 THEN capped ELSE line END, chr(10) ORDER BY pos)) AS text_md5 FROM w JOIN l USING (doc_id, pos) GROUP BY doc_id""")
def sentence_clean_stats(spark, d):
    return quality.cap_sentences(_t(spark, d, "documents")).select("doc_id", "removed", F.md5("text").alias("text_md5"))


_PAGES = "greatest(1, ceil(n_chars / 3000))"
_CLASSIFY = f"""WITH c AS (SELECT doc_id, lang, text, {_PAGES} AS pages, length(regexp_replace(substr(text, 1, 3000), '^\\s+|\\s+$', '', 'g')) AS n FROM documents),
k AS (SELECT doc_id, lang, pages::BIGINT AS page_count, CASE WHEN n > 200 THEN 'text_document' WHEN n = 0 AND pages = 1 THEN 'photograph' WHEN n > 0 AND pages = 1 THEN 'mixed' ELSE 'unknown' END AS doc_type FROM c)
"""


def _classified(spark, d):
    pages = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.col("n_chars") / 3000)) - 1), lambda i: F.substring("text", (i * 3000 + 1).cast("int"), F.lit(3000)))
    return _t(spark, d, "documents").select("doc_id", "lang", pages.alias("pages")).select("doc_id", "lang", F.size("pages").cast("long").alias("page_count"), T.classify(F.col("pages")).alias("doc_type"))


@query(_CLASSIFY + "SELECT doc_id, page_count, doc_type FROM k")
def classify_docs(spark, d):
    return _classified(spark, d).drop("lang")


@query(_CLASSIFY + "SELECT coalesce(lang, 'all') AS lang, coalesce(doc_type, 'all') AS doc_type, count(*) AS n FROM k GROUP BY ROLLUP (lang, doc_type)")
def doc_type_by_lang_rollup(spark, d):
    r = _classified(spark, d).rollup("lang", "doc_type").agg(F.count(F.lit(1)).alias("n"))
    return r.select(F.coalesce("lang", F.lit("all")).alias("lang"), F.coalesce("doc_type", F.lit("all")).alias("doc_type"), "n")


@query(r"""SELECT doc_id, CASE WHEN doc_id % 7 <> 0 AND n > 200 THEN 'text' WHEN doc_id % 7 <> 0 AND n > 50 THEN 'text_weak' ELSE 'image' END AS triage
FROM (SELECT doc_id, length(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS n FROM documents)""")
def triage_docs(spark, d):
    """No fonts are in the tables: documents whose id is divisible by 7 stand for scans."""
    return _t(spark, d, "documents").select("doc_id", T.triage(F.col("text"), F.col("doc_id") % 7 != 0).alias("triage"))


@query(r"SELECT doc_id, md5(regexp_replace(split_part(text, '|', 1), '^\s+|\s+$', '', 'g')) AS cleaned_md5, length(regexp_replace(split_part(text, '|', 1), '^\s+|\s+$', '', 'g')) AS cleaned_length FROM documents")
def pipe_clean(spark, d):
    c = T.pipe_clean(F.col("text"))
    return _t(spark, d, "documents").select("doc_id", F.md5(c).alias("cleaned_md5"), F.length(c).cast("long").alias("cleaned_length"))


@query("""SELECT name, NOT (lower(trim(name)) IN ('full name as written', 'organization name', 'organization name (unknown)', 'user', 'unknown', 'n/a', 'none', '') OR regexp_matches(lower(trim(name)), '^[a-z]{4}\\d+$') OR contains(lower(name), 'exact quote') OR contains(lower(name), 'one sentence')) AS valid
FROM (SELECT c_name AS name FROM customer UNION ALL SELECT s_name FROM supplier UNION ALL SELECT ' Unknown ' UNION ALL SELECT 'ABCD123')""")
def valid_name_filter(spark, d):
    extra = spark.createDataFrame([(" Unknown ",), ("ABCD123",)], "name string")
    names = _t(spark, d, "customer").select(F.col("c_name").alias("name")).unionByName(_t(spark, d, "supplier").select(F.col("s_name").alias("name"))).unionByName(extra)
    return names.select("name", T.valid_name(F.col("name")).alias("valid"))


_PRINT = r"""WITH f AS (SELECT doc_id, lang, source, n_chars, array_to_string(list_filter(string_split(text, chr(10)), lambda l: length(regexp_replace(l, '^\s+|\s+$', '', 'g')) > 10), ' ') AS k FROM documents),
fp AS (SELECT doc_id, lang, source, n_chars AS size, greatest(1, ceil(n_chars / 3000))::BIGINT AS page_count, CASE WHEN regexp_replace(k, '^\s+|\s+$', '', 'g') <> '' THEN md5(k) END AS text_hash FROM f)
"""


def _prints(spark, d):
    docs = _t(spark, d, "documents")
    return docs.select("doc_id", "lang", "source", F.col("n_chars").alias("size"), F.greatest(F.lit(1), F.ceil(F.col("n_chars") / 3000)).cast("long").alias("page_count"), T.text_fingerprint(F.col("text")).alias("text_hash"))


@query(_PRINT + "SELECT doc_id, text_hash FROM fp")
def text_fingerprint(spark, d):
    return _prints(spark, d).select("doc_id", "text_hash")


@query(_PRINT + "SELECT text_hash, min(doc_id) AS first_doc, count(*) AS n FROM fp WHERE text_hash IS NOT NULL GROUP BY text_hash HAVING count(*) > 1")
def exact_dup_groups(spark, d):
    return _prints(spark, d).where("text_hash IS NOT NULL").groupBy("text_hash").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n")).where("n > 1")


_LIKE = "(coalesce(x.h = l[1].h, false) OR (x.s > 0 AND l[1].s > 0 AND least(x.s, l[1].s)::DOUBLE / greatest(x.s, l[1].s) > 0.9))"


@query(_PRINT.replace("WITH f AS", "WITH RECURSIVE f AS", 1) + f""", b AS (SELECT page_count, list({{'d': doc_id, 's': size, 'h': text_hash}} ORDER BY doc_id) AS l FROM fp GROUP BY page_count),
g AS (SELECT page_count, NULL::BIGINT AS seed, NULL::BIGINT[] AS docs, l FROM b UNION ALL
 SELECT page_count, l[1].d, list_transform(list_filter(l, lambda x: x.d = l[1].d OR {_LIKE}), lambda x: x.d), list_filter(l[2:], lambda x: NOT {_LIKE}) FROM g WHERE len(l) > 0)
SELECT seed, unnest(docs) AS doc_id FROM g WHERE len(docs) > 1""")
def near_dup_groups(spark, d):
    """Greedy groups by the whole rule: only page counts must be equal."""
    return duplicates.similar_groups(_prints(spark, d))


_BOX = """WITH r AS (SELECT (l_orderkey // 2)::BIGINT AS grp, l_orderkey AS doc_id, l_linenumber AS page, (l_partkey % 60)::BIGINT AS x0, (l_suppkey % 60)::BIGINT AS y0, (l_partkey % 60 + l_quantity)::BIGINT AS x1, (l_suppkey % 60 + l_quantity)::BIGINT AS y1 FROM lineitem)
"""


def _regions(spark, d):
    li = _t(spark, d, "lineitem")
    x, y, q = F.col("l_partkey") % 60, F.col("l_suppkey") % 60, F.col("l_quantity")
    return li.select(F.floor(F.col("l_orderkey") / 2).alias("group"), F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), x.alias("x0"), y.alias("y0"), (x + q).cast("long").alias("x1"), (y + q).cast("long").alias("y1"))


@query(_BOX + """SELECT b.grp AS group_id, b.doc_id, b.page, b.x0, b.y0 FROM r b WHERE b.doc_id % 2 = 0 AND NOT EXISTS (SELECT 1 FROM r o WHERE o.doc_id % 2 = 1 AND o.grp = b.grp AND o.page = b.page
AND least((b.x1 - b.x0) * (b.y1 - b.y0), (o.x1 - o.x0) * (o.y1 - o.y0)) > 0 AND greatest(0, least(b.x1, o.x1) - greatest(b.x0, o.x0)) * greatest(0, least(b.y1, o.y1) - greatest(b.y0, o.y0)) > 0.3 * least((b.x1 - b.x0) * (b.y1 - b.y0), (o.x1 - o.x0) * (o.y1 - o.y0)))""")
def bbox_overlap_fillins(spark, d):
    r = _regions(spark, d)
    return duplicates.fill_ins(r.where("doc_id % 2 = 0"), r.where("doc_id % 2 = 1")).select(F.col("group").alias("group_id"), "doc_id", "page", "x0", "y0")


@query(_BOX + ", n AS (SELECT grp, doc_id, count(*) AS regions FROM r GROUP BY 1, 2) SELECT grp AS group_id, arg_min(doc_id, (regions, doc_id)) AS doc_id, min(regions) AS regions FROM n GROUP BY grp")
def base_document_pick(spark, d):
    return duplicates.base_document(_regions(spark, d)).withColumnRenamed("group", "group_id")


@query("SELECT event_id AS doc_id, 'Invalid events.event_type: ''' || event_type || ''' in doc ' || event_id AS message FROM events WHERE event_type NOT IN ('signup', 'error', 'click', 'view')")
def enum_violations(spark, d):
    e = _t(spark, d, "events").withColumnRenamed("event_id", "doc_id")
    return graph.violations(e, F.col("event_type"), EVENT_TYPES, "events", "event_type")


@query("SELECT 'Invalid events.event_type' AS violation_type, count(*) AS n FROM events WHERE event_type NOT IN ('signup', 'error', 'click', 'view') HAVING count(*) > 0")
def violation_rollup(spark, d):
    v = enum_violations(spark, d)
    return v.groupBy(F.split_part("message", F.lit(":"), F.lit(1)).alias("violation_type")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, coalesce((json_extract(props, '$.k'))::BIGINT, -1) AS k, coalesce(json_array_length(props, '$.tags')::BIGINT, 0) AS n_tags FROM events")
def props_json_parse(spark, d):
    p = F.from_json(T.fenced_json(F.col("props")), "k bigint, tags array<string>")
    return _t(spark, d, "events").select("event_id", F.coalesce(p["k"], F.lit(-1)).alias("k"), F.size(F.coalesce(p["tags"], F.array().cast("array<string>"))).cast("long").alias("n_tags"))


_NODES = """SELECT 'Person' AS label, c_name AS key FROM customer UNION ALL SELECT 'Organization', s_name FROM supplier UNION ALL SELECT 'Location', n_name FROM nation UNION ALL SELECT 'Document', o_orderkey::VARCHAR FROM orders"""


def _nodes(spark, d):
    n = lambda t, label, c: _t(spark, d, t).select(F.lit(label).alias("label"), F.col(c).cast("string").alias("key"))
    return n("customer", "Person", "c_name").unionByName(n("supplier", "Organization", "s_name")).unionByName(n("nation", "Location", "n_name")).unionByName(n("orders", "Document", "o_orderkey"))


@query("SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) FILTER (o_orderstatus <> 'O') AS closed_status FROM orders GROUP BY o_custkey")
def last_writer_wins(spark, d):
    o = _t(spark, d, "orders").withColumn("closed_status", F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus"))).withColumnRenamed("o_orderpriority", "priority")
    return graph.last_writer(o, ["o_custkey"], ["priority", "closed_status"], ["o_orderdate", "o_orderkey"])


@query("SELECT c_custkey, coalesce(n_name, v) AS name FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN lower(n_name) WHEN 1 THEN n_name ELSE 'x' || n_name END AS v FROM customer JOIN nation ON c_nationkey = n_nationkey) LEFT JOIN nation ON lower(n_name) = v")
def alias_resolution(spark, d):
    nation = _t(spark, d, "nation")
    j = _t(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey") % 3
    v = j.select("c_custkey", F.when(k == 0, F.concat(F.lit(" "), F.lower("n_name"), F.lit("\t"))).when(k == 1, F.col("n_name")).otherwise(F.concat(F.lit("x"), F.col("n_name"))).alias("name"))
    return graph.resolve(v, "name", nation.select(F.lower("n_name").alias("alias"), F.col("n_name").alias("canonical"))).select("c_custkey", "name")


@query(f"SELECT label, key, count(*) AS n FROM (SELECT * FROM ({_NODES}) UNION ALL SELECT 'Location', n_name FROM nation WHERE n_nationkey < 3) GROUP BY label, key HAVING count(*) > 1 OR key IS NULL")
def graph_key_violations(spark, d):
    twice = _t(spark, d, "nation").where("n_nationkey < 3").select(F.lit("Location").alias("label"), F.col("n_name").alias("key"))
    return graph.key_violations(_nodes(spark, d).unionByName(twice))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_remaining(spark, d):
    return batch.remaining(_t(spark, d, "documents").select("doc_id"), _t(spark, d, "labels"), "doc_id")


def _settle(spark):
    return lambda df: streaming.settle(df, streaming.work_folder(spark))


@query("SELECT doc_id, (ntile(7) OVER (ORDER BY doc_id) - 1)::BIGINT AS chunk FROM documents")
def split_ntile(spark, d):
    docs = _t(spark, d, "documents").select("doc_id")
    return batch.split_even(docs, 7, docs.count(), settle=_settle(spark))


@query("SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // ceil((SELECT count(*) FROM documents) / 7.0)::BIGINT)::BIGINT AS chunk FROM documents")
def split_ceil(spark, d):
    docs = _t(spark, d, "documents").select("doc_id")
    return batch.split_ceil(docs, 7, docs.count(), settle=_settle(spark))


@query("SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) % 7)::BIGINT AS chunk FROM documents")
def split_round_robin(spark, d):
    return batch.split_round_robin(_t(spark, d, "documents").select("doc_id"), 7, settle=_settle(spark))


@query("SELECT doc_id, md5(lang || ': ' || text) AS text_md5 FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings) AND trim(text) <> ''")
def embed_work_selection(spark, d):
    have = _t(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"))
    todo = batch.remaining(_t(spark, d, "documents").where(T.strip(F.col("text")) != ""), have, "doc_id")
    return todo.select("doc_id", F.md5(providers.embedding_text(F.col("text"), F.col("lang"))).alias("text_md5"))


_BM25 = r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{Nd}]+'), lambda x: x <> '') AS w FROM documents), tot AS (SELECT count(*) AS docs, avg(len(w)) AS mean FROM w),
h AS (SELECT doc_id, len(w) AS n, unnest(list_filter(w, lambda x: x IN ('the', 'ention', 'ble'))) AS token FROM w), tf AS (SELECT token, doc_id, n, count(*) AS tf FROM h GROUP BY ALL), df AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
bm AS (SELECT doc_id, round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * n / mean))), 6) AS score FROM tf JOIN df USING (token), tot GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 20)
"""


@query(_BM25 + "SELECT * FROM bm")
def keyword_search(spark, d):
    return search.keyword_search(_t(spark, d, "documents"), TERMS)


_LOC = """e AS (SELECT n_name AS src, r_name AS dst FROM nation JOIN region ON n_regionkey = r_regionkey UNION SELECT s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey), b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e)"""


@query(f"WITH RECURSIVE {_LOC}, k AS (SELECT r_name AS key, 0 AS hop FROM region WHERE r_regionkey = 0 UNION SELECT dst, hop + 1 FROM k JOIN b ON k.key = b.src WHERE hop < 3) SELECT key, min(hop)::INTEGER AS hop FROM k GROUP BY key")
def khop_expand(spark, d):
    n, r, s = (_t(spark, d, x) for x in ("nation", "region", "supplier"))
    e = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("src"), F.col("r_name").alias("dst")).unionByName(s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("src"), F.col("n_name").alias("dst")))
    return graph.expand(e, r.where("r_regionkey = 0").select(F.col("r_name").alias("key")))


@query("SELECT l_partkey, count(DISTINCT l_orderkey) AS n_docs, count(DISTINCT l_suppkey) AS n_sources FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_orderkey) >= 2 AND count(DISTINCT l_suppkey) >= 2")
def corroboration(spark, d):
    return patterns.corroboration(_t(spark, d, "lineitem"), ["l_partkey"], "l_orderkey", "l_suppkey")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, count(*) AS n, min(ts) AS start_ts, max(ts) AS end_ts FROM s GROUP BY user_id, k""")
def temporal_clusters(spark, d):
    return patterns.temporal_clusters(_t(spark, d, "events"), "user_id", "ts")


@query("SELECT c_custkey AS key, 'customer_without_order' AS gap FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT o_orderkey, 'order_without_item' FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def evidence_gaps(spark, d):
    o = _t(spark, d, "orders")
    a = patterns.missing(_t(spark, d, "customer").select("c_custkey"), o.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "customer_without_order")
    return a.unionByName(patterns.missing(o.select("o_orderkey"), _t(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "order_without_item"))


@query("SELECT o_orderkey AS event_id, o_orderdate AS event_date, coalesce((SELECT string_agg(DISTINCT s_name, ', ' ORDER BY s_name) FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_orderkey = o_orderkey), '') AS participants FROM orders")
def timeline(spark, d):
    who = _t(spark, d, "lineitem").join(_t(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("event_id"), F.col("s_name").alias("name"))
    return patterns.timeline(_t(spark, d, "orders").select(F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").alias("event_date")), who)


@query("SELECT c_name || ' -> ' || o_orderkey || ' -> ' || p_name || ' -> ' || s_name AS chain, count(*) AS n FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1")
def evidence_chain(spark, d):
    c, o, li, p, s = (_t(spark, d, x) for x in ("customer", "orders", "lineitem", "part", "supplier"))
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(p, F.col("l_partkey") == F.col("p_partkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return j.groupBy(F.concat_ws(" -> ", "c_name", F.col("o_orderkey").cast("string"), "p_name", "s_name").alias("chain")).agg(F.count(F.lit(1)).alias("n"))


_NET = """WITH l AS (SELECT n_name AS source, r_name AS target, 'PART_OF' AS rel, count(*) AS weight FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY ALL UNION ALL SELECT s_name, n_name, 'LOCATED_IN', count(*) FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)
"""


def _network(spark, d):
    n, r, s = (_t(spark, d, x) for x in ("nation", "region", "supplier"))
    e = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("source"), F.col("r_name").alias("target"), F.lit("PART_OF").alias("rel"))
    e = e.unionByName(s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("source"), F.col("n_name").alias("target"), F.lit("LOCATED_IN").alias("rel")))
    v = n.select(F.col("n_name").alias("id"), F.lit("Location").alias("label")).unionByName(r.select(F.col("r_name").alias("id"), F.lit("Region").alias("label"))).unionByName(s.select(F.col("s_name").alias("id"), F.lit("Organization").alias("label")))
    return patterns.network(v, e)


@query(_NET + "SELECT id, label, (SELECT count(*) FROM (SELECT source AS x FROM l UNION ALL SELECT target FROM l) WHERE x = id) AS degree FROM (SELECT n_name AS id, 'Location' AS label FROM nation UNION ALL SELECT r_name, 'Region' FROM region UNION ALL SELECT s_name, 'Organization' FROM supplier)")
def network_map_nodes(spark, d):
    return _network(spark, d)[0]


@query(_NET + "SELECT * FROM l")
def network_map_links(spark, d):
    return _network(spark, d)[1]


@query("SELECT conv_id, md5(string_agg(text, chr(10) || chr(10) || '--- PAGE BREAK ---' || chr(10) || chr(10) ORDER BY turn)) AS joined_md5, count(*) AS pages FROM conversations GROUP BY conv_id")
def conversation_page_join(spark, d):
    pages = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    return _t(spark, d, "conversations").groupBy("conv_id").agg(F.md5(F.array_join(pages, "\n\n--- PAGE BREAK ---\n\n")).alias("joined_md5"), F.count(F.lit(1)).alias("pages"))


@query("SELECT doc_id, (i // 900)::BIGINT AS chunk, md5(substr(text, i + 1, 1000)) AS chunk_md5 FROM (SELECT doc_id, text, unnest(range(0, greatest(1, length(text)), 900)) AS i FROM documents)")
def chunk_documents(spark, d):
    """Windows of 1000 characters that overlap by 100."""
    at = F.sequence(F.lit(0), F.greatest(F.lit(1), F.length("text")) - 1, F.lit(900))
    c = _t(spark, d, "documents").select("doc_id", "text", F.explode(at).alias("i"))
    return c.select("doc_id", F.floor(F.col("i") / 900).cast("long").alias("chunk"), F.md5(F.substring("text", F.col("i") + 1, F.lit(1000))).alias("chunk_md5"))


@query("SELECT doc_id, 'old' AS state FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT DISTINCT doc_id, 'new' FROM labels")
def manifest_merge(spark, d):
    old = _t(spark, d, "documents").select("doc_id", F.lit("old").alias("state"))
    return batch.merge_manifest(old, _t(spark, d, "labels").select("doc_id", F.lit("new").alias("state")).distinct())


@query("SELECT doc_id, substr(text, 1, 8000) <> text AS cut, md5('[' || lang || '] ' || substr(text, 1, 8000)) AS prompt_md5 FROM documents")
def prompt_render(spark, d):
    """Prompts take at most 8000 characters; what is cut is flagged."""
    return _t(spark, d, "documents").select("doc_id", (F.length("text") > 8000).alias("cut"), F.md5(F.format_string("[%s] %s", "lang", F.substring("text", 1, 8000))).alias("prompt_md5"))


@query("SELECT e.event_id, (SELECT arg_max(s.value, s.ts) FROM events s WHERE s.user_id = e.user_id AND s.event_type = 'signup' AND s.ts <= e.ts) AS value_at FROM events e WHERE e.event_type = 'purchase'")
def as_of_join(spark, d):
    e = _t(spark, d, "events")
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = e.where("event_type = 'signup'").select("user_id", "ts", F.col("value").alias("value_at"))
    return patterns.as_of(left, right, "user_id", "ts", "value_at").select("event_id", "value_at")


@query("SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def set_operations(spark, d):
    c = _t(spark, d, "customer")
    return c.select("c_custkey").intersect(_t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))).exceptAll(c.where("c_acctbal < 0").select("c_custkey"))


@query("SELECT event_id, CASE WHEN ends = 0 THEN s ELSE substr(s, strpos(s, '{'), ends) END AS found FROM (SELECT event_id, s, strpos(substr(s, strpos(s, '{')), '}}') + 1 AS ends FROM (SELECT event_id, 'Answer: {\"a\": ' || props || '} and }' AS s FROM events))")
def json_extract(spark, d):
    """The first balanced object in text around it."""
    wrapped = F.concat(F.lit('Answer: {"a": '), "props", F.lit("} and }"))
    return _t(spark, d, "events").select("event_id", T.balanced_json(wrapped).alias("found"))


_REWRITE = "SELECT doc_id, text, CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 4 = 1 THEN 'No corrections needed.' WHEN doc_id % 4 = 2 THEN substr(text, 1, 10) ELSE '```markdown' || chr(10) || upper(text) || chr(10) || '```' END AS c FROM documents"


@query(f"""WITH r AS ({_REWRITE}), o AS (SELECT *, CASE WHEN c IS NULL THEN 'error' WHEN contains(lower(c), 'no corrections needed') THEN 'kept' WHEN length(c) < length(text) * 0.5 THEN 'error' ELSE 'rewritten' END AS outcome FROM r)
SELECT outcome, count(*) AS n FROM o GROUP BY outcome""")
def rewrite_acceptance(spark, d):
    k, t = F.col("doc_id") % 4, F.col("text")
    proposed = F.when(k == 0, None).when(k == 1, "No corrections needed.").when(k == 2, F.substring(t, 1, 10)).otherwise(F.concat(F.lit("```markdown\n"), F.upper(t), F.lit("\n```")))
    return _t(spark, d, "documents").groupBy(T.rewrite_outcome(t, proposed).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id, CASE WHEN k = 'photograph' THEN k ELSE CASE WHEN doc_id % 2 = 0 THEN 'redaction_aware' WHEN k IN ('identity_document', 'legal_document') THEN k ELSE 'general' END || CASE WHEN k IN ('table', 'form') THEN '+' || k ELSE '' END END AS template
FROM (SELECT doc_id, ['photograph', 'identity_document', 'legal_document', 'table', 'form', 'general'][doc_id % 6 + 1] AS k FROM documents)""")
def prompt_routing(spark, d):
    kinds = F.array(*[F.lit(x) for x in ("photograph", "identity_document", "legal_document", "table", "form", "general")])
    kind = F.get(kinds, (F.col("doc_id") % 6).cast("int"))
    return _t(spark, d, "documents").select("doc_id", T.prompt_template(kind, F.col("doc_id") % 2 == 0).alias("template"))


@query("SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x::DOUBLE > m THEN '1' ELSE '0' END), '') AS bits FROM (SELECT vec_id, embedding, list_reduce(list_transform(embedding, lambda x: x::DOUBLE), lambda a, b: a + b) / len(embedding) AS m FROM embeddings)")
def mean_hash(spark, d):
    """The perceptual hash of vectors, which stand for the grey values of images."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    return _t(spark, d, "embeddings").select("vec_id", T.mean_hash(v, None).alias("bits"))


_COPIES = """WITH docs AS (SELECT o_custkey AS g, o_orderkey AS doc_id, o_orderpriority AS text FROM orders), regions AS (SELECT o_custkey AS g, o_orderkey AS doc_id, l_linenumber AS page, l_quantity AS x0, l_discount * 100 AS y0, l_quantity + 10 AS x1, l_discount * 100 + 5 AS y1, row_number() OVER () AS id FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
sized AS (SELECT g, doc_id, text, (SELECT count(*) FROM regions r WHERE r.doc_id = docs.doc_id) AS regions FROM docs), base AS (SELECT * FROM sized QUALIFY row_number() OVER (PARTITION BY g ORDER BY regions, doc_id) = 1),
met AS (SELECT o.g, o.doc_id, count(DISTINCT b.id) AS met FROM regions b JOIN base ON base.doc_id = b.doc_id JOIN regions o ON o.g = b.g AND o.page = b.page AND o.doc_id <> b.doc_id WHERE greatest(0, least(b.x1, o.x1) - greatest(b.x0, o.x0)) * greatest(0, least(b.y1, o.y1) - greatest(b.y0, o.y0)) > 0.3 * least((b.x1 - b.x0) * (b.y1 - b.y0), (o.x1 - o.x0) * (o.y1 - o.y0)) GROUP BY ALL),
s AS (SELECT s.g, s.doc_id, s.text, s.doc_id = b.doc_id AS is_base, CASE WHEN s.doc_id = b.doc_id THEN 0 ELSE b.regions - coalesce(met, 0) END AS fillins FROM sized s JOIN base b USING (g) LEFT JOIN met ON met.doc_id = s.doc_id),
m AS (SELECT g, max(CASE WHEN is_base THEN doc_id END) AS base_id, max(CASE WHEN is_base THEN text END) AS head, string_agg(CASE WHEN fillins > 0 THEN chr(10) || '--- From ' || doc_id || ' (' || fillins || ' fillins) ---' || chr(10) || chr(10) || text END, '' ORDER BY doc_id) AS tail, sum(fillins) AS total FROM s GROUP BY g)
"""


@query(_COPIES + """SELECT g AS "group", base_id, md5(head || CASE WHEN tail IS NULL THEN '' ELSE chr(10) || chr(10) || repeat('=', 80) || chr(10) || 'SUPPLEMENTAL CONTENT FROM OTHER COPIES' || chr(10) || repeat('=', 80) || chr(10) || 'The following content from other copies fills redactions in the base document.' || chr(10) || chr(10) || tail END) AS merged_md5, total::BIGINT AS total_fillins FROM m""")
def merged_copies(spark, d):
    """A customer's orders stand for copies, their items for regions."""
    o = _t(spark, d, "orders")
    li = _t(spark, d, "lineitem").join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    x, y = F.col("l_quantity"), F.col("l_discount") * 100
    regions = li.select(F.col("o_custkey").alias("group"), F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("page"), x.alias("x0"), y.alias("y0"), (x + 10).alias("x1"), (y + 5).alias("y1"))
    merged = duplicates.merge_all(o.select(F.col("o_custkey").alias("group"), F.col("o_orderkey").alias("doc_id"), F.col("o_orderpriority").alias("text")), regions)
    return merged.select("group", "base_id", F.md5("merged_text").alias("merged_md5"), "total_fillins")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS start_ts, max(ts) + INTERVAL 1 HOUR AS end_ts, count(*) AS n FROM s GROUP BY user_id, k""")
def event_sessions_stream(spark, d):
    return streaming.closed_sessions(spark, f"{d}/events.parquet", streaming.work_folder(spark))


@query(_Q + "SELECT * FROM report")
def quality_stream(spark, d):
    return _streamed(spark, streaming.incremental_quality(streaming.file_stream(spark, f"{d}/documents.parquet")))


def _streamed(spark, stream):
    work = streaming.work_folder(spark)
    return streaming.run_to_end(stream, f"{work}/out", f"{work}/checkpoint")


from . import evidence, intake, retrieval  # noqa: E402, F401 their queries are registered on import
