"""Queries of the intake: fingerprints, similar documents, routing, confidence and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import batch, duplicates, graph, routing, schema, validate
from .catalogue import _PRINT, _prints
from .registry import query
from .registry import table as _t


@query(_PRINT + r""", v AS (SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x::DOUBLE > m THEN '1' ELSE '0' END), '') AS bits FROM (SELECT vec_id, embedding, list_reduce(list_transform(embedding, lambda x: x::DOUBLE), lambda a, b: a + b) / len(embedding) AS m FROM embeddings))
SELECT fp.doc_id, size, page_count, sha256(text) AS file_hash, text_hash, coalesce(bits, '') AS phash FROM fp JOIN documents USING (doc_id) LEFT JOIN v ON vec_id = fp.doc_id""")
def fingerprints(spark, d):
    """Whole fingerprints: the text's bytes stand for the file, the vector of the same id for the first page's image."""
    bits = _t(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), T.mean_hash(F.transform("embedding", lambda x: x.cast("double")), None).alias("bits"))
    docs = _t(spark, d, "documents").join(bits, "doc_id", "left")
    docs = docs.withColumn("page_count", F.ceil(F.col("n_chars") / 3000)).withColumns({"size": F.col("n_chars"), "content": F.col("text")})
    return duplicates.fingerprints(docs, F.col("bits"))


_RULE = _PRINT + """, c AS (SELECT *, min(doc_id) OVER (PARTITION BY page_count, size, text_hash, f) AS class_id FROM (SELECT fp.*, sha256(text) AS f FROM fp JOIN documents USING (doc_id))),
l AS (SELECT a.doc_id, count(b.doc_id) AS n_links FROM c a LEFT JOIN c b ON a.page_count = b.page_count AND a.doc_id <> b.doc_id AND (a.text_hash = b.text_hash OR a.f = b.f OR (a.size > 0 AND b.size > 0 AND least(a.size, b.size)::DOUBLE / greatest(a.size, b.size) > 0.9)) GROUP BY a.doc_id)
"""


@query(_RULE + "SELECT doc_id, class_id, n_links FROM c JOIN l USING (doc_id)")
def near_dup_pairs(spark, d):
    """The whole rule of similar documents, links counted: a row for each document with its class, not all pairs."""
    return duplicates.similar_counts(_prints(spark, d).join(_t(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("file_hash")), "doc_id"))


@query(r"""WITH v AS (SELECT DISTINCT label AS page_count, array_to_string(list_transform(embedding[1:32], lambda x: CASE WHEN x::DOUBLE > m THEN '1' ELSE '0' END), '') AS h FROM (SELECT label, embedding, list_reduce(list_transform(embedding[1:32], lambda x: x::DOUBLE), lambda a, b: a + b) / 32 AS m FROM embeddings)),
p AS (SELECT a.page_count, a.h AS a, b.h AS b, list_sum(list_transform(range(1, 33), lambda i: CASE WHEN a.h[i] = b.h[i] THEN 1 ELSE 0 END)) / 32.0 AS s FROM v a JOIN v b ON a.page_count = b.page_count AND a.h < b.h)
SELECT page_count, a, b, round(s, 6)::DOUBLE AS similarity FROM p WHERE s >= 0.75""")
def look_alike_pages(spark, d):
    """Perceptual hashes of 32 bits, of vectors that stand for images, that agree in three quarters of their bits."""
    v = F.transform(F.slice("embedding", 1, 32), lambda x: x.cast("double"))
    prints = _t(spark, d, "embeddings").select(F.col("label").alias("page_count"), T.mean_hash(v, None).alias("phash"))
    return duplicates.look_alikes(prints, 0.75, 32).select("page_count", "a", "b", F.round("similarity", 6).alias("similarity"))


@query("""WITH d AS (SELECT o_custkey AS g, o_orderkey AS doc_id, 1 + o_orderkey % 3 AS pages FROM orders), p AS (SELECT g, doc_id, unnest(range(1, pages + 1)) AS page FROM d),
n AS (SELECT p.g, p.page, p.doc_id, count(l_orderkey) AS regions FROM p LEFT JOIN lineitem ON l_orderkey = p.doc_id AND l_linenumber = p.page GROUP BY ALL)
SELECT g AS "group", page::INTEGER AS page, arg_min(doc_id, (regions, doc_id)) AS doc_id, min(regions) AS regions FROM n GROUP BY g, page""")
def best_source_page(spark, d):
    """A customer's orders stand for copies, their items for regions on the page of their number."""
    docs = _t(spark, d, "orders").select(F.col("o_custkey").alias("group"), F.col("o_orderkey").alias("doc_id"), (1 + F.col("o_orderkey") % 3).alias("page_count"))
    regions = _t(spark, d, "lineitem").join(docs, F.col("l_orderkey") == F.col("doc_id")).select("group", "doc_id", F.col("l_linenumber").alias("page"))
    return duplicates.best_source(docs, regions)


@query(r"""SELECT source, lower(lang) AS lang, substr(md5('["' || array_to_string(list_sort(list(substr(sha256(text), 1, 16))), '", "') || '"]'), 1, 8) AS group_id, count(*) AS n FROM documents GROUP BY source, lang""")
def group_ids(spark, d):
    h = F.sha2(F.col("text").cast("binary"), 256)
    g = _t(spark, d, "documents").groupBy("source", F.lower("lang").alias("lang")).agg(F.collect_list(F.substring(h, 1, 16)).alias("h"), F.count(F.lit(1)).alias("n"))
    return g.select("source", "lang", T.group_id(F.col("h")).alias("group_id"), "n")


# Types of documents by id, among them an unknown one and none; sizes by id, one in five above 50 MB.
_TYPED = "SELECT doc_id, text, CASE doc_id % 5 WHEN 0 THEN 'text_document' WHEN 1 THEN 'photograph' WHEN 2 THEN 'mixed' WHEN 3 THEN 'unknown' END AS t, CASE WHEN doc_id % 5 = doc_id % 25 // 5 THEN 52428801 ELSE 52428800 END AS size FROM documents"


def _typed(spark, d):
    k = F.col("doc_id") % 5
    kind = F.when(k == 0, "text_document").when(k == 1, "photograph").when(k == 2, "mixed").when(k == 3, "unknown")
    big = k == F.floor(F.col("doc_id") % 25 / 5)
    return _t(spark, d, "documents").select("doc_id", "text", kind.alias("doc_type"), F.when(big, 52428801).otherwise(52428800).alias("size"))


@query(f"""SELECT 'text_first' AS "order", doc_id, CASE t WHEN 'text_document' THEN 'text' WHEN 'photograph' THEN t WHEN 'mixed' THEN t END AS track,
 CASE WHEN t IN ('text_document', 'mixed') AND size <= 52428800 THEN 'text' WHEN t IN ('text_document', 'mixed', 'photograph') THEN 'vision' END AS reader,
 CASE WHEN t IS NULL THEN 'Unknown document type: None' WHEN t = 'unknown' THEN 'Unknown document type: unknown' END AS error FROM ({_TYPED})
UNION ALL SELECT 'legacy', doc_id, CASE t WHEN 'text_document' THEN 'text' ELSE t END, CASE WHEN t <> 'photograph' AND size <= 52428800 THEN 'text' ELSE 'vision' END, NULL FROM ({_TYPED}) WHERE t IN ('text_document', 'mixed', 'photograph')
UNION ALL SELECT 'vision_first', doc_id, CASE WHEN t IN ('photograph', 'mixed') THEN t ELSE 'text' END, 'vision', NULL FROM ({_TYPED})""")
def document_routes(spark, d):
    docs = _typed(spark, d)
    parts = [routing.routed(docs, order).select(F.lit(order).alias("order"), "doc_id", "track", "reader", "error") for order in ("text_first", "legacy", "vision_first")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_READ = f"""r AS (SELECT doc_id, size, CASE WHEN t IN ('photograph', 'mixed') THEN t ELSE 'text' END AS track, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE substr(text, 1, (doc_id * 37 % 260)::INTEGER) END AS m, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE substr(text, 3, (doc_id * 53 % 180)::INTEGER) END AS s, 'a view of ' || doc_id AS a FROM ({_TYPED})),
n AS (SELECT *, length(regexp_replace(coalesce(m, ''), '^\\s+|\\s+$', '', 'g')) AS nm, length(regexp_replace(coalesce(s, ''), '^\\s+|\\s+$', '', 'g')) AS ns, length(coalesce(m, '')) AS lm FROM r)
"""


def _read(spark, d):
    i = F.col("doc_id")
    marked = F.when(i % 3 != 0, F.substring("text", F.lit(1), (i * 37 % 260).cast("int")))
    seen = F.when(i % 7 != 0, F.substring("text", F.lit(3), (i * 53 % 180).cast("int")))
    return _typed(spark, d).select("doc_id", "size", routing.route(F.col("doc_type"), "vision_first").alias("track"), marked.alias("marked"), seen.alias("seen"), F.concat(F.lit("a view of "), i.cast("string")).alias("analysis"))


@query(f"""WITH {_READ}, f AS (SELECT *, size <= 52428800 AND m IS NOT NULL AND m <> '' AND nm >= 20 AND lm >= 100 AS taken FROM n), t AS (SELECT *, CASE WHEN taken THEN m ELSE s END AS p FROM f)
SELECT doc_id, track, CASE WHEN track <> 'photograph' AND taken THEN 'marker' ELSE 'vision' END AS engine, md5(CASE track WHEN 'photograph' THEN a WHEN 'mixed' THEN coalesce(p, '') || chr(10) || chr(10) || '--- VISUAL ANALYSIS ---' || chr(10) || chr(10) || a ELSE p END) AS text_md5,
 CASE WHEN track = 'photograph' THEN 0.85 WHEN taken THEN 0.8 WHEN length(coalesce(s, '')) > 50 THEN 0.9 ELSE 0.7 END::DOUBLE AS confidence FROM t""")
def reader_results(spark, d):
    """What the text-first order makes of the readers' answers; pieces of the texts stand for these."""
    return routing.results(_read(spark, d)).select("doc_id", "track", "engine", F.md5("text").alias("text_md5"), "confidence")


@query(f"""WITH {_READ}, t AS (SELECT *, CASE track WHEN 'photograph' THEN a WHEN 'mixed' THEN doc_id || chr(10) || chr(10) || '--- VISUAL ANALYSIS ---' || chr(10) || chr(10) || a ELSE CASE WHEN ns < 100 AND nm > ns THEN m ELSE s END END AS p, track = 'text' AND ns < 100 AND nm > ns AS fell FROM n)
SELECT doc_id, track, CASE WHEN fell THEN 'marker' ELSE 'vision' END AS engine, md5(p) AS text_md5, CASE WHEN length(regexp_replace(coalesce(p, ''), '^\\s+|\\s+$', '', 'g')) > 50 THEN 0.9 ELSE 0.7 END::DOUBLE AS confidence FROM t""")
def vision_first_results(spark, d):
    return routing.results(_read(spark, d), "vision_first").select("doc_id", "track", "engine", F.md5("text").alias("text_md5"), "confidence")


@query(f"""WITH {_READ} SELECT doc_id, CASE WHEN coalesce(m, '') = '' THEN 0.0 WHEN nm < 20 THEN 0.2 WHEN lm < 100 THEN 0.4 ELSE 0.8 END::DOUBLE AS marker, CASE WHEN nm > 200 THEN 0.8 WHEN nm > 50 THEN 0.5 ELSE 0.2 END::DOUBLE AS vision_first, nm > 100 AS legacy_accepted,
 CASE WHEN track = 'photograph' THEN 0.85 WHEN ns > 50 THEN 0.9 ELSE 0.7 END::DOUBLE AS vision_stripped FROM n""")
def confidence_ladders(spark, d):
    m = F.col("marked")
    return _read(spark, d).select("doc_id", T.marker_confidence(m).alias("marker"), T.vision_first_confidence(m).alias("vision_first"), T.accepted(m, F.lit(0.85), legacy=True).alias("legacy_accepted"), T.vision_confidence(F.col("seen"), F.col("track"), stripped=True).alias("vision_stripped"))


@query(r"""WITH m AS (SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN '/in/' || doc_id || '.pdf' END AS p FROM documents), f AS (SELECT '/in/' || doc_id || '.pdf' AS p, doc_id % 7 <> 0 AS fonts, length(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS n FROM documents WHERE doc_id % 13 <> 0),
j AS (SELECT fonts AND n > 50 AS t FROM m JOIN f USING (p)) SELECT (SELECT count(*) FROM m) AS total, count(*) FILTER (t) AS text, count(*) FILTER (NOT t) AS image, (SELECT count(*) FROM m) - count(*) AS skipped FROM j""")
def triage_summary(spark, d):
    """Entries whose id is divisible by 11 have no path, files whose id is divisible by 13 are missing."""
    docs = _t(spark, d, "documents")
    path = F.concat(F.lit("/in/"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    files = docs.where("doc_id % 13 != 0").select(path.alias("path"), "text", (F.col("doc_id") % 7 != 0).alias("has_fonts"))
    return routing.triage_manifest(docs.select("doc_id", F.when(F.col("doc_id") % 11 != 0, path).alias("path")), files)[1]


@query("""SELECT conv_id AS doc_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS place, role AS kind, md5(CASE role WHEN 'user' THEN 'Read closely.' WHEN 'system' THEN 'Keep the order.' ELSE '' END || chr(10) || chr(10) || text) AS prompt_md5 FROM conversations""")
def block_prompts(spark, d):
    """Turns stand for a document's blocks, roles for their types."""
    block = F.struct("turn", F.concat(F.lit("BlockTypes."), F.col("role")).alias("block_type"), "text")
    docs = _t(spark, d, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    return routing.block_prompts(docs, {"user": "Read closely.", "system": "Keep the order."}).select("doc_id", "place", "kind", F.md5("prompt").alias("prompt_md5"))


# A page of 40 x 30 pixels for each nation: one dark box whose place and size follow from the key.
_BOXES = "SELECT n_nationkey AS doc_id, n_nationkey % 8 AS x, n_nationkey % 5 AS y, 8 + n_nationkey % 20 AS w, 6 + n_nationkey % 9 AS h FROM nation"


@query(f"SELECT doc_id::BIGINT AS doc_id, x::INTEGER AS x0, y::INTEGER AS y0, (x + w)::INTEGER AS x1, (y + h)::INTEGER AS y1, (w * h)::INTEGER AS area FROM ({_BOXES}) WHERE w * h >= 100")
def redaction_boxes(spark, d):
    k = F.col("n_nationkey")
    x, y, w, h = k % 8, k % 5, k % 20 + 8, k % 9 + 6
    inside = lambda i: (i % 40 >= x) & (i % 40 < x + w) & (F.floor(i / 40) >= y) & (F.floor(i / 40) < y + h)
    pixels = F.transform(F.sequence(F.lit(0), F.lit(1199)), lambda i: F.when(inside(i), 10).otherwise(200))
    pages = _t(spark, d, "nation").select(k.cast("long").alias("doc_id"), F.lit(1).alias("page"), F.lit(40).alias("width"), pixels.alias("pixels"))
    return routing.redactions(pages).select("doc_id", "x0", "y0", "x1", "y1", "area")


def _sql_list(domain: str) -> str:
    return ", ".join(f"'{v}'" for v in validate.DOMAINS[domain])


#: A value for each check: of its domain where the id isn't divisible by its number + 2, else one outside it; the first four take pipes.
_BROKEN = {k: ("bad value" if k % 2 else "Bad") for k in range(len(validate.CHECKS))}


def _check_sql(k: int) -> str:
    category, field, entity, domain, split, blank = validate.CHECKS[k]
    good = validate.DOMAINS[domain][k % 3]
    value = f"CASE WHEN event_id % {k + 2} = 0 THEN '{_BROKEN[k]}{'|' + good if split else ''}' WHEN event_id % {k + 2} = 1 THEN '{'' if split else good}' ELSE '{good}' END"
    parts = f"unnest(string_split({value}, '|'))" if split else value
    return f"SELECT event_id AS doc_id, 'Invalid {entity}.{field}: ''' || v || ''' in doc ' || event_id AS message FROM (SELECT event_id, {parts} AS v FROM events) WHERE v NOT IN ({_sql_list(domain)}{', ' + repr('') if blank else ''})"


@query(" UNION ALL ".join(_check_sql(k) for k in range(len(validate.CHECKS))))
def enum_violations_all(spark, d):
    """All fourteen checks over records made from the events."""
    lists: dict[str, list] = {}
    for k, (category, field, _, domain, split, _) in enumerate(validate.CHECKS):
        good, i = validate.DOMAINS[domain][k % 3], F.col("event_id") % (k + 2)
        bad = _BROKEN[k] + ("|" + good if split else "")
        lists.setdefault(category, []).append(F.when(i == 0, bad).when(i == 1, "" if split else good).otherwise(good).alias(field))
    records = _t(spark, d, "events").select(F.col("event_id").alias("doc_id"), *[F.array(F.struct(*fields)).alias(c) for c, fields in lists.items()])
    return validate.validate(records).where("NOT is_valid").select("doc_id", F.explode("violations").alias("message"))


@query("""SELECT alias, canonical FROM (SELECT lower(n_name) AS alias, n_name AS canonical FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT upper(n_name) || '!', n_name FROM nation
UNION ALL SELECT 'r' || r_regionkey, 'second' FROM region)""")
def alias_table(spark, d):
    """Aliases added to a table: later ones win, the old of the same alias go, white space is stripped."""
    n = _t(spark, d, "nation")
    old = n.where("n_nationkey % 2 = 0").select(F.lower("n_name").alias("alias"), F.lit("old").alias("canonical"))
    new = n.where("n_nationkey % 2 = 0").select(F.concat(F.lit(" "), F.lower("n_name")).alias("alias"), F.col("n_name").alias("canonical"), F.lit(1).alias("ord"))
    new = new.unionByName(n.select(F.concat(F.upper("n_name"), F.lit("! ")).alias("alias"), F.col("n_name").alias("canonical"), F.lit(1).alias("ord")))
    for k, value in enumerate(("first", "second")):
        new = new.unionByName(_t(spark, d, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("alias"), F.lit(value).alias("canonical"), F.lit(k).alias("ord")))
    return graph.add_aliases(old, new)


@query("SELECT doc_id FROM documents WHERE length(text) > 0 AND doc_id NOT IN (SELECT doc_id FROM labels)")
def first_write_rows(spark, d):
    """Texts to append to what the labelled documents stand for: of a key not written before, with text."""
    return batch.first_write(_t(spark, d, "labels"), _t(spark, d, "documents").select("doc_id", "text")).select("doc_id")


@query("SELECT count(*) FILTER (k = 0)::INTEGER AS keys, count(*) FILTER (k = 1)::INTEGER AS vectors, count(*) FILTER (k = 2)::INTEGER AS fulltexts, count(*) FILTER (k = 0) >= 9 AND count(*) FILTER (k = 1) >= 8 AND count(*) FILTER (k = 2) >= 8 AS ok FROM (SELECT n_nationkey % 3 AS k FROM nation)")
def schema_verify(spark, d):
    """A catalogue with an entry for each nation: half are there, what is missing is created, and another's index isn't counted."""
    k = F.col("n_nationkey") % 3
    kind = F.when(k == 0, "key").when(k == 1, "vector").otherwise("fulltext")
    n = _t(spark, d, "nation")
    want = n.select(kind.alias("kind"), F.concat(F.lit("index_"), F.col("n_name")).alias("name"), F.array("n_name").alias("labels"), F.array(F.lit("name")).alias("properties"), F.lit(None).cast("int").alias("dims"))
    want = want.select(*schema.wanted(spark).columns) if "dims" in schema.wanted(spark).columns else want.toDF(*schema.wanted(spark).columns)
    have = want.join(n.where("n_nationkey % 2 = 0").select(F.concat(F.lit("index_"), F.col("n_name")).alias("name")), "name", "left_semi").select(*want.columns)
    foreign = want.limit(1).withColumn("kind", F.lit("fulltext")).withColumn("name", F.lit(schema.FOREIGN)).withColumn("labels", F.array(F.lit("other")))
    return schema.verify(schema.create(have.unionByName(foreign), want), 9, 8, 8).select("keys", "vectors", "fulltexts", "ok")
