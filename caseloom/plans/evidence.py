"""Queries of the evidence graph: ingest and merge of extracted records, gaps, chains and timelines.

Orders stand for extracted documents: the buyer is a person, suppliers are organizations, nations are places.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import graph, patterns
from ..streaming import sessions as streaming
from .registry import query
from .registry import table as _t


def _extractions(spark, d):
    """Records as an extractor gives them, with what has to be cleaned: pipes, placeholders, blanks, aliases and nulls."""
    o, c, n = (_t(spark, d, t) for t in ("orders", "customer", "nation"))
    line = F.struct("l_linenumber", F.col("s_name").alias("name"), F.lit("company").alias("org_type"), F.lit("").alias("context"), F.col("l_returnflag").alias("description"))
    lines = _t(spark, d, "lineitem").join(_t(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"))
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    k, buyer = F.col("o_orderkey"), F.col("c_name")
    text = lambda c: F.lit(c).cast("string")
    lines = F.coalesce("lines", F.array().cast(j.schema["lines"].dataType))
    first = F.get(lines, F.lit(0))["name"]
    person = lambda name, role, context: F.struct(name.alias("name"), role.alias("role"), context.alias("context"))
    people = F.array_compact(F.array(person(buyer, text("buyer|payer"), F.col("c_mktsegment")), F.when(k % 5 == 0, person(text(" Unknown "), text("x"), text("y")))))
    place = F.struct(F.when(k % 2 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("name"), text("").alias("address"), text("country").alias("location_type"), text(None).alias("context"))
    event = F.struct(F.col("o_orderpriority").alias("event_type"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.when(k % 3 == 0, " ").otherwise(F.concat(F.lit("order "), k.cast("string"))).alias("description"), F.array(buyer, text("n/a")).alias("participants"), F.col("n_name").alias("location"))
    claim = F.struct(text("claim").alias("description"), text("minor").alias("severity"), text("alleged").alias("status"), F.array(first).alias("accused"), F.array(buyer).alias("victims"))
    bond = F.struct(buyer.alias("person_a"), first.alias("person_b"), text("buyer").alias("nature"), text(None).alias("timeframe"))
    organizations = F.transform(lines, lambda x: F.struct(x["name"].alias("name"), x["org_type"].alias("org_type"), x["context"].alias("context"), x["description"].alias("description")))
    return j.select(
        F.concat(F.lit("D"), k.cast("string")).alias("doc_id"),
        F.when(F.col("o_orderstatus") == "F", "closed|final").otherwise("open").alias("doc_type"),
        people.alias("people"),
        F.array(place).alias("locations"),
        organizations.alias("organizations"),
        F.array(event).alias("events"),
        F.filter(F.array(F.when(F.col("o_orderstatus") == "F", claim)), lambda x: x.isNotNull()).alias("allegations"),
        F.array(bond).alias("associations"),
        k.alias("k"),
    )


def _aliases(spark, d):
    return _t(spark, d, "nation").select(F.lower("n_name").alias("alias"), F.col("n_name").alias("canonical"))


def _ingested(spark, d):
    """Records are written first: every branch of the ingest reads them, and none makes them again."""
    records = streaming.settle(_extractions(spark, d).drop("k"), streaming.work_folder(spark))
    return graph.ingest(records, _aliases(spark, d))


def _shown(props):
    return F.array_join(F.transform(F.array_sort(F.map_entries(props)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")


_RECORDS = """WITH o AS (SELECT o_orderkey AS k, 'D' || o_orderkey AS doc, c_name, c_mktsegment AS seg, n_name, o_orderstatus AS st, o_orderpriority AS pr, strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
l AS (SELECT o.k, o.doc, s_name, l_returnflag AS rf, row_number() OVER (PARTITION BY o.k ORDER BY l_linenumber, s_name, l_returnflag) - 1 AS idx FROM o JOIN lineitem ON l_orderkey = o.k JOIN supplier ON s_suppkey = l_suppkey),
f AS (SELECT k, arg_min(s_name, idx) AS first, count(*) AS lines FROM l GROUP BY k), w AS (SELECT o.*, first, coalesce(lines, 0) AS lines FROM o LEFT JOIN f USING (k)),
persons AS (SELECT 'Person' AS label, c_name AS key, 'description=' || any_value(seg) || ';role=buyer' AS props FROM w GROUP BY c_name),
nodes AS (SELECT * FROM persons UNION ALL SELECT DISTINCT 'Person', first, '' FROM w WHERE first IS NOT NULL UNION ALL SELECT 'Document', doc, 'doc_type=' || CASE WHEN st = 'F' THEN 'closed' ELSE 'open' END FROM w
 UNION ALL SELECT DISTINCT 'Location', n_name, 'location_type=country' FROM w UNION ALL SELECT 'Organization', s_name, 'description=' || arg_max(rf, (doc, idx)) || ';org_type=company' FROM l GROUP BY s_name
 UNION ALL SELECT 'Event', doc || '_evt_0', 'date=' || dt || ';description=order ' || k || ';event_type=' || pr FROM w WHERE k % 3 <> 0
 UNION ALL SELECT 'Allegation', doc || '_alg_0', 'description=claim;severity=minor;status=alleged' FROM w WHERE st = 'F'),
edges AS (SELECT 'Person' AS src_label, c_name AS src_key, 'MENTIONED_IN' AS rel, 'Document' AS dst_label, doc AS dst_key, '' AS props FROM w UNION SELECT 'Location', n_name, 'MENTIONED_IN', 'Document', doc, '' FROM w UNION SELECT 'Organization', s_name, 'MENTIONED_IN', 'Document', doc, '' FROM l
 UNION SELECT 'Event', doc || '_evt_0', 'DOCUMENTED_IN', 'Document', doc, '' FROM w WHERE k % 3 <> 0 UNION SELECT 'Person', c_name, 'PARTICIPATED_IN', 'Event', doc || '_evt_0', '' FROM w WHERE k % 3 <> 0 UNION SELECT 'Event', doc || '_evt_0', 'OCCURRED_AT', 'Location', n_name, '' FROM w WHERE k % 3 <> 0
 UNION SELECT 'Allegation', doc || '_alg_0', 'DOCUMENTED_IN', 'Document', doc, '' FROM w WHERE st = 'F' UNION SELECT 'Person', first, 'ALLEGED_IN', 'Allegation', doc || '_alg_0', '' FROM w WHERE st = 'F' AND first IS NOT NULL UNION SELECT 'Person', c_name, 'VICTIM_OF', 'Allegation', doc || '_alg_0', '' FROM w WHERE st = 'F'
 UNION SELECT 'Person', c_name, 'ASSOCIATED_WITH', 'Person', first, 'nature=buyer' FROM w WHERE first IS NOT NULL),
stats AS (SELECT doc AS doc_id, 3 + lines + (k % 3 <> 0)::INTEGER + (st = 'F')::INTEGER AS nodes, 2 + lines + 3 * (k % 3 <> 0)::INTEGER + CASE WHEN st = 'F' THEN 2 + (first IS NOT NULL)::INTEGER ELSE 0 END + (first IS NOT NULL)::INTEGER AS rels FROM w)
"""


@query(_RECORDS + "SELECT label, key, props FROM nodes")
def graph_nodes(spark, d):
    return _ingested(spark, d)[0].select("label", "key", _shown(F.col("props")).alias("props"))


@query(_RECORDS + "SELECT * FROM edges")
def graph_edges(spark, d):
    return _ingested(spark, d)[1].select(*graph.EDGE_KEY, _shown(F.col("props")).alias("props"))


@query(_RECORDS + "SELECT src_key AS person_a, dst_key AS person_b, props FROM edges WHERE rel = 'ASSOCIATED_WITH'")
def association_edges(spark, d):
    """The directed associations that the records state; none is made up from what merely occurs together."""
    return _ingested(spark, d)[1].where("rel = 'ASSOCIATED_WITH'").select(F.col("src_key").alias("person_a"), F.col("dst_key").alias("person_b"), _shown(F.col("props")).alias("props"))


@query(_RECORDS + "SELECT doc_id, nodes, rels FROM stats")
def ingest_stats(spark, d):
    return _ingested(spark, d)[2]


@query(_RECORDS + "SELECT (SELECT count(*) FROM w) AS total, count(*) AS succeeded, (SELECT count(*) FROM w WHERE k % 9 = 0) AS failed, sum(nodes)::BIGINT AS nodes, sum(rels)::BIGINT AS rels FROM stats WHERE substr(doc_id, 2)::BIGINT % 9 <> 0")
def ingest_summary(spark, d):
    """A batch of JSON records, one in nine of them cut off: each of these fails alone."""
    records = _extractions(spark, d)
    schema = records.drop("k").schema.simpleString().removeprefix("struct<").removesuffix(">") + ",_bad:string"
    text = F.to_json(F.struct(*[c for c in records.columns if c != "k"]))
    raw = records.select("doc_id", F.when(F.col("k") % 9 == 0, F.substring(text, 1, 40)).otherwise(text).alias("json"))
    return graph.ingest_batch(raw, f"struct<{schema}>", _aliases(spark, d), lambda df: streaming.settle(df, streaming.work_folder(spark)))[2]


@query(_RECORDS + """SELECT s_name AS key, 'description=' || arg_max(rf, (k % 2, doc, idx)) || ';org_type=company' || CASE WHEN bool_or(k % 2 = 0) THEN ';seen=1' ELSE '' END AS props FROM l GROUP BY s_name""")
def graph_merge(spark, d):
    """A second batch merged into the store of a first: its properties win, what only the store has stays."""
    records = streaming.settle(_extractions(spark, d), streaming.work_folder(spark))
    nodes = lambda part: graph.ingest(records.where(part).drop("k"), _aliases(spark, d))[0].where("label = 'Organization'")
    store = nodes("k % 2 = 0").withColumn("props", F.map_concat("props", F.create_map(F.lit("seen"), F.lit("1"))))
    return graph.merge_properties(store, nodes("k % 2 = 1"), graph.NODE_KEY).select("key", _shown(F.col("props")).alias("props"))


@query(_RECORDS + "SELECT 'Allegation' AS label, doc || '_alg_0' AS key, 'allegation_without_accused' AS gap FROM w WHERE st = 'F' AND first IS NULL UNION ALL SELECT 'Event', doc || '_evt_0', 'event_without_place' FROM w WHERE k % 3 <> 0 AND k % 4 = 0")
def graph_gaps(spark, d):
    """Events and allegations without a link they should have; the places of every fourth order are taken out."""
    nodes, edges, _ = _ingested(spark, d)
    known = ~((F.col("rel") == "OCCURRED_AT") & (F.regexp_extract("src_key", r"^D(\d+)_", 1).cast("long") % 4 == 0))
    return patterns.gaps(nodes.select("label", "key"), edges.where(known))


_STEPS = """WITH e AS (SELECT s_name AS src, 'LOCATED_IN' AS rel, n_name AS dst, 'S' || s_suppkey AS doc FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION SELECT n_name, 'PART_OF', r_name, 'N' || n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey),
b AS (SELECT * FROM e UNION SELECT dst, rel, src, doc FROM e), s AS (SELECT s_name AS start FROM supplier WHERE s_suppkey % 20 = 0), one AS (SELECT start, dst AS stop, start || ' -[' || rel || ' @' || doc || ']-> ' || dst AS chain FROM s JOIN b ON src = start),
two AS (SELECT start, dst AS stop, min(chain || ' -[' || rel || ' @' || doc || ']-> ' || dst) AS chain FROM one JOIN b ON src = stop WHERE dst <> start GROUP BY ALL), three AS (SELECT start, dst AS stop, min(chain || ' -[' || rel || ' @' || doc || ']-> ' || dst) AS chain FROM two JOIN b ON src = stop WHERE dst NOT IN (SELECT src FROM e WHERE FALSE) GROUP BY ALL),
every AS (SELECT start, stop, 1 AS hops, chain FROM one UNION ALL SELECT start, stop, 2, chain FROM two WHERE (start, stop) NOT IN (SELECT (start, stop) FROM one) UNION ALL
 SELECT start, stop, 3, chain FROM three WHERE start <> stop AND (start, stop) NOT IN (SELECT (start, stop) FROM one) AND (start, stop) NOT IN (SELECT (start, stop) FROM two))
"""


@query(_STEPS + 'SELECT start, stop AS "end", hops, chain FROM every WHERE stop IN (SELECT r_name FROM region UNION SELECT n_name FROM nation UNION SELECT s_name FROM supplier WHERE s_suppkey % 3 = 0)')
def evidence_paths(spark, d):
    """Cited shortest chains of at most three steps from every twentieth supplier to regions, nations and every third supplier."""
    n, r, s = (_t(spark, d, x) for x in ("nation", "region", "supplier"))
    cited = lambda tag, key: F.concat(F.lit(tag), F.col(key).cast("string")).alias("doc")
    edges = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("src"), F.lit("LOCATED_IN").alias("rel"), F.col("n_name").alias("dst"), cited("S", "s_suppkey"))
    edges = edges.unionByName(n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("src"), F.lit("PART_OF").alias("rel"), F.col("r_name").alias("dst"), cited("N", "n_nationkey")))
    ends = r.select(F.col("r_name").alias("key")).union(n.select("n_name")).union(s.where("s_suppkey % 3 = 0").select("s_name"))
    return patterns.chains(edges, s.where("s_suppkey % 20 = 0").select(F.col("s_name").alias("key")), ends)


_DATED = """WITH e AS (SELECT o_orderkey AS event_id, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y') WHEN 3 THEN '~' || strftime(o_orderdate, '%Y') ELSE 'soon' END AS date, o_orderdate AS ts, o_orderpriority AS description FROM orders),
p AS (SELECT l_orderkey AS event_id, string_agg(DISTINCT s_name, ', ' ORDER BY s_name) AS who, string_agg(DISTINCT 'P' || l_partkey, ', ' ORDER BY 'P' || l_partkey) AS cited FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1),
t AS (SELECT e.event_id, event_id % 5 AS m, CASE WHEN event_id % 5 = 0 THEN ts::DATE WHEN event_id % 5 = 1 THEN date_trunc('month', ts)::DATE WHEN event_id % 5 < 4 THEN date_trunc('year', ts)::DATE END AS event_date, date, description, coalesce(who, '') AS participants, coalesce(cited, '') AS citations FROM e LEFT JOIN p USING (event_id))
"""


@query(_DATED + """SELECT event_id, event_date::VARCHAR AS event_date, CASE m WHEN 0 THEN 'day' WHEN 1 THEN 'month' WHEN 2 THEN 'year' WHEN 3 THEN 'year' END AS precision, m = 3 AS approximate, participants, citations,
CASE WHEN m = 4 THEN 'undated' ELSE date END || ': ' || description || CASE WHEN participants <> '' THEN ' (' || participants || ')' ELSE '' END || CASE WHEN citations <> '' THEN ' [' || citations || ']' ELSE '' END AS line FROM t""")
def cited_timeline(spark, d):
    """Orders as events with dates written in five ways, suppliers as participants, parts as citations."""
    k, at = F.col("o_orderkey"), F.col("o_orderdate")
    date = F.when(k % 5 == 0, F.date_format(at, "yyyy-MM-dd")).when(k % 5 == 1, F.date_format(at, "yyyy-MM")).when(k % 5 == 2, F.date_format(at, "yyyy")).when(k % 5 == 3, F.concat(F.lit("~"), F.date_format(at, "yyyy"))).otherwise("soon")
    events = _t(spark, d, "orders").select(k.alias("event_id"), date.alias("date"), F.col("o_orderpriority").alias("description"))
    lines = _t(spark, d, "lineitem").join(_t(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("event_id"), F.col("s_name").alias("name"), F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("doc"))
    return patterns.dated_timeline(events, lines.select("event_id", "name"), lines.select("event_id", "doc")).withColumn("event_date", F.col("event_date").cast("string"))


_LINKS = """WITH l AS (SELECT n_name AS source, r_name AS target, 'PART_OF' AS rel, count(*) AS weight FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)
"""


@query(_LINKS + """SELECT 'link' AS kind, '{"source":"' || source || '","target":"' || target || '","rel":"' || rel || '","weight":' || weight || '}' AS json FROM l
UNION ALL SELECT 'node', '{"id":"' || id || '","label":"' || label || '","degree":' || (SELECT count(*) FROM (SELECT source AS x FROM l UNION ALL SELECT target FROM l) WHERE x = id) || '}' FROM (SELECT n_name AS id, 'Location' AS label FROM nation UNION ALL SELECT r_name, 'Region' FROM region)""")
def network_json(spark, d):
    n, r = _t(spark, d, "nation"), _t(spark, d, "region")
    edges = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("source"), F.col("r_name").alias("target"), F.lit("PART_OF").alias("rel"))
    nodes = n.select(F.col("n_name").alias("id"), F.lit("Location").alias("label")).unionByName(r.select(F.col("r_name").alias("id"), F.lit("Region").alias("label")))
    return patterns.network_json(*patterns.network(nodes, edges))
