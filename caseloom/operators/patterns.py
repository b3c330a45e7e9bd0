"""Corroboration, temporal clusters, gaps, timelines and network export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def corroboration(facts: DataFrame, fact: list[str], doc: str, source: str, least: int = 2) -> DataFrame:
    """Facts with at least ``least`` documents and as many sources."""
    g = facts.groupBy(*fact).agg(F.countDistinct(doc).alias("n_docs"), F.countDistinct(source).alias("n_sources"))
    return g.where((F.col("n_docs") >= least) & (F.col("n_sources") >= least))


def temporal_clusters(events: DataFrame, by: str, ts: str, gap: str = "1 hour") -> DataFrame:
    """(by, start, end, n): runs of events less than ``gap`` apart."""
    s = events.groupBy(by, F.session_window(F.col(ts), gap).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"))
    return s.drop("w")


def missing(expected: DataFrame, present: DataFrame, key: str, gap: str) -> DataFrame:
    return expected.join(present.select(key).distinct(), key, "left_anti").select(F.col(key).alias("key"), F.lit(gap).alias("gap"))


def parse_date(c):
    """(date, precision, approximate) of YYYY, YYYY-MM or YYYY-MM-DD, with or without a leading ~."""
    raw = F.regexp_replace(c, r"^~", "")
    day = F.when(raw.rlike(r"^\d{4}$"), F.concat(raw, F.lit("-01-01"))).when(raw.rlike(r"^\d{4}-\d{2}$"), F.concat(raw, F.lit("-01"))).otherwise(raw)
    precision = F.when(raw.rlike(r"^\d{4}$"), "year").when(raw.rlike(r"^\d{4}-\d{2}$"), "month").when(raw.rlike(r"^\d{4}-\d{2}-\d{2}$"), "day")
    return F.try_to_date(day, "yyyy-MM-dd"), precision, c.startswith("~")


def timeline(events: DataFrame, participants: DataFrame) -> DataFrame:
    """event_id, event_date, participants (joined by ', ', sorted); undated events last when ordered."""
    who = participants.groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_set("name")), ", ").alias("participants"))
    return events.join(who, "event_id", "left").select("event_id", "event_date", F.coalesce("participants", F.lit("")).alias("participants"))


def dated_timeline(events: DataFrame, participants: DataFrame, citations: DataFrame) -> DataFrame:
    """event_id, event_date, precision, approximate, participants, citations, line of events with dates as written.

    ``events`` has event_id, date, description; ``participants`` event_id, name; ``citations`` event_id, doc.
    Dates are YYYY, YYYY-MM or YYYY-MM-DD, approximate with a leading ~; others stay undated and come last
    when ordered by event_date, nulls last, then event_id.
    """
    joined = lambda df, c: df.groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ", ").alias(f"_{c}"))
    date, precision, about = parse_date(F.col("date"))
    e = events.join(joined(participants, "name"), "event_id", "left").join(joined(citations, "doc"), "event_id", "left")
    e = e.select("event_id", "description", date.alias("event_date"), "date", precision.alias("precision"), F.coalesce(about, F.lit(False)).alias("approximate"), F.coalesce("_name", F.lit("")).alias("participants"), F.coalesce("_doc", F.lit("")).alias("citations"))
    precision = F.when(F.col("event_date").isNotNull(), F.col("precision"))
    who = F.when(F.col("participants") != "", F.concat(F.lit(" ("), "participants", F.lit(")"))).otherwise("")
    cited = F.when(F.col("citations") != "", F.concat(F.lit(" ["), "citations", F.lit("]"))).otherwise("")
    line = F.concat(F.when(F.col("event_date").isNotNull(), F.col("date")).otherwise("undated"), F.lit(": "), F.coalesce("description", F.lit("")), who, cited)
    return e.select("event_id", "event_date", precision.alias("precision"), "approximate", "participants", "citations", line.alias("line"))


def chains(edges: DataFrame, starts: DataFrame, ends: DataFrame, hops: int = 3, settle=None) -> DataFrame:
    """start, end, hops, chain: a shortest path of at most ``hops`` from each of ``starts`` (key) to each of ``ends`` (key) it reaches.

    ``edges`` has src, rel, dst, doc and is read both ways; the chain names each step and the document it is
    cited from. Of shortest paths the least by names is taken, so one row of a node and start goes on.
    """
    there = edges.select("src", "rel", "dst", "doc")
    both = there.union(there.select(F.col("dst").alias("src"), "rel", F.col("src").alias("dst"), "doc")).distinct()
    front = starts.select(F.col("key").alias("start"), F.col("key").alias("end"), F.lit(0).alias("hops"), F.col("key").alias("chain")).distinct()
    seen = front
    for n in range(1, hops + 1):
        step = F.concat("chain", F.lit(" -["), "rel", F.lit(" @"), "doc", F.lit("]-> "), "dst")
        front = front.join(both, F.col("end") == F.col("src")).groupBy("start", F.col("dst").alias("end")).agg(F.min(step).alias("chain"))
        front = front.join(seen.select("start", "end"), ["start", "end"], "left_anti").select("start", "end", F.lit(n).alias("hops"), "chain")
        front = settle(front, n) if settle else front
        seen = seen.unionByName(front)
    return seen.where("hops > 0").join(ends.select(F.col("key").alias("end")).distinct(), "end", "left_semi").select("start", "end", "hops", "chain")


#: Links that a node of a label should have: its relation and on which end of it the node stands.
EXPECTED = [("Event", "OCCURRED_AT", "src", "event_without_place"), ("Event", "PARTICIPATED_IN", "dst", "event_without_participant"), ("Allegation", "ALLEGED_IN", "dst", "allegation_without_accused")]


def gaps(nodes: DataFrame, edges: DataFrame, expected=EXPECTED) -> DataFrame:
    """label, key, gap of nodes (label, key) without an expected link among ``edges``."""
    found = []
    for label, rel, end, gap in expected:
        linked = edges.where(F.col("rel") == rel).select(F.col(f"{end}_key").alias("key")).distinct()
        found.append(nodes.where(F.col("label") == label).join(linked, "key", "left_anti").select("label", "key", F.lit(gap).alias("gap")))
    return reduce(DataFrame.unionByName, found)


def network_json(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """One JSON line a node or link, as graph viewers read them: kind, json."""
    a = nodes.select(F.lit("node").alias("kind"), F.to_json(F.struct("id", "label", "degree")).alias("json"))
    return a.unionByName(links.select(F.lit("link").alias("kind"), F.to_json(F.struct("source", "target", "rel", "weight")).alias("json")))


def network(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with degrees and links with weights, as graph viewers read them."""
    links = edges.groupBy("source", "target", "rel").agg(F.count(F.lit(1)).alias("weight"))
    ends = links.select(F.col("source").alias("id")).union(links.select(F.col("target").alias("id")))
    degree = ends.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    return nodes.join(degree, "id", "left").select("id", "label", F.coalesce("degree", F.lit(0)).cast("long").alias("degree")), links


def as_of(left: DataFrame, right: DataFrame, by: str, ts: str, value: str) -> DataFrame:
    """left rows with the last ``value`` of ``right`` at or before them, per ``by``: one union and one window, no range join."""
    a = left.select(by, ts, F.lit(1).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias(value), F.struct(*left.columns).alias("_row"))
    b = right.select(by, ts, F.lit(0).alias("_side"), value, F.lit(None).cast(a.schema["_row"].dataType).alias("_row"))
    w = W.partitionBy(by).orderBy(ts, "_side").rowsBetween(W.unboundedPreceding, 0)
    return a.unionByName(b).withColumn(value, F.last(value, ignorenulls=True).over(w)).where("_side = 1").select("_row.*", value)
