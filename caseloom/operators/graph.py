"""Entities and relations: validation, alias resolution, idempotent upsert, statistics, catalogue checks, expansion."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def resolve(df: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """Replace a name by its canonical form: one hop, case-sensitive, unknown names pass stripped."""
    name = T.strip(F.col(column))
    a = aliases.select(T.strip(F.col("alias")).alias("_alias"), T.strip(F.col("canonical")).alias("_canonical"))
    return df.withColumn(column, name).join(a, F.col(column) == F.col("_alias"), "left").withColumn(column, F.coalesce("_canonical", F.col(column))).drop("_alias", "_canonical")


def add_aliases(table: DataFrame, new: DataFrame) -> DataFrame:
    """An alias table with ``new`` rows (alias, canonical, ord) added: both stripped, the last of an alias stays, old ones of it go."""
    last = new.select(T.strip(F.col("alias")).alias("alias"), T.strip(F.col("canonical")).alias("canonical"), "ord").groupBy("alias").agg(F.max_by("canonical", "ord").alias("canonical"))
    old = table.select(T.strip(F.col("alias")).alias("alias"), T.strip(F.col("canonical")).alias("canonical"))
    return old.join(last.select("alias"), "alias", "left_anti").unionByName(last)


def last_writer(df: DataFrame, keys: list[str], values: list[str], order: str | list[str]) -> DataFrame:
    """One row per key: each value from the last row, by ``order``, in which it isn't null."""
    by = F.struct(*([order] if isinstance(order, str) else order))
    return df.groupBy(*keys).agg(*[F.max_by(F.col(v), F.when(F.col(v).isNotNull(), by)).alias(v) for v in values])


NODE_KEY = ["label", "key"]
EDGE_KEY = ["src_label", "src_key", "rel", "dst_label", "dst_key"]


def _listed(docs: DataFrame, column: str) -> DataFrame:
    return docs.select("doc_id", F.posexplode(column).alias("idx", "e")).withColumn("ord", F.struct("doc_id", "idx"))


def ingest(extractions: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, stats) of extracted documents.

    ``extractions`` has doc_id, doc_type and arrays of structs people(name, role, context),
    locations(name, address, location_type, context), organizations(name, org_type, context[, description]),
    events(event_type, date, description, participants, location), allegations(description, severity,
    status, accused, victims) and associations(person_a, person_b, nature, timeframe). Nodes are unique
    by (label, key), edges by their ends and kind; statistics count merge operations, as documents made
    them, not distinct nodes. A second ingest of the same input changes nothing.
    """
    docs = extractions.where("doc_id IS NOT NULL")

    def named(column: str) -> DataFrame:
        e = _listed(docs, column).withColumn("name", F.col("e.name")).where(T.valid_name(F.col("name")))
        return resolve(e, "name", aliases)

    def members(e: DataFrame, column: str) -> DataFrame:
        m = e.select("doc_id", "ord", "idx", "key", F.explode(column).alias("name")).where(T.valid_name(F.col("name")))
        return resolve(m, "name", aliases)

    # An organization without a context is described by its description, where records have one.
    fields = docs.schema["organizations"].dataType.elementType.fieldNames()
    context = F.nullif(F.col("e.context"), F.lit(""))
    described = F.coalesce(context, F.col("e.description")) if "description" in fields else F.col("e.context")
    people, locations, organizations = (named(c) for c in ("people", "locations", "organizations"))
    filled = lambda c: T.strip(F.coalesce(c, F.lit(""))) != ""
    key = lambda kind: F.concat(F.col("doc_id").cast("string"), F.lit(f"_{kind}_"), F.col("idx").cast("string")).alias("key")
    events = _listed(docs, "events").where(filled(F.col("e.description"))).withColumn("key", key("evt"))
    places = members(events.withColumn("place", F.array("e.location")), "place")
    taking = members(events, "e.participants")
    claims = _listed(docs, "allegations").where(filled(F.col("e.description"))).withColumn("key", key("alg"))
    accused, victims = members(claims, "e.accused"), members(claims, "e.victims")
    anyone = lambda c: F.coalesce(F.exists(c, lambda x: T.valid_name(x)), F.lit(False))
    claims = claims.where(anyone(F.col("e.accused")) | anyone(F.col("e.victims")))
    clean = lambda c: F.nullif(T.pipe_clean(c), F.lit(""))
    pairs = _listed(docs, "associations").select("doc_id", "ord", F.col("e.person_a").alias("a"), F.col("e.person_b").alias("b"), clean(F.col("e.nature")).alias("nature"), clean(F.col("e.timeframe")).alias("timeframe"))
    pairs = resolve(resolve(pairs.where(T.valid_name(F.col("a")) & T.valid_name(F.col("b"))), "a", aliases), "b", aliases).where("a != b")

    document = docs.select("doc_id", F.struct("doc_id", F.lit(-1).alias("idx")).alias("ord"), F.col("doc_id").alias("key"), "doc_type")
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    nodes = []
    for label, df, k, props in (
        ("Document", document, "key", {"doc_type": F.col("doc_type")}),
        ("Person", people, "name", {"role": F.col("e.role"), "description": F.col("e.context")}),
        ("Location", locations, "name", {"address": F.col("e.address"), "location_type": F.col("e.location_type"), "description": F.col("e.context")}),
        ("Organization", organizations, "name", {"org_type": F.col("e.org_type"), "description": described}),
        ("Event", events, "key", {"event_type": F.col("e.event_type"), "date": F.col("e.date"), "description": F.col("e.description")}),
        ("Allegation", claims, "key", {"description": F.col("e.description"), "severity": F.col("e.severity"), "status": F.col("e.status")}),
    ):
        kind = F.lit(label).alias("label")
        rows = df.select("ord", kind, F.col(k).alias("key"), *[clean(c).alias(n) for n, c in props.items()])
        # Names that only have to be there have nothing to order; each comes once.
        named_in = {"Person": [(taking, "name"), (accused, "name"), (victims, "name"), (pairs, "a"), (pairs, "b")], "Location": [(places, "name")]}.get(label)
        if named_in:
            rows = rows.unionByName(union([m.select(kind, F.col(c).alias("key")) for m, c in named_in]).distinct(), allowMissingColumns=True)
        nodes.append(last_writer(rows, NODE_KEY, list(props), "ord").select(*NODE_KEY, _present(list(props))))

    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))

    def linked(df: DataFrame, a: str, ak, kind: str, b: str, bk, by: list[str]) -> DataFrame:
        """Links that ``by`` tells apart: their keys are made of it, so it alone is shuffled."""
        return df.select(*by).distinct().select(F.lit(a).alias("src_label"), ak.alias("src_key"), F.lit(kind).alias("rel"), F.lit(b).alias("dst_label"), bk.alias("dst_key"), none.alias("props"))

    name, doc = F.col("name"), F.col("doc_id")
    member = ["doc_id", "idx", "name"]
    links = [linked(e, label, name, "MENTIONED_IN", "Document", doc, ["doc_id", "name"]) for e, label in ((people, "Person"), (locations, "Location"), (organizations, "Organization"))]
    links += [linked(e, label, key(kind), "DOCUMENTED_IN", "Document", doc, ["doc_id", "idx"]) for e, label, kind in ((events, "Event", "evt"), (claims, "Allegation", "alg"))]
    links += [linked(taking, "Person", name, "PARTICIPATED_IN", "Event", key("evt"), member), linked(places, "Event", key("evt"), "OCCURRED_AT", "Location", name, member)]
    links += [linked(accused, "Person", name, "ALLEGED_IN", "Allegation", key("alg"), member), linked(victims, "Person", name, "VICTIM_OF", "Allegation", key("alg"), member)]
    known = last_writer(pairs, ["a", "b"], ["nature", "timeframe"], "ord")
    bonds = known.select(F.lit("Person").alias("src_label"), F.col("a").alias("src_key"), F.lit("ASSOCIATED_WITH").alias("rel"), F.lit("Person").alias("dst_label"), F.col("b").alias("dst_key"), _present(["nature", "timeframe"]))
    count = lambda df, n, r: df.select("doc_id", F.lit(n).alias("nodes"), F.lit(r).alias("rels"))
    steps = [count(document, 1, 0)] + [count(df, 1, 1) for df in (people, locations, organizations, events, claims)] + [count(df, 0, 1) for df in (taking, places, accused, victims, pairs)]
    stats = union(steps).groupBy("doc_id").agg(F.sum("nodes").alias("nodes"), F.sum("rels").alias("rels"))
    return union(nodes), union([*links, bonds]), stats


def _present(names: list[str]) -> Column:
    """Columns as a map ``props``, those without a value left out."""
    every = F.create_map(*[x for n in names for x in (F.lit(n), F.col(n))])
    return F.map_filter(every, lambda _, v: v.isNotNull()).alias("props")


def merge_properties(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """A store after a batch: properties of ``new`` replace those of the same name, others are kept, absent keys too.

    Both have ``keys`` and ``props``, keys once. Merging the same batch again changes nothing.
    """
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    old, fresh = existing.withColumnRenamed("props", "_old"), new.withColumnRenamed("props", "_new")
    known, come = F.coalesce("_old", none), F.coalesce("_new", none)
    kept = F.map_filter(known, lambda k, _: ~F.map_contains_key(come, k))
    return old.join(fresh, keys, "full_outer").select(*keys, F.map_concat(kept, come).alias("props"))


def ingest_batch(records: DataFrame, schema: str, aliases: DataFrame, settle=None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, summary, failed) of JSON records (doc_id, json): a record that can't be read fails alone.

    ``summary`` has one row: total, succeeded, failed, nodes, rels, the last two being merge operations as
    documents made them. ``failed`` lists the records left out. ``settle`` may write the parsed records to
    shared storage, so that the branches of the ingest don't parse them again.
    """
    parsed = records.withColumn("_p", F.from_json("json", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})).drop("json")
    parsed = settle(parsed) if settle else parsed
    bad = F.col("_p").isNull() | F.col("_p._bad").isNotNull()
    nodes, edges, stats = ingest(parsed.where(~bad).select("_p.*").drop("_bad"), aliases)
    failed = parsed.where(bad).select("doc_id", F.lit("unreadable record").alias("error"))
    sums = stats.agg(F.coalesce(F.sum("nodes"), F.lit(0)).alias("nodes"), F.coalesce(F.sum("rels"), F.lit(0)).alias("rels"))
    # Both counts are taken where the records are parsed already: the records themselves may be dear to make again.
    counts = parsed.select(bad.alias("bad")).agg(F.count(F.lit(1)).alias("total"), F.count_if("bad").alias("failed"))
    one = counts.crossJoin(F.broadcast(sums))  # one row each
    return nodes, edges, one.select("total", (F.col("total") - F.col("failed")).alias("succeeded"), "failed", "nodes", "rels"), failed


def key_violations(nodes: DataFrame, label: str = "label", key: str = "key") -> DataFrame:
    """Nodes without a key, and keys that occur more than once in a label."""
    return nodes.groupBy(label, key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(key).isNull())


def expand(edges: DataFrame, seeds: DataFrame, hops: int = 3, settle=None) -> DataFrame:
    """(key, hop) of what is reached from ``seeds`` (key) over ``edges`` (src, dst), read both ways, within ``hops``.

    ``settle`` may write each round's frontier to shared storage, to cut lineage of long walks.
    """
    both = edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    seen = seeds.select("key", F.lit(0).alias("hop")).distinct()
    front = seen
    for n in range(1, hops + 1):
        front = front.join(both, front["key"] == both["src"]).select(F.col("dst").alias("key")).distinct().join(seen.select("key"), "key", "left_anti").withColumn("hop", F.lit(n))
        front = settle(front, n) if settle else front
        seen = seen.unionByName(front)
    return seen


def masked(df: DataFrame, columns: tuple[str, ...] = ("document_number", "account_number", "potential_identity")) -> DataFrame:
    """Sensitive columns as digests, as every sink writes them."""
    return df.withColumns({c: F.sha2(F.col(c).cast("string"), 256) for c in columns if c in df.columns})


def violations(df: DataFrame, column: Column, allowed: list[str], entity: str, field: str, split: bool = False) -> DataFrame:
    """doc_id, message of values outside the domain; ``split`` checks the parts between pipes."""
    value = F.explode(F.split(column, r"\|")) if split else column
    v = df.select("doc_id", value.alias("v")).withColumn("v", T.strip(F.col("v"))).where(F.col("v").isNotNull() & ~F.col("v").isin(*allowed))
    return v.select("doc_id", F.format_string(f"Invalid {entity}.{field}: '%s' in doc %s", "v", F.col("doc_id").cast("string")).alias("message"))
