"""The catalogue of a graph: which keys and indexes it should have, creation of what is missing, verification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "kind string, name string, labels array<string>, properties array<string>, dimensions int"

# The key of each kind of node, the vector indexes (768 dimensions) and the full-text indexes.
NODE_KEYS = {
    "Person": "name", "Organization": "name", "Location": "name", "Property": "name", "BankAccount": "account_number", "Transaction": "transaction_id",
    "Vessel": "name", "Aircraft": "tail_number", "PhysicalItem": "item_id", "DigitalEvidence": "file_name", "Event": "event_id",
    "PropertyDevelopment": "project_name", "Document": "doc_id", "DocumentChunk": "chunk_id", "VisualEvidence": "visual_id", "Allegation": "allegation_id",
    "LegalProceeding": "case_id", "Contact": "contact_id",
}
VECTORS = {
    "document_chunk_embeddings": ("DocumentChunk", "embedding"), "visual_evidence_embeddings": ("VisualEvidence", "embedding"),
    "event_embeddings": ("Event", "description_embedding"), "allegation_embeddings": ("Allegation", "embedding"),
    "person_description_embeddings": ("Person", "description_embedding"), "location_description_embeddings": ("Location", "description_embedding"),
}
FULLTEXTS = {"person_fulltext": ("Person", ["name", "description"]), "document_fulltext": ("Document", ["doc_id", "text_content"]), "allegation_fulltext": ("Allegation", ["description"]), "event_fulltext": ("Event", ["description"])}
#: An index of this name belongs to others and is not counted.
FOREIGN = "search"


def wanted(spark: SparkSession) -> DataFrame:
    keys = [("key", f"{label.lower()}_{prop}", [label], [prop], None) for label, prop in NODE_KEYS.items()]
    vectors = [("vector", name, [label], [prop], 768) for name, (label, prop) in VECTORS.items()]
    return spark.createDataFrame(keys + vectors + [("fulltext", name, [label], props, None) for name, (label, props) in FULLTEXTS.items()], SCHEMA)


def missing(existing: DataFrame, want: DataFrame) -> DataFrame:
    """What is to be created: entries that the catalogue has neither by name nor, for its kind, by labels and properties."""
    unnamed = want.join(existing.select("name").distinct(), "name", "left_anti")
    return unnamed.join(existing.select("kind", "labels", "properties").distinct(), ["kind", "labels", "properties"], "left_anti").select(*want.columns)


def create(existing: DataFrame, want: DataFrame) -> DataFrame:
    """The catalogue afterwards; a second call adds nothing."""
    return existing.unionByName(missing(existing, want))


def verify(catalogue: DataFrame, keys: int = len(NODE_KEYS), vectors: int = len(VECTORS), fulltexts: int = len(FULLTEXTS)) -> DataFrame:
    """One row: the number and the sorted names of each kind of entry, and whether all are there."""
    kind = lambda k: (F.col("kind") == k) & ~((F.col("kind") == "fulltext") & (F.col("name") == FOREIGN))
    names = [F.array_sort(F.collect_list(F.when(kind(k), F.col("name")))).alias(f"{k}_names") for k in ("key", "vector", "fulltext")]
    got = catalogue.agg(*names)
    got = got.withColumns({f"{k}s": F.size(f"{k}_names") for k in ("key", "vector", "fulltext")})
    return got.withColumn("ok", (F.col("keys") >= keys) & (F.col("vectors") >= vectors) & (F.col("fulltexts") >= fulltexts))
