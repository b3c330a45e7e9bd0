"""Sources and sinks: document trees, stage folders of JSON, manifests, alias tables, alerts, groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import validate
from ..operators.batch import split_ceil, split_errors
from ..operators.graph import masked


def document_tree(spark: SparkSession, path: str, pattern: str = "*.{pdf,PDF}") -> DataFrame:
    """doc_id (file stem), path, length, content, file_hash of the files below ``path``; one row per path."""
    b = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return b.dropDuplicates(["path"]).select(F.regexp_extract("path", r"([^/]+)\.[^./]*$", 1).alias("doc_id"), "path", "length", "content", F.sha2("content", 256).alias("file_hash"))


def stage_json(spark: SparkSession, path: str, schema=None, errors: bool = False) -> DataFrame:
    """The records of a stage folder, one JSON file each; error sidecars apart."""
    r = spark.read.option("multiLine", True).option("pathGlobFilter", "*.json")
    d = (r.schema(schema) if schema else r).json(path).withColumn("_file", F.col("_metadata.file_name"))
    side = F.col("_file").endswith(".error.json")
    return d.where(side if errors else ~side)


def manifest(spark: SparkSession, path: str, entry: str) -> DataFrame:
    """Entries of a manifest in either form: an object keyed by doc_id, or a list under ``documents``."""
    raw = spark.read.option("wholetext", True).text(path)
    listed = raw.select(F.explode(F.from_json("value", f"struct<documents:array<{entry}>>")["documents"]).alias("e"))
    keyed = raw.select(F.explode(F.map_values(F.from_json("value", f"map<string,{entry}>"))).alias("e")).where(F.col("e.doc_id").isNotNull())
    return listed.unionByName(keyed).select("e.*")


def aliases(spark: SparkSession, path: str) -> DataFrame:
    """(alias, canonical) of a flat JSON object; an absent file gives an empty table."""
    try:
        raw = spark.read.option("wholetext", True).text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "alias string, canonical string")
    return raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("alias", "canonical"))


def alerts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("timestamp string, doc_id string, provider string, violations array<string>").json(path).where("doc_id IS NOT NULL")


def alert_summary(alerts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Alerts per document and violations per type, the type being what stands before the first colon."""
    kinds = alerts.select(F.explode("violations").alias("v")).select(F.split_part("v", F.lit(":"), F.lit(1)).alias("violation_type"))
    return alerts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("alerts")), kinds.groupBy("violation_type").agg(F.count(F.lit(1)).alias("n"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    masked(df).write.mode(mode).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", by: tuple[str, ...] = ()) -> None:
    masked(df).write.mode(mode).partitionBy(*by).parquet(path)


def append_alerts(checked: DataFrame, path: str, provider: str) -> None:
    """Append the alerts of checked records (doc_id, is_valid, violations) to ``path``; where there is none, nothing is written."""
    found = validate.alerts(checked, provider)
    if not found.isEmpty():
        found.write.mode("append").json(path)


def write_stage(results: DataFrame, path: str) -> None:
    """Append a stage's results and, beside them, its errors (rows with ``error``); a later success doesn't remove an error."""
    good, bad = split_errors(results)
    write_json(good, f"{path}/results", "append")
    write_json(bad, f"{path}/errors", "append")


def write_groups(groups: DataFrame, path: str, strategy: str = "union") -> None:
    """Groups of documents (seed, doc_id) as one line each, and a summary with total_groups and total_documents."""
    listed = groups.groupBy(F.col("seed").alias("group_id")).agg(F.array_sort(F.collect_list("doc_id")).alias("documents"))
    write_json(listed.withColumn("merge_strategy", F.lit(strategy)), f"{path}/groups")
    summary = groups.agg(F.count_distinct("seed").alias("total_groups"), F.count(F.lit(1)).alias("total_documents"))
    summary.write.mode("overwrite").json(f"{path}/summary")


def groups(spark: SparkSession, path: str, kind: str = "string") -> DataFrame:
    """group_id, documents, merge_strategy as ``write_groups`` left them; a missing strategy is union."""
    read = spark.read.schema(f"group_id {kind}, documents array<{kind}>, merge_strategy string").json(f"{path}/groups")
    return read.withColumn("merge_strategy", F.coalesce("merge_strategy", F.lit("union")))


def write_merged(merged: DataFrame, path: str) -> None:
    """Merged texts, one folder a group, and a summary of how many there are and what they fill."""
    masked(merged).write.mode("overwrite").partitionBy("group").json(f"{path}/texts")
    merged.agg(F.count(F.lit(1)).alias("merged"), F.coalesce(F.sum("total_fillins"), F.lit(0)).alias("total_fillins")).write.mode("overwrite").json(f"{path}/summary")


def write_vectors(vectors: DataFrame, path: str) -> int:
    """Append vectors (label, key, embedding) to the table at ``path``; how many there were."""
    counted = Observation()
    vectors.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("append").partitionBy("label").parquet(path)
    return counted.get["n"]


def save_aliases(table: DataFrame, path: str) -> None:
    """The whole alias table as one JSON object, over what was there; it is a driver-sized table, as ``aliases`` reads it."""
    entries = F.array_sort(F.collect_list(F.struct("alias", "canonical")))
    table.agg(F.to_json(F.map_from_entries(entries)).alias("value")).write.mode("overwrite").text(path)


def write_triage(routes: DataFrame, path: str, splits: int = 1) -> None:
    """Triage results by route and split: each route in contiguous parts of equal size, the last one perhaps short, empty ones absent."""
    for route in ("text", "image"):
        part = routes.where(F.col("route") == route)
        n = part.count()
        if n:
            split_ceil(part, splits, n).withColumnRenamed("chunk", "split").write.mode("overwrite").partitionBy("split").json(f"{path}/{route}")


def page_texts(spark: SparkSession, documents: DataFrame, read: Callable[[bytes], list[str]]) -> DataFrame:
    """doc_id, pages, error of documents (doc_id, content): ``read`` gives a document's page texts; one that fails has an error and no pages."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for doc, content in zip(pdf["doc_id"], pdf["content"]):
                try:
                    rows.append((doc, [p or "" for p in read(bytes(content))], None))
                except Exception as e:  # noqa: BLE001 a document that can't be read is data, not a failure of the job
                    rows.append((doc, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["doc_id", "pages", "error"], dtype=object)

    return documents.select("doc_id", "content").mapInPandas(run, "doc_id string, pages array<string>, error string")
