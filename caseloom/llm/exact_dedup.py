"""Exact deduplication by a stateful stream (DataFrame and SQL functions only).

Method. Every row's text is normalised (A-Z lower-cased, null read as empty) and digested. A stream
over the digests, bounded files a micro-batch, keeps keyed state on disk (RocksDB, no watermark, so no
expiry): for each digest the stable identifier that stays, the content locator of that row (file and row)
and the number of rows seen. A digest that is met again is a hit, served from the state of earlier batches
or calls. The texts of hits are read again through their locators, those that stay and those that
came, and their full bytes are compared; a digest shared by different texts is parted by the texts
themselves, and what was found is written beside the state for the calls that follow.

Continuation. A later call with the same ``work`` folder goes on with the state: its rows are held
against all rows of earlier calls, whose files must still be there. A call that died is repeated with its
``call`` name; what it wrote already isn't counted twice.

Defined results: null text counts as empty; null doc_id orders below every doc_id; equal rows each
count and each come back; of rows that tie in doc_id and text the one with the largest locator is the
state's; rows that aren't unchanged rows of Parquet files are written to ``work`` first and have their
locators there; an empty table gives an empty result; other columns are ignored, whatever their names;
texts of any length are digested whole.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import exists, pack, settle, shared_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: State on disk with bounded memory; without preallocation, which would cost each of many small stores some MB of disk.
#: Stores are closed when their task has committed, so none stays open in an executor for the work that follows.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
#: Bits of the broadcast filter of hits: 16 for each, from 2**22 (0.5 MB) to 2**28 (32 MB); more hits than that are joined.
FILTER_BITS, MOST_BITS = 22, 28


def normalise(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` is much faster than ``translate``, and right unless other letters change."""
    text = F.coalesce(text, F.lit(""))
    other = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    return F.when(other == F.lower(other), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _locator() -> Column:
    return F.concat_ws("#", F.col("_metadata.file_path"), F.format_string("%019d", F.col("_metadata.row_index")))


def _in_files(docs: DataFrame) -> bool:
    """Whether ``docs`` has rows of one Parquet source with their text as it is there: asked of the plan, nothing is run."""
    plan = docs._jdf.queryExecution().analyzed()
    listed = lambda seq: [seq.apply(i) for i in range(seq.size())]
    leaves = listed(plan.collectLeaves())
    metadata = any(a.name() == "_metadata" and "row_index" in a.dataType().json() for a in listed(plan.metadataOutput()))
    text = [a.exprId().id() for a in listed(plan.output()) if a.name() == "text"]
    return len(leaves) == 1 and metadata and all(x in [a.exprId().id() for a in listed(leaves[0].output())] for x in text)


def texts_at(spark: SparkSession, locators: DataFrame) -> DataFrame:
    """(text, locator) of the rows at ``locators`` and perhaps of some others. Only names of files reach the driver."""
    files = [unquote(r["f"]) for r in locators.select(F.regexp_replace("locator", r"#\d+$", "").alias("f")).distinct().collect()]
    if not files:
        return locators.sparkSession.createDataFrame([], "text string, locator string")
    rows = spark.read.schema("text string").parquet(*sorted(files)).select("text", _locator().alias("locator"))
    return maybe_among(rows, locators, "locator")


def maybe_among(rows: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` may be among that of ``hits``, by a broadcast bitmap sized by their number; false positives only cost a comparison."""
    bits = max(FILTER_BITS, (16 * hits.count()).bit_length())
    if bits > MOST_BITS:
        return rows.join(hits.select(key).distinct(), key, "left_semi")
    place = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    maps = hits.select(place.alias("_place")).select((F.col("_place") / 32768).cast("int").alias("_word"), (F.col("_place") % 32768).alias("_bit")).groupBy("_word").agg(F.expr("bitmap_construct_agg(_bit)").alias("_map"))
    byte = F.expr("cast(conv(hex(substring(_map, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int)")
    rows = rows.withColumn("_place", place).withColumn("_word", (F.col("_place") / 32768).cast("int")).withColumn("_bit", (F.col("_place") % 32768).cast("int"))
    return rows.join(F.broadcast(maps), "_word").where(byte.bitwiseAND(F.expr("shiftleft(1, _bit % 8)")) != 0).drop("_word", "_bit", "_map", "_place")


def dedup_stream(rows: DataFrame) -> DataFrame:
    """Keyed state over a stream of (digest, doc_id, locator): digest, entry (largest doc_id, its locator), n."""
    return rows.groupBy("digest").agg(F.max(F.struct("doc_id", "locator")).alias("entry"), F.count(F.lit(1)).alias("n"))


def run_state(spark: SparkSession, schema, work: str, files: int) -> None:
    """Run the stream over the keys that no earlier run has read, ``files`` of them a micro-batch.

    State and progress lie in the shared folder: a lost executor's partitions are reloaded from there,
    and each batch's output is overwritten when it is repeated. Settings are those of a session of its own.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    for k, v in STATE_CONF.items():
        own.conf.set(k, v)
    stream = own.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{work}/calls/*/keys")
    query = (
        dedup_stream(stream)
        .writeStream.outputMode("update")
        .option("checkpointLocation", f"{work}/stream")
        .trigger(availableNow=True)
        .foreachBatch(lambda df, epoch: df.write.mode("overwrite").parquet(f"{work}/state/batch={epoch}"))
        .start()
    )
    query.awaitTermination()


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def exact_dedup(spark: SparkSession, docs: DataFrame, digest=sha256, work: str | None = None, call: str | None = None, files: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, locator of the row that stays.

    ``digest`` may be any function of the normalised text; a weak one costs time, not right results.
    ``files`` bounds a micro-batch; by default four files of keys a core, so batches grow with the cluster.
    """
    work, call = work or shared_dir(spark), call or uuid.uuid4().hex
    files = files or max(16, 4 * spark.sparkContext.defaultParallelism)
    here, plain = f"{work}/calls/{call}", digest is sha256
    kind = docs.schema["doc_id"].dataType.simpleString()
    entry = f"digest string, entry struct<doc_id:{kind},locator:string>, n bigint"
    docs = docs.select("doc_id", "text")
    if not _in_files(docs):
        docs = settle(docs.select("doc_id", F.col("text").cast("string").alias("text")), f"{here}/content")
    norm = normalise(F.col("text"))
    schema = f"doc_id {kind}, locator string, digest string" + ("" if plain else ", sha string")
    if not exists(spark, f"{here}/keys/_SUCCESS"):
        # The number of the first batch of this call parts what earlier calls have seen from what this one brings.
        earlier = _table(spark, f"{work}/state", "batch bigint").agg(F.coalesce(F.max("batch") + 1, F.lit(0)).alias("first"))
        settle(earlier, f"{here}/start")
        settle(docs.select("doc_id", _locator().alias("locator"), norm.alias("norm")).select("doc_id", "locator", digest(F.col("norm")).alias("digest"), *([] if plain else [sha256(F.col("norm")).alias("sha")])), f"{here}/keys")
    keys = spark.read.schema(schema).parquet(f"{here}/keys")
    first = spark.read.schema("first bigint").parquet(f"{here}/start").first()["first"]
    run_state(spark, keys.schema, work, files)
    told = _table(spark, f"{work}/state", entry + ", batch bigint")
    if first:
        told = told.join(keys.select("digest").distinct(), "digest", "left_semi")
    # A digest has a row for each batch that touched it; counts only grow and so does the largest entry.
    latest = lambda rows: rows.groupBy("digest").agg(F.max("entry").alias("entry"), F.max("n").alias("n"))
    state = settle(latest(told), f"{here}/groups")
    hits = state.where("n > 1").select("digest")
    # Full bytes of the hits, by their locators: all that came with this call, and of earlier ones what stayed.
    # Partial aggregation brings a hot group down to one row a task before the shuffle.
    came = keys.join(hits, "digest", "left_semi").select("locator")
    stayed = told.where(F.col("batch") < first).join(hits, "digest", "left_semi").select("entry.locator")
    texts = texts_at(spark, settle(came.union(stayed), f"{here}/hits")).select(norm.alias("norm"), "locator").withColumn("digest", digest(F.col("norm")))
    seen = texts.groupBy("digest").agg(F.min("norm").alias("low"), F.max("norm").alias("high"))
    parted = _table(spark, f"{work}/parted", entry + ", first bigint").where(F.col("first") < first)
    clash = settle(seen.where("low != high").select("digest").union(parted.join(hits, "digest", "left_semi").select("digest")).distinct(), f"{here}/clash")
    columns = ["doc_id", "digest", "keep_id", "group_size", "locator", *([] if plain else ["sha"])]
    final = keys.drop("locator").join(state, "digest").select("doc_id", "digest", F.col("entry.doc_id").alias("keep_id"), F.col("n").alias("group_size"), F.col("entry.locator").alias("locator"), *columns[5:])
    if not clash.isEmpty():
        final = final.join(clash, "digest", "left_anti").unionByName(_parted(spark, keys, clash, told, parted, latest, first, norm, work, here).select(*columns))
    return final.select("doc_id", "keep_id", F.col("group_size").cast("long"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest" if plain else "sha").alias("text_sha256"), "locator")


def _parted(spark: SparkSession, keys: DataFrame, clash: DataFrame, told: DataFrame, parted: DataFrame, latest, first: int, norm: Column, work: str, here: str) -> DataFrame:
    """The rows whose digest stands for several texts, grouped by the texts; the groups are written for later calls."""
    # What earlier calls know of these digests: the groups they parted last, or else the one text of the state.
    last = parted.join(clash, "digest", "left_semi").groupBy("digest").agg(F.max("first").alias("first"))
    old = parted.join(last, ["digest", "first"]).select("digest", "entry", "n")
    old = old.unionByName(latest(told.where(F.col("batch") < first).join(clash, "digest", "left_semi").join(last, "digest", "left_anti")).select("digest", "entry", "n"))
    new = keys.join(clash, "digest", "left_semi")
    rows = settle(new.select("digest", F.struct("doc_id", "locator").alias("entry"), F.lit(1).cast("long").alias("n")).unionByName(old).withColumn("locator", F.col("entry.locator")), f"{here}/parts")
    bodies = texts_at(spark, rows.select("locator")).select("locator", norm.alias("norm"))
    groups = rows.join(bodies, "locator").groupBy("digest", "norm").agg(F.max("entry").alias("entry"), F.sum("n").alias("n"))
    groups = settle(groups, f"{here}/parted")
    settle(groups.select("digest", "entry", "n"), f"{work}/parted/first={first}")
    return new.join(bodies, "locator").drop("locator").join(groups, ["digest", "norm"]).select(*[c for c in new.columns if c != "locator"], F.col("entry.doc_id").alias("keep_id"), F.col("n").alias("group_size"), F.col("entry.locator").alias("locator"))


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay; of equal rows with one doc_id, one."""
    from pyspark.sql import Window as W

    verdict = exact_dedup(spark, docs).where("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("key")).distinct()
    marked = pack(docs).withColumn("sha", sha256(normalise(F.col("text")))).drop("text")
    joined = marked.join(verdict, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("sha") == F.col("key")), "left_semi")
    # Only repeated doc_ids can leave several rows of one text.
    return joined.withColumn("n", F.row_number().over(W.partitionBy("doc_id", "sha").orderBy("doc_id"))).where("n = 1").select("row.*")


ORACLE = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, false) AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g ON d.t = g.t
"""


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("locator")
