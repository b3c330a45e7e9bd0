"""Streaming forms: sessions with watermark, running counts and incremental quality reports."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality


def file_stream(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A stream over the Parquet files of a table, be it a folder or a file."""
    return spark.readStream.schema(schema or spark.read.parquet(path).schema).parquet(f"{path}*")


def sessions(events: DataFrame, by: str = "user_id", gap: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Sessions of events; rows later than ``late`` are dropped, sessions come out when the watermark passes them."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    s = timed.groupBy(by, F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return s.select(by, F.col("w.start").alias("start_ts"), F.col("w.end").alias("end_ts"), "n")


def work_folder(spark: SparkSession) -> str:
    """A fresh folder for checkpoints and output, under ``spark.checkpoint.dir``.

    A local temporary folder is taken only where that is unset and the master is local; on a cluster without
    it a ValueError is raised, as executors would write to their own disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/caseloom-stream/{uuid.uuid4().hex}"


def settle(df: DataFrame, path: str) -> DataFrame:
    """Cut lineage: write to the shared folder and read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def closed_sessions(spark: SparkSession, path: str, work: str, gap: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """All sessions of a bounded input as the stream gives them, those still open at its end too.

    After the input, a closing row far in the future goes through the same query and checkpoint: it moves
    the watermark past every session, and is left out of the result.
    """
    schema = spark.read.parquet(path).schema
    closing = f"{work}/closing"
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(closing)

    def run() -> DataFrame:
        rows = file_stream(spark, path, schema).unionByName(spark.readStream.schema(schema).parquet(closing))
        return run_to_end(sessions(rows, gap=gap, late=late), f"{work}/out", f"{work}/checkpoint")

    run()
    far = F.lit("9000-01-01 00:00:00").cast(schema["ts"].dataType)
    row = spark.range(1).select(*[(far if f.name == "ts" else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])
    row.write.mode("append").parquet(closing)
    done = run().where("year(start_ts) < 9000")
    return done.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_ts", "end_ts")})


def windowed_counts(events: DataFrame, by: str = "event_type", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(by, F.window("ts", width).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(by, F.col("w.start").alias("start_ts"), "n")


def incremental_quality(docs: DataFrame) -> DataFrame:
    """Quality reports of documents as they arrive: stateless, so the checkpoint alone resumes it."""
    return quality.quality_report(docs)


def run_to_end(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over all there is, into Parquet, and read the result."""
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").option("path", path).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def each_batch(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> None:
    """Hand each micro-batch to an idempotent sink, keyed by its number."""
    stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start().awaitTermination()
