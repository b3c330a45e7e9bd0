"""Command line: ``python -m caseloom VERB ...``, each verb a thin call of the library over DataFrames."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import providers, text as T
from .operators import batch, graph, quality, schema
from .plans import catalogue
from .sources import files


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="caseloom", description=__doc__)
    verbs = p.add_subparsers(dest="verb", required=True)

    def verb(name: str, *places: str) -> argparse.ArgumentParser:
        v = verbs.add_parser(name)
        for x in places:
            v.add_argument(x)
        return v

    verb("queries")
    verb("query", "name", "tables", "out")
    verb("classify", "pages", "out").add_argument("--done")
    verb("quality", "docs", "out").add_argument("--done")
    verb("embed", "docs", "out").add_argument("--dims", type=int, default=64)
    verb("ingest", "extractions", "out").add_argument("--aliases")
    s = verb("split", "work", "out")
    s.add_argument("--parts", type=int, required=True)
    s.add_argument("--order", default="doc_id")
    verb("schema").add_argument("--catalogue")
    return p


def _left(spark: SparkSession, work: DataFrame, done: str | None) -> DataFrame:
    return batch.remaining(work, spark.read.parquet(done), "doc_id") if done else work


def run(spark: SparkSession, args: list[str]) -> int:
    """Exit code 0, or 1 where a check fails or a query is unknown."""
    a = parser().parse_args(args)
    read = spark.read.parquet
    if a.verb == "queries":
        print("\n".join(sorted(catalogue.QUERIES)))
    elif a.verb == "query":
        if a.name not in catalogue.QUERIES:
            print(f"no query {a.name}", file=sys.stderr)
            return 1
        files.write_parquet(catalogue.QUERIES[a.name](spark, a.tables), a.out)
    elif a.verb == "classify":
        kind = T.classify(F.col("pages"))
        files.write_parquet(_left(spark, read(a.pages), a.done).select("doc_id", kind.alias("doc_type"), providers.route_track(kind, True).alias("track")), a.out)
    elif a.verb == "quality":
        files.write_parquet(quality.quality_report(_left(spark, read(a.docs), a.done)), a.out)
    elif a.verb == "embed":
        files.write_parquet(read(a.docs).select("doc_id", providers.hashed_embedding(F.coalesce("text", F.lit("")), a.dims).alias("embedding")), a.out)
    elif a.verb == "ingest":
        names = files.aliases(spark, a.aliases) if a.aliases else spark.createDataFrame([], "alias string, canonical string")
        for name, df in zip(("nodes", "edges", "stats"), graph.ingest(read(a.extractions), names)):
            files.write_parquet(df, f"{a.out}/{name}")
    elif a.verb == "split":
        work = read(a.work)
        files.write_parquet(batch.split_even(work, a.parts, work.count(), a.order), a.out, by=("chunk",))
    else:
        have = read(a.catalogue) if a.catalogue else schema.wanted(spark)
        got = schema.verify(have).first()
        print(f"keys {got['keys']}, vector indexes {got['vectors']}, full-text indexes {got['fulltexts']}: {'complete' if got['ok'] else 'incomplete'}")
        return int(not got["ok"])
    return 0


if __name__ == "__main__":
    sys.exit(run(SparkSession.builder.appName("caseloom").getOrCreate(), sys.argv[1:]))
