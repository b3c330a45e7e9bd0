"""Interfaces of model-backed steps, with deterministic offline forms: fallback chains, extraction, embedding."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip

Provider = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def run_provider(df: DataFrame, provider: Provider, schema: str) -> DataFrame:
    """A provider opens its client once per partition and yields frames; it never sees a row at a time."""
    return df.mapInPandas(provider, schema)


def run_chain(df: DataFrame, providers: list[tuple[str, Provider]], schema: str, key: str = "doc_id") -> DataFrame:
    """Providers in turn, each for the rows that those before it failed: ``schema`` (with ``key``), provider, error.

    A provider is given frames of rows still open and yields frames of answers; rows without an answer, or a
    provider that raises, go to the next with the error kept. What no provider answers comes once, with
    provider null and the last error. Each provider's answers are made once; nothing is read twice.
    """
    names = [x.split()[0].strip("`") for x in schema.split(",")]

    def plain(frame: pd.DataFrame) -> pd.DataFrame:
        """Strings as objects: joined frames may hold them in several pieces, which Arrow doesn't take."""
        return frame.astype({c: object for c in frame.columns if pd.api.types.is_string_dtype(frame[c])})

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            left, why = pdf, pd.Series("no provider", index=pdf[key])
            for name, provider in providers:
                if left.empty:
                    break
                try:
                    got = pd.concat([x for x in provider(iter([left])) if len(x)] or [pd.DataFrame(columns=names)])
                    why[left[key]] = f"{name}: no answer"
                except Exception as e:  # noqa: BLE001 a provider's failure is data: the next one is asked
                    got = pd.DataFrame(columns=names)
                    why[left[key]] = f"{name}: {type(e).__name__}: {e}"
                if len(got):
                    yield plain(got[names].assign(provider=name, error=None))
                left = left[~left[key].isin(got[key])]
            if len(left):
                yield plain(left[[key]].assign(**{n: None for n in names if n != key}, provider=None, error=why[left[key]].tolist())[[*names, "provider", "error"]])

    return df.mapInPandas(work, f"{schema}, provider string, error string")


def batch_stats(work: DataFrame, done: DataFrame, results: DataFrame, key: str = "doc_id") -> DataFrame:
    """total, processed, skipped, failed of a batch: ``done`` was finished before, ``results`` has error."""
    total = work.agg(F.count(F.lit(1)).alias("total"))
    skipped = work.join(done.select(key).distinct(), key, "left_semi").agg(F.count(F.lit(1)).alias("skipped"))
    counts = results.agg(F.count_if(F.col("error").isNull()).alias("processed"), F.count_if(F.col("error").isNotNull()).alias("failed"))
    return total.crossJoin(F.broadcast(skipped)).crossJoin(F.broadcast(counts)).select("total", "processed", "skipped", "failed")  # one row each


def embed_nodes(nodes: DataFrame, done: DataFrame, embed: Callable[[list[str]], list[list[float]]], size: int = 50) -> tuple[DataFrame, DataFrame]:
    """(vectors, stats) of nodes (label, key, name, text) that have text and no vector yet, in batches of ``size``.

    ``vectors``: label, key, embedding. ``stats``: a row for each label and one for all (label null): total,
    embedded, skipped; a node with blank text is skipped.
    """
    todo = nodes.join(done.select("label", "key").distinct(), ["label", "key"], "left_anti").where(F.col("text").isNotNull())
    ready = F.length(strip(F.col("text"))) > 0
    texts = todo.where(ready).select("label", "key", embedding_text(F.col("text"), F.col("name")).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for a in range(0, len(pdf), size):
                part = pdf.iloc[a : a + size]
                yield part[["label", "key"]].assign(embedding=embed(part["text"].tolist()))

    vectors = texts.mapInPandas(run, "label string, key string, embedding array<double>")
    counts = todo.rollup("label").agg(F.count(F.lit(1)).alias("total"), F.count_if(ready).alias("embedded"), F.count_if(~ready).alias("skipped"))
    return vectors, counts


def fallback(*results: Column) -> Column:
    """The first provider's answer that isn't null."""
    return F.coalesce(*results)


def hashed_embedding(text: Column, dims: int = 64) -> Column:
    """A deterministic unit vector: signed hashed word counts. No model, no Python."""
    w = F.filter(F.split(F.lower(text), r"[^\p{L}\p{Nd}]+"), lambda x: x != "")
    at = F.transform(w, lambda x: F.pmod(F.xxhash64(x), F.lit(dims)))
    sign = F.transform(w, lambda x: F.when(F.xxhash64(x, F.lit("sign")) >= 0, 1.0).otherwise(-1.0))
    pairs = F.arrays_zip(at.alias("at"), sign.alias("sign"))
    vector = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda k: F.aggregate(F.filter(pairs, lambda p: p["at"] == k), F.lit(0.0), lambda s, p: s + p["sign"]))
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(vector, lambda x: F.when(norm > 0, x / norm).otherwise(0.0))


def embedding_text(text: Column, name: Column | None = None) -> Column:
    """What is embedded: 'name: text' where there is a name, else the text."""
    return text if name is None else F.when(F.coalesce(name, F.lit("")) != "", F.concat(name, F.lit(": "), text)).otherwise(text)


def route_track(doc_type: Column, vision_first: bool = False) -> Column:
    """Which track takes a document; an unknown type is an error in the text-first order and text in the other."""
    other = F.lit("text") if vision_first else F.when(doc_type == "text_document", "text")
    return F.when(doc_type.isin("photograph", "mixed"), F.when(doc_type == "photograph", "vision").otherwise("mixed")).otherwise(other)


def forensic_type(path: Column) -> Column:
    p = F.lower(path)
    return F.when(p.contains("photograph"), "photograph").when(p.contains("legal") | p.contains("court"), "legal_document").when(p.rlike(r"(^|[^a-z])form"), "form").otherwise("document")


class Mentions:
    """A table function: the capitalised words of a text, of four letters and more, and their places among these."""

    def eval(self, text: str):
        for k, m in enumerate(re.finditer(r"[A-Z][a-z]{3,}", text or "")):
            yield m.group(), k


def register_mentions(spark, name: str = "caseloom_mentions") -> None:
    """Make the table function known to a session's SQL."""
    spark.udtf.register(name, F.udtf(Mentions, returnType="mention string, place int"))
