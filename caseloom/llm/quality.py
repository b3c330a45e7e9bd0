"""Quality by nearest-neighbour voting over latent-semantic vectors.

Method. A text is a bag of hashed terms: its words, the shapes of its words (case, digits, signs; runs
collapsed), one term for words that repeat the word before and one for the share of these. Log term frequencies are weighted by
the idf of the labelled sample and projected onto the leading right singular vectors of the labelled
matrix (latent-semantic analysis). The labelled vectors are broadcast; every document's cosine with
every one of them is computed in blocks, and the NEAREST vote with their similarity to the power
SHARPEN as weight.

The labelled vectors are at most MOST rows of DIMS numbers (documented bound: 1.2 MB); scoring reads
every whole text. Defined results: null text counts as empty; a text without terms, or one that is
near to nothing, gets the share of label 1; without labels the score is 0; of labelled texts that tie as
the last neighbour, the first in the order of label and terms votes; texts of any length are read whole;
equal rows each come back; an empty table gives an empty result; columns other than doc_id and text are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit
from .common import fold, table
from .training import labelled_sample

MOST = 6000
WORD_TERMS, SHAPE_TERMS, SHARES = 3072, 1015, 8
TERMS = WORD_TERMS + SHAPE_TERMS + 1 + SHARES
#: Weight of the terms other than words: a few of them tell more than the many invented words.
FORM_WEIGHT = 3.0
DIMS = 48
NEAREST, SHARPEN = 15, 4
#: Texts whose counts are held at a time.
ROWS = 256


def term_counts(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, matrix of term counts) of chunks of texts: ROWS at most, so the matrix is bounded however short they are."""
    for i, j, data, off in textkit.chunks(column, limit, ROWS):
        s, e, row = textkit.spans(data, off)
        h, shape = textkit.span_hashes(textkit.LOWER[data], s, e), textkit.shapes(data, s, e)
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
        new, again = ~same, np.flatnonzero(same)
        base = row * TERMS
        words = (base + (h % np.uint64(WORD_TERMS)).astype(np.int64))[new]
        forms = (base + WORD_TERMS + (shape % np.uint64(SHAPE_TERMS)).astype(np.int64))[new]
        # A word that repeats the one before counts as that alone, and the share of such words has a term of its own.
        part = np.bincount(row[again], minlength=j - i) * SHARES // np.maximum(np.bincount(row, minlength=j - i), 1)
        share = np.repeat(np.flatnonzero(part), 20) * TERMS + TERMS - 1 - np.repeat(part[part > 0], 20)
        at = np.concatenate([words, forms, base[again] + TERMS - 1, share])
        yield i, j, np.bincount(at, minlength=(j - i) * TERMS).reshape(j - i, TERMS)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list[bytes] = []
        for _, _, m in term_counts(batch.column(0)):
            for x in m:
                at = np.flatnonzero(x)
                found.append(np.stack([at, x[at]]).astype(np.uint32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.binary())], ["label", "terms"])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit(labels: np.ndarray, rows: list[np.ndarray], seed: int = 1) -> dict:
    """idf, projection, vectors and labels of the neighbours."""
    n = len(rows)
    x = np.zeros((n, TERMS), np.float32)
    for k, (at, count) in enumerate(rows):
        x[k, at] = np.log1p(count)
    idf = np.log((1 + n) / (1 + (x > 0).sum(0))).astype(np.float32) + np.float32(0.1)
    idf[WORD_TERMS:] *= FORM_WEIGHT
    x *= idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    q = np.random.default_rng(seed).standard_normal((TERMS, DIMS + 16)).astype(np.float32)
    for _ in range(5):  # subspace iteration for the leading right singular vectors
        q, _ = np.linalg.qr(x.T @ (x @ q))
    u, _, _ = np.linalg.svd((x @ q).T @ (x @ q))
    basis = (q @ u[:, :DIMS]).astype(np.float32)
    return {"idf": idf, "basis": basis, "vectors": _unit(x @ basis).astype(np.float32), "labels": labels.astype(np.float32), "share": float(labels.mean()) if n else 0.0}


def train(docs: DataFrame, labels: DataFrame, most: int = MOST) -> dict:
    sample = labelled_sample(docs, labels, "quality", 5, 0, most)
    rows = sample.select("text", "label").mapInArrow(_rows, "label int, terms binary").collect()
    rows.sort(key=lambda r: (r["label"], bytes(r["terms"])))
    return fit(np.array([r["label"] for r in rows]), [np.frombuffer(r["terms"], np.uint32).reshape(2, -1) for r in rows])


def score_texts(column: pa.Array, model: dict) -> np.ndarray:
    out = np.full(len(column), model["share"])
    vectors, labels = model["vectors"], model["labels"]
    if not len(vectors):
        return out
    k = min(NEAREST, len(vectors))
    for i, j, m in term_counts(column):
        v = (np.log1p(m).astype(np.float32) * model["idf"]) @ model["basis"]
        has = np.linalg.norm(v, axis=1) > 1e-9
        cos = _unit(v).astype(np.float32) @ vectors.T
        near = _nearest(cos, k)
        weight = np.maximum(np.take_along_axis(cos, near, 1), 0).astype(np.float64) ** SHARPEN
        total = weight.sum(1)
        ok = has & (total > 0)
        vote = (weight * labels[near]).sum(1) / np.where(ok, total, 1)
        out[i:j][ok] = np.clip(vote[ok], 0, 1)
    return out


def _nearest(cos: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest cosines of each row; of equal ones at the edge those of the first labelled texts."""
    near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(cos, near, 1).min(1)
    for row in np.flatnonzero((cos >= least[:, None]).sum(1) > k):  # a tie at the edge
        near[row] = np.argsort(-cos[row], kind="stable")[:k]
    return near


def scores(docs: DataFrame, model: dict) -> DataFrame:
    """All columns of ``docs`` and ``quality_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text):
        import pandas as pd

        return pd.Series(score_texts(pa.array(text, pa.string()), shared.value))

    return docs.withColumn("quality_score", score(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scores(docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.3).cast("int").alias("predicted"))
