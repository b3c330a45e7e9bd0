"""Toxicity by a counterfactual-regularised classifier.

Method. A logistic model over the presence of words (A-Z lower-cased runs of letters and digits) and
of their beginnings. Those that tell the labels apart are chosen from the labelled texts by a chi-squared statistic; the
identity terms are always in. Each labelled text has a counterfactual: an identity term in it is
swapped for another or for none; a text without one is taken with a term and with another put in.
The loss adds LAMBDA times the squared change of the log-odds, so the mere mention of a group changes
no score, however such mentions fall among the labels.

The fit takes at most MOST labelled rows (documented bound); scoring reads every whole text. Defined
results: null text counts as empty; an empty text gets the score of a text without known words; equal
rows each come back; without labels of both kinds the score is the share of label 1, or 0 without
labels; an empty table gives an empty result; columns other than doc_id and text are never read.
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

MOST = 5_000
WORDS = 512
#: Scores from here on are toxic.
TOXIC = 0.7
#: Lengths in bytes of the beginnings of words that are features beside the words: inflected and compound forms share them.
PREFIXES = (4, 5, 6, 7, 8)
#: A word whose statistic is below this may tell nothing; about what the largest of 100,000 chance values reaches.
CHI = 16.0
LAMBDA = 5.0
RIDGE = 1e-5
STEPS = 600
#: Neutral group mentions that are swapped for one another; a parameter, to be extended for a corpus.
IDENTITY = (
    "women men woman man girls boys muslim muslims christian christians jewish jews hindu buddhist atheist black white asian african european american arab latino "
    "gay lesbian bisexual transgender straight immigrant immigrants refugee refugees disabled deaf blind elderly young foreigner foreigners "
    "frauen männer muslime christen juden schwarze ausländer flüchtlinge behinderte femmes hommes musulmans chrétiens juifs noirs immigrés réfugiés mujeres hombres musulmanes cristianos judíos negros inmigrantes refugiados"
).split()


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of the words, and of the beginnings of longer words in the lengths PREFIXES."""
    s, e, row = textkit.spans(data, off, textkit.NON_WORD)
    low = textkit.LOWER[data]
    found = [(textkit.span_hashes(low, s, e), row)]
    for n in PREFIXES:
        longer = e - s > n
        found.append((textkit.span_hashes(low, s[longer], s[longer] + n) ^ np.uint64(n), row[longer]))
    h, row = (np.concatenate(x) for x in zip(*found))
    return (h >> np.uint64(32)).astype(np.uint32), row


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label and the distinct features of each text, as 32-bit integers."""
    for batch in batches:
        bags: list[bytes] = []
        for i, j, data, off in textkit.chunks(batch.column(0), 1 << 18):
            h, row = features(data, off)
            order = np.argsort(row, kind="stable")
            h, row = h[order], row[order]
            cut = np.searchsorted(row, np.arange(j - i + 1))
            bags += [np.unique(h[a:z]).tobytes() for a, z in zip(cut, cut[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(bags, pa.binary())], ["label", "bag"])


def fit(labels: np.ndarray, bags: list[np.ndarray], identity=IDENTITY, seed: int = 3) -> tuple[np.ndarray, np.ndarray, float]:
    """Sorted features, their weights and the bias."""
    ((_, _, data, off),) = textkit.chunks(pa.array(list(identity)), 1 << 30)
    term_features, term = features(data, off)
    words = textkit.spans(data, off, textkit.NON_WORD)[2]  # one word a term, in their order
    terms = np.unique(term_features[: len(words)])
    n, y = len(labels), labels.astype(np.float64)
    if not n or y.min() == y.max():
        share = float(y.mean()) if n else 0.0
        return np.zeros(0, np.uint32), np.zeros(0, np.float32), float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    # Feature and label in one integer, sorted in place: the counts follow without an index of all of them.
    flat = np.concatenate([b.astype(np.uint64) << np.uint64(1) | np.uint64(label) for b, label in zip(bags, labels)])
    flat.sort()
    first = np.flatnonzero(np.diff(flat >> np.uint64(1), prepend=np.uint64(1 << 63)))
    vocab = (flat[first] >> np.uint64(1)).astype(np.uint32)
    df, pos = np.diff(np.append(first, len(flat))), np.add.reduceat((flat & np.uint64(1)).astype(np.uint32), first)
    del flat
    p = y.mean()
    chi = np.where(df >= 3, (pos - df * p) ** 2 / (df * p * (1 - p) + 1), 0)
    chi[chi < CHI] = -1
    chosen = np.argsort(-chi, kind="stable")[:WORDS]
    best = np.union1d(vocab[chosen[chi[chosen] > 0]], terms)
    x = np.zeros((n, len(best)), np.float32)
    for k, bag in enumerate(bags):
        at = np.searchsorted(best, bag)
        at[at == len(best)] = 0
        x[k, at[best[at] == bag]] = 1
    # Each term with the beginnings that are features: a swap changes all of them.
    at = np.searchsorted(best, term_features)
    at[at == len(best)] = 0
    ok = best[at] == term_features
    parts = np.zeros((len(identity), len(best)))
    parts[term[ok], at[ok]] = 1
    own = np.searchsorted(best, term_features[np.searchsorted(words, np.arange(len(identity)))])
    # The counterfactuals: for each text the term that is in, or put in, and the one that replaces it (-1: none).
    rng = np.random.default_rng(seed)
    has = x[:, own] > 0
    given = np.where(has.any(1), has.argmax(1), rng.integers(len(identity), size=n))
    other = np.where(rng.random(n) < 0.5, rng.integers(len(identity), size=n), -1)
    swapped = other >= 0
    w, b, mw, vw, mb, vb = np.zeros(len(best)), 0.0, 0.0, 0.0, 0.0, 0.0
    for k in range(1, STEPS + 1):
        z = x @ w.astype(np.float32) + b
        g = (1 / (1 + np.exp(-z)) - y) / n
        grad = (g.astype(np.float32) @ x).astype(np.float64) + RIDGE * w
        value = parts @ w
        change = value[given] - np.where(swapped, value[other], 0)  # of the log-odds, when the one term replaces the other
        coef = np.bincount(given, change, len(identity)) - np.bincount(other[swapped], change[swapped], len(identity))
        grad += 2 * LAMBDA / n * (coef @ parts)
        gb = float(g.sum())
        mw, vw = 0.9 * mw + 0.1 * grad, 0.99 * vw + 0.01 * grad**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        rate = 0.1 * (1 - k / (STEPS + 1)) + 0.005
        w -= rate * (mw / (1 - 0.9**k)) / (np.sqrt(vw / (1 - 0.99**k)) + 1e-8)
        b -= rate * (mb / (1 - 0.9**k)) / (np.sqrt(vb / (1 - 0.99**k)) + 1e-8)
    return best, w.astype(np.float32), b


def train(docs: DataFrame, labels: DataFrame, most: int = MOST, identity=IDENTITY) -> tuple[np.ndarray, np.ndarray, float]:
    sample = labelled_sample(docs, labels, "toxic", 3, 1, most)
    rows = sample.select("text", "label").mapInArrow(_bags, "label int, bag binary").collect()
    rows.sort(key=lambda r: (r["label"], bytes(r["bag"])))
    return fit(np.array([r["label"] for r in rows]), [np.frombuffer(r["bag"], np.uint32) for r in rows], identity)


def score_texts(column: pa.Array, model: tuple[np.ndarray, np.ndarray, float]) -> np.ndarray:
    best, w, b = model
    out = np.full(len(column), b)
    if len(best):
        for i, j, data, off in textkit.chunks(column, 1 << 18):
            h, row = features(data, off)
            at = np.searchsorted(best, h)
            at[at == len(best)] = 0
            ok = best[at] == h
            seen = np.zeros((j - i, len(best)), bool)
            seen[row[ok], at[ok]] = True
            out[i:j] += seen @ w
    return 1 / (1 + np.exp(-out))


def scores(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float]) -> DataFrame:
    """All columns of ``docs`` and ``toxic_score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(text):
        import pandas as pd

        return pd.Series(score_texts(pa.array(text, pa.string()), shared.value))

    return docs.withColumn("toxic_score", score(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scores(docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= TOXIC).cast("int").alias("predicted"))
