"""Near-duplicate detection: improved consistent weighted sampling over TF-IDF shingles, banded and verified.

Method. A text is a weighted set of five-word shingles (A-Z lower-cased, words parted by white space;
a text of one to four words is one shingle). A shingle's weight is its TF-IDF, (1 + ln tf) * idf with the
smoothed idf 1 + ln((1 + N) / (1 + df)): N is the number of all documents, df that of the documents with
the shingle, counted in 2**20 hash buckets (a bucket's count is at least its shingles' df). Improved
consistent weighted sampling (Ioffe 2010) gives BANDS x ROWS samples, each a
(shingle, t) of least ln a; texts that agree in all samples of a band are candidates, and candidates
are verified by their exact weighted Jaccard similarity.

Every pair of candidates is compared or lies in one component already: each band bucket is first
compared with its leader (the least id); then the strays, which aren't in the bucket's largest
component, are compared with all the rest, as listed pairs in small buckets and in blocks of bounded
numbers and bytes, by matrix products, in large ones. So no large bucket is enumerated as pairs and none
is capped. With 16 bands of 4 a pair of similarity 0.8 is missed with probability 0.0002.

Defined results: rows with equal texts share a group, empty ones too; null text counts as empty; a
text without words is near to nothing else; texts of any length are taken whole; a pair whose similarity
equals the threshold is linked; equal rows each come back; a text whose rows all lack a
doc_id has an id above 2**62 made from it, which is never the least of others; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit
from .common import give_back, settle, shared_dir
from .components import components
from .exact_dedup import maybe_among

WIDTH, THRESHOLD = 5, 0.8
BANDS, ROWS = 16, 4
SLOTS = 1 << 20
#: Buckets up to this size are compared by listed pairs, larger ones in blocks of so many strays and members.
SMALL, STRAYS, MEMBERS = 32, 512, 2048
#: Bytes of text of a block's strays, about, and a quarter of those of its members.
BLOCK_BYTES = 4_000_000
#: Rows of the tables of random numbers. ln c comes from another row than r and beta, so that two shingles share a sample
#: only if they share both rows.
TABLE = 1 << 15


def weighted(column: pa.Array, idf: np.ndarray | None, limit: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, shingle, row, weight or count) of chunks of texts, ordered by row, then shingle."""
    for i, j, data, off in textkit.chunks(column, limit):
        h, row = textkit.shingles(*textkit.words(data, off), j - i, WIDTH)
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(new)
        tf = np.diff(np.append(at, len(h)))
        h, row = h[at], row[at]
        yield i, j, h, row, (1 + np.log(tf)) * idf[h % np.uint64(SLOTS)] if idf is not None else tf


def frequencies(docs: DataFrame) -> np.ndarray:
    """idf of each hash bucket: 2**20 numbers, whatever the input."""
    block = 1 << 12

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, h, _, _ in weighted(batch.column(0), None):
                total += np.bincount((h % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
        if n:
            parts = total.astype(np.uint32).reshape(-1, block)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary()), pa.array([n if k == 0 else 0 for k in range(len(parts))], pa.int64())], ["block", "counts", "docs"])
        give_back()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        docs: dict[int, int] = {}
        for batch in batches:
            for k, x, n in zip(*(c.to_pylist() for c in batch.columns)):
                v = np.frombuffer(x, np.uint32 if len(x) == 4 * block else np.uint64).astype(np.uint64)
                sums[k] = sums[k] + v if k in sums else v
                docs[k] = docs.get(k, 0) + n
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary()), pa.array([docs[k] for k in sums], pa.int64())], ["block", "counts", "docs"])

    schema = "block int, counts binary, docs bigint"
    parts = docs.select("text").mapInArrow(count, schema).repartition(64, "block").mapInArrow(add, schema).collect()
    df, n = np.zeros(SLOTS, np.float64), max(1, sum(r["docs"] for r in parts))
    for r in parts:
        df[r["block"] * block : (r["block"] + 1) * block] = np.frombuffer(r["counts"], np.uint64)
    return (1 + np.log((1 + n) / (1 + np.minimum(df, n)))).astype(np.float32)


_tables: dict[int, tuple[np.ndarray, ...]] = {}


def _random_table(seed: int) -> tuple[np.ndarray, ...]:
    if seed not in _tables:
        g = np.random.default_rng(seed)
        size = (TABLE, BANDS * ROWS)
        r = g.gamma(2, 1, size).astype(np.float32)
        _tables[seed] = r, np.log(g.gamma(2, 1, size)).astype(np.float32), g.random(size).astype(np.float32)
    return _tables[seed]


def sample(h: np.ndarray, row: np.ndarray, weight: np.ndarray, seed: int = 9) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have shingles, and for each and each sample the least ln a, which stands for its (shingle, t)."""
    r, lnc, beta = _random_table(seed)
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    out = np.full((len(starts), BANDS * ROWS), np.inf, np.float32)
    place, second = (((h >> np.uint64(k)) % np.uint64(TABLE)).astype(np.int64) for k in (20, 40))
    s = np.log(weight).astype(np.float32)[:, None]
    owner = np.cumsum(np.diff(row, prepend=-1) != 0) - 1
    for a in range(0, len(h), 4096):
        p = place[a : a + 4096]
        rr, b = r[p], beta[p]
        x = s[a : a + 4096] / rr
        x += b
        np.floor(x, out=x)
        x -= b
        x += 1
        x *= rr
        np.subtract(lnc[second[a : a + 4096]], x, out=x)
        own = owner[a : a + 4096]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        out[own[first]] = np.minimum(out[own[first]], np.minimum.reduceat(x, first, axis=0))
    return row[starts], out


def band_hashes(samples: np.ndarray) -> np.ndarray:
    bits = samples.view(np.uint32).astype(np.uint64).reshape(len(samples), BANDS, ROWS)
    out = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(samples), 1))
    for k in range(ROWS):
        out = textkit.mix(out * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, k])
    return out.view(np.int64)


def similarities(left: pa.Array, right: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts; 0 where both are without words."""
    out = np.zeros(len(left))
    for i in range(0, len(left), 256):
        sets, n = [], min(256, len(left) - i)
        for column in (left, right):
            parts = [(h, row + a, w) for a, _, h, row, w in weighted(column.slice(i, 256), idf)]
            sets.append([np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, t) for t in (np.uint64, np.int64, np.float64)])
        h, row, w = (np.concatenate(x) for x in zip(*sets))
        order = np.lexsort((h, row))
        h, row, w = h[order], row[order], w[order]
        twice = np.flatnonzero((h[1:] == h[:-1]) & (row[1:] == row[:-1]))
        both = np.bincount(row[twice], np.minimum(w[twice], w[twice + 1]), n)
        union = np.bincount(row, w, n) - both
        out[i : i + n] = np.where(union > 0, both / np.where(union > 0, union, 1), 0)
    return out


def _block_links(pdf: pd.DataFrame, idf: np.ndarray, threshold: float) -> pd.DataFrame:
    """Links that join the components of a block's strays and members: enough of them, not all.

    The sum of minima is at most the product of the weights' square roots, and equals it where
    frequencies agree. These products are found by matrix products over slices of the shingles; only
    pairs which they leave possible, and which aren't joined yet, are compared exactly.
    """
    pdf = pdf.sort_values(["stray", "id"], ascending=[False, True], kind="stable")
    n = int(pdf["stray"].sum())
    ids, texts = pdf["id"].to_numpy(), pa.array(pdf["text"])
    labels = np.unique(pdf["component"].to_numpy(), return_inverse=True)[1]
    parts = [(h, row + i, w) for i, _, h, row, w in weighted(texts, idf)]
    h, row, w = (np.concatenate(x) for x in zip(*parts))
    total = np.bincount(row, w, len(pdf))
    _, which, count = np.unique(h, return_inverse=True, return_counts=True)
    shared = count[which] > 1
    which, row, w = which[shared], row[shared], np.sqrt(w[shared]).astype(np.float32)
    order = np.argsort(which, kind="stable")
    which, row, w = which[order], row[order], w[order]
    product = np.zeros((n, len(pdf) - n), np.float32)
    for first in range(0, len(count), 2048):
        i, j = np.searchsorted(which, [first, first + 2048])
        if j > i:
            m = np.zeros((len(pdf), 2048), np.float32)
            m[row[i:j], which[i:j] - first] = w[i:j]
            product += m[:n] @ m[n:].T
    possible = product >= (threshold - 1e-4) / (1 + threshold) * (total[:n, None] + total[None, n:])
    out: list[tuple[int, int]] = []
    while True:
        possible &= labels[:n, None] != labels[None, n:]
        x = np.flatnonzero(possible.any(1))
        if not len(x):
            return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        y = np.where(possible[x], product[x], -1).argmax(1)
        possible[x, y] = False
        near = similarities(texts.take(pa.array(x)), texts.take(pa.array(y + n)), idf) >= threshold - 1e-12
        for i, j in zip(x[near], y[near] + n):
            out.append((int(ids[i]), int(ids[j])))
            if labels[i] != labels[j]:
                labels[labels == labels[j]] = labels[i]


def near_duplicates(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD, work: str | None = None, carry: bool = False) -> DataFrame:
    """doc_id, group_id (least doc_id of the group), digest of the text, for each row of ``docs``.

    With ``carry``: id, digest, group_id of each distinct text instead.
    """
    work = work or shared_dir(spark)
    context = spark.sparkContext
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = docs.select("doc_id", text.alias("text"))
    idf = context.broadcast(frequencies(docs))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands: list = [None] * batch.num_rows
            for i, _, h, row, w in weighted(batch.column(2), idf.value):
                if len(h):
                    rows, samples = sample(h, row, w)
                    for k, x in zip((rows + i).tolist(), band_hashes(samples).tolist()):
                        bands[k] = x
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pc.binary_length(batch.column(2)).cast(pa.int64()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "digest", "size", "bands"])
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = settle(docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), "text").mapInArrow(sign, f"doc_id {kind}, digest binary, size bigint, bands array<bigint>"), f"{work}/signed")
    stand_in = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("digest"), 3)
    texts = settle(signed.groupBy("digest").agg(F.min("doc_id").cast("long").alias("id"), F.first("size").alias("size"), F.first("bands").alias("bands")).withColumn("id", F.coalesce("id", stand_in)), f"{work}/texts")
    # A doc_id that stands for several texts would merge their groups: texts that share their least doc_id get ids of their own.
    shared = texts.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")
    if not shared.isEmpty():
        odd = texts.join(shared, "id", "left_semi").withColumn("id", stand_in)
        texts = settle(texts.join(shared, "id", "left_anti").unionByName(odd.select(*texts.columns)), f"{work}/texts2")
    slots = texts.select("id", "size", F.explode("bands").alias("bucket"))
    leaders = settle(slots.groupBy("bucket").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "leader"), f"{work}/leaders")
    members = settle(slots.join(leaders, "bucket"), f"{work}/members")
    pairs = members.where("id != leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()

    def verify(pairs: DataFrame, name: str) -> DataFrame:
        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _tables.clear()  # signing is over; they are made again if not
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(similarities(batch.column(2), batch.column(3), idf.value), pa.float64())], ["a", "b", "s"])
            give_back()

        found = pairs.join(bodies.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").join(bodies.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        return settle(found.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a bigint, b bigint, s double"), f"{work}/{name}")

    # Texts of candidates only, one row each: a bitmap of fixed size keeps most others from the shuffle.
    wanted = texts.join(members.select("id").distinct(), "id", "left_semi").select("id", F.col("digest").alias("_digest"))
    hit = maybe_among(docs.withColumn("digest", F.unhex(F.sha2("text", 256))), wanted.select(F.col("_digest").alias("digest")), "digest")
    one = hit.groupBy("digest").agg(F.max("text").alias("text"))
    bodies = settle(one.join(wanted, F.col("digest") == F.col("_digest")).select("id", "text"), f"{work}/bodies")

    near = verify(pairs, "first")
    links = near.where(F.col("s") >= threshold - 1e-12).select("a", "b")
    groups = settle(components(links, f"{work}/cc1"), f"{work}/groups1")
    # What the leaders leave open: members of a bucket in different components. Strays are those outside
    # the bucket's largest component; pairs are listed for small buckets only, of at most SMALL members.
    placed = members.join(groups, "id", "left").select("id", "size", "bucket", F.coalesce("component", "id").alias("component"))
    split = placed.groupBy("bucket").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.count(F.lit(1)).alias("n")).where("c1 != c2").select("bucket", "n")
    open_ = settle(placed.join(split, "bucket"), f"{work}/open")
    tops = open_.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("count"), F.sum("size").alias("bytes"))
    tops = tops.groupBy("bucket").agg(F.max(F.struct("count", "component", "bytes")).alias("m"), F.sum("bytes").alias("bytes"))
    tops = tops.select("bucket", F.col("m.component").alias("top"), F.col("m.count").alias("of_top"), "bytes", (F.col("bytes") - F.col("m.bytes")).alias("stray_bytes"))
    ranked = settle(open_.join(tops, "bucket"), f"{work}/ranked")
    strays = ranked.where("component != top")
    few = strays.where(F.col("n") <= SMALL).select("bucket", F.col("id").alias("x"), F.col("component").alias("cx"), "top")
    few = few.join(ranked.where(F.col("n") <= SMALL).select("bucket", "id", "component"), "bucket").where("component != cx AND (component = top OR x < id)")
    few = few.select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")).distinct().join(near, ["a", "b"], "left_anti")
    more = verify(settle(few, f"{work}/few"), "second").where(F.col("s") >= threshold - 1e-12).select("a", "b")
    # Large buckets: blocks of strays against blocks of members, each compared inside one task.
    large = F.col("n") > SMALL
    lefts = F.ceil(F.greatest((F.col("n") - F.col("of_top")) / STRAYS, F.col("stray_bytes") / BLOCK_BYTES)).cast("int")
    rights = F.ceil(F.greatest(F.col("n") / MEMBERS, F.col("bytes") / (4 * BLOCK_BYTES))).cast("int")
    own = lambda count: F.pmod(F.xxhash64("id"), count).cast("int")
    grid = strays.where(large).select("bucket", "id", "component", F.lit(True).alias("stray"), own(lefts).alias("left"), F.explode(F.sequence(F.lit(0), rights - 1)).alias("right"))
    grid = grid.unionByName(ranked.where(large).select("bucket", "id", "component", F.lit(False).alias("stray"), F.explode(F.sequence(F.lit(0), lefts - 1)).alias("left"), own(rights).alias("right")))
    compare = lambda pdf: _block_links(pdf, idf.value, threshold)
    blocks = settle(grid.join(bodies, "id").groupBy("bucket", "left", "right").applyInPandas(compare, "a bigint, b bigint"), f"{work}/blocks")
    more = more.union(blocks)
    if not more.isEmpty():
        # The first components stand for their links: as stars, one row a member.
        stars = groups.where("id != component").select(F.col("id").alias("a"), F.col("component").alias("b"))
        groups = settle(components(stars.union(more), f"{work}/cc2"), f"{work}/groups2")
    named = texts.join(groups, "id", "left").select("id", "digest", F.coalesce("component", "id").alias("group_id"))
    if carry:
        return named
    named = named.drop("id")
    return signed.select("doc_id", "digest").join(named, "digest").select("doc_id", "group_id", F.hex("digest").alias("digest"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, group_id, kept (the document with the least doc_id of its group)."""
    found = near_duplicates(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "group_id", F.coalesce(F.col("doc_id") == F.col("group_id"), F.lit(False)).alias("kept"))
