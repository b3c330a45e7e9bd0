"""Sharding by best-fit-decreasing bin packing.

Method. Rows with equal texts form an indivisible group. Groups, largest first, enter the bin with
the least remaining capacity that still holds them; the bins lie in a balanced (AVL) tree ordered by
remaining capacity. ``pack`` opens as few bins of a fixed capacity as it can; ``pack_into`` looks for
the least capacity with which no more than a given number of bins are opened.

Scale. Groups of one size are interchangeable, so the driver packs a histogram of exact sizes, not groups.
Different sizes add up to no more than all bytes, so there are sqrt(2 * bytes) of them at most (245,000
for 30 GB; 14 million, as 16 bytes each, for 100 TB, and real corpora have far fewer). Which group of a
size goes where follows from its gapless index among the groups of that size, computed by many tasks
whose number grows with the input.

Defined results: of bins with equal remaining capacity the one opened first is filled; groups of one size
are ordered by digest; texts of any length are sized whole; null text counts as empty (size 1); equal rows are in one group and get slots of
their own; a group larger than an even share fills a shard alone and the others stay even; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import gapless, settle, shared_dir

ROWS_PER_BUCKET = 4000
#: A list of runs no longer than this is broadcast (28 bytes each); a longer one is joined by shuffle.
BROADCAST_RUNS = 1_000_000


class _Node:
    __slots__ = ("key", "left", "right", "height")

    def __init__(self, key):
        self.key, self.left, self.right, self.height = key, None, None, 1


def _h(n) -> int:
    return n.height if n else 0


def _fix(n: _Node) -> _Node:
    n.height = 1 + max(_h(n.left), _h(n.right))
    lean = _h(n.left) - _h(n.right)
    if lean > 1:
        if _h(n.left.left) < _h(n.left.right):
            n.left = _turn(n.left, "right", "left")
        return _turn(n, "left", "right")
    if lean < -1:
        if _h(n.right.right) < _h(n.right.left):
            n.right = _turn(n.right, "left", "right")
        return _turn(n, "right", "left")
    return n


def _turn(n: _Node, up: str, down: str) -> _Node:
    top = getattr(n, up)
    setattr(n, up, getattr(top, down))
    setattr(top, down, n)
    for x in (n, top):
        x.height = 1 + max(_h(x.left), _h(x.right))
    return top


class Bins:
    """An AVL tree of (remaining capacity, bin)."""

    def __init__(self):
        self.root = None

    def add(self, key, n="root"):
        if n == "root":
            self.root = self.add(key, self.root)
            return None
        if n is None:
            return _Node(key)
        if key < n.key:
            n.left = self.add(key, n.left)
        else:
            n.right = self.add(key, n.right)
        return _fix(n)

    def remove(self, key, n="root"):
        if n == "root":
            self.root = self.remove(key, self.root)
            return None
        if key < n.key:
            n.left = self.remove(key, n.left)
        elif key > n.key:
            n.right = self.remove(key, n.right)
        elif n.left is None or n.right is None:
            return n.left or n.right
        else:
            low = n.right
            while low.left:
                low = low.left
            n.key = low.key
            n.right = self.remove(low.key, n.right)
        return _fix(n)

    def tightest(self, size):
        """The least key whose capacity is ``size`` or more."""
        n, best = self.root, None
        while n:
            if n.key[0] >= size:
                best, n = n.key, n.left
            else:
                n = n.right
        return best


def pack(sizes: list[tuple[int, int]], capacity: int, most: int | None = None) -> tuple[list[tuple[int, int, int, int]], int] | None:
    """Best-fit-decreasing over (size, number of groups of it): runs (size, first index, end, bin) and the number of bins.

    None when more than ``most`` bins were needed. A size over the capacity gets a bin of its own.
    """
    bins, runs, opened = Bins(), [], 0
    for size, count in sorted(sizes, reverse=True):
        done = 0
        while done < count:
            key = bins.tightest(size)
            if key is None:
                if most is not None and opened >= most:
                    return None
                key = (max(capacity, size), opened)
                opened += 1
            else:
                bins.remove(key)
            # A bin just filled stays the tightest that fits: the items that follow go to it, all at once.
            n = min(count - done, key[0] // size)
            runs.append((size, done, done + n, key[1]))
            done += n
            if key[0] - n * size > 0:
                bins.add((key[0] - n * size, key[1]))
    return runs, opened


def pack_into(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Runs for ``shards`` bins of the least capacity found for which best-fit-decreasing needs no more.

    A group larger than an even share of what is left takes a bin to itself first, so that it doesn't
    loosen the capacity of the others.
    """
    sizes = sorted(((s, n) for s, n in sizes if n), reverse=True)
    alone: list[tuple[int, int, int, int]] = []
    total = sum(s * n for s, n in sizes)
    left = shards
    while sizes and left > 1 and sizes[0][0] * left > total:
        size, n = sizes[0]
        first = sum(1 for r in alone if r[0] == size)
        alone.append((size, first, first + 1, shards - left))
        total -= size
        left -= 1
        sizes = ([(size, n - 1)] if n > 1 else []) + sizes[1:]
    if not sizes:
        return alone
    moved = {s: sum(1 for r in alone if r[0] == s) for s, _ in sizes}
    low = max(-(-total // left), sizes[0][0])
    high, best = low, None
    while best is None:
        found = pack(sizes, high, left)
        best, high = (found[0], high) if found else (None, high + max(1, high // 4096, (high - low)))
    while low < high and high - low > max(0, high // 1_000_000):
        mid = (low + high) // 2
        found = pack(sizes, mid, left)
        if found:
            best, high = found[0], mid
        else:
            low = mid + 1
    return alone + [(s, a + moved[s], z + moved[s], b + shards - left) for s, a, z, b in best]


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 8, work: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of each row of ``docs``."""
    work = work or shared_dir(spark)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = settle(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("group")), f"{work}/rows")
    n = rows.count()
    groups = settle(rows.groupBy("group").agg(F.sum("size").alias("class")), f"{work}/groups")
    sizes = groups.groupBy("class").count().toArrow()
    runs = pack_into(list(zip(sizes["class"].to_pylist(), sizes["count"].to_pylist())), shards)
    short = len(runs) <= BROADCAST_RUNS
    runs = spark.createDataFrame(runs, "class long, first long, end long, shard int")
    buckets = max(1, n // ROWS_PER_BUCKET)
    ranked = gapless(groups, ["class"], ["group"], "index", buckets).withColumnRenamed("class", "_class")
    # One run for each size and bin at most.
    placed = ranked.join(F.broadcast(runs) if short else runs, (F.col("_class") == F.col("class")) & (F.col("index") >= F.col("first")) & (F.col("index") < F.col("end"))).select("group", "shard")
    sharded = settle(rows.join(placed, "group").drop("group"), f"{work}/sharded")
    return gapless(sharded, ["shard"], ["doc_id", "text_crc32", "size"], "slot", buckets)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
