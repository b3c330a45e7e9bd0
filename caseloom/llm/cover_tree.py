"""Embedding near-duplicates by dual traversal of cover trees: exact pairs over a cosine threshold.

Method. Equal vectors form a class. The classes are dealt to cells around pivots (the upper levels of
a cover tree over a sample, one for every block of vectors, MOST_PIVOTS at most), and cells to blocks of
bounded size. Each block has a cover tree: nested
levels whose radii halve, every node covering its descendants within a known radius. Pairs of blocks,
then pairs of nodes, are pruned when their centres are further apart than both radii and the
threshold's distance together, and taken whole when even their furthest members are near enough.
What is left at the leaves is compared by matrix products, and what comes near the threshold by dot
products in double precision. Where a level doesn't thin its points out, as for unrelated vectors of
many dimensions, the node stays a leaf.

Links are counted, not listed: a task gives each vector's number of links and one edge towards its
component, so a group of near copies costs no more rows than it has members. Which cells can hold links is
found by tasks from the pivots and the cells' radii, and pairs of blocks come from a join of cells: the
driver keeps the pivots and a radius and a number for each cell, never blocks or pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with
nothing and are components of their own; a cosine that equals the threshold in double precision links;
vectors of different lengths don't link; equal vectors link;
equal rows each come back and link with each other; rows without vec_id take part, their classes
having ids above 2**62, which are never the least, where no row has one; an empty table gives an empty result.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle, shared_dir, table
from .components import components

COSINE = 0.95
#: Classes in a block at most, about; a pair of blocks of 64 dimensions is 4 MB of floats or 8 MB of doubles.
BLOCK = 8192
#: Vectors sampled for each pivot, and pivots at most (2 MB of 64 dimensions).
SAMPLE, MOST_PIVOTS = 16, 4096
LEAF = 64
#: Added to radii and taken from bounds, so that rounding never prunes or takes a pair wrongly.
SLACK = 1e-6


def net(x: np.ndarray, radius: float, most: int | None = None) -> np.ndarray:
    """Of unit vectors, greedily in order, those further than ``radius`` from all before; the nearest of them for each."""
    cos = 1 - radius * radius / 2
    centres: list[int] = []
    near = np.full(len(x), -2.0)
    owner = np.zeros(len(x), np.int64)
    left = np.arange(len(x))
    while len(left) and (most is None or len(centres) < most):
        batch = left[:32]
        dots = x[batch] @ x[batch].T
        chosen: list[int] = []
        for k in range(len(batch)):
            if not chosen or (dots[k, chosen] < cos).all():
                chosen.append(k)
        new = batch[chosen]
        d = x @ x[new].T
        best = d.argmax(1)
        value = d[np.arange(len(x)), best]
        better = value > near
        owner[better] = best[better] + len(centres)
        near[better] = value[better]
        centres += new.tolist()
        left = left[near[left] < cos]
    return np.array(centres), owner


class Tree:
    """A cover tree over unit vectors, reordered so that each node's points lie together."""

    def __init__(self, x: np.ndarray):
        self.order = np.arange(len(x))
        self.x = x
        #: Of each node: first point, end, centre (a point), covering radius, children.
        self.nodes: list[tuple[int, int, int, float, list[int]]] = []
        if len(x):
            self._split(0, len(x), 1.0)
        self.low = self.x.astype(np.float32)

    def _split(self, a: int, z: int, level: float) -> int:
        part = self.x[a:z]
        radius = float(np.sqrt(np.maximum(0, 2 - 2 * (part @ part[0])).max())) + SLACK
        here = len(self.nodes)
        self.nodes.append((a, z, a, radius, []))
        if z - a <= LEAF or radius <= 4 * SLACK:
            return here
        while level >= radius:  # levels that one node would cover
            level /= 2
        centres, owner = net(part, level, (z - a) // 2 + 1)
        if len(centres) * 2 > z - a:
            return here
        # The parent's centre stays first, so levels are nested; each child's centre leads its points.
        lead = np.ones(z - a, bool)
        lead[centres] = False
        order = np.lexsort((lead, owner))
        self.order[a:z] = self.order[a:z][order]
        self.x[a:z] = part[order]
        cuts = a + np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(centres)))])
        children = [self._split(int(i), int(j), level / 2) for i, j in zip(cuts, cuts[1:]) if j > i]
        self.nodes[here] = (a, z, a, radius, children)
        return here


class Join:
    """Dual traversal of two trees (or of one with itself): counts of links and labels of components."""

    def __init__(self, left: Tree, right: Tree, weights: tuple[np.ndarray, np.ndarray], cosine: float):
        self.l, self.r, self.same = left, right, left is right
        self.cos, self.far = cosine, float(np.sqrt(2 - 2 * cosine))
        self.wl, self.wr = weights
        self.links = [np.zeros(len(left.x), np.int64), np.zeros(len(right.x), np.int64)]
        if self.same:
            self.links[1] = self.links[0]
        self.shift = 0 if self.same else len(left.x)
        self.label = np.arange(self.shift + len(right.x))
        self.edges: list[np.ndarray] = []
        if len(left.x) and len(right.x):
            self._visit()
        self._merge()

    def _visit(self) -> None:
        stack = [(0, 0)]
        while stack:
            p, q = stack.pop()
            a, z, c, r, below = self.l.nodes[p]
            b, y, e, s, under = self.r.nodes[q]
            itself = self.same and p == q
            d = 0.0 if itself else float(np.sqrt(max(0.0, 2 - 2 * float(self.l.x[c] @ self.r.x[e]))))
            if d > r + s + self.far + SLACK:
                continue
            if d + r + s < self.far - SLACK:
                self._all(a, z, b, y, itself)
            elif not below and not under or (z - a) * (y - b) <= LEAF * LEAF:
                self._compare(a, z, b, y, itself)
            elif itself:
                stack += [(m, n) for i, m in enumerate(below) for n in below[i:]]
            elif below and (r >= s or not under):
                stack += [(m, q) for m in self._close(self.l, below, self.r, e, s)]
            else:
                stack += [(p, n) for n in self._close(self.r, under, self.l, c, r)]

    def _close(self, tree: Tree, children: list[int], other: Tree, centre: int, radius: float) -> list[int]:
        at = np.array([tree.nodes[m][2] for m in children])
        reach = np.array([tree.nodes[m][3] for m in children]) + radius + self.far + SLACK
        d = np.sqrt(np.maximum(0, 2 - 2 * (tree.x[at] @ other.x[centre])))
        return [m for m, ok in zip(children, d <= reach) if ok]

    def _all(self, a: int, z: int, b: int, y: int, itself: bool) -> None:
        if itself:
            self.links[0][a:z] += self.wl[a:z].sum() - self.wl[a:z]
        else:
            self.links[0][a:z] += self.wr[b:y].sum()
            self.links[1][b:y] += self.wl[a:z].sum()
        points = np.concatenate([np.arange(a, z), np.arange(b, y) + self.shift])
        self.edges.append(np.stack([points, np.full(len(points), points[0])]))

    def _compare(self, a: int, z: int, b: int, y: int, itself: bool) -> None:
        for i in range(a, z, 512):
            j = min(z, i + 512)
            start = i if itself else b
            m, n = np.nonzero(self.l.low[i:j] @ self.r.low[start:y].T >= self.cos - 1e-4)
            m, n = m + i, n + start
            if itself:
                m, n = m[m < n], n[m < n]
            for k in range(0, len(m), 1 << 16):
                u, v = m[k : k + (1 << 16)], n[k : k + (1 << 16)]
                ok = np.einsum("ij,ij->i", self.l.x[u], self.r.x[v]) >= self.cos
                u, v = u[ok], v[ok]
                np.add.at(self.links[0], u, self.wr[v])
                np.add.at(self.links[1], v, self.wl[u])
                self.edges.append(np.stack([u, v + self.shift]))
            if sum(x.shape[1] for x in self.edges) > 1 << 20:
                self._merge()

    def _merge(self) -> None:
        if not self.edges:
            return
        u, v = np.concatenate(self.edges, axis=1)
        self.edges = []
        while True:
            low = np.minimum(self.label[u], self.label[v])
            # Hook the labels themselves, then shorten the paths.
            for side in (u, v):
                np.minimum.at(self.label, self.label[side], low)
                np.minimum.at(self.label, side, low)
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]
            if (self.label[u] == self.label[v]).all():
                return


def _unit(vectors: np.ndarray) -> np.ndarray:
    x = vectors / np.abs(vectors).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` centres: of the finest level that has no more, filled up from the next."""
    level, best = 2.0, np.zeros(0, np.int64)
    while len(best) < min(most, len(sample)) and level > 1e-3:
        level /= 2
        best, _ = net(sample, level, most)
        best = best[:most]
    return sample[best]


def near_vectors(spark: SparkSession, rows: DataFrame, cosine: float = COSINE, block: int = BLOCK, work: str | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``rows`` (vec_id, embedding)."""
    work = work or shared_dir(spark)
    v = F.col("embedding").cast("array<double>")
    rows = rows.select("vec_id", v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce((F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    key = F.when(valid, F.sha2(F.array_join(F.transform("v", lambda x: x.cast("string")), ","), 256))
    keyed = settle(rows.select("vec_id", key.alias("key"), F.when(valid, F.col("v")).alias("v")), f"{work}/keyed")
    stand_in = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("key"), 3)
    classes = settle(keyed.where("key IS NOT NULL").groupBy("key").agg(F.min("vec_id").cast("long").alias("id"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v")).withColumn("id", F.coalesce("id", stand_in)), f"{work}/classes")
    shared = classes.groupBy("id").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("id")  # a vec_id that stands for several vectors
    if not shared.isEmpty():
        odd = classes.join(shared, "id", "left_semi").withColumn("id", stand_in).select(*classes.columns)
        classes = settle(classes.join(shared, "id", "left_anti").unionByName(odd), f"{work}/classes2")
    size = classes.count()
    most = max(1, min(MOST_PIVOTS, -(-size // block)))
    taken = classes.orderBy(F.xxhash64("key"), "key").select("v").limit(SAMPLE * most).collect()
    by_dim: dict[int, np.ndarray] = {}
    for dim in {len(r["v"]) for r in taken}:
        sample = _unit(np.array([r["v"] for r in taken if len(r["v"]) == dim], np.float64))
        by_dim[dim] = pivots(sample, most)
    centres = spark.sparkContext.broadcast(by_dim)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths):
                part = batch.filter(pa.array(lengths == dim))
                x = _unit(_matrix(part.column(2)))
                p = centres.value.get(int(dim), x[:1] * 0)
                dots = x @ p.T
                cell = dots.argmax(1)
                far = np.sqrt(np.maximum(0, 2 - 2 * dots.max(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array([int(dim)] * len(x), pa.int32()), pa.array(cell, pa.int32()), pa.array(far, pa.float64())], ["id", "n", "v", "dim", "cell", "far"])

    dealt = settle(classes.select("id", "n", "v").mapInArrow(deal, "id bigint, n bigint, v array<double>, dim int, cell int, far double"), f"{work}/dealt")
    cells = settle(dealt.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("m"), F.max("far").alias("far")).withColumn("chunks", F.ceil(F.col("m") / block).cast("int")), f"{work}/cells")
    radii: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {r["dim"] for r in cells.select("dim").distinct().collect()}:
        own = sorted((r["cell"], r["far"]) for r in cells.where(F.col("dim") == dim).select("cell", "far").collect())
        radii[dim] = np.array([c for c, _ in own]), np.array([f for _, f in own])
    reach = spark.sparkContext.broadcast(radii)
    far = float(np.sqrt(2 - 2 * cosine))

    def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each cell the cells from itself on that are near enough to hold links with it."""
        for batch in batches:
            for dim, cell, own in zip(*(c.to_pylist() for c in batch.columns)):
                other, radius = reach.value[dim]
                at = other >= cell
                if dim in centres.value:
                    p = centres.value[dim]
                    at &= np.sqrt(np.maximum(0, 2 - 2 * (p[other] @ p[cell]))) <= own + radius + far + SLACK
                found = other[at]
                yield pa.RecordBatch.from_arrays([pa.array([dim] * len(found), pa.int32()), pa.array([cell] * len(found), pa.int32()), pa.array(found, pa.int32())], ["dim", "left", "right"])

    near = cells.select("dim", "cell", "far").repartition(max(1, spark.sparkContext.defaultParallelism)).mapInArrow(meetings, "dim int, left int, right int")
    name = lambda cell, chunk: F.concat_ws("-", "dim", cell, chunk)
    chunks = cells.select("dim", "cell", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    left = chunks.select("dim", F.col("cell").alias("left"), F.col("chunk").alias("x"))
    right = chunks.select("dim", F.col("cell").alias("right"), F.col("chunk").alias("y"))
    pairs = near.join(left, ["dim", "left"]).join(right, ["dim", "right"]).where("left < right OR x <= y").select(name("left", "x").alias("a"), name("right", "y").alias("b"))
    placed = dealt.join(F.broadcast(cells.select("dim", "cell", "chunks")), ["dim", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))

    def plant(pdf: pd.DataFrame) -> pd.DataFrame:
        v = np.array(pdf["v"].tolist(), np.float64)
        tree = Tree(_unit(v))
        out = io.BytesIO()
        nodes = tree.nodes
        # The vectors as they came, as floats where that loses nothing: half the bytes, and unit vectors are made again alike.
        low = v.astype(np.float32)
        np.savez(out, v=(low if (low == v).all() else v)[tree.order], id=pdf["id"].to_numpy()[tree.order], n=pdf["n"].to_numpy()[tree.order], span=np.array([t[:3] for t in nodes]), radius=np.array([t[3] for t in nodes]), child=np.array([c for t in nodes for c in t[4]], np.int64), many=np.array([len(t[4]) for t in nodes]))
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "tree": [out.getvalue()]})

    trees = settle(placed.select("id", "n", "v", name("cell", "chunk").alias("block")).groupBy("block").applyInPandas(plant, "block string, tree binary"), f"{work}/trees")
    sides = F.filter(F.array(F.struct(F.col("a").alias("block"), F.lit(0).alias("side")), F.when(F.col("a") != F.col("b"), F.struct(F.col("b").alias("block"), F.lit(1).alias("side")))), lambda x: x.isNotNull())
    wanted = pairs.select(F.concat_ws("/", "a", "b").alias("pair"), F.inline(sides))

    def load(data: bytes) -> tuple[Tree, np.ndarray, np.ndarray]:
        z = np.load(io.BytesIO(data))
        tree = Tree.__new__(Tree)
        tree.x = _unit(z["v"].astype(np.float64))
        tree.low = tree.x.astype(np.float32)
        ends = np.cumsum(z["many"])
        child = z["child"].tolist()
        tree.nodes = [(*span, float(r), child[e - m : e]) for span, r, e, m in zip(z["span"].tolist(), z["radius"], ends.tolist(), z["many"].tolist())]
        return tree, z["id"], z["n"]

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = [load(t) for t in pdf.sort_values("side")["tree"]]
        (left, ids, n), (right, ids2, n2) = sides[0], sides[-1]
        found = Join(left, right, (n, n2), cosine)
        every = ids if found.same else np.concatenate([ids, ids2])
        links = found.links[0] if found.same else np.concatenate(found.links)
        # The root of a component in this pair is named by its least id.
        low = np.full(len(every), np.iinfo(np.int64).max)
        np.minimum.at(low, found.label, every)
        has = links > 0
        return pd.DataFrame({"id": every[has], "links": links[has], "root": low[found.label][has]})

    met = settle(trees.join(wanted, "block").select("pair", "side", "tree").groupBy("pair").applyInPandas(meet, "id bigint, links bigint, root bigint"), f"{work}/met")
    total = met.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(met.select(F.col("id").alias("a"), F.col("root").alias("b")), f"{work}/cc")
    named = classes.join(total, "id", "left").join(groups, "id", "left").select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = keyed.drop("v").where("key IS NOT NULL").join(named, "key").select("vec_id", "n_links", "component_id")
    alone = keyed.where("key IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return out.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark, table(spark, sf_dir, "embeddings"))
