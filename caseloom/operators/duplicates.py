"""Similar documents: candidate pairs, greedy groups, and reconciliation of marked regions."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

def fingerprints(docs: DataFrame, bits: Column | None = None) -> DataFrame:
    """doc_id, size, page_count, file_hash, text_hash, phash of documents (doc_id, size, page_count, content, text).

    ``bits`` is the perceptual hash where there are images; blank texts have no text_hash, absent images an
    empty phash. A page count that is null or below 1 counts as 1.
    """
    phash = F.lit("") if bits is None else F.coalesce(bits, F.lit(""))
    pages = F.greatest(F.coalesce("page_count", F.lit(1)), F.lit(1))
    return docs.select("doc_id", "size", pages.cast("long").alias("page_count"), F.sha2(F.col("content").cast("binary"), 256).alias("file_hash"), T.text_fingerprint(F.col("text")).alias("text_hash"), phash.alias("phash"))


def similar_pairs(prints: DataFrame, ratio: float = 0.9, block: tuple[str, ...] = ("page_count",), by_size: bool = True) -> DataFrame:
    """(a, b) of documents equal in ``block`` with equal text_hash, or sizes within ``ratio`` of each other.

    Two equi-joins instead of one with OR: by hash, and by bands of the size's logarithm one ratio wide,
    of which each document looks into its own and the next. Lists pairs: for small tables; ``similar_counts``
    and ``similar_groups`` do without.
    """
    cols = ["doc_id", "size", "text_hash", *block]
    a, b = prints.select(*[F.col(c).alias(f"a_{c}") for c in cols]), prints.select(*[F.col(c).alias(f"b_{c}") for c in cols])
    same = [F.col(f"a_{c}") == F.col(f"b_{c}") for c in block]
    on = lambda extra: reduce(lambda x, y: x & y, [*same, *extra])
    order = F.col("a_doc_id") < F.col("b_doc_id")
    out = a.join(b, on([F.col("a_text_hash") == F.col("b_text_hash"), order]))
    if by_size:
        left = a.where("a_size > 0").withColumn("a_band", F.explode(_around(F.col("a_size"), ratio)))
        right = b.where("b_size > 0").withColumn("b_band", _band(F.col("b_size"), ratio))
        near = F.least("a_size", "b_size") / F.greatest("a_size", "b_size") > ratio
        out = out.unionByName(left.join(right, on([F.col("a_band") == F.col("b_band"), order, near])).drop("a_band", "b_band"))
    return out.select(F.col("a_doc_id").alias("a"), F.col("b_doc_id").alias("b"), *[F.col(f"a_{c}").alias(c) for c in block]).distinct()


def _band(size: Column, ratio: float) -> Column:
    return F.floor(F.log(size) / math.log(1 / ratio)).cast("int")


def _around(size: Column, ratio: float) -> Column:
    band = _band(size, ratio)
    return F.array(band - 1, band, band + 1)


def similar_counts(prints: DataFrame, ratio: float = 0.9) -> DataFrame:
    """doc_id, class_id, n_links of each document: how many others the whole rule links it with.

    The rule: equal page_count, and equal file_hash, equal non-empty text_hash, or sizes within ``ratio``.
    Documents with equal page_count, size, text_hash and file_hash are a class, named by its least doc_id.
    Links are counted between sums: of sizes, and of the sizes a hash has, so pairs of documents are never
    listed; what a hash links that its size doesn't already is added. A document without a page count links
    with nothing; null hashes and sizes that are null or below 1 link nothing.
    """
    keys = ["page_count", "_size", "_text", "_file"]
    docs = prints.select("doc_id", "page_count", F.greatest(F.coalesce("size", F.lit(0)), F.lit(0)).cast("long").alias("_size"), F.nullif("text_hash", F.lit("")).alias("_text"), F.nullif("file_hash", F.lit("")).alias("_file"))
    same = lambda a, b: F.col(f"{a}").eqNullSafe(F.col(f"{b}"))
    classes = docs.groupBy(*keys).agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n"))
    sizes = classes.where("_size > 0 AND page_count IS NOT NULL").groupBy("page_count", "_size").agg(F.sum("n").alias("n"))
    other = sizes.select(F.col("page_count").alias("_p"), F.col("_size").alias("_s"), F.col("n").alias("_n"), F.explode(_around(F.col("_size"), ratio)).alias("_b"))
    near = F.least("_size", "_s") / F.greatest("_size", "_s") > ratio
    by_size = sizes.withColumn("_band", _band(F.col("_size"), ratio)).join(other, (F.col("page_count") == F.col("_p")) & (F.col("_band") == F.col("_b")) & near)
    by_size = by_size.groupBy(F.col("page_count").alias("_p"), F.col("_size").alias("_s")).agg(F.sum("_n").alias("sized"))
    # Classes that share a hash but not a near size: met through the hash, each other class once.
    listed = classes.where("page_count IS NOT NULL").select(*keys, "class_id", "n")
    hashed = listed.select("page_count", "_size", "class_id", "n", F.explode(F.array_compact(F.array(F.concat(F.lit("t"), "_text"), F.concat(F.lit("f"), "_file")))).alias("hash"))
    several = hashed.groupBy("page_count", "hash").agg(F.count_distinct("class_id").alias("m")).where("m > 1").drop("m")
    spread = hashed.join(several, ["page_count", "hash"])
    a = spread.select("page_count", "hash", "_size", "class_id")
    b = spread.select("page_count", "hash", F.col("_size").alias("_s"), F.col("class_id").alias("_c"), F.col("n").alias("_n"))
    apart = (F.col("_size") == 0) | (F.col("_s") == 0) | ~near
    met = a.join(b, ["page_count", "hash"]).where((F.col("class_id") != F.col("_c")) & apart).select("class_id", "_c", "_n").distinct()
    by_hash = met.groupBy("class_id").agg(F.sum("_n").alias("hashed"))
    own = F.when(F.col("page_count").isNull(), 0).when((F.col("_size") > 0) | F.col("_text").isNotNull() | F.col("_file").isNotNull(), F.col("n") - 1).otherwise(0)
    sized = F.when(F.col("sized").isNotNull(), F.col("sized") - 1).otherwise(own)
    counted = classes.join(by_size, (F.col("page_count") == F.col("_p")) & (F.col("_size") == F.col("_s")), "left").join(by_hash, "class_id", "left")
    counted = counted.select(*[F.col(k).alias(f"c_{k}") for k in keys], "class_id", (sized + F.coalesce("hashed", F.lit(0))).cast("long").alias("n_links"))
    on = reduce(lambda x, y: x & y, [same(k, f"c_{k}") for k in keys])
    return docs.join(counted, on).select("doc_id", "class_id", "n_links")


def look_alikes(prints: DataFrame, least: float = 0.9, length: int = 64, rows: int = 4096) -> DataFrame:
    """(a, b, similarity) of distinct perceptual hashes of one page count that agree in ``least`` of their bits.

    Exact, so every pair of one page count is compared, but as packed bits: blocks of ``rows`` hashes meet, each
    pair of blocks in one task's memory, and only pairs that agree leave it. Rows grow with hashes times
    blocks, not with pairs. Equal hashes are one row of ``phash``, joined back by it.
    """
    most = max((d for d in range(length + 1) if (length - d) / length >= least), default=-1)
    kinds = prints.where(F.length("phash") == length).select("page_count", "phash").distinct()
    blocks = kinds.groupBy("page_count").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("_n"))
    placed = kinds.join(blocks, "page_count").withColumn("_block", F.pmod(F.xxhash64("phash"), F.col("_n")).cast("int"))
    left = placed.select("page_count", "phash", F.col("_block").alias("_i"), F.explode(F.sequence("_block", F.col("_n") - 1)).alias("_j"))
    right = placed.select(F.col("page_count").alias("page_count"), F.col("phash").alias("phash"), F.explode(F.sequence(F.lit(0), "_block")).alias("_i"), F.col("_block").alias("_j"))

    def packed(hashes: list[str]) -> np.ndarray:
        """(bit, hash, word): the bits of characters that aren't the same everywhere, of 64 characters a word; 0 and 1 take one bit."""
        codes = np.frombuffer("".join(hashes).encode("utf-32-le"), np.uint32).reshape(-1, length)
        varied = int(np.bitwise_or.reduce(codes ^ codes[0, 0], axis=None))
        wide = np.zeros((len(codes), -(-length // 64) * 64), np.uint8)
        planes = []
        for k in [k for k in range(varied.bit_length()) if varied >> k & 1] or [0]:
            wide[:, :length] = codes >> k & 1
            planes.append(np.packbits(wide, axis=1).view(np.uint64))
        return np.stack(planes)

    def meet(x, y):
        import pyarrow as pa

        kind = (x if len(x) else y).schema.field("page_count").type
        out = {"page_count": [pa.array([], kind)], "x": [pa.array([], pa.string())], "y": [pa.array([], pa.string())], "similarity": [pa.array([], pa.float64())]}
        if len(x) and len(y):
            page, same = x["page_count"][0], x["_i"][0] == x["_j"][0]
            y = x if same else y  # rows of one block come in any order
            names = [pa.array(t["phash"].to_pylist(), pa.string()) for t in (x, y)]
            bits = packed([*names[0].to_pylist(), *names[1].to_pylist()])
            a, b = bits[:, : len(x)], bits[:, len(x) :]
            for k in range(0, len(x), 256):
                # A character differs where one of its bits does.
                unlike = reduce(np.bitwise_or, [p[k : k + 256, None] ^ q[None] for p, q in zip(a, b)])
                apart = np.bitwise_count(unlike).sum(2, dtype=np.int32)
                i, j = np.nonzero(apart <= most)
                keep = i + k < j if same else slice(None)
                i, j = i[keep], j[keep]
                share = (length - apart[i, j]) / length
                for name, column in zip(out, (pa.repeat(page, len(i)), names[0].take(pa.array(i + k)), names[1].take(pa.array(j)), pa.array(share, pa.float64()))):
                    out[name].append(column)
        return pa.table({name: pa.chunked_array(columns) for name, columns in out.items()})

    by = ["page_count", "_i", "_j"]
    met = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(meet, f"page_count {prints.schema['page_count'].dataType.simpleString()}, x string, y string, similarity double")
    return met.select("page_count", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "similarity")


def best_source(docs: DataFrame, regions: DataFrame) -> DataFrame:
    """group, page, doc_id, regions: for each page of a group's documents the one with the fewest regions there, of equals the first.

    ``docs`` has group, doc_id and page_count; documents without a region on a page have none there.
    """
    pages = docs.select("group", "doc_id", F.explode(F.sequence(F.lit(1), F.greatest(F.col("page_count"), F.lit(1)).cast("int"))).alias("page"))
    counts = regions.groupBy("group", "doc_id", F.col("page").cast("int").alias("page")).agg(F.count(F.lit(1)).alias("regions"))
    all_ = pages.join(counts, ["group", "doc_id", "page"], "left").withColumn("regions", F.coalesce("regions", F.lit(0)))
    return all_.groupBy("group", "page").agg(F.min(F.struct("regions", "doc_id")).alias("m")).select("group", "page", F.col("m.doc_id").alias("doc_id"), F.col("m.regions").alias("regions"))


def greedy_groups(prints: DataFrame, pairs: DataFrame, block: tuple[str, ...] = ("page_count",)) -> DataFrame:
    """(seed, doc_id): in order of doc_id, each document not yet taken takes the later ones similar to it.

    Not transitive, so not components. Blocks are independent; a block's pairs are needed together.
    """

    def take(pdf: pd.DataFrame) -> pd.DataFrame:
        near: dict[int, list[int]] = {}
        for a, b in zip(pdf["a"], pdf["b"]):
            near.setdefault(a, []).append(b)
        taken: set[int] = set()
        out = []
        for a in sorted(near):
            if a not in taken:
                group = [b for b in sorted(near[a]) if b not in taken]
                if group:
                    taken.update(group, [a])
                    out += [(a, x) for x in [a, *group]]
        return pd.DataFrame(out, columns=["seed", "doc_id"], dtype="int64")

    return pairs.groupBy(*block).applyInPandas(take, "seed bigint, doc_id bigint")


def similar_groups(prints: DataFrame, ratio: float = 0.9, block: tuple[str, ...] = ("page_count",)) -> DataFrame:
    """(seed, doc_id): what ``greedy_groups`` gives for ``similar_pairs``, without listing the pairs.

    Documents of one block with equal size and text_hash are similar to the same others, so classes of them
    are taken whole. A hash that has one size only says no more than the size. So a class is a size, or a
    size with a hash that has several; a block's classes, not its documents, are one task's group.
    """
    keys = [*block, "_size", "_hash"]
    known = prints.where(F.col("doc_id").isNotNull()).dropna(subset=list(block))
    docs = known.select("doc_id", *block, F.greatest(F.coalesce("size", F.lit(0)), F.lit(0)).cast("long").alias("_size"), F.coalesce("text_hash", F.lit("")).alias("_hash"))
    # Without a size there is the hash only, and without either nothing to compare.
    docs = docs.where("_size > 0 OR _hash != ''")
    kinds = docs.groupBy(*keys).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    spread = kinds.where("_hash != ''").groupBy(*block, "_hash").agg((F.count(F.lit(1)) > 1).alias("spread"))
    kinds = kinds.join(spread, [*block, "_hash"], "left")
    kinds = kinds.withColumn("link", F.when((F.col("_size") == 0) | F.col("spread"), F.col("_hash")).otherwise(""))
    classes = kinds.groupBy(*block, "_size", "link").agg(F.min("first").alias("first"), F.sum("n").alias("n"))

    def take(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("first", ignore_index=True)
        size, link, n = pdf["_size"].to_numpy("float64"), pdf["link"].to_numpy(), pdf["n"].to_numpy()
        linked: dict[str, list[int]] = {}
        for i, x in enumerate(link):
            if x:
                linked.setdefault(x, []).append(i)
        seed = np.full(len(pdf), -1)
        for i in range(len(pdf)):
            if seed[i] < 0:
                # A seed with a size clears its whole band, so few seeds scan the block's sizes.
                near = (np.minimum(size, size[i]) / np.maximum(size, size[i]) > ratio) & (seed < 0) if size[i] > 0 else np.zeros(len(pdf), bool)
                near[[k for k in linked.get(link[i], []) if seed[k] < 0]] = True
                near[i] = True
                seed[near] = i
        total = np.bincount(seed, n, len(pdf))
        pdf["seed"] = pdf["first"].to_numpy()[seed]
        return pdf[total[seed] > 1][[*block, "_size", "link", "seed"]]

    kind = prints.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([*(f"`{c}` {prints.schema[c].dataType.simpleString()}" for c in block), "_size bigint", "link string", f"seed {kind}"])
    seeds = classes.groupBy(*block).applyInPandas(take, schema)
    placed = kinds.select(*keys, "link").join(seeds, [*block, "_size", "link"]).select(*keys, "seed")
    return docs.join(placed, keys).select("seed", "doc_id")


def overlaps(a: tuple[Column, ...], b: tuple[Column, ...], threshold: float = 0.3) -> Column:
    """Boxes (x0, y0, x1, y1) that share more than the threshold of the smaller one; an empty box overlaps nothing."""
    w = F.greatest(F.lit(0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    least = F.least((a[2] - a[0]) * (a[3] - a[1]), (b[2] - b[0]) * (b[3] - b[1]))
    return (least > 0) & (w * h > threshold * least)


def fill_ins(base: DataFrame, other: DataFrame, protected: Column | None = None) -> DataFrame:
    """Regions of ``base`` with no overlapping one on the same page of ``other``; protected ones are never filled."""
    box = lambda t: tuple(F.col(f"{t}.{c}") for c in ("x0", "y0", "x1", "y1"))
    b = base.where(~protected) if protected is not None else base
    return b.alias("b").join(other.alias("o"), (F.col("b.group") == F.col("o.group")) & (F.col("b.page") == F.col("o.page")) & overlaps(box("b"), box("o")), "left_anti")


def base_document(regions: DataFrame) -> DataFrame:
    """Per group the document with the fewest regions; of equals the first."""
    n = regions.groupBy("group", "doc_id").agg(F.count(F.lit(1)).alias("regions"))
    return n.groupBy("group").agg(F.min(F.struct("regions", "doc_id")).alias("m")).select("group", F.col("m.doc_id").alias("doc_id"), F.col("m.regions").alias("regions"))


#: How a merged text introduces what other copies add.
BANNER = "\n\n" + "=" * 80 + "\nSUPPLEMENTAL CONTENT FROM OTHER COPIES\n" + "=" * 80 + "\nThe following content from other copies fills redactions in the base document.\n\n"


def merge_sections(docs: DataFrame, regions: DataFrame) -> DataFrame:
    """group, doc_id, is_base, fillins, text of each document of a group, for its merged text.

    ``docs`` has group, doc_id, text; ``regions`` has group, doc_id, page and a box. The base has the fewest
    regions, none included; of equals the least doc_id. ``fillins`` counts the base's regions without an
    overlapping one on the same page of the other document, found as all regions less the matched ones, so
    that base regions aren't multiplied by documents. Documents without text fill nothing.
    """
    box = lambda t: tuple(F.col(f"{t}.{c}") for c in ("x0", "y0", "x1", "y1"))
    counts = regions.groupBy("group", "doc_id").agg(F.count(F.lit(1)).alias("regions"))
    sized = docs.select("group", "doc_id", "text").join(counts, ["group", "doc_id"], "left").withColumn("regions", F.coalesce("regions", F.lit(0)))
    base = sized.groupBy("group").agg(F.min(F.struct("regions", "doc_id")).alias("m")).select("group", F.col("m.doc_id").alias("base_id"), F.col("m.regions").alias("base_regions"))
    placed = regions.join(base, "group")
    own, others = placed.where("doc_id = base_id").withColumn("region", F.struct("page", "x0", "y0", "x1", "y1")), placed.where("doc_id != base_id")
    # Equal regions of a base are matched alike: they are counted once here and weighed by their number.
    own = own.groupBy("group", "page", "x0", "y0", "x1", "y1", "region").agg(F.count(F.lit(1)).alias("times"))
    met = own.alias("b").join(others.alias("o"), (F.col("b.group") == F.col("o.group")) & (F.col("b.page") == F.col("o.page")) & overlaps(box("b"), box("o")))
    met = met.select("b.group", "o.doc_id", "b.region", "b.times").distinct().groupBy("group", "doc_id").agg(F.sum("times").alias("met"))
    found = sized.join(base, "group").join(met, ["group", "doc_id"], "left")
    is_base, text = F.col("doc_id") == F.col("base_id"), F.coalesce("text", F.lit(""))
    fillins = F.when(is_base | (text == ""), 0).otherwise(F.col("base_regions") - F.coalesce("met", F.lit(0))).cast("long")
    return found.select("group", "doc_id", is_base.alias("is_base"), fillins.alias("fillins"), text.alias("text"))


def merged_texts(sections: DataFrame, name: str = "doc_id") -> DataFrame:
    """group, base_id, merged_text, total_fillins: the base's text, then each copy's whole text that fills something, by doc_id.

    A merged text is one value, so it has a value's bound of 2 GB; for larger groups use the sections themselves.
    """
    head = F.format_string("\n--- From %s (%d fillins) ---\n\n", F.col(name).cast("string"), F.col("fillins"))
    added = F.when(F.col("fillins") > 0, F.struct("doc_id", F.concat(head, "text").alias("part")))
    parts = F.transform(F.array_sort(F.collect_list(added)), lambda x: x["part"])
    g = sections.groupBy("group").agg(F.max(F.when(F.col("is_base"), F.struct("doc_id", "text"))).alias("b"), parts.alias("parts"), F.sum("fillins").alias("total_fillins"))
    rest = F.when(F.size("parts") > 0, F.concat(F.lit(BANNER), F.array_join("parts", ""))).otherwise("")
    return g.select("group", F.col("b.doc_id").alias("base_id"), F.concat("b.text", rest).alias("merged_text"), "total_fillins")


def merge_all(docs: DataFrame, regions: DataFrame) -> DataFrame:
    """The merged text of every group."""
    return merged_texts(merge_sections(docs, regions))
