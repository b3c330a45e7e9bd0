"""Which reader takes a document, and what becomes of what the readers give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Files above this go to the vision reader at once.
LARGEST = 50 * 1024 * 1024
KNOWN = ("text_document", "photograph", "mixed")


def route(doc_type: Column, order: str = "text_first") -> Column:
    """The track of a document: text, photograph or mixed.

    ``text_first`` and ``legacy`` know three types: another is an error in the one and null, left out without
    a trace, in the other. ``vision_first`` reads every other type as text.
    """
    track = F.when(doc_type == "text_document", "text").when(doc_type.isin("photograph", "mixed"), doc_type)
    return F.coalesce(track, F.lit("text")) if order == "vision_first" else track


def reader(track: Column, size: Column, order: str = "text_first") -> Column:
    """The reader that is tried first: the text reader for texts and mixed ones of at most LARGEST bytes, else the vision reader."""
    if order == "vision_first":
        return F.when(track.isNotNull(), "vision")
    return F.when((track != "photograph") & (size <= LARGEST), "text").when(track.isNotNull(), "vision")


def routed(docs: DataFrame, order: str = "text_first") -> DataFrame:
    """doc_id, track, reader, error of documents (doc_id, doc_type, size); the legacy order drops unknown types."""
    known = route(F.col("doc_type"), order)
    out = docs.select("doc_id", "doc_type", known.alias("track"), F.coalesce("size", F.lit(0)).alias("size"))
    out = out.where(F.col("track").isNotNull()) if order == "legacy" else out
    error = F.when(F.col("track").isNull(), F.concat(F.lit("Unknown document type: "), F.coalesce("doc_type", F.lit("None"))))
    return out.select("doc_id", "track", reader(F.col("track"), F.col("size"), order).alias("reader"), error.alias("error"))


def results(read: DataFrame, order: str = "text_first") -> DataFrame:
    """doc_id, track, engine, text, confidence of what the readers gave: (doc_id, track, size, marked, seen, analysis).

    ``marked`` is the text reader's text, ``seen`` what the vision reader read, ``analysis`` what it says of the
    image; each is null where it wasn't asked or failed.
    """
    track, marked, seen, analysis = (F.col(c) for c in ("track", "marked", "seen", "analysis"))
    if order == "vision_first":
        text = F.when(track == "photograph", analysis).when(track == "mixed", T.mixed_text(F.col("doc_id").cast("string"), analysis)).otherwise(T.longer_text(seen, marked))
        engine = F.when((track == "text") & ~text.eqNullSafe(seen), "marker").otherwise("vision")
        return read.select("doc_id", "track", engine.alias("engine"), text.alias("text"), F.when(F.length(T.strip(F.coalesce(text, F.lit("")))) > 50, 0.9).otherwise(0.7).alias("confidence"))
    sure = T.marker_confidence(marked)
    taken = (F.col("size") <= LARGEST) & T.accepted(marked, sure)
    plain, trust = F.when(taken, marked).otherwise(seen), F.when(taken, sure).otherwise(T.vision_confidence(seen, track))
    text = F.when(track == "photograph", analysis).when(track == "mixed", T.mixed_text(plain, analysis)).otherwise(plain)
    engine = F.when((track != "photograph") & taken, "marker").otherwise("vision")
    return read.select("doc_id", "track", engine.alias("engine"), text.alias("text"), F.when(track == "photograph", 0.85).otherwise(trust).alias("confidence"))


def block_prompts(docs: DataFrame, instructions: dict[str, str], template: str = "%s\n\n%s") -> DataFrame:
    """doc_id, place, kind, prompt of the blocks of documents (doc_id, blocks: list of structs block_type, text), in order."""
    b = docs.select("doc_id", F.posexplode("blocks").alias("place", "b"))
    kind = F.col("b.block_type")
    return b.select("doc_id", "place", T.block_kind(kind).alias("kind"), T.block_prompt(F.col("b.text"), kind, instructions, template).alias("prompt"))


def triage_manifest(manifest: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(routes, summary) of manifest entries (doc_id, path) and of the files that exist (path, text, has_fonts).

    ``routes`` has doc_id, path, triage and route (text or image); entries without a path or whose file isn't
    there are skipped and only counted. ``summary``: total, text, image, skipped.
    """
    found = manifest.where("path IS NOT NULL").join(files.select("path", T.triage(F.col("text"), F.coalesce("has_fonts", F.lit(False))).alias("triage")), "path")
    routes = found.select("doc_id", "path", "triage", F.when(F.col("triage") == "image", "image").otherwise("text").alias("route"))
    counts = routes.agg(F.count_if(F.col("route") == "text").alias("text"), F.count_if(F.col("route") == "image").alias("image"))
    total = manifest.agg(F.count(F.lit(1)).alias("total"))
    return routes, total.crossJoin(F.broadcast(counts)).select("total", "text", "image", (F.col("total") - F.col("text") - F.col("image")).alias("skipped"))  # one row each


def dark_boxes(mask, bands: bool = False, least: int = 100) -> list[tuple[int, int, int, int, int, float]]:
    """(x0, y0, x1, y1, area, confidence) of blacked-out regions of a page, given which pixels are dark.

    Connected regions (four neighbours) of ``least`` pixels whose width is a tenth to ten times their height;
    with ``bands``, instead, stripes of ten rows or more that are dark nearly all across.
    """
    import numpy as np

    mask = np.asarray(mask, bool)
    height, width = mask.shape
    out = []
    if bands:
        share = lambda y: mask[y : y + 10].sum() / (10 * width)
        for start in range(0, height - 10, 5):
            if share(start) <= 0.95:
                continue
            end = start
            while end < height - 10 and share(end) > 0.9:
                end += 5
            across = np.flatnonzero(mask[start:end].sum(0) > (end - start) * 0.9)
            x0, x1 = (int(across[0]), int(across[-1])) if len(across) else (0, width)
            if (area := (x1 - x0) * (end - start)) >= least:
                out.append((x0, start, x1, end, area, 0.7))
        return out
    # Runs of dark pixels in each row, joined with the runs they touch in the row above.
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    (row, first), last = np.nonzero(edge == 1), np.nonzero(edge == -1)[1]
    parent = np.arange(len(row))

    def find(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    begins = np.searchsorted(row, np.arange(height + 1))
    for y in range(1, height):
        above, here = begins[y - 1], begins[y]
        while above < begins[y] and here < begins[y + 1]:
            if first[above] < last[here] and first[here] < last[above]:
                parent[find(here)] = find(above)
            if last[above] <= last[here]:
                above += 1
            else:
                here += 1
    root = np.array([find(k) for k in range(len(row))], np.int64)
    for r in np.unique(root):
        own = root == r
        area = int((last[own] - first[own]).sum())
        x0, x1, y0, y1 = int(first[own].min()), int(last[own].max()), int(row[own].min()), int(row[own].max()) + 1
        if area >= least and 0.1 <= (x1 - x0) / (y1 - y0) <= 10:
            out.append((x0, y0, x1, y1, area, 0.85))
    return out


def redactions(pages: DataFrame, dark: int = 50, bands: bool = False, least: int = 100) -> DataFrame:
    """doc_id, page, x0, y0, x1, y1, area, confidence of pages (doc_id, page, width, pixels: grey values row by row).

    Pixels below ``dark`` are dark. A page whose pixels don't fill its width, or without any, has no region.
    """

    def find(frames):
        import numpy as np
        import pandas as pd

        for pdf in frames:
            rows = []
            for doc, page, width, pixels in zip(pdf["doc_id"], pdf["page"], pdf["width"], pdf["pixels"]):
                if pixels is not None and width and len(pixels) and len(pixels) % int(width) == 0:
                    grey = np.asarray(pixels, float).reshape(-1, int(width))
                    rows += [(doc, page, *box) for box in dark_boxes(grey < dark, bands, least)]
            yield pd.DataFrame(rows, columns=["doc_id", "page", "x0", "y0", "x1", "y1", "area", "confidence"])

    kind = pages.schema["doc_id"].dataType.simpleString()
    return pages.select("doc_id", F.col("page").cast("int").alias("page"), F.col("width").cast("int").alias("width"), "pixels").mapInPandas(find, f"doc_id {kind}, page int, x0 int, y0 int, x1 int, y1 int, area int, confidence double")
