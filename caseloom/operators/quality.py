"""Quality reports and repair of repeated lines and sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def quality_report(docs: DataFrame, min_length: int = 20, max_repetition: float = 0.5, min_unique: float = 0.3) -> DataFrame:
    """One row per document: measures, issues, score and verdict."""
    t = F.coalesce(F.col("text"), F.lit(""))
    rep, uniq = F.col("repetition_ratio"), F.col("unique_word_ratio")
    # Windows and words are columns of their own, so that each is made once and read often.
    d = docs.select("doc_id", t.alias("text")).withColumn("windows", T.sampled_windows(F.col("text"))).withColumn("words", T.words(F.col("text")))
    d = d.select("doc_id", "text", T.repeated_share(F.col("windows")).alias("repetition_ratio"), T.distinct_share(F.col("words")).alias("unique_word_ratio"))
    checks = [
        F.when(F.length(T.strip(F.col("text"))) < min_length, "too_short"),
        F.when(rep > max_repetition, "repetition"),
        F.when((uniq > 0) & (uniq < min_unique), "low_diversity"),
        F.when(T.number_sequence(F.col("text")), "number_sequence"),
    ]
    checks += [F.when(T.occurrences(F.col("text"), p) > 3, f"loop_phrase_{k}") for k, p in enumerate(T.LOOP_PHRASES)]
    d = d.withColumn("issues", F.array_compact(F.array(*checks)))
    n = F.size("issues")
    return d.select(
        "doc_id",
        (n == 0).alias("is_valid"),
        F.round(F.greatest(F.lit(0.0), 1.0 - 0.2 * n), 6).alias("confidence_score"),
        F.array_join("issues", ",").alias("issues"),
        F.length("text").cast("long").alias("text_length"),
        F.round(uniq, 6).alias("unique_word_ratio"),
        F.round(rep, 6).alias("repetition_ratio"),
    )


def quality_summary(report: DataFrame) -> DataFrame:
    ok = F.count_if("is_valid")
    return report.agg(F.count(F.lit(1)).alias("total"), ok.alias("valid"), F.count_if(~F.col("is_valid")).alias("invalid"), F.round(ok / F.count(F.lit(1)), 6).alias("success_rate"))


def _let(value, use):
    """``use`` of a value that is made once: the one element of a list."""
    return F.transform(F.array(value), use)[0]


def _capped(lines, most: int, free, joiner: str):
    """(text, removed): of equal stripped strings the first ``most`` stay, those that ``free`` accepts always.

    Strings are sorted by key and place, so one is too many where the one ``most`` places before it has its
    key: no counting, no grouping, a sort inside the row.
    """
    listed = F.array_sort(F.transform(lines, lambda x, i: F.struct(T.strip(x).alias("key"), i.alias("pos"), x.alias("line"))))
    fits = lambda s: F.filter(s, lambda x, i: free(x["key"]) | (i < most) | (F.get(s, i - most)["key"] != x["key"]))
    order = lambda s: F.array_join(F.transform(F.array_sort(F.transform(s, lambda x: F.struct(x["pos"], x["line"]))), lambda x: x["line"]), joiner)
    return _let(listed, lambda s: _let(fits(s), lambda k: F.struct(order(k).alias("text"), (F.size(s) - F.size(k)).cast("long").alias("removed"))))


def cap_lines(docs: DataFrame, most: int = 3, shortest: int = 20) -> DataFrame:
    """doc_id, text, removed for each row: of each line of ``shortest`` characters or more the first ``most`` stay, in order.

    A null text stays null; rows with equal doc_ids stay apart. Nothing is shuffled.
    """
    capped = _capped(F.split("text", "\n"), most, lambda key: F.length(key) < shortest, "\n")
    return docs.select("doc_id", "text", F.when(F.col("text").isNotNull(), capped).alias("c")).select("doc_id", F.col("c.text").alias("text"), F.coalesce("c.removed", F.lit(0)).alias("removed"))


def cap_sentences(docs: DataFrame, most: int = 3, longest: int = 500, least: int = 6, shortest: int = 20) -> DataFrame:
    """doc_id, text, removed: inside lines of ``longest`` characters or more, repeated sentences are capped likewise.

    Only a line of ``least`` sentences or more that loses one is joined anew, by single spaces; others stay
    as they are. A null text stays null; rows with equal doc_ids stay apart. Nothing is shuffled.
    """
    same = lambda line: F.struct(line.alias("text"), F.lit(0).cast("long").alias("removed"))

    def long(line):
        whole = lambda parts: _let(_capped(parts, most, lambda key: F.length(key) <= shortest, " "), lambda c: F.when(c["removed"] > 0, c).otherwise(same(line)))
        return _let(F.split(line, r"(?<=[.!?])\s+"), lambda parts: F.when(F.size(parts) >= least, whole(parts)).otherwise(same(line)))

    lines = F.transform(F.split("text", "\n"), lambda line: F.when(F.length(line) >= longest, long(line)).otherwise(same(line)))
    done = docs.select("doc_id", lines.alias("lines"))
    removed = F.aggregate("lines", F.lit(0).cast("long"), lambda s, x: s + x["removed"])
    return done.select("doc_id", F.array_join(F.transform("lines", lambda x: x["text"]), "\n").alias("text"), F.coalesce(removed, F.lit(0)).alias("removed"))


def repaired(docs: DataFrame, most: int = 3) -> DataFrame:
    """doc_id, text, removed after both passes: lines first, then the sentences of long lines."""
    first = cap_lines(docs, most)
    keyed = first.select(F.struct("doc_id", "removed").alias("doc_id"), "text")
    both = cap_sentences(keyed, most)
    return both.select("doc_id.doc_id", "text", (F.col("removed") + F.col("doc_id.removed")).alias("removed"))
