"""Mixing sources to target weights by Pareto order sampling.

Method. Within a source a document's expected copies grow with its size to the power POWER: e = level *
size**POWER, MOST at most, the level being such that expected words add up to the source's target. (Sizes
are taken in steps of a quarter octave, so a level is found exactly from a few sums.) The whole part of e
is certain: so many copies are allocated. The fraction is the inclusion probability pi of one more.
Documents are ranked by their random odds over their inclusion odds, [u/(1-u)] / [pi/(1-pi)] with u
uniform, and of each stratum, a source's documents of one octave of sizes, a fixed number with the least
ranks is taken. The numbers are set before any document is drawn: from the largest octave to the least,
each is the sum of its pi, scaled so that what larger octaves' rounding left over is shared by all that
remain in proportion to their expected words, and rounded up or down at random. Closing rule: then one
document of the source is added, or one of the extra copies left out, that whose size is nearest to what
is missing or too much, if that brings the words nearer to the target. It is the only departure from the
design's fixed numbers.

Scale. No source is sorted as a whole: ranks are dealt over about sqrt(rows) buckets of y = q/(1+q), the
documents of each bucket are counted, and only the one bucket of a stratum in which its number is reached
is ordered row by row. u is a hash of seed, doc_id and text, and rows are numbered once, in a written
table, so reruns and retried tasks agree. Sources are numbered by key ranges and their level is found by
repeated sums, so a table with many sources isn't sorted in one task either.

Defined results: null text has size 0; null source is a source, ordered last; rows of size 0 take
nothing; texts of any length are counted whole; equal rows share u, tie and are taken in the order of
their numbers; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import settle, shared_dir

WORD = r"[^\x20\x09-\x0D]+"
#: Expected copies within a source grow with the size to this power.
POWER = 0.25
#: Steps of size in an octave.
STEPS = 4
#: A table of sources no longer than this is broadcast; a longer one is joined by shuffle.
BROADCAST_SOURCES = 100_000


def uniform(*of: Column | str) -> Column:
    """A number between 0 and 1, both excluded, by hash."""
    return (F.shiftrightunsigned(F.xxhash64(*of), 11).cast("double") + 0.5) / float(1 << 53)


def targets(spark: SparkSession, sizes: DataFrame, work: str, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0, ranges: int = 1) -> DataFrame:
    """source, source_size, target from (source, source_size): weights go round by code point, null last.

    Each target is the lesser of ``most`` times the source's size and a level times its weight, the level
    being such that all add up to ``share`` of everything. The level only rises while sources reach their
    limit, so it is found by repeated sums over the table, a handful of them. Sources are numbered in
    ``ranges`` ranges of keys.
    """
    order = [F.col("source").isNull(), F.col("source")]
    placed = settle(sizes.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), f"{work}/ranges")
    counts = sorted((r["p"], r["count"], r["words"]) for r in placed.groupBy(F.shiftright("_id", 33).alias("p")).agg(F.count(F.lit(1)).alias("count"), F.sum("source_size").alias("words")).collect())
    before = spark.createDataFrame([(p, sum(n for _, n, _ in counts[:k])) for k, (p, _, _) in enumerate(counts)], "_p bigint, _before bigint")
    t = placed.join(F.broadcast(before), F.shiftright("_id", 33) == F.col("_p"))
    rank = F.col("_before") + F.col("_id").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    t = t.select("source", "source_size", weight.alias("_w"), (F.lit(float(most)) * F.col("source_size")).alias("_cap"))
    total = sum(words for _, _, words in counts) * share
    level, capped, rest = 0.0, -1, 0.0
    while True:
        over = F.col("_cap") < level * F.col("_w")
        n, limit, rest = t.agg(F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, F.col("_cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("_w"))), F.lit(0.0))).first()
        if n == capped or not rest:
            break
        level, capped = max(level, (total - limit) / rest), n
    return t.select("source", "source_size", F.least("_cap", F.lit(level) * F.col("_w") if rest else F.col("_cap")).alias("target"))


def expected(sizes: DataFrame, goal: DataFrame, power: float, most: float) -> DataFrame:
    """source, step, stratum, whole, pi and the source's sums for each step of sizes: at most 160 steps a source, whatever its size."""
    measure = F.pow(F.lit(2.0), F.col("step") * (power / STEPS))
    s = sizes.join(goal.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).withColumn("m", measure)
    above = W.partitionBy("_source").orderBy(F.desc("m")).rowsBetween(W.unboundedPreceding, -1)
    from_here = W.partitionBy("_source").orderBy(F.desc("m")).rowsBetween(0, W.unboundedFollowing)
    # Were all steps of larger measure at the limit, this would be the level of the rest; the first that stays below holds.
    level = F.try_divide(F.col("target") - most * F.coalesce(F.sum("words").over(above), F.lit(0)), F.sum(F.col("m") * F.col("words")).over(from_here))
    s = s.withColumn("level", level).withColumn("level", F.max(F.when((F.col("words") > 0) & (F.col("level") * F.col("m") <= most), F.struct("m", "level"))).over(W.partitionBy("_source"))["level"])
    e = F.greatest(F.lit(0.0), F.least(F.lit(float(most)), F.coalesce(F.col("level") * F.col("m"), F.lit(float(most)))))
    whole = F.floor(e + 1e-9)
    stratum = F.floor(F.col("step") / STEPS).cast("int")
    return s.select("source", "step", stratum.alias("stratum"), "n", "words", "source_size", "target", whole.cast("long").alias("whole"), F.when(e - whole > 1e-9, F.least(e - whole, F.lit(1 - 1e-9))).otherwise(0.0).alias("pi"))


def numbers(steps: DataFrame, seed: int) -> DataFrame:
    """source, stratum, take: how many documents of each octave are drawn, what rounding leaves being carried from large to small."""
    strata = steps.where("pi > 0 AND words > 0").groupBy("source", "stratum").agg(F.sum(F.col("words") * F.col("pi")).alias("e"), F.sum(F.col("n") * F.col("pi")).alias("p"), F.sum("n").alias("n"))
    below = W.partitionBy("source").orderBy("stratum").rowsBetween(W.unboundedPreceding, 0)
    strata = strata.withColumn("rest", F.sum("e").over(below))
    listed = strata.groupBy("source").agg(F.array_sort(F.collect_list(F.struct((-F.col("stratum")).alias("o"), "e", "p", "rest", F.col("n").cast("double").alias("n"), uniform(F.lit(seed), "source", "stratum").alias("r")))).alias("strata"))
    take = "greatest(0D, least(x.n, floor(x.p * (1 + a.carry / x.rest) + x.r)))"
    drawn = f"aggregate(strata, named_struct('carry', 0D, 'out', cast(array() as array<struct<stratum:int,take:bigint>>)), (a, x) -> named_struct('carry', a.carry + x.e - {take} * x.e / x.p, 'out', concat(a.out, array(named_struct('stratum', -x.o, 'take', cast({take} as bigint))))), a -> a.out)"
    return listed.select("source", F.inline(F.expr(drawn)))


def mix(spark: SparkSession, docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 8, work: str | None = None, carry: list[str] | None = None, power: float = POWER, closing: bool = True) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of each row of ``docs``, with the columns in ``carry`` as _c_<name>.

    Without ``closing`` the numbers of the design stay fixed, and words are as near to the target as these are.
    """
    work = work or shared_dir(spark)
    carry = carry or []
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    step = F.floor(F.log2(F.greatest("size", F.lit(1)).cast("double")) * STEPS + 1e-9).cast("int")
    rows = docs.select("doc_id", "source", size.alias("size"), uniform(F.lit(seed), "doc_id", "text").alias("u"), F.monotonically_increasing_id().alias("rid"), *[F.col(c).alias(f"_c_{c}") for c in carry])
    rows = settle(rows.withColumn("step", step), f"{work}/rows")
    sizes = settle(rows.groupBy("source", "step").agg(F.sum("size").alias("words"), F.count(F.when(F.col("size") > 0, 1)).alias("n")), f"{work}/sizes")
    sources, total = sizes.agg(F.count_distinct(F.coalesce("source", F.lit(""))), F.coalesce(F.sum("n"), F.lit(0))).first()
    small = F.broadcast if sources <= BROADCAST_SOURCES else (lambda x: x)
    goal = targets(spark, sizes.groupBy("source").agg(F.sum("words").alias("source_size")), work, weights, share, most, ranges=1 + sources // BROADCAST_SOURCES)
    steps = settle(expected(sizes, goal, power, most), f"{work}/steps")
    # One table of all that a row takes from its source and step; at most 160 rows a source.
    on = lambda *keys: [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    under = lambda df, *keys: df.withColumnsRenamed({k: f"_{k}" for k in keys})
    plan = steps.join(under(numbers(steps, seed), "source", "stratum"), on("source", "stratum"), "left")
    plan = settle(plan.select(F.col("source").alias("_source"), F.col("step").alias("_step"), "stratum", "source_size", "target", "whole", "pi", "take"), f"{work}/plan")
    rows = rows.join(small(plan), on("source", "step")).drop("_source", "_step")
    may = (F.col("pi") > 0) & (F.col("size") > 0)
    q = F.try_divide((F.col("u") / (1 - F.col("u"))) * (1 - F.col("pi")), F.col("pi"))
    buckets = 1 << max(4, math.isqrt(total).bit_length())
    rows = rows.withColumn("y", F.when(may, q / (1 + q))).withColumn("bucket", F.least(F.floor(F.col("y") * buckets), F.lit(buckets - 1)).cast("int"))
    # The bucket of a stratum in which its number is passed: those before it are taken whole, and in it rows are ranked.
    sums = rows.where(may).groupBy("source", "stratum", "bucket").agg(F.count(F.lit(1)).alias("n"), F.max("take").alias("take"))
    upto = F.sum("n").over(W.partitionBy("source", "stratum").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
    cut = sums.withColumn("upto", upto).where("upto > take").groupBy("source", "stratum").agg(F.min(F.struct("bucket", (F.col("take") - F.col("upto") + F.col("n")).alias("left"))).alias("cut"))
    cut = settle(cut.select(F.col("source").alias("_source"), F.col("stratum").alias("_stratum"), F.col("cut.bucket").alias("cut"), F.col("cut.left").alias("left")), f"{work}/cut")
    edge = rows.where(may).join(small(cut), [*on("source", "stratum"), F.col("bucket") == F.col("cut")])
    edge = edge.select("source", "stratum", "y", "rid", "left", "cut").withColumn("k", F.row_number().over(W.partitionBy("source", "stratum").orderBy("y", "rid")))
    # Where none of the bucket is left to take, its first row only tells the bucket.
    last = edge.where(F.col("k") == F.greatest("left", F.lit(1))).select(F.col("source").alias("_source"), F.col("stratum").alias("_stratum"), "cut", F.when(F.col("left") > 0, F.col("y")).alias("last_y"), F.col("rid").alias("last_rid"))
    rows = rows.join(small(settle(last, f"{work}/last")), on("source", "stratum"), "left").drop("_source", "_stratum")
    before = (F.col("y") < F.col("last_y")) | ((F.col("y") == F.col("last_y")) & (F.col("rid") <= F.col("last_rid")))
    taken = F.col("cut").isNull() | (F.col("bucket") < F.col("cut")) | ((F.col("bucket") == F.col("cut")) & F.coalesce(before, F.lit(False)))
    rows = rows.withColumn("extra", F.when(may & taken, 1).otherwise(0)).withColumn("copies", F.when(F.col("size") > 0, F.col("whole")).otherwise(0) + F.col("extra"))
    if not closing:
        return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), F.col("copies").cast("long").alias("copies"), *[f"_c_{c}" for c in carry])
    # Closing: what each source's words miss of its target (or have too much), and the one document nearest to that.
    gap = settle(rows.groupBy(F.col("source").alias("_source")).agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap")), f"{work}/gap")
    off = F.abs(F.col("gap") - F.col("size") * F.when(F.col("extra") == 1, -1).otherwise(1))
    near = rows.where(may).join(small(gap), on("source")).where(off < F.abs("gap")).groupBy("source").agg(F.min(F.struct(off.alias("off"), "y", "rid")).alias("m"))
    near = settle(near.select(F.col("source").alias("_source"), F.col("m.rid").alias("closing")), f"{work}/closing")
    closed = F.when(F.coalesce(F.col("rid") == F.col("closing"), F.lit(False)), 1 - 2 * F.col("extra")).otherwise(0)
    rows = rows.join(small(near), on("source"), "left").withColumn("copies", (F.col("copies") + closed).cast("long"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", *[f"_c_{c}" for c in carry])


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark, spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("copies")
