"""Mixing sources to target weights (operator 8).

Each document has a 60-bit hash of its doc_id. Words are summed per source and hash bucket; running
sums over the buckets find the bucket in which a source's budget ends, only that bucket is summed
again by its next bits, and the documents below the final hash are taken by a filter. Nothing is
sorted or ranked over all documents, and thresholds nest: a larger budget only raises the cut. What
the cut leaves open is filled by the single document of the nearest size.

A target above a source's size takes every document that many whole times and the rest by hash.
Nulls: a null source is a source of its own (last in order), a null text has size 0, and a null
doc_id is hashed as an empty string. Rows with the same doc_id share a hash and are taken together.
An empty table gives no rows. Texts of any length are counted in the JVM. The row is boxed where texts are kept, so
other columns cannot clash. The table of sources, a row for each, is windowed in one task: sources are taken
to be names of corpora (some million at most), not of pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, boxed, written

#: Most times that a document's words may be used.
REPEATS = 3
WEIGHTS = (5, 2, 1)
LEVELS, BITS = 3, 12


def doc_hash(doc_id: Column) -> Column:
    """The first 60 bits of the MD5 of the id in decimal."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, h), without texts."""
    return docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        doc_hash(F.col("doc_id")).alias("h"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Add ``target`` to ``sources`` (source, source_size), one row per source.

    Targets are min(repeats x size, level x weight) with one common level. Sources in order of
    repeats x size / weight fill up first, so the level follows from running sums over this table,
    which has one row per source however many documents there are.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    w = sources.withColumn("weight", weight).withColumn("cap", F.lit(float(repeats)) * F.col("source_size"))
    w = w.withColumn("ratio", F.col("cap") / F.col("weight"))
    whole = Window.partitionBy()
    upto = Window.orderBy("ratio").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    w = w.withColumn("total", F.sum("source_size").over(whole).cast("double"))
    # the words that all sources would take at this source's own ratio as the level
    later = F.sum("weight").over(whole) - F.sum("weight").over(upto)
    w = w.withColumn("full", F.sum("cap").over(upto) + F.col("ratio") * later <= F.col("total"))
    level = (F.col("total") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(whole)) / F.sum(
        F.when(~F.col("full"), F.col("weight"))).over(whole)
    return w.withColumn("level", level).select(
        "source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * F.col("level")).alias("target"))


def mix_plan(own: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """One row per source of ``own`` (as of ``sizes``): (_source, source_size, target, base, rest, cut, fill)."""
    shift = (LEVELS - 1) * BITS + (60 - LEVELS * BITS)
    first = own.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("words"))
    first = written(first, "buckets")
    per = written(targets(first.groupBy("source").agg(F.sum("words").alias("source_size")), weights, repeats), "targets")
    size = F.col("source_size")
    base = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    plan = per.withColumn("base", F.least(base, F.lit(repeats)))
    plan = plan.withColumn("rest", F.greatest(F.col("target") - F.col("base") * size, F.lit(0.0)))
    at = plan.select("source", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("used"))
    buckets = first
    for level in range(LEVELS):
        if level:
            shift -= BITS
            inside = own.join(at, own["source"].eqNullSafe(at["source"]) & (F.shiftright("h", shift + BITS) == F.col("prefix")))
            buckets = inside.groupBy(own["source"].alias("source"), F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        at = written(_boundary(buckets, at), f"level{level}")
    # at most a few hashes share the last bucket; the cut is the last of them that fits the budget
    inside = own.join(at, own["source"].eqNullSafe(at["source"]) & (F.shiftright("h", shift) == F.col("prefix")))
    last = inside.groupBy(own["source"].alias("source"), "h", "rest", "used").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source").orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = last.withColumn("reach", F.col("used") + F.sum("words").over(order))
    cut = last.where("reach <= rest").groupBy("source").agg(F.max(F.struct("h", "reach")).alias("x"))
    start = at.select(F.col("source").alias("_s"), F.shiftleft("prefix", shift).alias("low"), "used")
    plan = plan.join(start, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    plan = plan.join(cut.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    # documents with h <= cut, or below the boundary bucket, get one more copy
    plan = written(plan.select(
        F.col("source").alias("_source"), "source_size", "target", "base", "rest", F.coalesce("x.h", F.col("low") - 1, F.lit(-1)).alias("cut"),
        (F.col("rest") - F.coalesce("x.reach", "used", F.lit(0))).alias("gap")), "plan")
    # and so does the one document above the cut whose size is nearest to what is still missing
    above = own.join(plan, F.col("source").eqNullSafe(F.col("_source"))).where("h > cut and size > 0 and size < 2 * gap")
    fill = above.groupBy("_source").agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")), "h")).alias("x"))
    fill = fill.select(F.col("_source").alias("_s"), F.col("x.h").alias("fill"))
    return written(plan.join(fill, F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s", "gap"), "plan")


def copies() -> Column:
    """How often a row is taken: whole rounds, and one more at or below its source's cut."""
    extra = (F.col("rest") > 0) & ((F.col("h") <= F.col("cut")) | F.coalesce(F.col("h") == F.col("fill"), F.lit(False)))
    return (F.col("base") + extra.cast("long")).cast("int")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every document."""
    own = written(sizes(docs), "sizes")
    plan = mix_plan(own, weights, repeats)
    return (
        own.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn("copies", copies())
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def _boundary(buckets: DataFrame, at: DataFrame) -> DataFrame:
    """Per source the bucket in which its budget ends, with the words before it. ``buckets`` has at
    most 2^BITS rows per source."""
    by = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = buckets.select("source", "bucket", "words")
    b = b.join(at.select(F.col("source").alias("_s"), "rest", F.col("used").alias("before")), F.col("source").eqNullSafe(F.col("_s")))
    b = b.withColumn("reach", F.col("before") + F.sum("words").over(by))
    hit = b.where(F.col("reach") > F.col("rest")).groupBy("source", "rest").agg(
        F.min(F.struct("bucket", (F.col("reach") - F.col("words")).alias("used"))).alias("x"))
    return hit.select("source", "rest", F.col("x.bucket").alias("prefix"), F.col("x.used").alias("used"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; rows taken zero times go. Only the plan,
    one row per source, is joined: texts are not shuffled."""
    plan = mix_plan(written(sizes(docs), "sizes"), weights, repeats).select("_source", "base", "rest", "cut", "fill")
    rows = boxed(docs).withColumn("h", doc_hash(F.col("row.doc_id"))).join(plan, F.col("row.source").eqNullSafe(F.col("_source")))
    rows = rows.withColumn("copies", copies()).where("copies > 0")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
