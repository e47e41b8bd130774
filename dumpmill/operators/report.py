"""The quality report: grouped counts over violations, skips, repairs and records.

All inputs are long tables, so partial counts are combined before any shuffle, and reports of parts
merge by adding up.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = ("releases", "artists", "labels", "masters")


def violation_counts(long: DataFrame) -> DataFrame:
    """(data_type, rule, errors, warnings, infos)."""
    kinds = [F.count_if(F.col("severity") == s).alias(f"{s}s") for s in ("error", "warning", "info")]
    return long.groupBy("data_type", "rule").agg(*kinds)


def record_totals(records: DataFrame) -> DataFrame:
    """(data_type, total) before any skip."""
    return records.groupBy("data_type").agg(F.count("*").alias("total"))


def skip_counts(skipped: DataFrame, sample: int | None = 20) -> DataFrame:
    """(data_type, reason, skipped, ids): with the ``sample`` smallest ids of a reason in one text, or with all (None).

    Without ids for 0. All ids of a reason need not fit a row: ``skip_ids`` returns them in blocks."""
    own = skipped.select("data_type", F.col("_skip.reason").alias("reason"), "id")
    ids = F.array_join(F.array_sort(F.collect_list("id")), ", ").alias("ids")
    counts = own.groupBy("data_type", "reason").agg(F.count("*").alias("skipped"), *([ids] if sample is None else []))
    if not sample:
        return counts
    # the rank filter is applied before the shuffle too, so no group is gathered
    rank = F.row_number().over(Window.partitionBy("data_type", "reason").orderBy("id"))
    firsts = own.withColumn("_n", rank).where(F.col("_n") <= sample).groupBy("data_type", "reason").agg(ids)
    return counts.join(firsts, ["data_type", "reason"])


def skip_ids(skipped: DataFrame, block: Column) -> DataFrame:
    """(data_type, reason, block, skipped, ids): all ids, a row per ``block``, a column of ``skipped`` that bounds what a row holds."""
    own = skipped.select("data_type", F.col("_skip.reason").alias("reason"), block.alias("block"), "id")
    ids = F.array_join(F.array_sort(F.collect_list("id")), ", ")
    return own.groupBy("data_type", "reason", "block").agg(F.count("*").alias("skipped"), ids.alias("ids"))


def repair_counts(filtered: DataFrame, actions: str = "actions") -> DataFrame:
    """(data_type, field, reason, records, values)."""
    own = filtered.select("data_type", F.explode(actions).alias("a"))
    return own.groupBy("data_type", F.col("a.field").alias("field"), F.col("a.reason").alias("reason")).agg(
        F.count("*").alias("records"), F.sum("a.removed_count").cast("long").alias("values"))


def merged(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Counts of several reports added up."""
    whole = reduce(lambda a, b: a.unionByName(b), parts)
    return whole.groupBy(*keys).agg(*[F.sum(c).cast("long").alias(c) for c in whole.columns if c not in keys])


def phase_totals(progress: DataFrame) -> DataFrame:
    """One row with the records, messages and completed files of all files (status, records, messages)."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return progress.agg(total("records"), total("messages"), F.count_if(F.col("status") == "completed").alias("files"))


def byte_progress(read: DataFrame, sizes: DataFrame, step: int = 8 << 20) -> DataFrame:
    """(file, bytes, size, percent, steps): bytes read so far (file, bytes; any number of rows a file) against the
    sizes of files (file, size), with the whole steps done."""
    own = sizes.select("file", "size").join(read.groupBy("file").agg(F.sum("bytes").alias("bytes")), "file", "left")
    done = F.least(F.coalesce("bytes", F.lit(0)), "size").cast("long")
    percent = F.when(F.col("size") > 0, F.floor(done * 100 / F.col("size"))).otherwise(F.lit(100)).cast("int")
    return own.select("file", done.alias("bytes"), "size", percent.alias("percent"), F.floor(done / step).cast("long").alias("steps"))


def flags(violations: DataFrame, skips: DataFrame, repairs: DataFrame) -> DataFrame:
    """One row: has_violations, has_skipped, has_filtered."""
    some = lambda df, c: df.agg(F.coalesce(F.bool_or(c), F.lit(False)).alias("x"))
    a, b, c = some(violations, F.col("errors") + F.col("warnings") + F.col("infos") > 0), some(skips, F.col("skipped") > 0), some(repairs, F.col("values") > 0)
    return a.withColumnRenamed("x", "has_violations").crossJoin(F.broadcast(b.withColumnRenamed("x", "has_skipped"))).crossJoin(F.broadcast(c.withColumnRenamed("x", "has_filtered")))


def record_counts(progress: DataFrame) -> DataFrame:
    """One row with the map data_type -> records of the files that completed, as an event needs it."""
    own = progress.groupBy("data_type").agg(F.sum("records").cast("long").alias("n"))
    return own.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("data_type", "n")))).alias("record_counts"))


def stalled(progress: DataFrame, now: Column, seconds: int = 120) -> DataFrame:
    """(data_type, last) of types that are not completed and had no record for ``seconds``."""
    own = progress.groupBy("data_type").agg(F.max("ts").alias("last"), F.bool_and("completed").alias("completed"))
    return own.where(~F.col("completed") & (F.unix_timestamp(now) - F.unix_timestamp("last") > seconds)).select("data_type", "last")


TITLE = "Data quality report"


def render(totals: DataFrame, violations: DataFrame, skips: DataFrame, repairs: DataFrame) -> str:
    """The report as text; the inputs hold a row per rule, reason or field."""
    count = {r.data_type: r.total for r in totals.collect()}
    rows = {k: [] for k in (*ORDER, *count)}
    for r in skips.collect():
        ids = ""
        if "ids" in r:
            more = r.skipped - r.ids.count(", ") - 1
            ids = f" ({r.ids}, and {more} more)" if more > 0 else f" ({r.ids})"
        rows.setdefault(r.data_type, []).append((1, r.reason, f"  skipped: {r.skipped} {r.reason}{ids}"))
    for r in repairs.collect():
        rows.setdefault(r.data_type, []).append((2, r.field + r.reason, f"  repaired: {r['values']} values in {r.records} records of {r.field}: {r.reason}"))
    sums: dict[str, list[int]] = {}
    for r in violations.collect():
        rows.setdefault(r.data_type, []).append((0, r.rule, f"  {r.rule}: {r.errors} errors, {r.warnings} warnings, {r.infos} infos"))
        own = sums.setdefault(r.data_type, [0, 0])
        own[0] += r.errors
        own[1] += r.warnings
    out = [TITLE]
    for name, lines in rows.items():
        if name in count or lines:
            errors, warnings = sums.get(name, (0, 0))
            out += [f"{name}: {count.get(name, 0)} records, {errors} errors, {warnings} warnings", *(x[2] for x in sorted(lines))]
    return "\n".join(out) + "\n"


def has_findings(text: str) -> bool:
    """Whether a rendered report holds more than totals."""
    return any(line.startswith("  ") for line in text.splitlines())
