"""Shared helpers: input tables, the shared work folder and connected components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of every contract: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The folder all executors share, spark.checkpoint.dir. Where that is unset, a local session uses its
    warehouse and any other raises, as its folders may be local to machines."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir')}/_work"
    return f"{base.rstrip('/')}/dumpmill"


_made: ContextVar[Scratch | None] = ContextVar("made", default=None)


class Scratch:
    """Tables written inside a ``scratch`` block, with their folders."""

    def __init__(self, around: Scratch | None):
        self.tables: list[tuple[DataFrame, str]] = []
        self.around = around

    def kept(self, df: DataFrame) -> DataFrame:
        """``df``, a table written in the block, which stays; it goes to the block around, if there is one."""
        for own in [x for x in self.tables if x[0] is df]:
            self.tables.remove(own)
            if self.around is not None:
                self.around.tables.append(own)
        return df


@contextmanager
def scratch() -> Iterator[Scratch]:
    """Tables written inside are removed at the end, unless they are ``kept``."""
    own = Scratch(_made.get())
    token = _made.set(own)
    try:
        yield own
    finally:
        _made.reset(token)
        for df, path in own.tables:
            _removed(df.sparkSession, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, which cuts its lineage.

    Later stages, and retries after a lost executor, start from these files.
    """
    path = f"{work_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    own = df.sparkSession.read.schema(df.schema).parquet(path)
    if (made := _made.get()) is not None:
        made.tables.append((own, path))
    return own


def _removed(spark: SparkSession, path: str) -> None:
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)


def dropped(df: DataFrame) -> None:
    """Remove the files of a table made by ``written`` that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _removed(df.sparkSession, folder)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def trim() -> None:
    """Give memory that a Python worker has freed back to the system; idle workers would keep it beside the JVM."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def boxed(df: DataFrame) -> DataFrame:
    """``df`` as one struct column ``row``, so that columns added beside it cannot clash with its own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def aside(df: DataFrame, *made: str) -> DataFrame:
    """``df`` with columns named like one of ``made`` renamed: underscores are added until the name is free."""
    taken = {*df.columns, *made}
    names = []
    for c in df.columns:
        new = c
        if c in made:
            while new in taken:
                new += "_"
            taken.add(new)
        names.append(new)
    return df.toDF(*names)


def hashed(*cols: str | Column) -> list[Column]:
    """A 128-bit key of the columns as two longs."""
    own = [F.col(c) if isinstance(c, str) else c for c in cols]
    return [F.xxhash64(*own), F.xxhash64(F.lit(1), *own)]


def joined(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner", least: int = 2000, most: int = 4096) -> DataFrame:
    """``rows`` with the one row that a written ``table`` has of their keys; its column ``n`` says how many rows have
    them. Keys of more than ``least`` rows, the ``most`` largest of them, are joined by broadcast, as
    all their rows would land in one task; the rest, none of which is larger than any of those, by shuffle."""
    hot = table.where(F.col("n") > least).orderBy(F.desc("n"), *keys).limit(most)
    if hot.isEmpty():
        return rows.join(table, keys, how)
    hot = F.broadcast(hot)
    return rows.join(hot, keys).union(rows.join(hot, keys, "left_anti").join(table.join(hot, keys, "left_anti"), keys, how))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, root), root the smallest node.

    Alternates the large-star and small-star steps of Kiveris et al., "Connected Components in
    MapReduce and Beyond" (2014), until no edge changes. Each step aggregates a minimum per node
    (partial aggregation before the shuffle) and joins it back, so hubs can be split as skewed
    join partitions. Nodes without an edge have no row. Nulls are ignored.
    """
    now = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        new = (
            large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", F.col("m").alias("v"))).distinct()
        )
        last, now, before = now, written(new, "edges"), state
        state = _state(now)
        dropped(last)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
    return row[0], row[1]


def group_runs(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Regroup sorted batches into tables of about ``rows`` rows that end where ``keys`` change.

    A group of more rows than that is yielded in one table, so callers split such groups first.
    """
    import numpy as np

    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        whole = pa.Table.from_batches(held).combine_chunks()
        change = np.zeros(whole.num_rows - 1, bool)
        for k in keys:
            own = whole.column(k).to_numpy()
            change |= own[1:] != own[:-1]
        cut = np.flatnonzero(change)
        if len(cut):
            at = int(cut[-1]) + 1
            yield whole.slice(0, at)
            held = whole.slice(at).to_batches()
            count = whole.num_rows - at
        else:
            held = whole.to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def min_labels(a, b, n: int):
    """Smallest reachable index for each of n nodes over the edges (a, b), by numpy label passing."""
    import numpy as np

    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jump = new[new]
            if (jump == new).all():
                break
            new = jump
        new = new[label]
        if (new == label).all():
            break
        label = new
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label
