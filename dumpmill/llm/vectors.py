"""Embedding near-dedup by collision-counting projections (operator 7).

Vectors of one label (and dimension) are projected on many random orthonormal directions. Every
direction is sorted, and a query collides with the rows inside a window around its own value, which is walked along
the sorted order. Pairs that collide at least a calibrated number of times are verified by cosine in double precision.
Window and count are calibrated once by simulation: of pairs exactly at the cosine bound, at least
``recall`` reach the count (pairs closer than that collide more often).

Work is dealt out so that no task holds a whole label: exact copies collapse first; a label with more
than ``cell`` vectors (and only such a label) is halved again and again at its own medians of further
random directions. A vector near a median goes to both halves. As one end of a pair near the median is
enough to bring both together, ``MARGIN`` spreads of a pair at the bound to each side lose a pair only
where it differs by twice that, about one in 1,700 pairs exactly at the bound a split; each split adds some
18% of rows where vectors fill their space. Of the cells in which a pair meets, the one on the side of its
smaller uid counts it, so each cell returns counts of links per vector, and a star of edges for the
components it sees, never its pairs. Cells that are still too large are dealt out as pairs of chunks.

Null labels, null, zero or non-finite vectors link with nothing. Rows with equal vectors link with
each other and count one by one. A null vec_id takes part, but names no component unless alone.
Empty tables give no rows. Other columns are not looked at, so their names cannot clash.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .common import components, hashed, joined, min_labels, scratch, written

DIRECTIONS, WINDOW, CELL, MARGIN = 24, 2.0, 2048, 1.15
#: Rows whose counts are compared at once, most halvings of a label, and directions that are walked beyond those a pair may miss.
BLOCK, MOST_SPLITS, WALKED = 256, 24, 4


@lru_cache(maxsize=64)
def directions(dim: int, count: int, seed: int) -> np.ndarray:
    """``count`` random unit columns, orthogonal in runs of ``dim``."""
    rng = np.random.default_rng([seed, dim])
    parts = [np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(-(-count // dim))]
    return np.concatenate(parts, axis=1)[:, :count]


@lru_cache(maxsize=64)
def calibrated(dim: int, cosine: float, recall: float, count: int = DIRECTIONS) -> tuple[float, int]:
    """(half width of a window, least collisions) from 20,000 simulated pairs at the cosine bound.

    A pair's differences along the directions are those of a random vector of length
    sqrt(2 - 2 cosine)."""
    rng = np.random.default_rng([7, dim])
    gap = rng.standard_normal((20_000, dim))
    gap *= np.sqrt(2 - 2 * cosine) / np.linalg.norm(gap, axis=1, keepdims=True)
    half = WINDOW * np.sqrt((2 - 2 * cosine) / dim)
    hits = np.sort((np.abs(gap @ directions(dim, count, 11)) <= half).sum(axis=1))
    return half, int(hits[int((1 - recall) * len(hits))])


def cell_links(ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray, sides: np.ndarray, near: np.ndarray, part: np.ndarray, cosine: float, recall: float):
    """Links between the rows of one cell; where ``part`` holds two chunks, between the chunks only.

    Returns (links per row, counted with copies; star edges as row numbers). ``sides`` and ``near`` are the bits of
    each split on the way to the cell: a row's own side, and whether it went to both.

    Each direction is sorted on its own, and from each row a window is walked upwards: every row in it collides once with the
    row it starts from. Collisions are added up per pair. A pair that after ``walked`` directions can no longer reach the
    calibrated count, whatever the rest, is dropped; the others are looked up in the windows of the remaining sorted directions
    by their ranks. Nothing else is left out before the cosines. A cell holds two chunks at most, so the counts take a few MB.
    """
    own = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    half, least = calibrated(own.shape[1], cosine, recall)
    place = own @ directions(own.shape[1], DIRECTIONS, 11)
    first = np.argsort(place[:, 0], kind="stable")  # rows go by the first direction, whose windows then are slices
    own, place, names, weight, side, both, chunk = (x[first] for x in (own, place, ids, copies, sides, near, part))
    orders = np.argsort(place, axis=0, kind="stable")
    lines = np.take_along_axis(place, orders, axis=0)
    ends = np.stack([np.searchsorted(line, line + half * (1 + 1e-6) + 1e-7, "right") for line in lines.T], axis=1)
    ranks = np.argsort(orders, axis=0)
    walked = min(DIRECTIONS, max(1, DIRECTIONS - least + WALKED))
    count = np.zeros((len(own), len(own)), np.uint8)
    for at, end in enumerate(ends[:, 0].tolist()):
        count[at, at + 1 : end] = 1
    for j in range(1, walked):
        order = orders[:, j]
        for at, (row, end) in enumerate(zip(order.tolist(), ends[:, j].tolist(), strict=True)):
            count[row, order[at + 1 : end]] += 1
    two = len(np.unique(chunk)) > 1
    links = np.zeros(len(ids), np.int64)
    ea, eb = [], []
    for at in range(0, len(own), BLOCK):
        to = min(at + BLOCK, len(own))
        both_ways = count[at:to, at:] + count[at:, at:to].T
        x, y = np.nonzero(both_ways >= max(0, least - (DIRECTIONS - walked)))
        got, later = both_ways[x, y], y > x
        x, y, got = x[later] + at, y[later] + at, got[later]
        for j in range(walked, DIRECTIONS):
            low, high = np.minimum(ranks[x, j], ranks[y, j]), np.maximum(ranks[x, j], ranks[y, j])
            got += high < ends[low, j]
            alive = got >= least - (DIRECTIONS - 1 - j)
            x, y, got = x[alive], y[alive], got[alive]
        for s in range(0, len(x), 1 << 16):
            i, k = x[s : s + (1 << 16)], y[s : s + (1 << 16)]
            ok = (names[i] != names[k]) & (chunk[i] != chunk[k]) if two else names[i] != names[k]
            ok &= np.einsum("ij,ij->i", own[i], own[k]) >= cosine
            i, k = i[ok], k[ok]
            # the cell is one of several where both went both ways: it counts where it is on the smaller uid's way
            mine = np.where(names[i] < names[k], side[i], side[k])
            counts = (both[i] & both[k] & mine) == 0
            i, k = i[counts], k[counts]
            links += np.bincount(i, weight[k], len(ids)).astype(np.int64) + np.bincount(k, weight[i], len(ids)).astype(np.int64)
            ea.append(first[i])
            eb.append(first[k])
        if sum(map(len, ea)) > 1 << 20:
            ea, eb = _star(ea, eb, ids)
    ea, eb = _star(ea, eb, ids)
    back = np.empty_like(links)
    back[first] = links
    return back, ea[0], eb[0]


def _star(ea: list, eb: list, ids: np.ndarray) -> tuple[list, list]:
    """The same components by one edge per row; a vector that stands as query and candidate is one node."""
    if not ea:
        none = np.empty(0, np.int64)
        return [none], [none]
    name, first, node = np.unique(ids, return_index=True, return_inverse=True)
    label = min_labels(node[np.concatenate(ea)], node[np.concatenate(eb)], len(name))
    far = np.flatnonzero(label != np.arange(len(name)))
    return [first[far]], [first[label[far]]]


def split_points(vectors: DataFrame, cell: int = CELL) -> DataFrame:
    """(label, dim, medians) of the labels with more than ``cell`` vectors: one median for each halving."""
    many = vectors.groupBy("label", F.size("embedding").alias("dim")).count().where(F.col("count") > cell)
    depth = F.least(F.ceil(F.log2(F.col("count") / cell)), F.lit(MOST_SPLITS)).cast("int")
    many = written(many.select("label", "dim", depth.alias("depth")), "large")
    most = many.agg(F.max("depth")).head()[0] or 0
    if not most:
        return many.select("label", "dim", F.array().cast("array<double>").alias("medians"))

    @F.pandas_udf("array<double>")
    def projected(embeddings):
        return embeddings.map(lambda e: _route(np.asarray(e, np.float64), most))

    own = vectors.select("label", F.size("embedding").alias("dim"), projected("embedding").alias("p")).join(many, ["label", "dim"])
    medians = F.array(*[F.percentile_approx(F.col("p")[i], 0.5, 1000) for i in range(most)])
    return own.groupBy("label", "dim").agg(F.slice(medians, 1, F.first("depth")).alias("medians"))


def vector_links(vectors: DataFrame, cosine: float = 0.98, recall: float = 0.999, cell: int = CELL) -> tuple[DataFrame, DataFrame]:
    """For distinct ``vectors`` (uid, label, embedding, copies): (uid, links) and edges (a, b)."""
    own = vectors.select("uid", "label", F.size("embedding").alias("dim"), "embedding", "copies")
    own = own.join(split_points(vectors, cell), ["label", "dim"], "left")
    rows = written(cell_rows(own, cosine, recall), "cells")
    keys = ["label", "dim", "code"]
    full = rows.groupBy(*keys).agg(F.ceil(F.count("*") / cell).cast("int").alias("parts"), F.count("*").alias("n")).where("n > 1")
    rows = rows.join(full.drop("n"), keys)
    part = F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int")
    rows = rows.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("c1", F.least("part", "other")).withColumn("c2", F.greatest("part", "other")).drop("other", "parts")

    def compare(group: pa.Table) -> pa.Table:
        column = lambda name: group.column(name).to_numpy()
        values = group.column("embedding").combine_chunks()
        values = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(group.num_rows, -1)
        ids, left = column("uid"), column("left").astype(np.int64)
        links, a, b = cell_links(ids, values, column("copies"), left, column("near").astype(np.int64), column("part"), cosine, recall)
        some = np.flatnonzero(links)
        return pa.table({
            "uid": np.concatenate([ids[some], ids[a]]), "links": np.concatenate([links[some], np.zeros(len(a), np.int64)]),
            "other": pa.array(np.concatenate([ids[some], ids[b]]))})

    found = written(rows.groupBy(*keys, "c1", "c2").applyInArrow(compare, "uid long, links long, other long"), "links")
    return found.groupBy("uid").agg(F.sum("links").alias("links")), found.where("uid <> other").select(F.col("uid").alias("a"), F.col("other").alias("b"))


def cell_rows(own: DataFrame, cosine: float = 0.98, recall: float = 0.999) -> DataFrame:
    """A row for each cell of each vector (with its label's ``medians``, or null): ``code`` of the cell, ``near`` with
    a bit for each split that sent it both ways, and ``left`` with those of them at which the cell is not on
    the vector's own side."""
    rest = [f for f in own.schema.fields if f.name != "medians"]

    def dealt(batches):
        for batch in batches:
            flat, cuts = batch.column("embedding").flatten(), batch.column("embedding").offsets.to_numpy()
            values = flat.to_numpy(zero_copy_only=False)
            cuts = cuts - cuts[0]
            row, code, left, near = [], [], [], []
            for i, (a, b, medians) in enumerate(zip(cuts, cuts[1:], batch.column("medians").to_pylist(), strict=False)):
                codes, mine, close = [0], 0, 0
                if medians:
                    place = _route(values[a:b].astype(np.float64), len(medians)) - medians
                    edge = np.abs(place) <= MARGIN * np.sqrt((2 - 2 * cosine) / (b - a))
                    mine = sum(1 << j for j in np.flatnonzero(place > 0).tolist())
                    codes = [mine]
                    for j in np.flatnonzero(edge).tolist():
                        close |= 1 << j
                        codes += [x ^ (1 << j) for x in codes]
                row += [i] * len(codes)
                code += codes
                left += [x ^ mine for x in codes]
                near += [close] * len(codes)
            taken = batch.select([f.name for f in rest]).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, *(pa.array(x, pa.int32()) for x in (code, left, near))], names=[*taken.schema.names, "code", "left", "near"])

    return own.mapInArrow(dealt, StructType([*rest, *(StructField(k, IntegerType()) for k in ("code", "left", "near"))]))


def _route(vector: np.ndarray, depth: int) -> np.ndarray:
    """Places on the directions that split labels (not those that count collisions)."""
    return vector @ directions(len(vector), depth, 13) / np.linalg.norm(vector) if depth else np.empty(0)


def vector_groups(table: DataFrame, cosine: float = 0.98, recall: float = 0.999, cell: int = CELL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``table`` (vec_id, embedding, label)."""
    length = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sound = F.coalesce(
        F.col("label").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & (length > 0) & (length != float("inf")), F.lit(False))
    keys = ["label", "h1", "h2"]
    one, two = hashed("embedding")
    own = table.select("vec_id", "label", "embedding", one.alias("h1"), two.alias("h2"), sound.alias("sound"))
    with scratch() as work:
        distinct = own.where("sound").groupBy(*keys).agg(
            F.first("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("first"))
        distinct = written(distinct.withColumn("uid", F.monotonically_increasing_id()), "vectors")
        links, edges = vector_links(distinct, cosine, recall, cell)
        roots = components(edges).withColumnRenamed("node", "uid")
        named = distinct.select("uid", *keys, "copies", "first").join(roots, "uid", "left").join(links, "uid", "left")
        named = named.withColumn("root", F.coalesce("root", "uid")).withColumn("n_links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
        firsts = named.groupBy("root").agg(F.min("first").alias("component_id"))
        named = work.kept(written(named.join(firsts, "root").select(*keys, "n_links", "component_id", F.col("copies").alias("n")), "named"))
    rows = own.select("vec_id", F.when(F.col("sound"), F.col("label")).alias("label"), "h1", "h2")
    rows = joined(rows, named, keys, "left")
    component = F.coalesce("component_id", "vec_id")
    return rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))
