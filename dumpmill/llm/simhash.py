"""SimHash near-dedup (operator 9).

Fingerprints come from one Arrow pass over whole texts. Fingerprints, not documents, are compared:
exact copies collapse first. 64 bits are cut into ``blocks`` blocks; two fingerprints within
``radius`` bits agree on at least ``blocks - radius`` of them, so every choice of that many blocks
is one key (pigeonhole, no link lost). Within a key the fingerprints are stored as vertical bit
planes, and all distances are updated plane by plane with carry-save counters; blocks of 64
candidates are abandoned once all exceed the radius. A key with more than ``cell`` fingerprints is
dealt out as pairs of chunks, so no task holds more than two chunks of it. Each task returns a star
(one edge per fingerprint at most) for each component it finds, never all pairs.

Nulls and texts without a word have fingerprint zero and link like any other; a null doc_id takes
part but is never a component's id unless it is alone with nulls. Repeated rows stay repeated. Texts are
hashed whole, one after the other, in memory proportional to the longest. ``simhash_groups`` reads doc_id
and text alone and ``near_dedup`` boxes the other columns, so their names cannot clash. Empty tables give
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import boxed, components, group_runs, joined, min_labels, scratch, trim, written

SEED = 42
LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str | None, width: int = 3) -> np.ndarray:
    """XXH64 of each ``width``-word shingle of the ASCII-lower-cased text, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    size = min(width, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - size]]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[s : e - 1], SEED) for s, e in zip(starts, ends[size - 1 :], strict=True)], np.uint64)


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per group of ``sizes`` hashes the bits set in over half of them.

    Eight bits are summed at a time in the eight bytes of a word, at most 255 rows before a byte
    could overflow.
    """
    out = np.zeros(len(sizes), np.uint64)
    if not len(hashes):
        return out
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    full = sizes > 0
    parts = [np.arange(s, s + n, 255) for s, n in zip(starts[full], sizes[full], strict=True)]
    cuts = np.concatenate(parts)
    first = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]])
    need = sizes[full]
    got = np.zeros(len(need), np.uint64)
    for i in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(i)) & LANES, cuts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        bits = (2 * counts > need[:, None]).astype(np.uint64)
        for byte in range(8):
            got |= bits[:, byte] << np.uint64(8 * byte + i)
    out[full] = got
    return out


@F.pandas_udf(LongType())
def fingerprint(texts):
    """SimHash of each text over 3-word shingles as a signed long."""
    import pandas as pd

    out = np.empty(len(texts), np.uint64)
    for at in range(0, len(texts), 256):
        own = [shingle_hashes(t) for t in texts.iloc[at : at + 256]]
        sizes = np.array([len(h) for h in own])
        out[at : at + len(own)] = majority(np.concatenate(own), sizes)
    own = None
    trim()
    return pd.Series(out.view(np.int64))


def link_groups(group: np.ndarray, prints: np.ndarray, radius: int, step: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (i, root) of the components within each run of equal ``group`` values.

    ``group`` is sorted. Members of a run are stored 64 to a word as bit planes.
    """
    n = len(prints)
    edge = np.flatnonzero(group[1:] != group[:-1]) + 1
    starts = np.concatenate([[0], edge])
    sizes = np.diff(np.concatenate([starts, [n]]))
    keep = np.repeat(sizes > 1, sizes)
    if not keep.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rows = np.flatnonzero(keep)
    sizes = sizes[sizes > 1]
    values = prints[rows]
    pos = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    words = (sizes + 63) // 64
    word0 = np.cumsum(words) - words
    mine = np.repeat(word0, sizes) + pos // 64
    bit = (pos % 64).astype(np.uint64)
    first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
    one = np.uint64(1)
    planes = [np.bitwise_or.reduceat(((values >> np.uint64(k)) & one) << bit, first) for k in range(64)]
    valid = np.bitwise_or.reduceat(one << bit, first)
    last = np.repeat(word0 + words, sizes)
    spans = last - mine
    a, b = [], []
    ends = np.cumsum(spans)
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + step, "right")))
        span = spans[at:to]
        query = np.repeat(np.arange(at, to), span)
        word = np.arange(len(query)) - np.repeat(np.cumsum(span) - span, span) + np.repeat(mine[at:to], span)
        query, word, over = _sweep(values, planes, valid, query, word, radius)
        hit = (~over)
        for k in range(64):
            on = ((hit >> np.uint64(k)) & one).astype(bool)
            if on.any():
                a.append(query[on])
                b.append(first[word[on]] + k)
        at = to
        if sum(map(len, a)) > 4 * step:
            a, b = _forest(a, b, len(rows))
    a, b = _forest(a, b, len(rows))
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return rows[a[0]], rows[b[0]]


def _forest(a: list, b: list, n: int) -> tuple[list, list]:
    if not a:
        return a, b
    label = min_labels(np.concatenate(a), np.concatenate(b), n)
    node = np.flatnonzero(label != np.arange(n))
    return [node], [label[node]]


def _sweep(values, planes, valid, query, word, radius):
    """Distances of each query to the 64 members of a word, all at once: bits of ``over`` are set
    for members that are further than ``radius``."""
    over = ~valid[word]
    levels = radius.bit_length()
    counters = [np.zeros(len(query), np.uint64) for _ in range(levels)]
    zero = np.uint64(0)
    for k in range(64):
        flip = zero - ((values[query] >> np.uint64(k)) & np.uint64(1))
        carry = planes[k][word] ^ flip
        for i in range(levels):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        over |= carry
        if radius & (radius + 1):
            over |= _above(counters, radius)
        if k % 8 == 7:
            alive = over != ~zero
            if not alive.all():
                query, word, over = query[alive], word[alive], over[alive]
                counters = [c[alive] for c in counters]
    return query, word, over


def _above(counters: list, radius: int):
    """Bits whose counter exceeds ``radius`` (not one less than a power of two)."""
    more, same = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for i in reversed(range(len(counters))):
        if radius >> i & 1:
            same = same & counters[i]
        else:
            more, same = more | (same & counters[i]), same & ~counters[i]
    return more


def band_keys(print_: Column, radius: int, blocks: int) -> Column:
    """One struct (band, key) for each choice of ``blocks - radius`` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    out = []
    for band, chosen in enumerate(combinations(masks, blocks - radius)):
        mask = sum(chosen)
        mask -= (mask >> 63) << 64
        out.append(F.struct(F.lit(band).alias("band"), print_.bitwiseAND(F.lit(mask)).alias("key")))
    return F.array(*out)


def fingerprint_links(prints: DataFrame, radius: int = 3, blocks: int = 5, cell: int = 2048) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints ``fp`` within ``radius`` bits."""
    keys = prints.select("fp", F.explode(band_keys(F.col("fp"), radius, blocks)).alias("k")).select("fp", "k.*")
    hot = keys.groupBy("band", "key").count().where(F.col("count") > cell)
    parts = F.coalesce(F.ceil(F.col("count") / cell), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    cells = (
        keys.join(hot, ["band", "key"], "left").withColumn("parts", parts).withColumn("own", own)
        .select("band", "key", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select("band", "key", "fp", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"))
    )
    names = ["band", "key", "c1", "c2"]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in group_runs(batches, names, 1 << 17):
            group = np.zeros(t.num_rows, np.int64)
            for k in names:
                own = t.column(k).to_numpy()
                group[1:] += own[1:] != own[:-1]
            fp = t.column("fp").to_numpy()
            a, b = link_groups(np.cumsum(group > 0), fp.view(np.uint64), radius)
            yield pa.RecordBatch.from_pydict({"a": fp[a], "b": fp[b]})
        trim()

    return cells.repartition(*names).sortWithinPartitions(*names).mapInArrow(link, "a long, b long").distinct()


def simhash_groups(docs: DataFrame, radius: int = 3, blocks: int = 5, cell: int = 2048) -> DataFrame:
    """Rows (doc_id, fp, component_id): ``fp`` a signed long, ``component_id`` the smallest doc_id
    reachable over links of ``radius`` bits or fewer."""
    with scratch() as work:
        own = work.kept(written(docs.select("doc_id", fingerprint("text").alias("fp")), "prints"))
        firsts = own.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
        roots = components(fingerprint_links(firsts.select("fp"), radius, blocks, cell))
        linked = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        ids = linked.groupBy("root").agg(F.min("first").alias("component_id"))
        named = work.kept(written(linked.join(ids, "root").select("fp", "component_id", "n"), "named"))
    return joined(own, named, ["fp"]).select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group: the row whose doc_id is the group's smallest.

    Rows with a doc_id of their own are dropped by that id alone. Where a doc_id is null or repeats,
    the fingerprint decides too: of equal rows one stays, and rows without a doc_id stay only
    where their whole group has none, one for each distinct fingerprint.
    """
    groups = written(simhash_groups(docs, **options), "groups")
    shared = groups.groupBy("doc_id").count().where("doc_id is null or count > 1").select(F.col("doc_id").alias("shared"))
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    rows = boxed(docs)
    kept = rows.where("row.doc_id is not null").join(gone, F.col("row.doc_id") == F.col("gone"), "left_anti")
    if shared.isEmpty():
        return kept.select("row.*")
    stay = groups.where("doc_id = component_id or component_id is null").join(shared, F.col("doc_id").eqNullSafe(F.col("shared")), "left_semi")
    stay = stay.select("doc_id", F.col("fp").alias("own")).distinct()
    alone = kept.join(shared, F.col("row.doc_id") == F.col("shared"), "left_anti")
    odd = rows.join(shared, F.col("row.doc_id").eqNullSafe(F.col("shared")), "left_semi").withColumn("fp", fingerprint("row.text"))
    odd = odd.join(stay, F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("fp") == F.col("own")), "left_semi")
    odd = odd.withColumn("id", F.col("row.doc_id")).dropDuplicates(["id", "fp"])
    return alone.select("row").union(odd.select("row")).select("row.*")


def hex_print(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
