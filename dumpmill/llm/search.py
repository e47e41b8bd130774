"""Ranked lexical search by sort-based accumulation (operator 11).

A set of query items ranks all documents. One pass over the texts keeps, of each document, its number of terms and the
query terms that it holds with their counts; statistics of the corpus come from what this pass has written. A second
pass turns postings into (item, document, impact) arrays: packed keys of item and document are radix sorted by digits
of 16 bits, runs of a key are summed by ``numpy.add.reduceat``, and a heap per item keeps the best of a task. What tasks
keep, ``top`` rows per item, meets in two steps: ranges of tasks first, then an item.

All of a document's impacts arise in the task that holds it, so no posting is shuffled, however frequent its term; keys
of a block of documents fill 16 bits where items allow, so that most sorts take one pass of counting. Scores are 64-bit
integers; weights are ``floor(1000 ln((2N+2)/(2df+1)))`` in doubles.

Items are taken in blocks of about ``BLOCK`` pairs of item and term, dealt by hash; each block is broadcast and costs a
pass over the documents. The block is the bound of what the driver and a broadcast hold (an item with more terms than
that is a block of its own).

Nulls: a null text, of an item or a document, has no terms; a null item_id or doc_id is an id like any other, last in
order. Rows of items that share an id are one item, and equal ones of them count once. Rows of documents that share a
doc_id are ranked row by row. Empty tables give no rows. Texts of any length are taken whole. Only the id and
text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, written

#: Characters of terms: ASCII letters and digits, and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Pairs of item and term in a block; impacts that are sorted at once, about.
BLOCK, ROOM = 200_000, 1 << 21
#: Each byte of UTF-8 as it counts: A-Z in lower case, what is no term as a blank.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """The terms of a text in order."""
    return text.encode().translate(_BYTES).split() if text else []


def lowered(text: Column) -> Column:
    """A-Z in lower case and no other letter."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term, times) of the items' texts."""
    own = items.select(F.col(item).alias("item"), F.col(text).alias("t")).distinct()
    own = own.select("item", F.explode(F.regexp_extract_all(lowered(F.col("t")), F.lit(TERM), F.lit(0))).alias("term"))
    return own.groupBy("item", "term").agg(F.count("*").alias("times"))


class Block:
    """A block of items: its terms with the items that hold them, as arrays by place of the term."""

    def __init__(self, rows):
        terms = sorted({r.term for r in rows})
        self.place = {t.encode(): i for i, t in enumerate(terms)}
        self.items = sorted({r.item for r in rows}, key=lambda x: (x is None, x))
        number = {x: i for i, x in enumerate(self.items)}
        rows = sorted(((self.place[r.term.encode()], number[r.item], r.times) for r in rows))
        self.item = np.array([r[1] for r in rows], np.int64)
        self.times = np.array([r[2] for r in rows], np.int64)
        self.held = np.bincount(np.array([r[0] for r in rows], np.int64), minlength=len(terms))
        self.first = np.cumsum(self.held) - self.held


def postings(docs: DataFrame, block: Block, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n, terms, counts) of every document with a term: places of the block's terms in it and how often they occur."""
    place = docs.sparkSession.sparkContext.broadcast(block.place)

    def run(batches):
        find = place.value.get
        for batch in batches:
            ids, n, terms, counts = [], [], [], []
            for i, t in enumerate(batch.column("t")):
                if not (own := words(t.as_py())):
                    continue
                found = Counter(filter(None.__ne__, map(find, own)))
                ids.append(i)
                n.append(len(own))
                terms.append(list(found))
                counts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(ids, pa.int64())), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                ["doc", "n", "terms", "counts"])

    return docs.select(F.col(doc).cast("long").alias("doc"), F.col(text).alias("t")).mapInArrow(run, "doc long, n long, terms array<int>, counts array<long>")


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The stable order of non-negative keys, by counting digits of 16 bits from the lowest."""
    order = np.argsort(keys.astype(np.uint16), kind="stable")
    left = int(keys.max(initial=0)) >> 16
    shift = 16
    while left:
        order = order[np.argsort((keys[order] >> shift).astype(np.uint16), kind="stable")]
        left >>= 16
        shift += 16
    return order


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, ascending, with the sum of its values."""
    if not len(keys):
        return keys, values
    order = radix_order(keys)
    keys, values = keys[order], values[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(values, at)


class Best:
    """The ``top`` highest entries of each item: a heap of (score, not a null id, -id), the worst first."""

    def __init__(self, items: int, top: int):
        self.heaps, self.top = [[] for _ in range(items)], top
        self.least = np.ones(items, np.int64)  # only scores from here on can enter

    def add(self, item: np.ndarray, doc: list, score: np.ndarray) -> None:
        for i, d, s in zip(item.tolist(), doc, score.tolist(), strict=True):
            heap, entry = self.heaps[i], (s, d is not None, -(d or 0))
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heappushpop(heap, entry)
            else:
                continue
            if len(heap) == self.top:
                self.least[i] = heap[0][0]


def impacts(n, doc, term, count, block: Block, weight: np.ndarray, docs_n: int, terms_n: int):
    """(item, doc, impact) of postings; ``doc`` is the place of a posting's document in ``n``."""
    m = 75 + (25 * n * docs_n) // terms_n
    own = weight[term] * ((1_000_000_000 * count) // (1000 * count + 12 * m[doc]))
    held = block.held[term]
    at = np.repeat(block.first[term] - (np.cumsum(held) - held), held) + np.arange(held.sum())
    return block.item[at], np.repeat(doc, held), np.repeat(own, held) * block.times[at]


def best_of_tasks(own: DataFrame, block: Block, weight: np.ndarray, docs_n: int, terms_n: int, top: int) -> DataFrame:
    """(item, doc, score, part): the best of each task, ``item`` as place in the block."""
    shared = own.sparkSession.sparkContext.broadcast((block, weight))
    step = max(1, 65_536 // max(1, len(block.items)))

    def run(batches):
        block, weight = shared.value
        best, part = Best(len(block.items), top), 0
        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            ids, n = batch.column("doc"), batch.column("n").to_numpy()
            ends = batch.column("terms").offsets.to_numpy() - batch.column("terms").offsets[0].as_py()
            term, count = batch.column("terms").flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
            reach = np.concatenate([[0], np.cumsum(block.held[term])])[ends]  # impacts before each document
            low = 0
            while low < len(n):
                high = min(low + step, max(low + 1, int(np.searchsorted(reach, reach[low] + ROOM, "right")) - 1), len(n))
                mine = slice(ends[low], ends[high])
                doc = np.repeat(np.arange(high - low), np.diff(ends[low : high + 1]))
                item, doc, value = impacts(n[low:high], doc, term[mine], count[mine], block, weight, docs_n, terms_n)
                keys, score = summed(item * (high - low) + doc, value)
                item = keys // (high - low)
                in_reach = np.flatnonzero(score >= best.least[item])
                item, doc = item[in_reach], keys[in_reach] % (high - low)
                best.add(item, ids.take(pa.array(doc + low)).to_pylist(), score[in_reach])
                low = high
        rows = [(i, -e[2] if e[1] else None, e[0], part) for i, heap in enumerate(best.heaps) for e in heap]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["item", "doc", "score", "part"])

    return own.withColumn("part", F.spark_partition_id()).mapInArrow(run, "item int, doc long, score long, part int")


def search(items: DataFrame, docs: DataFrame, top: int = 20, item: str = "item_id", doc: str = "doc_id") -> DataFrame:
    """(item, rank, doc, score) under the names of the id columns: of each item the ``top`` documents whose score is
    above 0. Ids of documents are integers."""
    with scratch() as own:
        by_item, out = written(item_terms(items, item), "items"), None
        blocks = max(1, math.ceil(by_item.count() / BLOCK))
        for at in range(blocks):
            rows = by_item.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == at).collect()
            part = own.kept(_ranked(Block(rows), by_item.schema["item"].dataType.simpleString(), docs, top, item, doc))
            out = part if out is None else out.unionByName(part)
    return out


def _ranked(block: Block, kind: str, docs: DataFrame, top: int, item: str, doc: str) -> DataFrame:
    """``search`` for one block of items, written."""
    with scratch() as own:
        found = written(postings(docs, block, doc), "postings")
        size = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).head()
        df = np.zeros(len(block.place), np.int64)
        for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[r.t] = r["count"]
        weight = np.array([math.floor(1000 * math.log((2 * size[0] + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        best = best_of_tasks(found, block, weight, size[0], max(1, size[1]), top)
        order = [F.desc("score"), F.col("doc").asc_nulls_last()]
        for by in (["item", F.shiftright("part", 6)], ["item"]):  # the best of 64 tasks, then of all
            best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
        names = docs.sparkSession.createDataFrame(list(enumerate(block.items)), f"place int, id {kind}")
        best = best.join(F.broadcast(names), F.col("item") == F.col("place"))
        return own.kept(written(best.select(F.col("id").alias(item), "rank", F.col("doc").alias(doc), "score"), "ranked"))
