"""Quality classifier by importance resampling (operator 1).

Two bag-of-hashed-n-grams models are counted: one over texts labelled good (the target), one over
the raw corpus, all of it. A document's log weight is the sum over its n-grams (words and adjacent
pairs) of log target probability less log raw probability. Gumbel noise drawn from a hash of the
doc_id is added and the top k documents are kept, which samples without replacement in proportion
to the weights. k is the number of documents at or above a log weight calibrated on the half of the
labelled sample that the target model has not seen (the cut of highest balanced accuracy).

Weights are fixed-point integers, so sums agree exactly wherever and however often they are made.
Only the labelled rows are sampled (``max_labelled``, by hash); corpus counts cover everything.
Null and empty texts have no n-grams, log weight 0, and are rejected. A null doc_id hashes as an
empty string; rows that tie at the cut are all kept. Without
labels of both kinds nothing can be fitted and every document with an n-gram is kept. Long texts are hashed whole,
some million characters of short ones at a time. ``quality_scores`` reads doc_id and text alone, and
``good_documents`` boxes the other columns, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, trim, written

#: Buckets of n-grams (a power of two), fixed-point units of a log weight, bound of labelled rows.
BUCKET_BITS, UNIT, MAX_LABELLED = 14, 1_000_000, 20_000
_POWERS = np.random.default_rng(1).integers(1, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: 0 white space, 1 letters, digits and bytes of other characters, 2 the rest.
_KIND = np.array([0 if c in b" \t\n\v\f\r" else 1 if c > 127 or chr(c).isalnum() else 2 for c in range(256)], np.uint8)


def hashed_ngrams(texts: list[str | None], bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, index of its text) of every token, of every pair of adjacent tokens, and one more,
    the same for all tokens, where a token repeats the one before. A token is a run of bytes of one kind."""
    data = [(t or "").encode() for t in texts]
    blob = np.frombuffer(b" ".join(data) + b" ", np.uint8)
    kind = _KIND[blob]
    edge = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts = np.concatenate([[0], edge])
    ends = np.concatenate([edge, [len(blob)]])
    own = kind[starts] > 0
    starts, ends = starts[own], ends[own]
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    size = ends - starts
    inside = np.flatnonzero(kind > 0)
    place = (inside - np.repeat(starts, size)) & 255
    token = np.add.reduceat((blob[inside].astype(np.uint64) + np.uint64(1)) * _POWERS[place], np.cumsum(size) - size) * _ODD
    token ^= token >> np.uint64(31)
    text = np.searchsorted(np.cumsum([len(d) + 1 for d in data]), starts, "right")
    pair = (token[:-1] * np.uint64(31) + token[1:]) * _ODD
    same = text[1:] == text[:-1]
    shift = np.uint64(64 - bits)
    again = same & (token[1:] == token[:-1])
    repeat = np.full(int(again.sum()), _ODD)
    bucket = np.concatenate([token * _ODD, pair[same], repeat]) >> shift
    return bucket.astype(np.int64), np.concatenate([text, text[:-1][same], text[:-1][again]])


def _slices(values: list[str | None], step: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of about ``step`` characters, one text at least."""
    at = size = 0
    for i, t in enumerate(values):
        size += len(t or "") + 1
        if size >= step:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(values):
        yield at, len(values)


def labelled_sample(labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """At most ``max_labelled`` rows (doc_id, good, held_out) with the smallest hashes; a doc_id is good
    if all its labels are. Half of them, held out from the target model, calibrate the cut."""
    own = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))
    held_out = F.pmod(F.xxhash64(F.lit("held out"), "doc_id"), F.lit(2)) == 1
    return own.withColumn("held_out", held_out).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)


def ngram_log_ratios(docs: DataFrame, sample: DataFrame, bits: int = BUCKET_BITS) -> np.ndarray | None:
    """Fixed-point log(target / raw) of each bucket; None without target texts. Both counts are taken
    at the target's scale with one added, so rare buckets count for little.

    Each task adds up its own rows and returns a row per bucket; a grouped sum makes the model of
    2^bits numbers.
    """
    flagged = docs.select("doc_id", "text").join(F.broadcast(sample.where("not held_out").select("doc_id", "good")), "doc_id", "left").select("text", "good")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            values = batch.column("text").to_pylist()
            good = np.array([g is True for g in batch.column("good").to_pylist()], bool)
            for a, b in _slices(values):
                bucket, text = hashed_ngrams(values[a:b], bits)
                total[0] += np.bincount(bucket, minlength=1 << bits)
                total[1] += np.bincount(bucket[good[a:b][text]], minlength=1 << bits)
        full = np.flatnonzero(total[0])
        trim()
        yield pa.RecordBatch.from_pydict({"bucket": full.astype(np.int32), "raw": total[0][full], "target": total[1][full]})

    rows = flagged.mapInArrow(count, "bucket int, raw long, target long").groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect()
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    for b, r, t in rows:
        raw[b], target[b] = r, t
    if not target.sum():
        return None
    ratio = np.log((target + 1) / (raw * (target.sum() / raw.sum()) + 1))
    return np.round(ratio * UNIT).astype(np.int64)


def log_weight(ratios: np.ndarray, text: str = "text") -> Column:
    """The log weight of a text in units of 1 / UNIT; null if it has no n-gram."""
    bits = int(len(ratios)).bit_length() - 1

    @F.pandas_udf("long")
    def weigh(texts):
        import pandas as pd

        values = [t if isinstance(t, str) else None for t in texts]
        out: list = []
        for a, b in _slices(values):
            bucket, own = hashed_ngrams(values[a:b], bits)
            order = np.argsort(own, kind="stable")
            value = np.concatenate([[0], np.cumsum(ratios[bucket[order]])])
            cuts = np.searchsorted(own[order], np.arange(b - a + 1))
            total = value[cuts[1:]] - value[cuts[:-1]]
            out += [int(x) if n else None for x, n in zip(total, np.diff(cuts), strict=True)]
            bucket = own = order = value = None
        trim()
        return pd.Series(out, dtype="Int64")

    return weigh(F.col(text))


def gumbel(doc_id: Column) -> Column:
    """Standard Gumbel noise from the id's hash, in units of 1 / UNIT."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    u = (F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))
    return F.round(-F.log(-F.log(u)) * UNIT).cast("long")


def kth_largest(values: DataFrame, name: str, k: int, bits: int = 12) -> int | None:
    """The k-th largest long of a column, exactly: counts in 2^bits ranges, then again inside the
    range that holds it. Only those counts come to the driver."""
    low, high, n = values.agg(F.min(name), F.max(name), F.count(name)).head()
    if not n or k < 1:
        return None
    k = min(k, n)
    shift = max(0, (high - low).bit_length() - bits)
    while True:
        width = 1 << shift
        part = values.where(F.col(name).between(low, high)).groupBy(F.shiftright(F.col(name) - F.lit(low), shift).alias("b")).count()
        for b, c in sorted(part.collect(), reverse=True):
            if c >= k:
                low, high = low + b * width, min(high, low + (b + 1) * width - 1)
                break
            k -= c
        if not shift:
            return low
        shift = max(0, shift - bits)


def balanced_cut(weights: np.ndarray, good: np.ndarray) -> int:
    """The log weight at and above which kept labelled rows give the highest balanced accuracy: midway
    between the highest rejected and the lowest kept of them."""
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    rejected_bad = np.concatenate([[0], np.cumsum(~g)]) / max(1, (~g).sum())
    kept_good = 1 - np.concatenate([[0], np.cumsum(g)]) / max(1, g.sum())
    first = np.concatenate([[True], w[1:] != w[:-1]])
    score = np.where(first, (rejected_bad + kept_good)[:-1], -1)
    at = int(np.argmax(score))
    return (int(w[at]) + int(w[max(0, at - 1)])) // 2


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, bits: int = BUCKET_BITS) -> tuple[np.ndarray, DataFrame]:
    """(log ratios, labelled sample)."""
    sample = written(labelled_sample(labels, max_labelled), "labelled")
    ratios = ngram_log_ratios(docs, sample, bits)
    return (np.zeros(1 << bits, np.int64) if ratios is None else ratios), sample


def resample(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, bits: int = BUCKET_BITS, k: int | None = None):
    """(ratios, cut, weights): the model, the noisy log weight of the k-th document (None: none is
    kept) and the table (doc_id, weight, noisy) of all documents."""
    ratios, sample = fit(docs, labels, max_labelled, bits)
    own = docs.select("doc_id", log_weight(ratios).alias("weight"))
    own = written(own.withColumn("noisy", F.col("weight") + gumbel(F.col("doc_id"))), "weights")
    if k is None:
        # a doc_id that repeats counts once, by its largest weight, so no more rows than labelled ones come back
        rows = own.join(F.broadcast(sample), "doc_id").where("held_out and weight is not null").groupBy("doc_id", "good").agg(F.max("weight").alias("weight")).collect()
        good = np.array([r.good for r in rows], bool)
        least = balanced_cut(np.array([r.weight for r in rows]), good) if good.any() and not good.all() else None
        k = own.where("weight is not null" if least is None else F.col("weight") >= least).count()
    return ratios, kth_largest(own, "noisy", k), own


def kept(cut: int | None) -> Column:
    return F.coalesce(F.col("noisy") >= F.lit(cut), F.lit(False)) if cut is not None else F.lit(False)


def quality_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, log_weight, noisy_weight, kept) of every document."""
    _, cut, own = resample(docs, labels, **options)
    return own.select("doc_id", (F.col("weight") / UNIT).alias("log_weight"), (F.col("noisy") / UNIT).alias("noisy_weight"), kept(cut).alias("kept"))


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the resampling keeps. Weights are exact integers, so they are made
    again from the text here rather than joined to it."""
    ratios, cut, _ = resample(docs, labels, **options)
    rows = boxed(docs).withColumn("noisy", log_weight(ratios, "row.text") + gumbel(F.col("row.doc_id")))
    return rows.where(kept(cut)).select("row.*")
