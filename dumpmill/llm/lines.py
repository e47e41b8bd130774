"""Line dedup by a segment-partition edit join (operator 2).

Lines of at least ``least`` code points are compared; shorter ones are left alone. With ``bands``,
pairs of (least length, edits), every line that holds a word (a letter or digit) takes part, whatever its
length, and no other: rules and blank lines are left alone. Equal lines are grouped, and the edits allowed grow with the length of the shorter line (BANDS in the
registered query and the pipeline). Equal lines are grouped by a 128-bit hash. Lines within ``edits``
edits of each other are linked: a line is cut into edits + 1 segments, one of which survives unchanged
in any such partner. Each line is indexed under (length, segment number, segment) and probes the
indexes of all lengths it can reach with the substrings at the positions that remain possible
(multi-match-aware windows of Li et al., "Pass-Join", 2011). Substring hashes come from prefix sums
over whole batches. Candidate pairs pass a letter-count sketch and are verified by banded bit-parallel
edit distance, many pairs at once.

A key shared by more than SMALL lines never emits its pairs, and one of more than CELL lines is refined: two lines within the edits that share a segment are
so without it too, so what is left of each line is cut into segments again, and both segments together
are the next key, until keys are small (``refined``). What cannot be cut further, lines that are alike in all
parts, rests of a few characters and what is large still after LEVELS rounds, is dealt out as pairs of chunks of CELL lines, compared where they
meet, and returns at most one edge per line. Keys that a hash sample (one in SAMPLE) shows to be
hot are salted or kept out of the shuffle; the sample decides where rows go, never which are compared. Of each
class (lines reachable over links) the occurrence with the smallest (doc_id, line number) stays; the
others go.

Lines are told apart by 128 bits throughout; only the rows under keys carry 64 of them, and texts and
links of lines that share those are kept apart. Rows without a doc_id pass unchanged and take no part.
Rows that share a doc_id count as one document.
Null texts have no lines; empty tables give no rows. Texts of any length are cut in one pass, and what is
left of them is put together in time linear in their lines. Other columns pass unchanged, whatever
their names; doc_id may have any type that sorts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from dumpmill.functions.values import let

from .common import boxed, components, joined, scratch, trim, written

EDITS, LEAST, SMALL, CELL = 2, 24, 64, 512
#: Rounds of cutting large keys, times that a round may make rows under large keys more, and the most edits of keys that are cut.
LEVELS, GROWTH, REFINED = 3, 2, 2
#: Key rows travel in blocks of BLOCK at most, and a bucket of keys is to hold BUCKET rows; least and most bits that name a bucket.
#: A task deals out PENDING rows at once and a bucket is looked through whenever it holds HELD.
BLOCK, BUCKET, BITS, PENDING, HELD = 256, 1 << 18, (12, 16), 1 << 19, 1 << 22
#: Bits of the bitmap of candidates: sixteen a line, within these bounds (8 kB and 16 MB).
BITMAP = (1 << 16, 1 << 27)
#: One line in SAMPLE shows hot keys, of which the HOT_KEYS largest are salted.
SAMPLE, HOT_KEYS = 64, 8192
#: (least length, edits): two dates or numbers differ by four to eight edits. Lines under the first length have no
#: segments of six characters or more and are compared exactly only.
BANDS = ((12, 1), (24, 2), (512, 4), (2048, 8))
_WORD = re.compile(r"[^\W_]")
_P, _MIX = 0x9E3779B97F4A7C15 | 1, np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(_P, -1, 1 << 64))


def _lines(text: str | None, least: int, words: bool = False) -> list[tuple[int, str]]:
    """Lines of ``least`` code points at least; with ``words`` only those that hold a word."""
    return [(i, x) for i, x in enumerate(text.split("\n")) if len(x) >= least and (not words or _WORD.search(x))] if text else []


def allowed(bands, n: int) -> int:
    """The edits within which a line of ``n`` code points is linked to one as long or longer."""
    return max((e for least, e in bands if least <= n), default=0)


def line_name(line: str) -> int:
    """XXH64 with seed 42 as a signed long, the value of SQL's xxhash64."""
    h = xxhash.xxh64_intdigest(line, 42)
    return h - (h >> 63 << 64)


def _reach(edits: int, least: int, bands) -> tuple[tuple, int, bool]:
    """(bands, least length compared exactly, whether a line needs a word)."""
    return (tuple(bands), 1, True) if bands else (((least, edits),), least, False)


def occurrences(docs: DataFrame, edits: int = EDITS, least: int = LEAST, bands=None) -> DataFrame:
    """(doc_id, line_no, h1, h2) of every line that is long enough, ``key`` null; besides, (h1, ``key``) of
    a hash sample of lines with each of their keys."""
    bands, least, words = _reach(edits, least, bands)
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, no, one, two, sample = [], [], [], [], []

            def table(ids=batch.column("doc_id")):
                longs = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (one, two)]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at, pa.int64())), pa.array(no, pa.int32()), *longs, pa.nulls(len(at), pa.int64())], names=names)
                if sample:
                    h = np.array([line_name(x) for x in sample], np.int64)
                    for rows, key, *_ in signatures(sample, bands):
                        n = len(rows)
                        yield pa.RecordBatch.from_arrays(
                            [pa.nulls(n, ids.type), pa.nulls(n, pa.int32()), pa.array(h[rows]), pa.nulls(n, pa.int64()), pa.array(key)], names=names)
                for x in (at, no, one, two, sample):
                    x.clear()

            for i, text in enumerate(batch.column("text")):
                for n, line in _lines(text.as_py(), least, words):
                    h = xxhash.xxh64_intdigest(line, 42)
                    at.append(i)
                    no.append(n)
                    one.append(h)
                    two.append(xxhash.xxh64_intdigest(line, 43))
                    if h % SAMPLE == 0 and len(line) >= bands[0][0]:
                        sample.append(line)
                if len(at) > 1 << 17:
                    yield from table()
            yield from table()
        trim()

    names = ["doc_id", "line_no", "h1", "h2", "key"]
    schema = StructType([StructField("doc_id", kind), *(StructField(k, t) for k, t in zip(names[1:], (IntegerType(), LongType(), LongType(), LongType()), strict=True))])
    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, schema)


def hot_keys(found: DataFrame, many: int = 32) -> np.ndarray:
    """The keys of more than ``many`` sampled lines, sorted, HOT_KEYS at most."""
    counts = found.where("key is not null").select("key", "h1").distinct().groupBy("key").count().where(F.col("count") > many)
    return np.sort(np.array([r.key for r in counts.orderBy(F.desc("count"), "key").limit(HOT_KEYS).collect()], np.int64))


def signatures(lines: list[str], bands) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, keys, whether the rows are indexed under them, place and size of the segment) for each band. The lowest four
    bits of a key are its edits."""
    sizes = np.array([len(x) for x in lines])
    starts = np.cumsum(sizes) - sizes
    points = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
    power, back = _powers(len(points) + 1)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(points * power[: len(points)], dtype=np.uint64)])
    for (least, edits), (end, _) in zip(bands, [*bands[1:], (np.iinfo(np.int64).max, 0)], strict=True):
        own = np.flatnonzero((sizes >= least) & (sizes - edits < end))
        if not len(own):
            continue
        less, part, shift, mark = _windows(edits)
        parts, found = edits + 1, []
        step = max(1, (1 << 16) // len(less))
        for first in range(0, len(own), step):  # all windows of some lines at once
            rows = own[first : first + step]
            length, begin = sizes[rows, None], starts[rows, None]
            other = length - np.arange(parts)
            size, rest = (x[:, less] for x in np.divmod(other, parts))
            other = other[:, less]
            longer = np.maximum(0, part - parts + rest)
            at = size * part + longer + shift
            size += part >= parts - rest
            ok = (other >= least) & (other < end) & (at >= 0) & (at + size <= length) & (size > 0)
            place, size = at[ok], size[ok]
            a = (begin + at)[ok]
            h = (prefix[a + size] - prefix[a]) * back[a]
            h = (h ^ (other * parts + part)[ok].astype(np.uint64)) * _MIX
            h ^= h >> np.uint64(32)
            h = h * _MIX & ~np.uint64(15) | np.uint64(edits)
            found.append((rows[np.nonzero(ok)[0]], h.view(np.int64), np.broadcast_to(mark, ok.shape)[ok], place, size))
        yield tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """``size`` powers of _P and of its inverse or more; those of the usual sizes are kept."""
    return _kept_powers() if size <= 1 << 20 else _made_powers(size)


def _made_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    own = [np.full(size, x, np.uint64) for x in (_P, _INVERSE)]
    for x in own:
        x[0] = 1
        np.multiply.accumulate(x, out=x)
    return own[0], own[1]


@cache
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _made_powers(1 << 20)


@cache
def _windows(edits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(characters less, segment, shift, whether indexed) of all windows in which a line can hold a segment of a partner."""
    own = [(less, i, shift) for less in range(edits + 1) for i in range(edits + 1)
           for shift in range(max(-i, less - (edits - i)), min(i, less + edits - i) + 1)]
    less, part, shift = np.array(own).T
    return less, part, shift, (less == 0) & (shift == 0)


def sketches(lines: list[str]) -> np.ndarray:
    """Sixteen letter counts of four bits. An edit changes two of them by one at most."""
    length = np.array([len(x) for x in lines])
    points = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
    lane = (points * np.uint32(0x9E3779B1)) >> np.uint32(28)
    counts = np.bincount(np.repeat(np.arange(len(lines)) * 16, length) + lane, minlength=16 * len(lines)).reshape(-1, 16)
    return ((counts & 15).astype(np.uint64) << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=1, dtype=np.uint64)


def sketch_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A lower bound of the letter counts that differ."""
    out = np.zeros(np.broadcast(a, b).shape, np.uint8)
    for lane in range(16):
        shift = np.uint64(4 * lane)
        d = ((a >> shift) - (b >> shift)).astype(np.uint8) & 15
        out += np.minimum(d, 16 - d)
    return out


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most ``edits``.

    Equal ends are cut off. Bit k of row d then says that d edits turn the first j + k - edits
    characters of ``a`` into the first j of ``b``; only those 2 * edits + 1 diagonals are kept.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    low = _common(a, b, False)
    a, b = a[low:], b[low:]
    high = _common(a, b, True)
    a, b = a[: len(a) - high], b[: len(b) - high]
    if len(a) <= edits and len(b) <= edits:
        return True
    full = (1 << (2 * edits + 1)) - 1
    rows = [((1 << (d + 1)) - 1) << edits for d in range(edits + 1)]
    for j, c in enumerate(b):
        match = 0
        for k in range(2 * edits + 1):
            i = j + k - edits
            if 0 <= i < len(a) and a[i] == c:
                match |= 1 << k
        before, new = 0, 0
        for d, row in enumerate(rows):
            new = row & match if d == 0 else (row & match | before | before >> 1 | new << 1) & full
            before, rows[d] = row, new
        if not new:
            return False
    k = len(a) - len(b) + edits
    return bool(rows[-1] >> k & 1)


def within_many(a: list[str], b: list[str], edits: np.ndarray) -> np.ndarray:
    """``within`` for many pairs at once: the same rows of bits, one number a pair and row."""
    out = np.zeros(len(a), bool)
    open_: list[tuple[int, str, str]] = []
    for n, (x, y, e) in enumerate(zip(a, b, edits.tolist(), strict=True)):
        if abs(len(x) - len(y)) > e:
            continue
        low = _common(x, y, False)
        x, y = x[low:], y[low:]
        high = _common(x, y, True)
        x, y = x[: len(x) - high], y[: len(y) - high]
        if len(x) <= e and len(y) <= e:
            out[n] = True
        elif x and y:
            open_.append((n, x, y))
    for e in np.unique(edits).tolist():
        own = sorted((z for z in open_ if edits[z[0]] == e), key=lambda z: len(z[2]))
        at = 0
        while at < len(own):  # pairs of like lengths, some million characters at a time
            to = at + 1
            while to < len(own) and to - at < 8192 and (to - at) * len(own[to][2]) < 1 << 21:
                to += 1
            part = own[at:to]
            out[[z[0] for z in part]] = _banded([z[1] for z in part], [z[2] for z in part], e)
            at = to
    return out


def _matrix(texts: list[str], height: int, above: int, fill: int) -> np.ndarray:
    """A column of code points for each text, from row ``above`` on."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) for t in texts])
    out = np.full((height, len(texts)), fill, np.uint32)
    out[np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + above, np.repeat(np.arange(len(texts)), size)] = flat
    return out


def _banded(a: list[str], b: list[str], edits: int) -> np.ndarray:
    """Whether each pair of non-empty texts, in the order of len(b), is within ``edits``."""
    size = np.array([len(t) for t in b])
    goal = np.array([len(t) for t in a]) - size + edits
    left = _matrix(a, int(size[-1]) + 2 * edits + 1, edits, 0xFFFFFFFF)
    right = _matrix(b, int(size[-1]), 0, 0xFFFFFFFE)
    full = np.uint32((1 << (2 * edits + 1)) - 1)
    rows = [np.full(len(a), ((1 << (d + 1)) - 1) << edits, np.uint32) & full for d in range(edits + 1)]
    out, live, base = np.zeros(len(a), bool), np.arange(len(a)), 0
    one = np.uint32(1)
    for j in range(int(size[-1])):
        match = np.zeros(len(live), np.uint32)
        for k in range(2 * edits + 1):
            match |= (left[j - base + k] == right[j - base]).astype(np.uint32) << np.uint32(k)
        before = new = None
        for d, row in enumerate(rows):
            new = row & match if d == 0 else (row & match | before | before >> one | new << one) & full
            before, rows[d] = row, new
        ended = size[live] == j + 1
        done = ended | (new == 0)
        if ended.any():
            at = np.flatnonzero(ended)
            out[live[at]] = new[at] >> goal[live[at]].astype(np.uint32) & one
        elif j & 7 != 7:
            continue
        if ended.any() or done.mean() > 0.3:
            if done.all():
                break
            keep = ~done
            live, rows = live[keep], [r[keep] for r in rows]
            left, right, base = left[j + 1 - base :, keep], right[j + 1 - base :, keep], j + 1
    return out


def _common(a: str, b: str, end: bool) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if (a[len(a) - mid :] == b[len(b) - mid :]) if end else (a[:mid] == b[:mid]):
            low = mid
        else:
            high = mid - 1
    return low


def bucket_bits(found: DataFrame) -> int:
    """Bits of the buckets for all key rows, by the sampled ones of ``occurrences``."""
    rows = SAMPLE * found.where("key is not null").count()
    return min(max((rows // BUCKET).bit_length(), BITS[0]), BITS[1])


def _blocks(held: list[tuple[np.ndarray, ...]], bits: int) -> Iterator[pa.RecordBatch]:
    """Key rows (key, line, sketch, indexed, salted) as blocks of one bucket, salted rows in blocks of their own."""
    key, line, sketch, indexed, salted = (np.concatenate(x) for x in zip(*held, strict=True))
    bucket = (key.view(np.uint64) >> np.uint64(64 - bits)).astype(np.uint16)
    bucket[salted] = (line[salted].view(np.uint64) >> np.uint64(64 - bits)).astype(np.uint16)  # one key in many buckets
    order = np.argsort(bucket, kind="stable")
    dealt = salted[order]
    for mine in (order[~dealt], order[dealt]) if dealt.any() else (order,):
        if not len(mine):
            continue
        k, n, s, i, of = key[mine], line[mine], sketch[mine], indexed[mine].view(np.uint8), bucket[mine]
        edge = np.flatnonzero(of[1:] != of[:-1]) + 1
        first, last = np.concatenate([[0], edge]), np.concatenate([edge, [len(of)]])
        cuts = [(x, min(x + BLOCK, z)) for a, z in zip(first.tolist(), last.tolist(), strict=True) for x in range(a, z, BLOCK)]
        for at in range(0, len(cuts), 1 << 12):
            part = cuts[at : at + (1 << 12)]
            blocks = [k[x:z].tobytes() + n[x:z].tobytes() + s[x:z].tobytes() + i[x:z].tobytes() for x, z in part]
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(of[[x for x, _ in part]].astype(np.int32)), "salted": pa.array([bool(salted[mine[0]])] * len(part)),
                "block": pa.array(blocks, pa.binary())})


def _among(key: np.ndarray, hot: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Whether keys are among the sorted ``hot`` ones; ``table`` has a bit for the first twenty of each."""
    own = np.zeros(len(key), bool)
    some = np.flatnonzero(table[key.view(np.uint64) >> np.uint64(44)])
    own[some] = hot[np.minimum(np.searchsorted(hot, key[some]), len(hot) - 1)] == key[some]
    return own


def _rows_of(blocks: list[bytes]) -> list[np.ndarray]:
    """(key, line, sketch, indexed) of blocks."""
    cols: list[list[np.ndarray]] = [[], [], [], []]
    for block in blocks:
        n = len(block) // 25
        for c in range(3):
            cols[c].append(np.frombuffer(block, np.int64, n, 8 * n * c))
        cols[3].append(np.frombuffer(block, np.bool_, n, 24 * n))
    return [np.concatenate(c) for c in cols]


def line_keys(docs: DataFrame, edits: int = EDITS, least: int = LEAST, bands=None, hot: np.ndarray | None = None, bits: int = BITS[0]) -> DataFrame:
    """(bucket, salted, block): the index and probe rows (key, line, sketch, indexed) of each line, packed by buckets of
    keys, as rows of their own would cost more to shuffle and sort than to compare; the rows of ``hot`` keys are
    salted and dealt out by line. A task leaves out lines that it has seen lately; what is left
    over is the same again and harmless."""
    bands, _, words = _reach(edits, least, bands)
    least = bands[0][0]
    shared = docs.sparkSession.sparkContext.broadcast(hot) if hot is not None and len(hot) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[np.ndarray, ...]] = []
        rows_held = 0
        if shared is not None:
            many, table = shared.value, np.zeros(1 << 20, bool)
            table[many.view(np.uint64) >> np.uint64(44)] = True
        for batch in batches:
            lines: list[str] = []
            names: list[int] = []
            size = 0
            for text in [*batch.column("text"), None]:
                for _, line in _lines(text.as_py(), least, words) if text is not None else ():
                    if (name := line_name(line)) not in seen:
                        if len(seen) >= 1 << 19:
                            seen.clear()
                        seen.add(name)
                        lines.append(line)
                        names.append(name)
                        size += len(line)
                if lines and (size > 1 << 19 or text is None):
                    name, sketch = np.array(names, np.int64), sketches(lines).view(np.int64)
                    for rows, key, indexed, *_ in signatures(lines, bands):
                        salted = _among(key, many, table) if shared is not None else np.zeros(len(key), bool)
                        held.append((key, name[rows], sketch[rows], indexed, salted))
                        rows_held += len(key)
                    lines, names, size = [], [], 0
                    if rows_held >= PENDING:
                        yield from _blocks(held, bits)
                        held, rows_held = [], 0
        if held:
            yield from _blocks(held, bits)
        held = []
        seen.clear()
        trim()

    return docs.where("doc_id is not null").select("text").mapInArrow(run, "bucket int, salted boolean, block binary")


def _pairs_of(key, line, sketch, indexed, first, last):
    """Pairs (i, j) of rows within the runs first..last that pass the sketch, one row at least indexed."""
    size = last - first
    row = np.arange(int(first[0]), int(last[-1])) if len(first) else np.empty(0, np.int64)
    row = row[np.repeat(size > 1, size)] if len(first) else row
    end = np.repeat(last[size > 1], size[size > 1])
    span = end - row - 1
    i = np.repeat(row, span)
    j = np.arange(len(i)) - np.repeat(np.cumsum(span) - span, span) + i + 1
    ok = (indexed[i] | indexed[j]) & (line[i] != line[j])
    i, j = i[ok], j[ok]
    ok = sketch_distance(sketch[i], sketch[j]) <= 2 * (key[i] & 15)
    return i[ok], j[ok]


def candidate_pairs(keys: DataFrame) -> DataFrame:
    """Rows (line, other) of candidate pairs for keys of up to SMALL rows; the rows of larger and of salted
    keys as they are (key, line, sketch, indexed), ``other`` null. A task holds a bucket; of one that outgrows HELD rows, large keys
    are not kept."""
    names = ["key", "line", "other", "sketch", "indexed"]

    def batch_of(key, line, other, sketch, indexed):
        n = len(line)
        none = lambda kind: pa.nulls(n, kind)
        cols = [none(pa.int64()) if key is None else pa.array(key), pa.array(line), none(pa.int64()) if other is None else pa.array(other),
                none(pa.int64()) if sketch is None else pa.array(sketch), none(pa.bool_()) if indexed is None else pa.array(indexed)]
        return pa.RecordBatch.from_arrays(cols, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: list[bytes] = []  # of whole buckets, and of the one that goes on
        dealt: list[bytes] = []  # salted
        size, most, now, large = 0, HELD, None, np.empty(0, np.int64)  # keys of that one that are known to be large
        for batch in batches:
            for bucket, salted, block in zip(*(batch.column(c).to_pylist() for c in ("bucket", "salted", "block")), strict=True):
                if salted:
                    dealt.append(block)
                    if len(dealt) >= 256:
                        yield as_they_are(dealt)
                        dealt = []
                    continue
                if bucket != now:
                    if size >= 1 << 17:
                        yield from sorted_rows(_rows_of(blocks), large)
                        blocks, size, most, large = [], 0, HELD, np.empty(0, np.int64)
                    now = bucket
                blocks.append(block)
                size += len(block) // 25
                if size >= most:  # what is large already goes on, the rest stays
                    own = _rows_of(blocks)
                    name, count = np.unique(own[0], return_counts=True)
                    large = np.union1d(large, name[count > SMALL])
                    many = np.isin(own[0], large)
                    yield batch_of(own[0][many], own[1][many], None, own[2][many], own[3][many])
                    own = [x[~many] for x in own]
                    blocks, size = [b"".join(x.tobytes() for x in own)], len(own[0])
                    most = max(HELD, 2 * size)
        if dealt:
            yield as_they_are(dealt)
        if blocks:
            yield from sorted_rows(_rows_of(blocks), large)
        blocks = []
        trim()

    def as_they_are(blocks):
        key, line, sketch, indexed = _rows_of(blocks)
        return batch_of(key, line, None, sketch, indexed)

    def sorted_rows(own, large):
        if len(large):
            many = np.isin(own[0], large)
            yield batch_of(own[0][many], own[1][many], None, own[2][many], own[3][many])
            own = [x[~many] for x in own]
        order = np.argsort(own[0])
        yield from small([x[order] for x in own])

    def small(own):
        key, line, sketch, indexed = own
        if not len(key):
            return
        edge = np.flatnonzero(key[1:] != key[:-1]) + 1
        first, last = np.concatenate([[0], edge]), np.concatenate([edge, [len(key)]])
        large = last - first > SMALL
        if large.any():
            rows = np.flatnonzero(np.repeat(large, last - first))
            yield batch_of(key[rows], line[rows], None, sketch[rows], indexed[rows])
            rows = np.flatnonzero(~np.repeat(large, last - first))
            key, line, sketch, indexed = (x[rows] for x in own)
            if not len(key):
                return
            edge = np.flatnonzero(key[1:] != key[:-1]) + 1
            first, last = np.concatenate([[0], edge]), np.concatenate([edge, [len(key)]])
        i, j = _pairs_of(key, line, sketch.view(np.uint64), indexed, first, last)
        if len(i):
            a, b = np.minimum(line[i], line[j]), np.maximum(line[i], line[j])
            pair = np.unique(np.stack([a, b]), axis=1)
            yield batch_of(None, pair[0], pair[1], None, None)

    return keys.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "key long, line long, other long, sketch long, indexed boolean")


def line_bitmap(names: DataFrame) -> np.ndarray:
    """A bitmap with a bit for each ``line``: sixteen bits a line, within the bounds of BITMAP."""
    size = min(max(1 << (16 * names.count()).bit_length(), BITMAP[0]), BITMAP[1])
    words = names.groupBy(F.shiftright(F.pmod("line", F.lit(size)), 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pmod(line, 64) as int))")).alias("bits"))
    out, own = np.zeros(size // 64, np.int64), words.toArrow()
    out[own.column("word").to_numpy()] = own.column("bits").to_numpy()
    return out


def line_texts(docs: DataFrame, names: DataFrame, least: int = LEAST) -> DataFrame:
    """(uid, line, h2, text) of the lines in ``names``. The bitmap keeps most others out of the shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(line_bitmap(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        size = 64 * len(bits)
        seen: set[int] = set()
        for batch in batches:
            name, second, text = [], [], []
            for value in batch.column("text"):
                for _, line in _lines(value.as_py(), least):
                    h = line_name(line)
                    b = h % size
                    if int(bits[b >> 6]) >> (b & 63) & 1:
                        two = xxhash.xxh64_intdigest(line, 43)
                        if (h, two) in seen:
                            continue
                        if len(seen) >= 1 << 18:
                            seen.clear()
                        seen.add((h, two))
                        name.append(h)
                        second.append(two)
                        text.append(line)
            two = pa.array(np.array(second, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(name, pa.int64()), two, pa.array(text, pa.string())], names=["line", "h2", "text"])
        trim()

    found = docs.where("doc_id is not null").select("text").mapInArrow(run, "line long, h2 long, text string")
    found = found.join(names, "line", "left_semi").groupBy("line", "h2").agg(F.first("text").alias("text"))
    return found.withColumn("uid", F.monotonically_increasing_id())


def verified(batches: Iterator[pa.RecordBatch], bands) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1 << 13):
            part = batch.slice(at, 1 << 13)
            a, b = part.column("ta").to_pylist(), part.column("tb").to_pylist()
            ok = pa.array(within_many(a, b, np.array([allowed(bands, min(len(x), len(y))) for x, y in zip(a, b, strict=True)])))
            yield pa.RecordBatch.from_arrays([part.column("ua").filter(ok), part.column("ub").filter(ok)], names=["a", "b"])


def rests_of(large: DataFrame, bands) -> DataFrame:
    """(key, uid, rest, indexed, last) of rows (key, uid, text): what is left of a line without the segment of a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 12):
                part = batch.slice(at, 1 << 12)
                texts, uids, keys = part.column("text").to_pylist(), part.column("uid").to_pylist(), part.column("key").to_numpy()
                place: dict[str, int] = {}
                wanted: dict[tuple[int, int], list[int]] = {}
                for t, u, k in zip(texts, uids, keys.tolist(), strict=True):
                    wanted.setdefault((place.setdefault(t, len(place)), k), []).append(u)
                own, rows = list(place), []
                for row, key, indexed, start, size in signatures(own, bands):
                    for i in np.flatnonzero(np.isin(key, keys)).tolist():
                        text, a = own[row[i]], int(start[i])
                        for u in wanted.get((int(row[i]), int(key[i])), ()):
                            rows.append((int(key[i]), u, text[:a] + text[a + int(size[i]) :], bool(indexed[i]), 0))
                yield _rest_batch(rows)
        trim()

    return large.select("key", "uid", "text").mapInArrow(run, _REST)


_REST = "key long, uid long, rest string, indexed boolean, root long, last boolean"
_REST_NAMES = ["key", "uid", "rest", "indexed", "root", "last"]


def _rest_batch(rows: list[tuple], last: bool = False) -> pa.RecordBatch:
    """Rows of (key, uid, rest, indexed, root: the key that was cut)."""
    cols = list(zip(*dict.fromkeys(rows), strict=True)) or [[]] * 5
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64())
    return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(cols, kinds, strict=True)), pa.array([last] * len(cols[0]), pa.bool_())], names=_REST_NAMES)


def cut_again(rests: DataFrame) -> DataFrame:
    """The rows of ``rests`` under their next keys, and what is left without that segment too.

    Of two rests within e edits either both have over e characters and share one of e + 1 segments, or both have 2e at
    most: those meet under a key of their own as well, which is the ``last``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 12):
                part = batch.slice(at, 1 << 12)
                keys, uids, texts = part.column("key").to_numpy(), part.column("uid").to_pylist(), part.column("rest").to_pylist()
                for e in np.unique(keys & 15).tolist():
                    mine = np.flatnonzero(keys & 15 == e)
                    short = [i for i in mine.tolist() if len(texts[i]) <= 2 * e]
                    rows = [(_next_key(np.array([keys[i]]), np.array([7]), e)[0].item(), uids[i], texts[i], True, int(keys[i])) for i in short]
                    yield _rest_batch(rows, True)
                    own, rows = [texts[i] for i in mine.tolist()], []
                    for row, key, indexed, start, size in signatures(own, ((e + 1, e),)):
                        whose = mine[row]
                        for i, k, flag, a, n in zip(whose.tolist(), _next_key(keys[whose], key, e).tolist(), indexed.tolist(), start.tolist(), size.tolist(), strict=True):
                            rows.append((k, uids[i], texts[i][:a] + texts[i][a + n :], flag, int(keys[i])))
                    yield _rest_batch(rows)
        trim()

    return rests.mapInArrow(run, _REST)


def _next_key(key: np.ndarray, more: np.ndarray, edits: int) -> np.ndarray:
    h = (key.view(np.uint64) * np.uint64(_P) ^ more.view(np.uint64)) * _MIX
    h ^= h >> np.uint64(32)
    return (h * _MIX & ~np.uint64(15) | np.uint64(edits)).view(np.int64)


def split_keys(rows: DataFrame) -> DataFrame:
    """Candidates (a, b), whose rests are within the edits, under keys of up to SMALL rows, and the rows of larger keys as
    they are (``a`` null). Two lines can differ by more edits than their rests, never by fewer. Rows of keys that a hash sample shows to be hot are not shuffled; no key is held in memory."""
    sample = rows.where(F.pmod(F.xxhash64("uid"), F.lit(SAMPLE)) == 0).groupBy("key").count().where(F.col("count") > SMALL)
    hot = F.broadcast(sample.orderBy(F.desc("count"), "key").limit(HOT_KEYS).select("key"))
    none = F.lit(None).cast("long")

    def large(t: pa.Table) -> Iterator[pa.RecordBatch]:
        n = pa.nulls(t.num_rows, pa.int64())
        for batch in pa.table({"a": n, "b": n, **{c: t.column(c) for c in _REST_NAMES}}).to_batches():
            yield batch

    def small(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key, uid, rest = t.column("key").to_numpy(), t.column("uid").to_numpy(), t.column("rest").to_pylist()
        edge = np.flatnonzero(key[1:] != key[:-1]) + 1
        first, last = np.concatenate([[0], edge]), np.concatenate([edge, [len(key)]])
        many = np.repeat(last - first > SMALL, last - first)
        if many.any():
            yield from large(t.filter(pa.array(many)))
            yield from small(t.filter(pa.array(~many))) if not many.all() else ()
            return
        i, j = _pairs_of(key, uid, sketches(rest), t.column("indexed").to_numpy(), first, last)
        for at in range(0, len(i), 1 << 13):
            x, y = i[at : at + (1 << 13)], j[at : at + (1 << 13)]
            ok = within_many([rest[k] for k in x.tolist()], [rest[k] for k in y.tolist()], key[x] & 15)
            a, b = np.minimum(uid[x[ok]], uid[y[ok]]), np.maximum(uid[x[ok]], uid[y[ok]])
            empty = [pa.nulls(len(a), kind) for kind in (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.bool_())]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *empty], names=["a", "b", *_REST_NAMES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        going: int | None = None  # a large key whose rows go on
        for batch in batches:
            t = pa.Table.from_batches([batch])
            if going is not None:
                n = int(np.searchsorted(t.column("key").to_numpy(), going, "right"))
                yield from large(t.slice(0, n))
                t = t.slice(n)
                if not t.num_rows:
                    continue
                going = None
            held.append(t)
            if sum(x.num_rows for x in held) < 1 << 14:
                continue
            t = pa.concat_tables(held).combine_chunks()
            key = t.column("key").to_numpy()
            n = int(np.searchsorted(key, key[-1], "left"))
            if n:
                yield from small(t.slice(0, n))
            held = [t.slice(n)]
            if held[0].num_rows > SMALL:
                going = int(key[-1])
                yield from large(held.pop())
        if held:
            yield from small(pa.concat_tables(held).combine_chunks())
        trim()

    rest = rows.join(hot, "key", "left_anti").select(*rows.columns).repartition("key").sortWithinPartitions("key").mapInArrow(run, f"a long, b long, {_REST}")
    return rest.unionByName(rows.join(hot, "key", "left_semi").select(none.alias("a"), none.alias("b"), *rows.columns))


def refined(large: DataFrame, bands, levels: int) -> tuple[list[DataFrame], DataFrame | None]:
    """(candidates (a, b), rows of keys that are large to the end or None) of rows (key, uid, text) of large keys.

    Cutting helps where lines share a part and differ in the rest. Where it leaves more than GROWTH times a key's rows under
    large keys, lines are alike in all parts: such a key is compared as it is, where most rows are joined at once. So
    are keys of more than REFINED edits, whose lines have many segments."""
    cut = F.col("key").bitwiseAND(F.lit(15)) <= REFINED
    edges, now = [], written(rests_of(large, bands), "rests")
    ends, now = [now.where(~cut)], now.where(cut)
    for level in range(levels):
        if now.isEmpty():
            break
        found = written(split_keys(written(cut_again(now), "cut")), "split")
        edges.append(found.where("a is not null").select("a", "b"))
        more = found.where("a is null").drop("a", "b")
        sizes = now.groupBy("key").agg(F.count("*").alias("n"))
        stuck = more.groupBy("root").agg(F.count("*").alias("m")).join(sizes, F.col("root") == F.col("key")).where(F.col("m") > GROWTH * F.col("n")).select("root")
        stuck = written(stuck, "stuck")
        ends.append(now.join(stuck, now["key"] == stuck["root"], "left_semi"))
        more = more.join(stuck, "root", "left_anti").select(*_REST_NAMES)
        ends.append(more.where("last"))
        now = written(more.where("not last"), "more")
    ends.append(now)
    rest = ends[0].select(*_REST_NAMES)
    for x in ends[1:]:
        rest = rest.unionByName(x.select(*_REST_NAMES))
    return edges, None if rest.isEmpty() else rest


def cell_edges(line: np.ndarray, text: list[str], sketch: np.ndarray, indexed: np.ndarray, edits: int, step: int = 4096) -> tuple[list[int], list[int]]:
    """Edges that connect the rows of a cell as their links do. Pairs are verified ``step`` at a time, and rows that are
    joined by then are not compared again."""
    row = np.unique(line, return_index=True, return_inverse=True)
    label = row[1][row[2]]  # equal lines are one from the start
    a, b = [], []
    i, n = 0, len(line)
    while i < n - 1:
        held: list[np.ndarray] = []
        while i < n - 1 and sum(map(len, held)) < step:
            rest = np.arange(i + 1, n)
            rest = rest[label[rest] != label[i]]
            if not indexed[i]:
                rest = rest[indexed[rest]]
            rest = rest[sketch_distance(sketch[i : i + 1], sketch[rest]) <= 2 * edits]
            if len(rest):
                held.append(np.stack([np.full(len(rest), i), rest], axis=1))
            i += 1
        if not held:
            break
        pairs = np.concatenate(held)
        for at in range(0, len(pairs), step):
            x, y = pairs[at : at + step].T
            apart = label[x] != label[y]
            x, y = x[apart], y[apart]
            ok = within_many([text[k] for k in x.tolist()], [text[k] for k in y.tolist()], np.full(len(x), edits))
            for k, m in zip(x[ok].tolist(), y[ok].tolist(), strict=True):
                if label[k] != label[m]:
                    label[label == max(label[k], label[m])] = min(label[k], label[m])
                    a.append(int(line[k]))
                    b.append(int(line[m]))
    return a, b


def near_links(docs: DataFrame, edits: int = EDITS, least: int = LEAST, bands=None, hot: np.ndarray | None = None, bits: int = BITS[0]) -> tuple[DataFrame, DataFrame]:
    """(edges (a, b) between uids that connect all lines within the edits that their band allows, texts by uid).

    A line has at most SMALL partners under each of its keys in ``pairs``, so no line is a hot key of its join."""
    bands, _, _ = _reach(edits, least, bands)
    own = ["key", "line", "sketch", "indexed"]
    found = written(candidate_pairs(line_keys(docs, bands=bands, hot=hot, bits=bits)), "candidates")
    some = not found.where("other is null").isEmpty()
    large = found.where("other is null").select(*own).distinct()
    both = found.where("other is not null")
    pairs = both.select(F.col("line").alias("a"), F.col("other").alias("b")).distinct()
    names = both.select("line").union(both.select("other"))
    names = (names.union(large.select("line")) if some else names).distinct()
    texts = written(line_texts(docs, written(names, "names"), bands[0][0]), "texts")
    side = lambda x: texts.select(F.col("line").alias(x), F.col("uid").alias(f"u{x}"), F.col("text").alias(f"t{x}"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number, as few bytes can be much work here
    checked = pairs.join(side("a"), "a").repartition(tasks, "b").join(side("b"), "b").select("ua", "ub", "ta", "tb")
    few = checked.mapInArrow(lambda batches: verified(batches, bands), "a long, b long")
    if not some:
        return few, texts
    big = written(large.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CELL).select("key"), "big")
    close, more, left = [], None, large.select("key", "line", "indexed")
    if not big.isEmpty():  # keys of one chunk are compared as they are
        close, more = refined(left.join(big, "key", "left_semi").select("key", "line").distinct().join(texts, "line"), bands, LEVELS)
        left = left.join(big, "key", "left_anti")
    left = left.join(texts, "line").select("key", "uid", "indexed")
    if more is not None:
        left = left.unionByName(more.select("key", "uid", "indexed"))
    for x in close:
        side = lambda x: texts.select(F.col("uid").alias(f"u{x}"), F.col("text").alias(f"t{x}"))
        own = x.select(F.col("a").alias("ua"), F.col("b").alias("ub")).distinct().join(side("a"), "ua").repartition(tasks, "ub").join(side("b"), "ub")
        few = few.unionByName(own.select("ua", "ub", "ta", "tb").mapInArrow(lambda batches: verified(batches, bands), "a long, b long"))
    left = left.distinct()
    parts = left.groupBy("key").agg(F.ceil(F.count("*") / CELL).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int")
    cells = left.join(parts, "key").withColumn("own", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cells = cells.select("key", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"), "uid", "indexed").join(texts.select("uid", "text"), "uid")

    def compare(group: pa.Table) -> pa.Table:
        text = group.column("text").to_pylist()
        a, b = cell_edges(group.column("uid").to_numpy(), text, sketches(text), group.column("indexed").to_numpy(), group.column("key")[0].as_py() & 15)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return few.unionByName(cells.repartition(tasks, "key", "c1", "c2").groupBy("key", "c1", "c2").applyInArrow(compare, "a long, b long")), texts


def repeated_lines(docs: DataFrame, edits: int = EDITS, least: int = LEAST, bands=None) -> DataFrame:
    """(doc_id, line_no, line, near): the occurrences that go; ``near`` if no equal line came first."""
    both = ["h1", "h2"]
    with scratch() as own:
        found = written(occurrences(docs, edits, least, bands), "lines")
        seen = found.where("key is null").select("doc_id", "line_no", *both)
        firsts = written(seen.groupBy(*both).agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("n")), "firsts")
        edges, texts = near_links(docs, edits, least, bands, hot_keys(found), bucket_bits(found))
        roots = components(edges).join(texts.select(F.col("uid").alias("node"), F.col("line").alias("h1"), "h2"), "node").select(*both, "root")
        classes = firsts.join(roots, both)
        leads = classes.groupBy("root").agg(F.min("first").alias("lead"))
        classes = classes.join(leads, "root").select(*both, "first", "lead", "n")
        more = firsts.where("n > 1").join(roots, both, "left_anti").select(*both, "first", F.col("first").alias("lead"), "n")
        lost = written(classes.union(more), "lost")
        gone = joined(seen, lost, both)  # a frequent line would be one join key
        gone = gone.withColumn("own", F.struct("doc_id", "line_no")).where("own <> lead")
        return own.kept(written(gone.select("doc_id", "line_no", F.col("h1").alias("line"), (F.col("own") == F.col("first")).alias("near")), "gone"))


def dedup_lines(docs: DataFrame, edits: int = EDITS, least: int = LEAST, bands=None) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text`` (and ``n_chars``, if there, counted again).
    Documents that lose their last word go."""
    gone = repeated_lines(docs, edits, least, bands)
    lists = gone.groupBy("doc_id").agg(F.collect_set(F.struct("line_no", "line")).alias("gone"))
    rows = boxed(docs).join(lists, F.col("row.doc_id") == F.col("doc_id"), "left").select("row", "gone")

    def left(lines: Column) -> Column:  # places are taken out as a set, so the time is linear
        own = F.filter("gone", lambda g: F.coalesce(F.xxhash64(F.get(lines, g["line_no"])) == g["line"], F.lit(False)))
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.transform(own, lambda g: g["line_no"]))
        return F.array_join(F.transform(places, lambda i: F.get(lines, i)), "\n")

    cut = F.col("gone").isNotNull()
    rows = rows.withColumn("text", F.when(cut, let(F.split("row.text", "\n"), left)).otherwise(F.col("row.text")))
    rows = rows.where(~cut | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col("text"), "n_chars": F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("row.n_chars"))}
    return rows.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])


def line_report(docs: DataFrame, edits: int = EDITS, least: int = LEAST, bands=None) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, n_near (removed without an equal line before)."""
    gone = repeated_lines(docs, edits, least, bands).groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("n"), F.count_if("near").alias("m"))
    lines = F.when(F.length("text") > 0, F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).otherwise(0)
    rows = docs.select("doc_id", lines.cast("long").alias("n_lines")).join(gone, F.col("doc_id") == F.col("_id"), "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return rows.select("doc_id", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), count("n").alias("n_removed"), count("m").alias("n_near"))
