"""Packing documents into sequences of a fixed capacity by harmonic classes (operator 13).

A document is its token ids and an end id. Whole sequences are cut off it first. Class k takes lengths in
(capacity/(k+1), capacity/k], and a bin of class k always holds k of them, so a worker fills bins without knowing other
workers' and without searching for a place. As documents may be cut, what is left of one, of r ids, gives a piece of
exactly floor(capacity/k) for the smallest such k that r reaches, and so on, until ``FINE`` ids or fewer are left, which go
to their class as they are: a full bin of class k lacks fewer than k tokens, and one of the fine classes less than one of
its pieces. What a worker has in bins that did not fill up, fewer than k pieces a class, is joined end to end,
cut into whole sequences, and the rest into sequences whose lengths are powers of two, which need no padding.

Nothing is shuffled, and a task that is repeated gives the same sequences: their numbers are made of the partition's
and a count within it. Ids come from worker caches of white-space-delimited words, which hold for vocabularies that drop
white space; others raise ValueError.

Nulls: a null text is empty and has the end id only; a null doc_id is kept. Repeated rows are packed row by row, ties do
not arise, an empty table gives no rows, and a text of any length is cut as often as it takes. Only the id and text
columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import splits_at_space

CAPACITY, END, FINE = 2048, 1, 64
#: Entries of a generation of each of a worker's two caches, and the longest word that they keep, in bytes.
CACHED, LONGEST = 1 << 20, 64
_MARKS = b".,;:!?"
#: Last letters of words after which a mark is a piece of its own, besides ASCII: Latin letters up to U+024F. The signs ×
#: and ÷ are none, and U+0130 ends in a combining dot in lower case.
_LATIN = {chr(c) for c in range(0xC0, 0x250)} - {"×", "÷", "\u0130"}


#: Words of the letters a-z and U+00DF to U+00FF without the sign ÷.
_SMALL = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: Bytes as byte-level vocabularies spell them: those that print in Latin-1 as themselves, the others from U+0100 on.
_PRINTS = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {b: chr(b) for b in _PRINTS} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_PRINTS}))}


@lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    return own


class Cache(dict):
    """The results of ``make`` by word: two generations of CACHED entries, so that what is in use stays as words come and go."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, word: bytes) -> bytes:
        own = self.old.get(word)
        if own is None:
            own = self.make(word)
        if len(word) <= LONGEST:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[word] = own
        return own


class Ids:
    """Ids of texts by white-space-delimited words (UTF-8), as little-endian unsigned 32-bit integers.

    Where the vocabulary is found to treat case and marks so, A-Z are put in lower case first, and a word not seen before
    is looked up without the marks at its end. What is new then goes to the library's merges if it is of small Latin
    letters, which normalization leaves alone and no pattern splits, and else through all of the library. Texts that hold
    special strings, which are told by case, or marks that combine with letters of one case only stay in their case."""

    def __init__(self, path: str):
        own = _library(path)
        ids = lambda w: own.encode(w, add_special_tokens=False).ids
        self.folds = all(ids(w) == ids(w.lower()) for w in ("Word", "MIXED9a", "QX", "Zz-Top"))
        marks = _MARKS if all(ids(w + m) == ids(w) + ids(m) for w in ("word", "r2", "é") for m in (*_MARKS.decode(), "...", "?!")) else b""
        merge = own.model.tokenize
        merged = lambda w: [t.id for t in merge("".join(map(_BYTE.__getitem__, w)))]
        direct = all(merged(w.encode()) == ids(w) for w in ("a", "word", "straße", "ñandú", "quelqueñada", "antidisestablishment"))

        def of_core(word: bytes) -> bytes:
            own = merged(word) if direct and _SMALL.fullmatch(word) else ids(word.decode())
            return b"".join([i.to_bytes(4, "little") for i in own])

        cores = Cache(of_core)

        def of_word(word: bytes) -> bytes:
            core = word.rstrip(marks)
            if core and core != word and (core[-1:].isalnum() if core[-1] < 128 else core.decode()[-1] in _LATIN):
                return cores[core] + cores[word[len(core) :]]
            return cores[word]

        self.words = Cache(of_word)

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        own = text.encode()
        if self.folds and b"<|" not in own and b"\xcc" not in own and b"\xcd" not in own:  # U+0300 to U+036F
            own = own.lower()
        return b"".join(map(self.words.__getitem__, own.split()))


_caches: dict[str, Ids] = {}


def cuts(n: int, capacity: int = CAPACITY, fine: int = FINE) -> list[tuple[int, int]]:
    """(class, length) of the pieces of a document of n ids, in order."""
    out = [(1, capacity)] * (n // capacity)
    n %= capacity
    while n > fine:
        length = capacity // -(-capacity // n)  # for the smallest k with capacity // k <= n
        out.append((capacity // length, length))
        n -= length
    return [*out, (capacity // n, n)] if n else out


def powers(n: int) -> list[int]:
    """n as powers of two, the largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """The bins of one partition. A piece is (doc, start, ids, doc_tokens); ``out`` has the placed ones as
    (doc, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, part: int, capacity: int, fine: int):
        self.capacity, self.fine, self.open, self.out = capacity, fine, {}, []
        self.next = part << 33

    def place(self, pieces) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.out.append((doc, start, ids, total, self.next, at))
            at += len(ids) // 4
        self.next += 1

    def add(self, doc, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        for k, length in cuts(total, self.capacity, self.fine):
            own = self.open.setdefault(k, [])
            own.append((doc, start, ids[4 * start : 4 * (start + length)], total))
            start += length
            if len(own) == k:
                self.place(own)
                own.clear()

    def finish(self) -> None:
        """What is left in open bins, end to end: whole sequences, then powers of two."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        size = sum(len(p[2]) // 4 for p in left)
        rooms = [self.capacity] * (size // self.capacity) + powers(size % self.capacity)
        held, room = [], rooms.pop(0) if rooms else 0
        for doc, start, ids, total in left:
            while ids:
                held.append((doc, start, ids[: 4 * room], total))
                taken = len(held[-1][2]) // 4
                ids, start, room = ids[4 * taken :], start + taken, room - taken
                if not room:
                    self.place(held)
                    held, room = [], rooms.pop(0) if rooms else 0
        self.open.clear()


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, fine: int = FINE, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: the id column, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id, offset."""
    if not splits_at_space(path):
        raise ValueError(f"{path} does not split texts at white space and drop it")
    kind = docs.schema[doc].dataType.simpleString()
    last = end.to_bytes(4, "little")

    def run(batches):
        if path not in _caches:
            _caches.clear()
            _caches[path] = Ids(path)
        encode, packer = _caches[path].of, None

        def placed():
            cols = list(zip(*packer.out, strict=True)) or [[]] * 6
            packer.out = []
            lengths = [len(x) // 4 for x in cols[2]]
            arrays = [pa.array(cols[0], doc_type), *(pa.array(c, pa.int64()) for c in (cols[1], lengths)), pa.array(cols[2], pa.binary()), *(pa.array(c, pa.int64()) for c in cols[3:])]
            return pa.RecordBatch.from_arrays(arrays, ["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            doc_type = batch.column("doc").type
            for i, t, part in zip(batch.column("doc").to_pylist(), batch.column("t"), batch.column("part").to_pylist(), strict=True):
                packer = packer or Packer(part, capacity, fine)
                packer.add(i, encode(t.as_py()) + last)
                if len(packer.out) >= 8192:
                    yield placed()
        if packer:
            packer.finish()
            yield placed()

    own = docs.select(F.col(doc).alias("doc"), F.col(text).alias("t"), F.spark_partition_id().alias("part"))
    out = own.mapInArrow(run, f"doc {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
    return out.withColumnRenamed("doc", doc)
