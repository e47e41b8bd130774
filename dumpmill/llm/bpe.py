"""Byte-level BPE encoding and decoding (operator 5).

Pre-tokens are found without a regular expression. Each code point becomes a symbol: its class
(letter, number, other, white space) refined by the characters after it. A small automaton over
symbols says where a pre-token begins. Its transition functions form a finite monoid, so the state
before every character is an associative scan over monoid elements, one table lookup each: rows of
64 characters are scanned side by side, then the rows' totals, then both are combined. Whole
batches of texts go through one scan; each text's first symbol resets the state.

The pre-tokens' UTF-8 slices are merged by rank; results sit in a bounded cache per worker process.
Token end offsets (in bytes) are kept next to the ids, and decoding uses them.

Null texts encode as empty ones. Ids beyond the vocabulary raise an error when decoded. Empty
tables give no rows; repeated rows are encoded row by row; memory follows the longest text.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .common import aside, trim

L, N, O, A1, A2, IN, SP, WS = range(8)  # noqa: E741  symbols; + 8: first of its text
#: A1, A2: an apostrophe before s t m d, or before re ve ll. IN: white space that is not the last of
#: its run, or ends the text. SP, WS: a space, or other white space, that ends its run.
FRESH, LETTERS, NUMBERS, OTHERS, BLANKS, SPACED, ONE, TWO = range(8)
#: States: nothing open, inside a run of letters / numbers / others / white space, after a space that
#: joins the next run, one or two letters of a contraction to come.
CACHED, LONGEST, ROW, NEVER = 1 << 18, 64, 64, 1 << 40


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a pre-token begins at the symbol."""
    if symbol >= 8:
        state, symbol = FRESH, symbol - 8
    begin = {L: LETTERS, N: NUMBERS, O: OTHERS, A1: ONE, A2: TWO, IN: BLANKS, SP: SPACED, WS: FRESH}[symbol]
    run = {L: LETTERS, N: NUMBERS, O: OTHERS, A1: OTHERS, A2: OTHERS}.get(symbol)
    if state == ONE and symbol == L:
        return FRESH, False
    if state == TWO and symbol == L:
        return ONE, False
    if state == SPACED and run is not None:
        return run, False
    if state == run and state in (LETTERS, NUMBERS, OTHERS):
        return run, False
    if state == BLANKS and symbol == IN:
        return BLANKS, False
    return begin, True


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(begins[state, symbol], element of each symbol, product[a, b], images[element, state])."""
    steps = [[_step(s, x) for s in range(8)] for x in range(16)]
    begins = np.array([[steps[x][s][1] for x in range(16)] for s in range(8)])
    found: dict[tuple[int, ...], int] = {tuple(range(8)): 0}
    images = [tuple(range(8))]
    own = []
    for x in range(16):
        f = tuple(s for s, _ in steps[x])
        own.append(found.setdefault(f, len(images)))
        if len(found) > len(images):
            images.append(f)
    at = 0
    generators = list(dict.fromkeys(images[i] for i in own))
    while at < len(images):
        for g in generators:
            f = tuple(g[s] for s in images[at])
            if f not in found:
                found[f] = len(images)
                images.append(f)
        at += 1
    product = np.array([[found[tuple(b[s] for s in a)] for b in images] for a in images], np.uint16)
    return begins, np.array(own, np.uint16), product, np.array(images, np.uint8)


def scan(elements: np.ndarray, product: np.ndarray) -> np.ndarray:
    """The product of all elements before each one (exclusive associative scan)."""
    n = len(elements)
    if n == 0:
        return elements
    size = len(product)
    flat = product.ravel()
    rows = -(-n // ROW)
    padded = np.zeros(rows * ROW, np.uint16)
    padded[:n] = elements
    columns = np.ascontiguousarray(padded.reshape(rows, ROW).T)
    before = np.empty_like(columns)
    total = np.zeros(rows, np.intp)
    for i in range(ROW):
        before[i] = total
        total = flat[total * size + columns[i]].astype(np.intp)
    if rows > 1:
        start = scan(total.astype(np.uint16), product).astype(np.intp)
        before = flat[start[None, :] * size + before]
    return np.ascontiguousarray(before.T).ravel()[:n]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """0 letter, 1 number, 2 other, 5 white space, for each code point.

    Unicode versions differ, so the classes are those of the library whose ids are to be matched:
    it passes over all code points once for each class and returns those that the class holds.
    """
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    out = np.full(0x110000, O, np.uint8)
    for kind, name in ((L, r"\p{L}+"), (N, r"\p{N}+"), (IN, r"\s+")):
        own = tiktoken.Encoding(name, pat_str=name, mergeable_ranks=single, special_tokens={})
        found = own.decode_bytes(own.encode_ordinary(every)).decode()
        out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return out


def symbols(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The symbol of each code point; ``firsts`` marks the first of each text."""
    kind = classes()[points]
    n = len(points)
    ends = np.ones(n, bool)
    ends[:-1] = firsts[1:]
    after = np.zeros(n, np.uint32)
    after[:-1] = points[1:]
    after[ends] = 0
    blank = kind == IN
    inner = np.ones(n, bool)
    inner[:-1] = blank[1:]
    inner |= ends
    out = kind.copy()
    last = blank & ~inner
    out[last] = np.where(points[last] == 32, SP, WS)
    quote = np.flatnonzero((points == 39) & ~ends)
    if len(quote):
        one, two = after[quote], np.where(quote + 2 < n, points[np.minimum(quote + 2, n - 1)], 0)
        two = np.where(ends[np.minimum(quote + 1, n - 1)], 0, two)
        short = np.isin(one, [115, 116, 109, 100])  # s t m d
        long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)  # re ve ll
        out[quote[short]] = A1
        out[quote[long]] = A2
    return out + np.uint8(8) * firsts


def pre_token_starts(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Which code points begin a pre-token."""
    begins, element, product, images = automaton()
    own = symbols(points, firsts)
    state = images[scan(element[own], product), FRESH]
    return begins[state, own]


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def vocabulary(path: str) -> list[bytes | None]:
    own = ranks(path)
    out: list[bytes | None] = [None] * (max(own.values()) + 1)
    for k, v in own.items():
        out[v] = k
    return out


def merged(piece: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of ``piece`` by pair merging: always join the adjacent pair of lowest rank, leftmost first."""
    if len(piece) > LONGEST:
        return _merged_long(piece, rank)
    get = rank.get
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [get(piece[i : i + 2], NEVER) for i in range(len(piece) - 1)]
    while pairs and (low := min(pairs)) != NEVER:
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], NEVER)
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], NEVER)
    return [rank[p] for p in parts]


def _merged_long(piece: bytes, rank: dict[bytes, int]) -> list[int]:
    """The same for long pieces (a run of one character, say) in n log n steps: candidate pairs wait
    in a heap and parts are linked both ways."""
    from heapq import heapify, heappop, heappush

    n = len(piece)
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        if not alive[i] or end[i] >= stop or end[i] >= n or end[end[i]] != stop:
            continue
        alive[end[i]] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := rank.get(piece[i : end[stop]])) is not None:
                heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := rank.get(piece[p:stop])) is not None:
            heappush(heap, (r, p, stop))
    return [rank[piece[i : end[i]]] for i in range(n) if alive[i]]


class Pieces(dict):
    """Ids of pre-tokens as packed uint32, in two generations: a full one becomes the old one, from
    which pieces that are asked for again move back. Bounded in entries and in the length of keys.

    Pair merging gives the one sequence of tokens of which every two neighbours merge to just
    themselves. Whether two tokens do is cached too, so a new pre-token is mostly put together
    from its longest tokens by looking up their pairs, going back where a pair does not hold.
    """

    def __init__(self, path: str):
        super().__init__()
        self.rank = ranks(path)
        self.old: dict[bytes, bytes] = {}
        self.stable: dict[tuple[bytes, bytes], bool] = {}
        self.longest: dict[bytes, int] = {}
        for token in self.rank:
            self.longest[token[:2]] = max(len(token), self.longest.get(token[:2], 1))

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = array("I", self.tokens(piece)).tobytes()
        if len(piece) <= LONGEST:
            if len(self) >= CACHED:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def tokens(self, piece: bytes) -> list[int]:
        rank, stable, longest = self.rank, self.stable, self.longest
        if piece in rank:
            return [rank[piece]]
        if len(piece) > LONGEST:
            return merged(piece, rank)
        n, at, last = len(piece), 0, b""
        out: list[bytes] = []
        end = min(n, longest.get(piece[:2], 1))
        while at < n:
            while end > at:
                token = piece[at:end]
                if token in rank and ((ok := stable.get((last, token))) or ok is None and self.holds(last, token)):
                    break
                end -= 1
            else:
                if not out:
                    return merged(piece, rank)
                end, at = at - 1, at - len(out.pop())
                last = out[-1] if out else b""
                continue
            out.append(token)
            at, last = end, token
            end = min(n, at + longest.get(piece[at : at + 2], 1))
        return [rank[t] for t in out]

    def holds(self, last: bytes, token: bytes) -> bool:
        """Whether merging the bytes of both tokens gives these two again (or the one, if first)."""
        own = [self.rank[last], self.rank[token]] if last else [self.rank[token]]
        if len(self.stable) >= CACHED:
            self.stable.clear()
        ok = self.stable[last, token] = merged(last + token, self.rank) == own
        return ok


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


@lru_cache(maxsize=2)
def token_lengths(path: str) -> np.ndarray:
    return np.array([len(x or b"") for x in vocabulary(path)], np.int64)


def encode_texts(texts: list[str | None], path: str) -> list[np.ndarray]:
    """The ids of each text."""
    data = [(t or "").encode() for t in texts]
    wide = [(t or "").encode("utf-32-le") for t in texts]
    counts = np.array([len(w) // 4 for w in wide])
    points = np.frombuffer(b"".join(wide), np.uint32)
    firsts = np.zeros(len(points), bool)
    begin = np.cumsum(counts) - counts
    firsts[begin[counts > 0]] = True
    starts = np.flatnonzero(pre_token_starts(points, firsts))
    width = np.ones(len(points), np.int64)
    for limit in (0x80, 0x800, 0x10000):
        width += points >= limit
    offset = (np.cumsum(width) - width)[starts].tolist()
    blob = b"".join(data)
    offset.append(len(blob))
    cut = np.searchsorted(starts, np.concatenate([begin, [len(points)]])).tolist()
    own = pieces(path)
    get = own.__getitem__
    parts = [get(blob[a:b]) for a, b in zip(offset, offset[1:], strict=False)]
    return [np.frombuffer(b"".join(parts[a:b]), np.uint32) for a, b in zip(cut, cut[1:], strict=False)]


def decode_ids(ids: np.ndarray, cuts: np.ndarray, sizes: np.ndarray, path: str, step: int = 1 << 17) -> list[bytes]:
    """The bytes of each run ids[cuts[i]:cuts[i + 1]], ``sizes`` long; ``step`` ids at a time."""
    words = vocabulary(path)
    blob = b"".join(b"".join(map(words.__getitem__, ids[a : a + step].tolist())) for a in range(0, len(ids), step))
    at = [0, *np.cumsum(sizes).tolist()]
    if at[-1] != len(blob):
        raise ValueError("token_ends do not fit token_ids")
    return [blob[a:b] for a, b in zip(at, at[1:], strict=False)]


def encode(docs: DataFrame, path: str, text: str = "text", step: int = 1 << 19, decoded: str | None = None) -> DataFrame:
    """``docs`` without its text (columns named like new ones kept as ``<name>_``) but with ``token_ids`` (array<int>) and ``token_ends`` (array<int>,
    the byte at which each token ends). Batches are encoded about ``step`` characters at a time.
    ``decoded`` names a further binary column: the bytes that the ids decode to, made in the same pass."""
    docs = aside(docs, "token_ids", "token_ends", *([decoded] if decoded else []))
    names = [c for c in docs.columns if c != text]
    lists = ArrayType(IntegerType())
    added = [StructField("token_ids", lists), StructField("token_ends", lists)]
    added += [StructField(decoded, BinaryType())] if decoded else []
    schema = StructType([*docs.select(names).schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text)
            size = np.cumsum(pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + step, "right")))
                own = encode_texts(column.slice(at, to - at).to_pylist(), path)
                ids = np.concatenate(own)
                cuts = np.concatenate([[0], np.cumsum([len(x) for x in own])])
                reach = np.concatenate([[0], np.cumsum(token_lengths(path)[ids])])
                ends = reach[1:] - np.repeat(reach[cuts[:-1]], np.diff(cuts))
                cols = [batch.column(c).slice(at, to - at) for c in names]
                cols += [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x.astype(np.int32))) for x in (ids, ends)]
                if decoded:
                    cols.append(pa.array(decode_ids(ids, cuts, np.diff(reach[cuts]), path), pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=[*names, *(f.name for f in added)])
                at = to
        trim()

    return docs.select(*names, text).mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, name: str = "decoded") -> DataFrame:
    """``tokens`` with the binary column ``name``: the tokens' bytes joined, as long as ``token_ends`` says."""

    @F.arrow_udf(BinaryType())
    def joined(ids: pa.Array, size: pa.Array) -> pa.Array:
        cuts = ids.offsets.to_numpy()
        return pa.array(decode_ids(ids.flatten().to_numpy(), cuts - cuts[0], size.to_numpy(), path), pa.binary())

    last = F.when(F.size("token_ends") > 0, F.element_at("token_ends", -1)).otherwise(0)
    return tokens.withColumn(name, joined("token_ids", last))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each document, by a whole round trip."""
    own = encode(docs.select("doc_id", "text"), path, decoded="decoded")
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return own.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
