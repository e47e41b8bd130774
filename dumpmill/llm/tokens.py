"""Token counts by a two-tier map-side lookup (operator 4).

The vocabulary drops white space, so a text's count is the sum over its white-space-delimited
pre-tokens. Tier one is a compact table of the lengths of frequent pre-tokens, counted over a
bounded sample of documents (it only decides what is fast, never a count) and broadcast at a fixed
size. Tier two encodes misses by the tokenizer library and keeps them in a bounded cache per worker
process. Pre-tokens are never shuffled.

An input column named like the new one is kept as ``<name>_``. Texts of any length are counted word by word.
A null text counts as empty (0 bytes, 0 tokens). Ties and repeated rows are counted row by row; an
empty table gives no rows. Special strings inside texts are handled as the library does by default.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import aside

#: Bounds of the sample, of the broadcast table and of each worker's cache (entries, bytes of a key).
SAMPLE_DOCS, SAMPLE_CHARS, FREQUENT, CACHED, LONGEST = 2000, 20_000, 1 << 15, 1 << 18, 64


@lru_cache(maxsize=2)
def library(path: str):
    """The tokenizer of a .json (tokenizers) or .model (sentencepiece) file as str -> count."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text, num_threads=1))
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    return lambda text: len(own.encode(text, add_special_tokens=False).ids)


class Lengths(dict):
    """Token counts of pre-tokens (UTF-8); a miss is encoded and kept while there is room."""

    def __init__(self, path: str, words: bytes = b"", counts: bytes = b""):
        super().__init__(zip(words.split(b"\n"), counts, strict=False) if counts else ())
        self.path, self.fixed = path, len(self)
        self.frequent = dict(self)

    def __missing__(self, word: bytes) -> int:
        n = library(self.path)(word.decode())
        if len(word) <= LONGEST:
            if len(self) - self.fixed >= CACHED:
                self.clear()
                self.update(self.frequent)
            self[word] = n
        return n


_tables: dict[str, Lengths] = {}


#: Texts on which a tokenizer that keeps white space, or joins across it, shows.
_PROBES = ("a b", " lead", "trail ", "two  blanks", "line\nbreak", "tab\tand \r\n more", "don't  stop", "1 2  33", "é  \u0301x", "日本 語", "( a ) [b]", "\x0b\x0cx")


@lru_cache(maxsize=4)
def splits_at_space(path: str) -> bool:
    """Whether the ids of a text are those of its white-space-delimited pre-tokens one after the other, so that counts
    add up over them. Tried on _PROBES; sentencepiece models, whose pieces may span blanks, are not taken."""
    if path.endswith(".model"):
        return False
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    ids = lambda t: own.encode(t, add_special_tokens=False).ids
    return all(ids(t) == [i for w in t.encode().split() for i in ids(w.decode())] for t in _PROBES)


def frequent(docs: DataFrame, path: str) -> tuple[bytes, bytes]:
    """The FREQUENT most frequent pre-tokens of a bounded sample, joined by newlines, and a byte for each count.

    The sample is counted in tasks; at most FREQUENT words of LONGEST bytes come to the driver."""
    words = F.explode(F.split(F.substring("text", 1, SAMPLE_CHARS), r"[\x20\x09-\x0D]+")).alias("w")
    counts = docs.sample(0.05, 17).limit(SAMPLE_DOCS).select(words).where((F.col("w") != "") & (F.octet_length("w") <= LONGEST)).groupBy("w").count()
    own = Lengths(path)
    pairs = [(w, own[w]) for w in (r.w.encode() for r in counts.orderBy(F.desc("count"), "w").limit(FREQUENT).collect())]
    pairs = [(w, n) for w, n in pairs if n < 256]
    return b"\n".join(w for w, _ in pairs), bytes(n for _, n in pairs)


def token_counts(docs: DataFrame, path: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """``docs`` with the long column ``name``. Raises ValueError for vocabularies whose counts do not add up over
    white-space-delimited pre-tokens."""
    if not splits_at_space(path):
        raise ValueError(f"{path} does not split texts at white space and drop it")
    docs = aside(docs, name)
    shared = docs.sparkSession.sparkContext.broadcast(frequent(docs.select(F.col(text).alias("text")), path))
    key = f"{path}:{id(shared)}"

    @F.pandas_udf("long")
    def count(texts):
        import pandas as pd

        if key not in _tables:
            _tables.clear()
            _tables[key] = Lengths(path, *shared.value)
        length = _tables[key].__getitem__
        return pd.Series([sum(map(length, t.encode().split())) if t else 0 for t in texts], dtype="int64")

    return docs.withColumn(name, count(text))
