"""Quality rules as a short-circuit cascade (operator 3).

Some measures are taken of every text (the base). Further rules only run on texts that passed all
rules before them. Each rule's seconds and rejections are measured on a bounded sample of
documents; rules then run in order of rejections per second. The order changes the cost, never the
verdict, which is that of all rules together.

A null text has no words; an empty table gives no rows; repeated rows are judged row by row. Texts
are read whole, with memory in proportion to the longest text. Only doc_id (of any type) and text are read,
so other columns cannot clash.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

SPACE, SYMBOLS, WINDOW = " \t\n\v\f\r", "#*$%&|<>", 8
#: Bounds of the sample on which rules are measured.
SAMPLE_DOCS, SAMPLE_CHARS = 400, 20_000
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MIX = np.random.default_rng(8).integers(1, 1 << 62, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: ASCII letters and bytes of other characters become "a", spaces stay, the rest becomes a point.
_LETTERS = bytes(97 if c > 127 or chr(c).isalpha() else c if chr(c) in SPACE else 46 for c in range(256))


class Text:
    """A text with what several rules share."""

    __slots__ = ("text", "words", "base")

    def __init__(self, text: str | None):
        self.text = text or ""
        self.words = self.text.encode().split()  # bytes split at the six ASCII spaces only
        self.base = ()


def repeat_words(words: list[bytes]) -> int:
    """Words inside windows of eight words that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    names: dict[bytes, int] = {}
    ids = np.array([names.setdefault(w, len(names)) for w in words], np.int64)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    rolled = np.zeros(n, np.uint64)
    for i, m in enumerate(_MIX):
        rolled += mixed[i : i + n] * m
    ordered = np.sort(rolled)
    if not (ordered[1:] == ordered[:-1]).any():  # equal windows have equal hashes: none is repeated
        return 0
    for step in (1, 2, 4):  # exact names of 2, 4 and 8 words
        pair = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        ids = np.unique(pair, return_inverse=True)[1]
    often = np.bincount(ids)[ids] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(often), 1)
    np.add.at(cover, np.flatnonzero(often) + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def measure(t: Text) -> tuple[int, ...]:
    text = t.text
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return (
        len(t.words), len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)), repeat_words(t.words),
    )


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < 20 or 100 * n_repeat > 30 * n_words


def _symbols(t: Text) -> bool:
    return 10 * t.base[2] > t.base[0]


def _word_length(t: Text) -> bool:
    return not 2 * t.base[0] <= t.base[1] <= 20 * t.base[0]


def _duplicate_lines(t: Text) -> bool:
    lines = t.text.count("\n") + 1
    return lines >= 4 and 100 * t.base[3] > 30 * lines


def _few_letters(t: Text) -> bool:
    """Under 70% of the words hold a letter."""
    letters = sum(1 for w in t.text.encode().translate(_LETTERS).split() if b"a" in w)
    return 10 * letters < 7 * len(t.words)


def _shouting(t: Text) -> bool:
    """More ASCII capitals than small letters, or an exclamation mark every third word."""
    own = np.frombuffer(t.text.encode(), np.uint8)
    capitals = np.count_nonzero((own >= 65) & (own <= 90))
    small = np.count_nonzero((own >= 97) & (own <= 122))
    return capitals > small or 3 * t.text.count("!") > len(t.words)


def _one_word(t: Text) -> bool:
    """One word makes up over 30% of the text."""
    most: dict[bytes, int] = {}
    for w in t.words:
        most[w] = most.get(w, 0) + 1
    return 10 * max(most.values(), default=0) > 3 * len(t.words) and len(t.words) >= 20


def _ellipses(t: Text) -> bool:
    """Over 30% of the lines end in an ellipsis."""
    lines = t.text.split("\n")
    return 10 * sum(x.rstrip(SPACE).endswith(("...", "…")) for x in lines) > 3 * len(lines)


def _bullets(t: Text) -> bool:
    """Over 90% of the lines start with a bullet."""
    lines = t.text.split("\n")
    return 10 * sum(x.lstrip(SPACE).startswith(("-", "*", "•")) for x in lines) > 9 * len(lines)


#: Name and test of each rule; a test is true where the rule rejects a text with a base.
RULES: dict[str, Callable[[Text], bool]] = {
    "symbols": _symbols, "word_length": _word_length, "duplicate_lines": _duplicate_lines, "few_letters": _few_letters,
    "shouting": _shouting, "one_word": _one_word, "ellipses": _ellipses, "bullets": _bullets,
}


def cascade_order(docs: DataFrame, rules: dict[str, Callable] | None = None) -> list[str]:
    """Rule names in the order in which each rejects most per second of what those before it leave.

    A bounded sample of ``docs`` (column ``text``) is tried in one task; a number for each text and rule comes
    to the driver, no text."""
    rules = rules or RULES
    names = list(rules)

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, costs = [], []
            for value in batch.column("t"):
                t = Text(value.as_py())
                t.base = measure(t)
                if base_failed(t.base[0], t.base[4]):
                    continue
                hit, cost = [], []
                for name in names:
                    start = time.perf_counter()
                    hit.append(bool(rules[name](t)))
                    cost.append(time.perf_counter() - start)
                hits.append(hit)
                costs.append(cost)
            yield pa.RecordBatch.from_pydict({"hits": pa.array(hits, pa.list_(pa.bool_())), "costs": pa.array(costs, pa.list_(pa.float64()))})

    sample = docs.select(F.substring("text", 1, SAMPLE_CHARS).alias("t")).sample(0.05, 23).limit(SAMPLE_DOCS)
    rows = sample.mapInArrow(tried, "hits array<boolean>, costs array<double>").collect()
    hits = np.array([r.hits for r in rows], bool).reshape(len(rows), len(names))
    cost = np.array([r.costs for r in rows]).reshape(len(rows), len(names)).sum(axis=0) + 1e-9
    order, left, open_ = [], np.ones(len(rows), bool), set(range(len(names)))
    while open_:
        best = max(open_, key=lambda k: ((hits[left, k].sum() + 0.5) / cost[k], names[k]))
        order.append(names[best])
        open_.remove(best)
        left &= ~hits[:, best]
    return order


def quality_rules(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Rows (doc_id, the base measures, base_failed, kept, rejected_by): ``rejected_by`` names the
    first rule of the cascade that rejects, null if none or if the base failed. The order is found by
    timing, so ``rejected_by`` may differ between runs unless ``order`` is given; the other columns do not."""
    names = order or cascade_order(docs)
    tests = [(n, RULES[n]) for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, failed, by = [], [], []
            for value in batch.column("text"):
                t = Text(value.as_py())
                t.base = measure(t)
                base.append(t.base)
                failed.append(base_failed(t.base[0], t.base[4]))
                by.append(None if failed[-1] else next((n for n, test in tests if test(t)), None))
            out = {"doc_id": batch.column("doc_id")} | {k: pa.array([b[i] for b in base], pa.int64()) for i, k in enumerate(BASE)}
            out |= {"base_failed": pa.array(failed, pa.bool_()), "kept": pa.array([not f and b is None for f, b in zip(failed, by, strict=True)], pa.bool_())}
            yield pa.RecordBatch.from_pydict(out | {"rejected_by": pa.array(by, pa.string())})

    kinds = [*((k, LongType()) for k in BASE), ("base_failed", BooleanType()), ("kept", BooleanType()), ("rejected_by", StringType())]
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *(StructField(k, t) for k, t in kinds)])
    return docs.select("doc_id", "text").mapInArrow(run, schema)
