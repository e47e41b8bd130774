"""Packing: pieces put together again, fixed numbers in bins, padding, and ids of the library."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dumpmill.llm import packing, queries
from tests.llm.helpers import documents, empty, texts, with_ids

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["Word. WORD, word;; word!? it's they'LL. don't! École. école, straße: İ.", "J̌. ǰ É. x×. —. a—. 3.14. 7, <|endoftext|>. x<|endoftext|>y. <|startoftext|>", "a b. c \x1c \x85.", ".,;:!?", "word.́ ́. '.", "x" * 3000 + ".", "The THE the. The, tHe!"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def whole(pieces):
    """Checks of any packing; returns ids by document and the lengths of sequences."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in pieces:
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert len(own) == r.length > 0
        by_doc[r.doc_id].append((r.start, own, r.doc_tokens))
        by_seq[r.sequence_id].append((r.offset, r.length))
    ids, sizes = {}, {}
    for d, rows in by_doc.items():
        rows.sort()
        at = 0
        for start, own, total in rows:
            assert start == at
            at += len(own)
        assert {r[2] for r in rows} == {at}
        ids[d] = [x for r in rows for x in r[1]]
    for s, rows in by_seq.items():
        rows.sort()
        at = 0
        for offset, length in rows:
            assert offset == at
            at += length
        sizes[s] = at
    return ids, sizes


def test_ids_of_words(library):
    own, rng = packing.Ids(PATH), random.Random(2)
    parts = list("abEZéÉ'.,;:!?-́  3") + ["ing", "'s", "日本", " The ", "word", "İ"]
    for text in ODD + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]:
        for _ in range(2):
            assert np.frombuffer(own.of(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_cuts():
    for capacity, fine in ((2048, 64), (100, 5), (7, 1), (1, 0)):
        for n in range(0, 3 * capacity + 2):
            own = packing.cuts(n, capacity, fine)
            assert sum(length for _, length in own) == n
            for k, length in own:
                assert capacity // (k + 1) < length <= capacity // k
                assert length == capacity // k or length <= fine
    assert all(sum(p) == n and all(x & (x - 1) == 0 for x in p) for n in range(300) for p in [packing.powers(n)])


def test_fixed_counts_in_full_bins():
    rng, own = random.Random(1), packing.Packer(3, 2048, 64)
    for i in range(3000):
        own.add(i, bytes(4 * rng.randint(1, 3000)))
    bins = defaultdict(list)
    for _, _, ids, _, sequence, _ in own.out:
        bins[sequence].append(len(ids) // 4)
    for lengths in bins.values():
        assert len({2048 // x for x in lengths}) == 1 and len(lengths) == 2048 // lengths[0]
    before = set(bins)
    own.finish()
    left = Counter()
    for _, _, ids, _, sequence, _ in own.out:
        if sequence not in before:
            left[sequence] += len(ids) // 4
    assert all(n == 2048 or n & (n - 1) == 0 for n in left.values()) and len(left) > 1
    assert not own.open and len({s >> 33 for s in [*before, *left]}) == 1


def test_documents(spark, library):
    own = texts(5, 200) + ODD
    ids, sizes = whole(packing.pack(with_ids(spark, own).repartition(3), PATH).collect())
    assert ids == {i: ids_of(library, t) for i, t in enumerate(own)}
    assert max(sizes.values()) <= 2048
    assert sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes.values()) <= 0.01 * sum(sizes.values())
    small, sizes = whole(packing.pack(with_ids(spark, own), PATH, capacity=50, fine=3).collect())
    assert small == ids and max(sizes.values()) <= 50


def test_odd_tables(spark):
    assert packing.pack(empty(spark), PATH).count() == 0
    docs = documents(spark)
    rows = packing.pack(docs, PATH).collect()
    assert sum(r.length for r in rows if r.doc_id is not None) == sum({(r.doc_id): r.doc_tokens for r in rows if r.doc_id is not None}.values())
    same = packing.pack(with_ids(spark, ["one two three."]).union(with_ids(spark, ["one two three."])), PATH).collect()
    assert sum(r.length for r in same) == 2 * same[0].doc_tokens
    with pytest.raises(ValueError):
        packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def test_full_caches_start_anew(library, monkeypatch):
    monkeypatch.setattr(packing, "CACHED", 3)
    own = packing.Ids(PATH)
    text = "one two three. four five, six seven one two"
    assert np.frombuffer(own.of(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids and len(own.words) <= 3 and len(own.words.old) <= 3


def test_query(spark, sf_dir, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op13_harmonic_packing"](spark, sf_dir).collect()
    assert rows[0].asDict().keys() == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    own = {d: ids_of(library, t) for d, t in docs.items()}
    for r in rows:
        piece = np.array(own[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert r.ids_crc32 == zlib.crc32(piece) and r.doc_tokens == len(own[r.doc_id])
    assert sum(r.length for r in rows) == sum(map(len, own.values()))
    assert queries.QUERIES["op13_harmonic_packing"](spark, sf_dir).exceptAll(spark.createDataFrame(rows)).count() == 0
