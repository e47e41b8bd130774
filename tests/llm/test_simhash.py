import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dumpmill.llm import simhash as S
from dumpmill.llm.common import components
from tests.llm.helpers import Groups, documents, empty, prose, texts, with_ids


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)] if words else []
    return sum(1 << b for b in range(64) if hashes and 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints, radius=3):
    g = Groups(len(prints))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                g.join(i, j)
    return [g.top(i) for i in range(len(prints))]


def test_groups_match_brute_force(spark):
    rng = random.Random(4)
    own = texts(5, 40)
    base = prose(rng, 300).split()
    for _ in range(40):
        new = list(base)
        for _ in range(rng.randint(0, 3)):
            new[rng.randrange(len(new))] = rng.choice("abcdefgh")
        own.append(" ".join(new))
    got = sorted((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in S.simhash_groups(with_ids(spark, own)).collect())
    prints = [slow_print(t) for t in own]
    assert got == [(i, p, c) for i, (p, c) in enumerate(zip(prints, slow_groups(prints), strict=True))]


@pytest.mark.parametrize(("radius", "blocks", "cell"), [(3, 5, 4), (3, 6, 2048), (2, 4, 3), (1, 3, 100), (0, 1, 5)])
def test_links_of_close_prints(spark, radius, blocks, cell):
    rng = random.Random(radius)
    prints = {rng.getrandbits(64) for _ in range(100)}
    for _ in range(6):
        near = rng.getrandbits(64)
        for _ in range(30):
            prints.add(near)
            near ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
    own = sorted(prints)
    df = spark.createDataFrame([(p - (p >> 63 << 64),) for p in own], "fp long")
    edges = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in S.fingerprint_links(df, radius, blocks, cell).collect()]
    at = {p: i for i, p in enumerate(own)}
    g = Groups(len(own))
    for a, b in edges:
        g.join(at[a], at[b])
    assert [g.top(i) for i in range(len(own))] == slow_groups(own, radius)


def test_bit_planes_span_words():
    rng = np.random.default_rng(1)
    prints = np.unique(rng.integers(0, 1 << 6, 300).astype(np.uint64) | np.uint64(1 << 63))
    a, b = S.link_groups(np.zeros(len(prints), np.int64), prints, 1, step=7)
    assert len(set(b)) == 1 and len(a) == len(prints) - 1


def test_odd_tables(spark):
    docs = documents(spark)
    got = S.simhash_groups(docs)
    assert got.count() == docs.count() and S.simhash_groups(empty(spark)).count() == 0
    zero = [r for r in got.collect() if r.fp == 0]
    assert len(zero) >= 3 and len({r.component_id for r in zero}) == 1
    kept = S.near_dedup(docs)
    assert kept.columns == docs.columns and S.near_dedup(empty(spark)).count() == 0
    first = {r.component_id for r in got.collect() if r.component_id is not None}
    assert {r.doc_id for r in kept.where("doc_id is not null").collect()} == first
    twice = docs.union(docs)
    assert S.near_dedup(twice).where("doc_id is not null").count() == len(first)
    assert {(r.h, r.row) for r in kept.collect()} == {(9, "r")}


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    g = Groups(1100)
    for a, b in edges:
        if a is not None:
            g.join(a, b)
    assert got == {x: g.top(x) for e in edges if e[0] is not None and e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hex(spark):
    got = spark.createDataFrame([(-1,), (10,)], "fp long").select(S.hex_print(F.col("fp"))).collect()
    assert [r[0] for r in got] == ["f" * 16, "0" * 15 + "a"]
