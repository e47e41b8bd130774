"""Ranked search against a plain version with dictionaries."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from dumpmill.llm import queries, search
from tests.llm.helpers import documents, empty

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def slow(items, docs, top=20):
    own = [(d, terms(t)) for d, t in docs]
    own = [(d, t, Counter(t)) for d, t in own if t]
    big_n, big_l = len(own), sum(len(t) for _, t, _ in own)
    df = Counter(x for _, _, c in own for x in c)
    by_item, out = {}, []
    for i, t in set(items):
        by_item.setdefault(i, []).extend(terms(t))
    for i, query in by_item.items():
        rows = []
        for d, t, c in own:
            m = 100 - 25 + (25 * len(t) * big_n) // big_l
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[x] + 1))) * ((1000000000 * c[x]) // (1000 * c[x] + 12 * m)) for x in query if c[x])
            if score > 0:
                rows.append((-score, d is None, d or 0))
        out += [(i, k + 1, None if gone else d, -s) for k, (s, gone, d) in enumerate(sorted(rows)[:top])]
    return out


def check(spark, items, docs, **more):
    a = spark.createDataFrame(items, "item_id long, text string")
    b = spark.createDataFrame(docs, "doc_id long, text string")
    key = lambda r: tuple(map(repr, r))
    got = search.search(a, b, **more)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(slow(items, docs, **more), key=key)


ODD = ["It's A-b_c 42 ÉCOLE école Écolé́ 日本語", "KK k İ i̇", "", None, " \x00\x7f.,", "go go go go", "x" * 50_000 + " alpha", "alpha " * 30_000]


@pytest.mark.parametrize("block", [200_000, 7])
def test_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "ROOM", 50)
    rng = random.Random(4)
    word = lambda: rng.choice(["alpha", "Beta", "GAMMA", "delta9", "é", "école", "the", "a1"]) if rng.random() < 0.8 else f"w{rng.randrange(300)}"
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(word() for _ in range(n))
    docs = [(i if i % 17 else None, text(rng.randint(0, 40))) for i in range(400)] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(5, "alpha beta"), (5, "alpha beta")]
    items = [(i if i else None, text(rng.randint(1, 9))) for i in range(12)] + [(20 + i, t) for i, t in enumerate(ODD[:6])] + [(3, "alpha beta"), (3, "alpha beta"), (3, "zeta alpha")]
    check(spark, items, docs)
    check(spark, items, docs, top=3)


def test_ties_go_by_id(spark):
    check(spark, [(1, "alpha")], [(i, "alpha beta") for i in range(100, 0, -1)] + [(None, "alpha beta"), (200, "other")])


def test_odd_tables(spark):
    docs = documents(spark)
    assert search.search(empty(spark).withColumnRenamed("doc_id", "item_id"), docs).count() == 0
    assert search.search(docs, empty(spark), item="h").count() == 0
    own = search.search(docs.limit(5).selectExpr("doc_id as item_id", "text", "size as score", "row as rank"), docs)
    assert own.columns == ["item_id", "rank", "doc_id", "score"] and own.count() > 0


def test_radix_sums():
    rng = np.random.default_rng(1)
    for top in (5, 1 << 16, 1 << 40):
        keys, values = rng.integers(0, top, 3000), rng.integers(0, 1 << 40, 3000)
        assert (search.radix_order(keys) == np.argsort(keys, kind="stable")).all()
        got, sums = search.summed(keys, values)
        want = Counter()
        for k, v in zip(keys.tolist(), values.tolist()):
            want[k] += v
        assert dict(zip(got.tolist(), sums.tolist())) == want and (np.diff(got) > 0).all()


def test_query(spark, sf_dir):
    read = lambda n, i: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{n}.parquet").select(i, "text").collect()]
    got = queries.QUERIES["op11_ranked_search"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == sorted(slow(read("benchmark", "item_id"), read("documents", "doc_id")))
