"""Key rows of line dedup travel in blocks of a bucket; buckets that outgrow what a task holds give the same."""
import random

import numpy as np

from dumpmill.llm import lines as N

BANDS = ((12, 1), (24, 2))


def texts(n=300):
    rng = random.Random(11)
    start = "the very same beginning of many lines, "
    own = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(13, 60))) + "x" for _ in range(n)]
    return own + [x[:-1] + "y" for x in own[:40]] + [start + "".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(150)]


def docs(spark, own):
    return spark.createDataFrame([(i, x) for i, x in enumerate(own)], "doc_id long, text string").coalesce(1)


def key_rows(own):
    return sum(len(key) for _, key, *_ in N.signatures(own, BANDS))


def found(df):
    rows = df.collect()
    return {(r.line, r.other) for r in rows if r.other is not None}, {(r.key, r.line, r.indexed) for r in rows if r.other is None}


def test_blocks(spark):
    own = texts()
    rows = N.line_keys(docs(spark, own), bands=BANDS, bits=1).collect()
    cols = N._rows_of([bytes(r.block) for r in rows])
    assert len(cols[0]) == key_rows(own) > 3000 and len(rows) < len(cols[0]) / 100
    assert all(len(r.block) <= 25 * N.BLOCK and r.bucket in (0, 1) and not r.salted for r in rows)
    assert set(cols[1].tolist()) == {N.line_name(x) for x in own}


def test_outgrown_buckets(spark, monkeypatch):
    own = docs(spark, texts())
    want = found(N.candidate_pairs(N.line_keys(own, bands=BANDS)))
    assert len(want[0]) >= 40 and len(want[1]) >= 150
    monkeypatch.setattr(N, "HELD", 100)
    monkeypatch.setattr(N, "BLOCK", 16)
    assert found(N.candidate_pairs(N.line_keys(own, bands=BANDS, bits=1))) == want


def test_hot_keys_are_dealt_out(spark):
    own = docs(spark, texts())
    pairs, large = found(N.candidate_pairs(N.line_keys(own, bands=BANDS)))
    hot = np.unique(np.array([k for k, _, _ in large], np.int64))
    rows = N.line_keys(own, bands=BANDS, hot=hot, bits=2)
    cols = N._rows_of([bytes(r.block) for r in rows.where("salted").collect()])
    assert set(cols[0].tolist()) == set(hot.tolist()) and rows.where("salted").select("bucket").distinct().count() == 4
    assert found(N.candidate_pairs(rows)) == (pairs, large)
