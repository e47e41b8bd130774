"""Texts of some million characters, clashing columns, other kinds of doc_id, and the Gumbel draw by brute force."""
import hashlib
import math
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from dumpmill.llm import bpe, licenses, lines, mixing, quality, rules, secrets, simhash, tokens
from tests.llm.helpers import prose, with_ids
from tests.llm.test_quality import corpus

BPE, WORDS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
KEY = 'token = "0f1e2d3c4b5a69788796a5b4c3d2e1f00f1e2d3c"'


@pytest.fixture(scope="module")
def long_texts():
    many = [f"entry {i} of a long list of things {i * 7919 % 1000003}" for i in range(60_000)]
    return ["some words of prose, " * 150_000 + KEY, "x" * 1_500_000, "\n".join(many), "\n".join([*many, "one more line at the end of it"]), "short text"]


def test_long_texts(spark, long_texts):
    docs = with_ids(spark, long_texts).withColumn("source", F.lit("s"))
    got = {r.doc_id: r for r in rules.quality_rules(docs).collect()}
    assert [got[i].n_words for i in range(5)] == [len(t.split()) for t in long_texts] and got[1].word_chars == 1_500_000
    assert {r.doc_id: r.size for r in mixing.sizes(docs).collect()} == {i: len(t.split()) for i, t in enumerate(long_texts)}
    prints = {r.doc_id: r.fp & (1 << 64) - 1 for r in simhash.simhash_groups(docs).select("doc_id", "fp").collect()}
    for i in (1, 4):
        h = simhash.shingle_hashes(long_texts[i])
        assert prints[i] == sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in h) > len(h))
    count = tokens.library(WORDS)
    assert {r.doc_id: r.n_tokens for r in tokens.token_counts(docs, WORDS).collect()} == {i: count(t) for i, t in enumerate(long_texts)}
    assert licenses.license_matches(docs.select("doc_id", "text"), windows=True).count() == 5
    found = secrets.scan(docs.select("doc_id", "text"), labelled=secrets.made_findings(spark), assigned=True).where("is_secret").collect()
    assert [(r.doc_id, r.value) for r in found] == [(0, KEY.split('"')[1])]
    assert quality.quality_scores(docs, corpus(spark, 40)[1]).count() == 5


def test_long_texts_encode_and_decode(spark, long_texts):
    own = [t[:400_000] for t in long_texts]
    got = {r.doc_id: r.decoded_sha256 for r in bpe.digests(with_ids(spark, own), BPE).collect()}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in enumerate(own)}


def test_long_texts_lose_lines_in_linear_time(spark):
    def seconds(n):
        text = "\n".join(f"{i} {'abcdefghij'[i % 10] * 3} number {i * 7919 % 1000003}" for i in range(n))
        docs = with_ids(spark, [text, text + "\nleft alone here", "kept"]).withColumn("n_chars", F.length("text").cast("long"))
        start = time.time()
        got = {r.doc_id: r for r in lines.dedup_lines(docs, edits=0, least=200).collect()}  # nothing is long enough
        assert len(got) == 3
        rows = {r.doc_id: r.text for r in lines.dedup_lines(docs, bands=((4000, 1),)).collect()}
        assert rows[1] == "left alone here" and rows[2] == "kept"
        return time.time() - start

    seconds(100)
    few, more = seconds(10_000), seconds(40_000)
    assert more < few + 20


CLASH = "doc_id string, text string, source string, lang string, n_chars long, n_tokens int, token_ids string, token_ends string, licenses string, line int, uid int, n int, key int, `row` string, h1 long, copies int, gone string"


def test_clashing_columns_and_text_ids(spark):
    rows = [(f"d{i}", t, "s", "en", len(t), 1, "a", "b", "c", 2, 3, 4, 5, "r", 6, 7, "g") for i, t in enumerate(["alpha beta gamma delta", "alpha beta gamma delta", f"{KEY} and words", ""])]
    docs = spark.createDataFrame(rows, CLASH)
    own = {r.doc_id: r for r in tokens.token_counts(docs, WORDS).collect()}
    assert own["d0"].n_tokens_ == 1 and own["d0"].n_tokens == tokens.library(WORDS)(rows[0][1])
    own = bpe.encode(docs, BPE).head()
    assert (own.token_ids_, own.token_ends_) == ("a", "b") and len(own.token_ids) > 3
    assert licenses.license_matches(docs).head().licenses_ == "c"
    for got in (lines.dedup_lines(docs, bands=lines.BANDS), simhash.near_dedup(docs), mixing.mixed_documents(docs)):
        assert got.columns == docs.columns and {(r.line, r.uid, r.key, r.row, r.gone) for r in got.collect()} == {(2, 3, 5, "r", "g")}
    assert {r.doc_id for r in lines.dedup_lines(docs, bands=lines.BANDS).collect()} == {"d0", "d2", "d3"}
    assert {r.doc_id: r.n_removed for r in lines.line_report(docs, bands=lines.BANDS).collect()} == {"d0": 0, "d1": 1, "d2": 0, "d3": 0}
    assert {r.doc_id for r in rules.quality_rules(docs).collect()} == {"d0", "d1", "d2", "d3"}


def test_other_vocabularies_are_refused(spark):
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        with pytest.raises(ValueError, match="white space"):
            tokens.token_counts(with_ids(spark, ["a b"]), public_tokenizers.path(name))


def test_gumbel_top_k_by_brute_force(spark):
    docs, labels, rows = corpus(spark, 300)
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    _, sample = quality.fit(docs, labels)
    weight = {i: round(r.log_weight * quality.UNIT) for i, r in got.items()}
    noisy = {}
    for i, r in got.items():
        u = (int(hashlib.md5(str(i).encode()).hexdigest()[:12], 16) + 0.5) / 2**48
        noisy[i] = weight[i] + round(-math.log(-math.log(u)) * quality.UNIT)
        assert abs(noisy[i] - r.noisy_weight * quality.UNIT) <= 1.5
    held = [(weight[r.doc_id], r.good) for r in sample.where("held_out").collect()]
    good, bad = sum(g for _, g in held), sum(not g for _, g in held)
    best = max((sum(w < c and not g for w, g in held) / bad + sum(w >= c and g for w, g in held) / good, -c) for c in {w for w, _ in held})
    cut = -best[1]
    below = [w for w, _ in held if w < cut]
    k = sum(w >= (cut + max(below)) // 2 for w in weight.values()) if below else sum(w >= cut for w in weight.values())
    want = {i for i in sorted(noisy, key=lambda i: -noisy[i])[:k]}
    assert {i for i, r in got.items() if r.kept} == want and 0 < len(want) < len(rows)
    assert np.isclose(np.mean([x - weight[i] for i, x in noisy.items()]) / quality.UNIT, 0.577, atol=0.3)


def test_prose_is_no_secret(spark):
    import random

    rng = random.Random(2)
    assert secrets.scan(with_ids(spark, [prose(rng, 50) for _ in range(20)]), labelled=secrets.made_findings(spark), assigned=True).where("is_secret").count() == 0
