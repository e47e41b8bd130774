import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from dumpmill.llm import bpe, tokens
from tests.llm.helpers import documents, empty, texts, with_ids

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = ["don't we'll they're I've 'tis ''s 's's 'S  's \n's", "a" * 700 + " " * 300 + "\n" * 20, "x\r\n\r\n y", "12 345 ٣٤½", "日本語 テスト", "\U0001F600‍\U0001F525 ok", "<|endoftext|> end", " ", "\n", "é" * 100, "\x00\x01"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(PATH), special_tokens={})


def test_random_texts(library):
    rng = random.Random(1)
    parts = list("abstmdrevlL'’ \n\tß1٣!?-　日") + ["\r\n", "'ll", "'re", " '", "the ", "\U0001F600"]
    own = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(4000)] + ODD
    for text, ids in zip(own, bpe.encode_texts(own, PATH), strict=True):
        assert ids.tolist() == library.encode_ordinary(text)


def test_pieces_equal_plain_merging():
    rng, own = random.Random(2), bpe.Pieces(PATH)
    known = list(own.rank)
    for _ in range(5000):
        piece = rng.choice([lambda: bytes(rng.randrange(256) for _ in range(rng.randint(1, 14))), lambda: b"".join(rng.choice(known) for _ in range(4))[:60]])()
        assert own.tokens(piece) == ([own.rank[piece]] if piece in own.rank else bpe.merged(piece, own.rank))


def test_scan_is_the_running_product():
    _, _, product, images = bpe.automaton()
    own = np.random.default_rng(1).integers(0, len(images), 5000).astype(np.uint16)
    got, now = bpe.scan(own, product), 0
    for i, x in enumerate(own):
        assert got[i] == now
        now = product[now, x]
    assert len(bpe.scan(own[:0], product)) == 0


def test_round_trip(spark, library):
    own = texts(3, 30) + ODD
    got = {r.doc_id: r for r in bpe.digests(with_ids(spark, own), PATH).collect()}
    for i, t in enumerate(own):
        ids = library.encode_ordinary(t or "")
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_decode_operator_and_odd_tables(spark):
    docs = documents(spark)
    coded = bpe.encode(docs, PATH, step=500)
    assert coded.columns == [c for c in docs.columns if c != "text"] + ["token_ids", "token_ends"]
    back = {r.doc_id: bytes(r.decoded).decode() for r in bpe.decode(coded, PATH).select("doc_id", "decoded").collect()}
    assert back == {r.doc_id: r.text or "" for r in docs.collect()}
    assert bpe.digests(empty(spark), PATH).count() == 0
    row = coded.where("doc_id = 0").head()
    assert row.token_ends[-1] == len(docs.where("doc_id = 0").head().text.encode())
    bad = coded.limit(1).selectExpr("array(1, 999999) as token_ids", "array(1, 2) as token_ends")
    with pytest.raises(Exception, match="IndexError|list index"):
        bpe.decode(bad, PATH).collect()


def test_token_counts(spark):
    from tokenizers import Tokenizer

    name = "word_bpe_49k.json"
    own = texts(4, 40) + ODD + ["<|startoftext|>a<|endoftext|>", "Á Σ ΣΑΣ", "no break"]
    library = Tokenizer.from_file(public_tokenizers.path(name))
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(with_ids(spark, own), public_tokenizers.path(name)).collect()}
    assert [got[i] for i in range(len(own))] == [len(library.encode(t or "", add_special_tokens=False).ids) for t in own]


def test_counts_of_odd_tables_and_small_caches(spark, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = documents(spark)
    assert tokens.token_counts(docs, path).columns == [*docs.columns, "n_tokens"]
    assert tokens.token_counts(empty(spark), path).count() == 0
    monkeypatch.setattr(tokens, "CACHED", 3)
    own = tokens.Lengths(path, b"a\nthe", bytes([1, 1]))
    words = [b"a", b"unlikelihood", b"the", b"b", b"cc", b"dd", b"unlikelihood"] * 3
    assert [own[w] for w in words] == [tokens.library(path)(w.decode()) for w in words] and len(own) <= 6
