import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dumpmill.llm import lines as N
from tests.llm.helpers import Groups, documents, empty, prose, with_ids


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, line, n):
    own = list(line)
    for _ in range(n):
        i = rng.randrange(len(own) or 1)
        if not own:
            own = ["a"]
        rng.choice([lambda: own.insert(i, "é"), lambda: own.pop(i), lambda: own.__setitem__(i, "#")])()
    return "".join(own)


def corpus(seed, families=12):
    rng = random.Random(seed)
    bases = [prose(rng, rng.randint(5, 12)) for _ in range(families)] + [f"entry {i:03d} of the long common list of things" for i in range(30)]
    docs = []
    for _ in range(40):
        docs.append("\n".join(rng.choice([lambda: changed(rng, rng.choice(bases), rng.randint(0, 4)), lambda: rng.choice(bases), lambda: "short", lambda: prose(rng, 7)])() for _ in range(rng.randint(1, 6))))
    return docs


def brute(rows, edits=2, least=24):
    occ = sorted((d, i, x) for d, t in rows if t and d is not None for i, x in enumerate(t.split("\n")) if len(x) >= least)
    names = sorted({x for _, _, x in occ})
    g = Groups(len(names))
    for i, a in enumerate(names):
        for j in range(i):
            if abs(len(a) - len(names[j])) <= edits and distance(a, names[j]) <= edits:
                g.join(i, j)
    cls = {x: g.top(i) for i, x in enumerate(names)}
    lead, first = {}, {}
    for d, i, x in occ:
        lead.setdefault(cls[x], (d, i))
        first.setdefault(x, (d, i))
    return {(d, i): first[x] == (d, i) for d, i, x in occ if lead[cls[x]] != (d, i)}


@pytest.mark.parametrize(("edits", "small", "cell"), [(2, 64, 512), (1, 64, 512), (3, 4, 5), (2, 2, 3)])
def test_repeated_lines_match_brute_force(spark, monkeypatch, edits, small, cell):
    monkeypatch.setattr(N, "CELL", cell)
    own = corpus(edits)
    rows = list(enumerate(own))
    monkeypatch.setattr(N, "SMALL", small)
    got = {(r.doc_id, r.line_no): r.near for r in N.repeated_lines(with_ids(spark, own), edits).collect()}
    want = brute(rows, edits)
    assert got == want and any(want.values())


@pytest.mark.parametrize(("edits", "small", "levels"), [(2, 4, 3), (1, 2, 2), (4, 3, 1)])
def test_keys_are_refined(spark, monkeypatch, edits, small, levels):
    """Lines that share beginnings, ends or all but a few characters, with keys that are cut again and again."""
    monkeypatch.setattr(N, "SMALL", small)
    monkeypatch.setattr(N, "LEVELS", levels)
    monkeypatch.setattr(N, "CELL", 20)
    monkeypatch.setattr(N, "GROWTH", 4)
    monkeypatch.setattr(N, "REFINED", 4)
    rng = random.Random(10 * edits + small)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    start, end = "https://example.org/a/long/path/", "/index.html?page=first"
    own = [start + word(rng.randint(1, 12)) for _ in range(40)] + [word(rng.randint(2, 12)) + end for _ in range(30)] + [start + word(rng.randint(1, 6)) + end for _ in range(40)]
    own += [changed(rng, rng.choice(own), rng.randint(0, edits + 1)) for _ in range(40)]
    got = {(r.doc_id, r.line_no): r.near for r in N.repeated_lines(with_ids(spark, own), edits).collect()}
    assert got == brute(list(enumerate(own)), edits)


def test_hot_keys_stay_out_of_the_shuffle(spark, monkeypatch):
    monkeypatch.setattr(N, "SMALL", 3)
    monkeypatch.setattr(N, "SAMPLE", 1)
    rng = random.Random(2)
    own = ["the same beginning of every line: " + "".join(rng.choice("abcdef") for _ in range(rng.randint(2, 9))) for _ in range(90)]
    got = {(r.doc_id, r.line_no): r.near for r in N.repeated_lines(with_ids(spark, own)).collect()}
    assert got == brute(list(enumerate(own)))


def test_large_keys(spark):
    """Over SMALL lines under one key."""
    rng = random.Random(1)
    start = "the very same beginning of many lines, "
    own = [start + "".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(150)]  # one key of 150 lines
    own += [changed(rng, x, rng.randint(1, 2)) for x in own[:30]]
    got = {(r.doc_id, r.line_no): r.near for r in N.repeated_lines(with_ids(spark, own)).collect()}
    assert got == brute(list(enumerate(own))) and len(got) > 5
    found = N.candidate_pairs(N.line_keys(with_ids(spark, own)))
    assert found.where("other is null").count() > 64


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(4000):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 14)))
        b = changed(rng, a, rng.randint(0, 4)) if a else "".join(rng.choice("ab") for _ in range(3))
        for e in (0, 1, 2, 3):
            assert N.within(a, b, e) == (distance(a, b) <= e)


def test_many_edit_distances():
    rng = random.Random(4)
    a, b = [], []
    for n in range(900):
        x = "".join(rng.choice("abcé") for _ in range(rng.randint(0, 12 if n % 2 else 60)))
        a.append(x)
        b.append(changed(rng, x, rng.randint(0, 10)) if x else "b" * rng.randint(0, 3))
    for bound in ([0, 1, 2, 3], [4], [8, 1]):
        edits = np.array([rng.choice(bound) for _ in a])
        got = N.within_many(a, b, edits)
        assert [bool(x) for x in got] == [distance(x, y) <= e for x, y, e in zip(a, b, edits)]
    assert N.within_many([], [], np.empty(0, int)).tolist() == []


def test_dedup_changes_texts_only(spark):
    docs = documents(spark)
    got = N.dedup_lines(docs)
    assert got.columns == docs.columns
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    new = {r.doc_id: r for r in got.collect()}
    for r in docs.collect():
        left = [x for i, x in enumerate((r.text or "").split("\n")) if (r.doc_id, i) not in want]
        text = None if r.text is None else "\n".join(left)
        if any(k[0] == r.doc_id for k in want) and not (text or "").split():
            assert r.doc_id not in new
        else:
            assert new[r.doc_id].text == text and new[r.doc_id].n_chars == len(text or "") and new[r.doc_id].h == 9
    report = {r.doc_id: r for r in N.line_report(docs).collect()}
    removed = Counter(d for d, _ in want)
    assert {d: r.n_removed for d, r in report.items()} == {r.doc_id: removed[r.doc_id] for r in docs.collect()}
    assert N.dedup_lines(empty(spark)).count() == 0 and N.line_report(empty(spark)).count() == 0
    twice = N.dedup_lines(docs.union(docs))
    assert twice.groupBy("doc_id").count().where(F.col("count") % 2 == 1).where("doc_id is not null").count() == 0


def test_bands_match_brute_force(spark):
    """Short repeats go too, and long lines may differ by more edits."""
    rng = random.Random(7)
    long = [prose(rng, 14 * n) for n in (6, 8, 40)]
    own = corpus(5) + ["-" * 10 + "\n" + "=" * 30 + "\n" + "a" * i for i in range(5)] + ["And ornd.\nx", "x\nAnd ornd.", "---\n\n---", "All rights reserved.", "All rights reserved!"]
    own += [changed(rng, x, n) for x in long for n in (0, 3, 4, 7, 8)]
    rows = list(enumerate(own))
    bands = N.BANDS
    occ = sorted((d, i, x) for d, t in rows for i, x in enumerate(t.split("\n")) if any(c.isalnum() for c in x))
    names = sorted({x for _, _, x in occ}, key=len)
    g = Groups(len(names))
    for j, b in enumerate(names):
        for i in range(j):
            e = max((e for n, e in bands if n <= len(names[i])), default=0)
            if len(b) - len(names[i]) <= e and distance(names[i], b) <= e:
                g.join(i, j)
    cls = {x: g.top(i) for i, x in enumerate(names)}
    lead, want = {}, set()
    for d, i, x in occ:
        if lead.setdefault(cls[x], (d, i)) != (d, i):
            want.add((d, i))
    got = {(r.doc_id, r.line_no) for r in N.repeated_lines(with_ids(spark, own), bands=bands).collect()}
    assert got == want
    assert not any(own[d].split("\n")[i] in ("-" * 10, "=" * 30) for d, i in got)  # rules stay, whatever their length
    before = brute([(i, t.replace("=" * 30, "-")) for i, t in rows])
    n = own.index("And ornd.\nx")
    assert {(n + 1, 0), (n + 1, 1), (n + 4, 0)} <= got and set(before) < got
