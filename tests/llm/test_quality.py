import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from dumpmill.llm import quality, rules
from tests.llm.helpers import documents, empty, prose, texts, with_ids


def corpus(spark, n=400):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        rows.append((i, prose(rng, rng.randint(20, 80)) if good else " ".join(rng.choice("zork blip ### qux | %%%".split()) for _ in range(rng.randint(20, 80)))))
        if i % 2:
            labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_held_out_accuracy_and_reruns(spark):
    docs, labels, rows = corpus(spark)
    got = {r.doc_id: r.kept for r in quality.quality_scores(docs, labels).collect()}
    truth = {i: "zork" not in t and "###" not in t for i, t in rows}
    held_out = [i for i in got if i % 2 == 0]
    assert sum(got[i] == truth[i] for i in held_out) >= 0.98 * len(held_out)
    again = {r.doc_id: r.kept for r in quality.quality_scores(docs.repartition(7), labels.repartition(3)).collect()}
    assert again == got
    kept = {r.doc_id for r in quality.good_documents(docs, labels).collect()}
    assert kept == {i for i, k in got.items() if k}


def test_log_weights_match_brute_force(spark):
    docs, labels, rows = corpus(spark, 60)
    ratios, sample = quality.fit(docs, labels)
    good = {r.doc_id for r in sample.where("good and not held_out").collect()}

    def grams(text):
        tokens = re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+|[^\sA-Za-z0-9\u0080-\U0010ffff]+", text)
        return quality.hashed_ngrams([text])[0], 2 * len(tokens) - 1 + sum(a == b for a, b in zip(tokens, tokens[1:], strict=False))

    raw, target = Counter(), Counter()
    for i, t in rows:
        own, n = grams(t)
        assert len(own) == n
        raw.update(own.tolist())
        if i in good:
            target.update(own.tolist())
    for b in raw:
        want = np.log((target[b] + 1) / (raw[b] * sum(target.values()) / sum(raw.values()) + 1))
        assert abs(ratios[b] - want * quality.UNIT) <= 1
    got = {r.doc_id: r.w for r in docs.select("doc_id", quality.log_weight(ratios).alias("w")).collect()}
    assert got == {i: int(ratios[grams(t)[0]].sum()) for i, t in rows}
    together = quality.hashed_ngrams([t for _, t in rows])
    for i in range(len(rows)):
        assert sorted(together[0][together[1] == i]) == sorted(grams(rows[i][1])[0])


def test_top_k_is_exact(spark):
    rng = random.Random(1)
    values = [rng.choice([-5, 3, rng.randint(-10**12, 10**12)]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    for k in (1, 2, 100, 499, 500, 900):
        assert quality.kth_largest(df, "v", k) == sorted(values, reverse=True)[min(k, 500) - 1]
    assert quality.kth_largest(df, "v", 0) is None and quality.kth_largest(df.limit(0), "v", 5) is None
    docs, labels, _ = corpus(spark, 100)
    assert quality.quality_scores(docs, labels, k=13).where("kept").count() == 13


def test_odd_tables(spark):
    docs = documents(spark)
    _, labels, _ = corpus(spark, 60)
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    blank = {r.doc_id for r in docs.collect() if not (r.text or "").split()}
    assert all(got[i].log_weight is None and not got[i].kept for i in blank)
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns and quality.good_documents(empty(spark), labels).count() == 0
    none = labels.limit(0)
    assert quality.quality_scores(docs, none).where("kept").count() == docs.count() - len(blank)
    one_sided = labels.withColumn("quality", F.lit(1)).union(spark.createDataFrame([(None, 1, 0), (5, None, 1)], labels.schema))
    assert quality.quality_scores(docs, one_sided).where("kept").count() == docs.count() - len(blank)
    assert quality.labelled_sample(labels, 7).count() == 7


def slow_rules(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w))


def test_rules_base(spark):
    rng = random.Random(9)
    own = texts(7, 30) + [" ".join(rng.choice("abc") for _ in range(60)) for _ in range(20)] + ["a\nb\n\na\n \na", "one two three  x"]
    got = {r.doc_id: r for r in rules.quality_rules(with_ids(spark, own)).collect()}
    for i, t in enumerate(own):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == slow_rules(t)
        assert not (r.kept and r.base_failed)


def test_cascade_order_never_changes_the_verdict(spark):
    own = with_ids(spark, texts(8, 30) + ["GO AWAY NOW!! " + prose(random.Random(1), 40).upper(), "x| " * 50])
    names = list(rules.RULES)
    verdicts = []
    for order in (names, names[::-1]):
        verdicts.append({r.doc_id: r.kept for r in rules.quality_rules(own, order).collect()})
    t = rules.Text("| # | # a b c d e f g h " * 5)
    t.base = rules.measure(t)
    assert verdicts[0] == verdicts[1] and not all(verdicts[0].values()) and any(verdicts[0].values())
    order = rules.cascade_order(own, {"slow": lambda t: sum(range(20000)) < 0, "quick": lambda t: True})
    assert order == ["quick", "slow"]
    assert rules.quality_rules(empty(spark)).count() == 0 and rules.quality_rules(documents(spark)).count() == documents(spark).count()
