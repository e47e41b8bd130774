import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from dumpmill.functions.canon import RECORD
from dumpmill.operators.policy import apply_filters, skip_reason, split_skipped, violations, violations_long
from dumpmill.plans.policy import PolicyError, lint_policy, load_policy, parse_policy

POLICY = {
    "skip_records": {"artists": [{"field": "profile", "contains": "DO NOT USE", "reason": "junk"}, {"field": "tags.tag", "contains": "bad", "reason": "tagged"}]},
    "filters": {"artists": [
        {"field": "genres.genre", "remove_matching": r"^\d+$", "reason": "numeric"},
        {"field": "released", "nullify_when": {"type": "range", "below": 1860, "above": 2027}, "reason": "date"},
        {"field": "list.1.word", "remove_matching": "^x", "reason": "nested"}]},
    "rules": {"artists": [
        {"name": "name", "field": "name", "severity": "error", "condition": {"type": "required"}},
        {"name": "size", "field": "size", "severity": "warning", "condition": {"type": "range", "min": 2, "max": 9}},
        {"name": "digits", "field": "genres.genre", "severity": "info", "condition": {"type": "regex", "pattern": r"^\d+$"}},
        {"name": "long", "field": "name", "severity": "info", "condition": {"type": "length", "min": 2, "max": 4}},
        {"name": "known", "field": "genres.genre", "severity": "warning", "condition": {"type": "enum", "values": ["Rock", "Jazz"]}}]},
}


def records(spark, rows):
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "n int, j string")
    return df.select("n", F.parse_json("j").cast(RECORD).alias("data"))


# a row-at-a-time version of the policy semantics
def values(tree, path):
    now = [tree]
    for step in path.split("."):
        new = []
        for v in now:
            if isinstance(v, dict) and step in v:
                new += v[step] if isinstance(v[step], list) else [v[step]]
        now = new
    return ["" if v is None else v if isinstance(v, str) else json.dumps(v) for v in now if v is None or isinstance(v, str) or isinstance(v, int | float) and not isinstance(v, bool)]


def number(s):
    if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[+-]?(inf|infinity|nan)", s, re.I):
        return float(s)
    return None


def check(rule, s):
    c = rule["condition"]
    if c["type"] == "regex":
        return re.search(c["pattern"].replace("$", r"\Z"), s) is not None
    if c["type"] == "enum":
        return s not in c["values"]
    n = len(s) if c["type"] == "length" else number(s)
    return n is not None and not math.isnan(n) and (n < c["min"] or n > c["max"])


def expected(tree):
    out = []
    for rule in POLICY["rules"]["artists"]:
        vals = values(tree, rule["field"])
        if rule["condition"]["type"] == "required":
            bad = [""] if not vals else [v for v in vals if v == ""]
        else:
            bad = [v for v in vals if check(rule, v)]
        out += [(rule["name"], rule["severity"], rule["field"], v) for v in bad]
    return out


def random_tree(rng):
    word = lambda: rng.choice(["Rock", "Jazz", "12", "7\n", "", "héé", "abcdef", "x", "3", "10.5", "nan", "5d", " 5 ", "DO not use me"])
    value = lambda: rng.choice([word(), None, rng.randint(-5, 20), True, [word(), None, 3], {"a": 1}, []])
    out = {k: value() for k in ("name", "size", "profile") if rng.random() < 0.8}
    if rng.random() < 0.8:
        out["genres"] = rng.choice([{"genre": value()}, [{"genre": value()}, {"genre": word()}], {"genre": [word(), word(), {"q": 1}]}, word(), None])
    if rng.random() < 0.5:
        out["tags"] = {"tag": rng.choice([["a", "So BAD"], "badly", None])}
    return out


def test_rules_and_skips_match_a_row_by_row_version(spark):
    rng = random.Random(3)
    trees = [random_tree(rng) for _ in range(400)]
    own = parse_policy(POLICY).of("artists")
    df = records(spark, trees)
    rows = df.select("n", violations(df, own.rules, "data").alias("v"), skip_reason(df, own.skips, "data").alias("s")).orderBy("n").collect()
    for tree, r in zip(trees, rows, strict=True):
        assert [tuple(v) for v in r.v] == expected(tree), tree
        skip = next(((s["reason"], s["field"], v) for s in POLICY["skip_records"]["artists"] for v in values(tree, s["field"]) if s["contains"].lower() in v.lower()), None)
        assert (tuple(r.s) if r.s else None) == skip, tree


def test_filters(spark):
    own = parse_policy(POLICY).of("artists")
    trees = [
        {"genres": {"genre": ["Rock", "12", 5, "7"]}, "released": "0400-01-01"}, {"genres": {"genre": "12"}, "released": "1969-09-26"},
        {"genres": [{"genre": "12"}], "released": 3000}, {"released": None}, {"released": "Sep 1969", "genres": {"genre": {"x": 1}}}, {"released": "NaN"},
        {"list": [{"word": "x"}, {"word": ["xa", "b"]}]}, {"released": ["1"], "genres": {"other": 1}}]
    rows = apply_filters(records(spark, trees), own, "data").orderBy("n").select(F.to_json(F.to_variant_object("data")).alias("d"), "actions").collect()
    got = [(json.loads(r.d), [(a.field, a.removed_count, list(a.removed_values)) for a in r.actions]) for r in rows]
    assert got == [
        ({"genres": {"genre": ["Rock", 5]}, "released": None}, [("genres.genre", 2, ["12", "7"]), ("released", 1, ["0400-01-01"])]),
        ({"genres": {}, "released": "1969-09-26"}, [("genres.genre", 1, ["12"])]),
        ({"genres": [{"genre": "12"}], "released": None}, [("released", 1, ["3000"])]),
        ({"released": None}, []), (trees[4], []), (trees[5], []),
        ({"list": [{"word": "x"}, {"word": ["b"]}]}, [("list.1.word", 1, ["xa"])]), (trees[7], [])]


def test_typed_tables(spark):
    df = spark.createDataFrame([(1, "abc", ["Rock", "9"], (["7", "x"],), 5.0, "1700-01-01"), (2, None, None, None, None, None)],
                               "id int, name string, tags array<string>, deep struct<w:array<string>>, size double, day string")
    policy = parse_policy({
        "filters": {"t": [{"field": "tags", "remove_matching": "^[0-9]$", "reason": "r"}, {"field": "deep.w", "remove_matching": "^7$", "reason": "r"},
                          {"field": "day", "nullify_when": {"type": "range", "below": 1800}, "reason": "r"}, {"field": "name", "remove_matching": "zz", "reason": "r"}]},
        "rules": {"t": [{"name": "a", "field": "name", "severity": "error", "condition": {"type": "required"}},
                        {"name": "b", "field": "deep.w", "severity": "info", "condition": {"type": "enum", "values": ["q"]}},
                        {"name": "c", "field": "size", "severity": "info", "condition": {"type": "range", "max": 4}}]}}, ["t"]).of("t")
    out = apply_filters(df, policy)
    out = out.withColumn("violations", violations(out, policy.rules))
    a, b = out.orderBy("id").collect()
    assert (a.tags, a.deep.w, a.day, len(a.actions)) == (["Rock"], ["x"], None, 3)
    assert [(v.rule, v.value) for v in a.violations] == [("b", "x"), ("c", "5.0")]
    assert b.actions == [] and [v.rule for v in b.violations] == ["a"]
    kept, skipped = split_skipped(df, parse_policy({"skip_records": {"t": [{"field": "name", "contains": "B", "reason": "r"}]}}, ["t"]).of("t").skips)
    assert [r.id for r in kept.collect()] == [2] and [tuple(r._skip) for r in skipped.collect()] == [("r", "name", "abc")]
    assert violations_long(out, "id").count() == 3


def test_bad_policies(tmp_path):
    rule = lambda **c: {"rules": {"artists": [{"name": "n", "field": "f", "severity": "error", "condition": c}]}}
    for bad in (
        {"rules": {"songs": []}}, {"extra": {}}, rule(type="odd"), rule(type="regex", pattern="("), rule(type="regex"), rule(type="range", min="1"),
        {"rules": {"artists": [{"name": "n", "field": "f", "severity": "fatal", "condition": {"type": "required"}}]}},
        {"filters": {"artists": [{"field": "f", "reason": "r", "nullify_when": {"type": "range"}}]}},
        {"filters": {"artists": [{"field": "f", "reason": "r", "nullify_when": {"type": "odd", "below": 1}}]}}, {"skip_records": {"artists": [{"field": "f"}]}}):
        with pytest.raises(PolicyError):
            parse_policy(bad)
    with pytest.raises(PolicyError):
        load_policy(str(tmp_path / "p.json"))
    (tmp_path / "p.yml").write_text("rules: {artists: [{name: n, field: f, severity: info, condition: {type: required}}]}")
    assert load_policy(str(tmp_path / "p.yml")).of("artists").rules[0].name == "n" and load_policy(str(tmp_path / "p.yml")).of("labels").rules == ()


def test_lint():
    policy = parse_policy(POLICY | {"rules": {"artists": [
        {"name": "shadowed", "field": "released", "severity": "info", "condition": {"type": "range", "min": 1800, "max": 2030}},
        {"name": "wider", "field": "released", "severity": "info", "condition": {"type": "range", "min": 1900}},
        {"name": "same", "field": "genres.genre", "severity": "info", "condition": {"type": "regex", "pattern": r"^\d+$"}}]}})
    assert lint_policy(policy) == [("artists", "shadowed"), ("artists", "same")]
