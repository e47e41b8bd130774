import random
import re
from collections import Counter

from pyspark.sql import functions as F

from dumpmill.llm import licenses, mixing, secrets
from tests.llm.helpers import documents, empty, prose, rows_of, with_ids


def slow_dice(unit):
    def grams(text):
        w = re.sub(r"[^a-z0-9\u0080-\U0010ffff]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)).replace("licence", "license").split()
        return Counter(zip(w, w[1:], strict=False))

    own, best = grams(unit), None
    for name, text in sorted(licenses.TEMPLATES.items()):
        other = grams(text)
        n = sum(own.values()) + sum(other.values())
        dice = 2 * sum((own & other).values()) / n if n else 0
        if sum(own.values()) and dice >= 0.8 and (best is None or dice > best[1]):
            best = name, dice
    return best


def test_license_units_match_brute_force(spark):
    rng = random.Random(2)
    units = []
    for text in licenses.TEMPLATES.values():
        one = " ".join(text.split())
        w = one.split()
        for _ in range(4):
            new = list(w)
            for _ in range(rng.randint(0, 1 + len(w) // 8)):
                new[rng.randrange(len(new))] = rng.choice(["other", "license", "the"])
            units.append(" ".join(new))
    units += ["nothing of the kind here at all", "license", ""]
    got = {r.doc_id: r.licenses for r in licenses.license_matches(with_ids(spark, units)).collect()}
    for i, u in enumerate(units):
        hit = slow_dice(u)
        assert [(m.license, m.dice) for m in got[i]] == ([hit] if hit else [])


def test_license_report(spark):
    mit = licenses.TEMPLATES["MIT/c"]
    own = ["x y z\nReleased under the MIT licence\nq", f"intro\n\nCopyright (c) 2020 A\n{mit}\n\nend", prose(random.Random(1), 200), None, ""]
    got = rows_of(licenses.license_report(with_ids(spark, own)).orderBy("doc_id"))
    assert [(r["license"], r["dice"]) for r in got] == [("MIT", 1.0), ("MIT", 1.0), (None, None), (None, None), (None, None)]
    docs = documents(spark)
    report = licenses.license_report(docs)
    assert report.count() == docs.count() and report.where("license = 'Apache-2.0'").count() == 1 and licenses.license_report(empty(spark)).count() == 0


def test_license_windows_match_brute_force(spark):
    rng = random.Random(4)
    own, hidden = licenses.templates(0.8), []
    for name, text in licenses.TEMPLATES.items():
        w = text.split()
        for _ in range(rng.randint(0, len(w) // 9)):
            w[rng.randrange(len(w))] = "other"
        hidden.append(f"{prose(rng, 30)} {' '.join(w)} {prose(rng, 30)}")
    for text in [*hidden, " ".join(hidden[:3])]:
        words = licenses.plain(text).split()
        want = []
        for name, grams, n in own.own:
            for a in range(len(words) - n):
                common = sum((licenses.bigrams(words[a : a + n + 1]) & grams).values())
                if common / n >= 0.8:
                    want.append((-common, -common / n, name, a, a + n + 1))
        kept = []
        for hit in sorted(want):
            if all(hit[4] <= x[3] or x[4] <= hit[3] for x in kept):
                kept.append(hit)
        assert own.windows(words) == sorted(((x[2], x[3], x[4], -x[1]) for x in kept), key=lambda x: x[1])
    text = "The tool reads logs and writes charts. Released under the MIT License."
    mit = licenses.TEMPLATES["MIT/c"]
    rows = [text, f"{mit}\nint main() {{ return f(a, b, c, d, e, f, g, h, i, j, k, l, m, n, o, p, q, r, s, t, u, v, w, x, y, z); }} " + prose(rng, 60), hidden[0] + " " + hidden[-2], prose(rng, 300), "Released under the MIT License."]
    got = {r.doc_id: r for r in licenses.license_report(with_ids(spark, rows), windows=True).collect()}
    assert [got[i].licenses for i in range(5)] == ["MIT", "MIT", "Apache-2.0,MPL-2.0", "", "MIT"] and got[0].dice == 1.0 and got[4].n_matches == 1


def test_sibling_licenses_keep_their_names(spark):
    texts = licenses.standard()
    names = sorted(set(texts) - set(licenses.TEMPLATES))
    rng = random.Random(8)
    own = [texts[n] for n in names] + [f"{prose(rng, 40)} {texts[n]} {prose(rng, 40)}" for n in names]
    got = {r.doc_id: r for r in licenses.license_report(with_ids(spark, own), windows=True, full=True).collect()}
    for i, n in enumerate([*names, *names]):
        assert got[i].license == n.split("/")[0] and got[i].dice >= 0.8, n
    few = {n: got[len(names) + i].licenses for i, n in enumerate(names) if not n.endswith("/full") or n[0] in "BIM"}
    assert all(v == n.split("/")[0] for n, v in few.items()), few


def test_whole_licenses_behind_comment_marks(spark):
    """With and without marks, in the middle of code; prose about licences is none."""
    texts = licenses.standard()
    names = [n for n in texts if n.endswith("/full") and n.split("/")[0] in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "ISC")]
    assert {n.split("/")[0] for n in names} == {"MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "ISC"}
    code = "int add(int a, int b) { return a + b; }\n"
    own = []
    for n in names:
        for mark in ("", " * ", "# ", "// "):
            own.append(code + "\n".join(mark + x for x in texts[n].split("\n")) + "\n" + code)
    own += ["The licence of the shop was granted without charge to any person, and the work was sold as is.",
            "We use, copy, modify and merge documents; the notice on the door says that copies are not for sale.", code * 40]
    got = {r.doc_id: r for r in licenses.license_report(with_ids(spark, own), windows=True, full=True).collect()}
    assert [got[i].license for i in range(len(own))] == [n.split("/")[0] for n in names for _ in range(4)] + [None] * 3


def test_secret_candidates(spark):
    own = ["a token = \"abcdefghij0123456789\" b 'ZZZZZZZZZZZZZZZZ' tail", None, "", "none here", "ABCDEFGHIJKLMNOP abcdefghijklmnop abcdefghijklmnop"]
    got = [(r.doc_id, r.ordinal, r.value, r.before[-4:], r.after[:2]) for r in secrets.candidates(with_ids(spark, own)).select("row.*", "ordinal", "value", "before", "after").orderBy("doc_id", "ordinal").collect()]
    assert got == [(0, 0, "abcdefghij0123456789", " = \"", "\" "), (0, 1, "ZZZZZZZZZZZZZZZZ", " b '", "' "),
                   (4, 0, "ABCDEFGHIJKLMNOP", "", " "), (4, 1, "abcdefghijklmnop", " ", " "), (4, 2, "abcdefghijklmnop", " ", "")]


def test_forest_held_out_accuracy(spark):
    rows = secrets.made_findings(spark, 4000).withColumn("part", F.pmod(F.xxhash64("value", "before"), F.lit(4)))
    model = secrets.train(rows.where("part < 3").drop("part"))
    scored = secrets._scored(rows.where("part = 3").withColumn("path", F.lit(None).cast("string")), model, None).select("found.secret", (F.col("score") >= 0.5).alias("said"))
    right, n = scored.agg(F.count_if(F.col("secret") == F.col("said")), F.count("*")).head()
    assert n > 500 and right / n > 0.97


def test_corpus_findings_held_out_by_document(spark):
    """The planted secrets of the given documents against their other candidates, split by document."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model, words, sample = secrets.fit(docs)
    assert sample.where("secret").count() > 100 and sample.where("not secret").count() > 1000
    got = secrets.quality(sample, model, words)
    assert got["findings"] > 300 and got["secrets"] > 30 and got["precision"] > 0.95 and got["recall"] > 0.95


def test_corpus_words_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen = Counter()
    for r in docs.select("text").collect():
        seen.update(set(re.findall(r"(?<![a-z])[a-z]{4,12}(?![a-z])", (r.text or "").lower())))
    top = sorted((w for w in seen if seen[w] > 1), key=lambda w: (-seen[w], w))[: secrets.CORPUS_WORDS]
    assert len(top) > 10 and secrets.corpus_words(docs) == top


def slow_features(value, before, after, path, words):
    low, before, path = value.lower(), before.lower(), (path or "").lower()
    n = len(value)
    kinds = ["a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "." for c in value]
    steps = sum((a != b) if a != "." else b != "." for a, b in zip(kinds, kinds[1:]))
    vowels, cons = "aeiouy", "bcdfghjklmnpqrstvwxz"
    turns = sum((a in vowels and b in cons) or (a in cons and b in vowels) for a, b in zip(low, low[1:]))
    covered, i = 0, 0
    known = sorted({w for w in [*secrets.DICTIONARY, *words] if len(w) > 3}, key=lambda w: (-len(w), w))
    while i < n:
        hit = next((w for w in known if low.startswith(w, i)), None)
        covered += len(hit) if hit else 0
        i += len(hit) if hit else 1
    has = lambda pattern, text: float(re.search(pattern, text) is not None)
    return {
        "length": n, "digits": sum(c in "0123456789" for c in value) / n, "capitals": sum(c.isupper() for c in value) / n, "marks": sum(not c.isalnum() for c in value) / n,
        "hexadecimal": float(all(c in "0123456789abcdef" for c in value) or all(c in "0123456789ABCDEF" for c in value)), "class_changes": steps / n, "vowel_changes": turns / n,
        "dictionary": covered / n, "slashes": value.count("/"),
        "dashed": float([len(x) for x in value.split("-")] == [8, 4, 4, 4, 12] and all(c in "0123456789abcdefABCDEF-" for c in value)),
        "near_word": float(any(w in before for w in ("secret", "token", "credential", "bearer", "auth", "passwd", "password", "passwor", "passw")) or bool(re.search("(api|access|private).?key", before))),
        "far_word": float(any(re.fullmatch("commit|sha-?[0-9]*|md5|checksum|digest|uuid|guid|hash|revision|build|integrity|version|etag|blob|tree", w)
                              for w in re.findall(r"sha-[0-9]*|sha[0-9]*(?![a-z])|md5|[a-z]+", before))),
        "assigned": float(bool(before.rstrip().rstrip("\"'").rstrip()[-1:] in ("=", ":")) and before.count("") > 1), "quoted": float(before[-1:] in ('"', "'") and before != ""),
        "dotted": float(before[-1:] in (".", "@") and before != "" or (after[:1] in (".", "@") and after != "" and (after[1:2].isalnum() or after[1:2] == "_"))),
        "repeated": float(any(len(set(value[i : i + 5])) == 1 for i in range(n - 4))),
        "path_code": has(r"\.(py|js|ts|java|go|rs|c|cc|cpp|h|rb|php|cs|sh|scala|kt|sql)$", path),
        "path_config": has(r"\.(env|ini|cfg|conf|toml|ya?ml|json|properties|pem|key)$|config|settings|secrets?|credentials?", path),
        "path_sample": has("test|example|sample|fixture|mock|docs?/|readme", path)}


def test_features_match_brute_force(spark):
    rng = random.Random(9)
    rows = [(r.value, r.before, r.after, rng.choice([None, "src/app.py", "deploy/.env", "tests/data.json", "README", "a/settings.go"])) for r in secrets.made_findings(spark, 400, assigned=True).collect()]
    rows += [("a" * 20 + "B1", "x.", ".com", "p"), ("ABCDEF0123456789ABCD", "see @", "@y", None), ("abcdefab-1234-ABCD-0000-abcdefabcdef", "uuid: ", "", "")]
    words = ["thing", "anne", "keitung"]
    df = spark.createDataFrame(rows, "value string, before string, after string, path string")
    for r in secrets.features(df, words).collect():
        want = slow_features(r.value, r.before, r.after, r.path, words)
        got = r.features.asDict()
        assert set(got) == set(want) == set(secrets.FEATURES)
        for k in want:
            assert abs(got[k] - want[k]) < 1e-9, (k, r.value, r.before, got[k], want[k])


def test_scan_keeps_columns(spark):
    hexes = "0f1e2d3c4b5a69788796a5b4c3d2e1f00f1e2d3c"
    df = spark.createDataFrame([(1, f'token = "{hexes}"', 7, 0.5, "v", "l")], "doc_id long, text string, length int, score double, value string, `odd.name` string")
    row = secrets.scan(df, labelled=secrets.made_findings(spark)).head()
    assert (row.doc_id, row.length, row.score_, row.value_, row["odd.name"], row.value, row.is_secret) == (1, 7, 0.5, "v", "l", hexes, True)


def test_secret_scan(spark):
    hexes = "0f1e2d3c4b5a69788796a5b4c3d2e1f00f1e2d3c"
    own = [f"text token = \"{hexes}\" more", f"fixed in commit {hexes} today", "see /usr/local/share/application/config", "Donaudampfschifffahrtsgesellschaft ist lang", "SHOUTINGWORDSWITHOUTEND !!"]
    made = secrets.made_findings(spark)
    got = {r.doc_id: r.is_secret for r in secrets.scan(with_ids(spark, own), labelled=made).collect()}
    assert got == {0: True, 1: False, 2: False, 3: False, 4: False}
    docs = documents(spark)
    found = secrets.scan(docs)
    assert found.where("is_secret").count() == 1 and secrets.scan(empty(spark)).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_assigned_secrets(spark):
    hexes = "0f1e2d3c4b5a69788796a5b4c3d2e1f00f1e2d3c"
    own = [f"export API_KEY={hexes}", f"aws_secret_access_key = \"{hexes}\"", "password = \"Hunter2-Blue77\"", f"fixed in commit {hexes} today", "token = undefined",
           "a abc=defghijklmnop z", "x " + "QUJDREVGR0hJSktMTU5P==" + " y"]
    got = {(r.doc_id, r.value): r for r in secrets.scan(with_ids(spark, own), labelled=secrets.made_findings(spark, assigned=True), assigned=True).collect()}
    assert sorted(got) == sorted([(0, hexes), (1, "aws_secret_access_key"), (1, hexes), (2, "Hunter2-Blue77"), (3, hexes), (4, "undefined"),
                                  (5, "abc=defghijklmnop"), (6, "QUJDREVGR0hJSktMTU5P==")])
    assert got[1, hexes].before == 'aws_secret_access_key = "' and got[0, hexes].before == "export API_KEY="
    assert [got[k].is_secret for k in ((0, hexes), (1, hexes), (2, "Hunter2-Blue77"), (3, hexes), (4, "undefined"))] == [True, True, True, False, False]


def slow_targets(size, weights=(5, 2, 1), repeats=3):
    names = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(size.values()), set()
    while True:
        left = total - sum(repeats * size[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        out = {s: repeats * size[s] if s in full else left * weight[s] / share for s in names}
        new = {s for s in names if out[s] > repeats * size[s]}
        if not new - full:
            return out
        full |= new


def test_mix(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randint(1, 60)), rng.choice(["a", "b", "c", "d", "tiny", None] if i % 3 else ["big"])) for i in range(600)]
    rows += [(600, None, "a"), (601, "", "zero"), (602, "  \n", "zero")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = rows_of(mixing.mix(df))
    size = Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    want, taken = slow_targets(size), Counter()
    for r in got:
        assert r["source_size"] == size[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6 and r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= max(3, 0.01 * want[s]) for s in want)
    again = {r["doc_id"]: r["taken"] for r in rows_of(mixing.mix(df.repartition(9)))}
    assert again == {r["doc_id"]: r["taken"] for r in got}
    copies = Counter(r.doc_id for r in mixing.mixed_documents(df).collect())
    assert all(copies[r["doc_id"]] == r["copies"] for r in got)


def test_mix_odd_tables(spark):
    docs = documents(spark)
    own = mixing.mixed_documents(docs)
    assert own.columns == docs.columns and {r.h for r in own.collect()} <= {9}
    assert mixing.mix(docs).count() == docs.count() and mixing.mix(empty(spark)).count() == 0 and mixing.mixed_documents(empty(spark)).count() == 0
    blank = with_ids(spark, ["", None]).withColumn("source", F.lit("s"))
    assert [r.taken for r in mixing.mix(blank).collect()] == [0, 0]
    one = with_ids(spark, ["a b c"] * 50).withColumn("source", F.lit("s"))
    assert [r.taken for r in mixing.mix(one).collect()] == [3] * 50
