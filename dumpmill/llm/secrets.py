"""Secret scans with a random forest against false positives (operator 10).

Candidates are runs of 16 or more characters of keys, hashes, base64 and paths. The text around
each gives its neighbouring words. Every feature is a SQL expression: length, shares of character
classes, transitions between classes and between vowels and consonants, the share covered by words
of a dictionary, marks of paths and identifiers, and words before and after. A random forest that
is trained on labelled findings then separates secrets from other long strings. All work on texts
is DataFrame and SQL functions; nothing is shuffled.

With ``assigned`` (the registered query) runs are cut at the ``=`` after an identifier, shorter values
and other marks count after an assignment to a key word, and ``before`` is the text itself, earlier
candidates included.

The forest learns from labelled findings: those of the corpus itself that their form decides
(``document_findings``: keys, hashes and mixed strings assigned to a key word against words, numbers, paths
and placeholders; what is unclear is left out) and a set made by rule that adds forms a corpus may lack
(``made_findings``). ``quality`` measures precision and recall on documents that training has not seen.
The dictionary is counted over all documents: the words that most of them use, with a short list of words of
code. ``path`` may name a column with the path of a document, of which three features are made.

Null and empty texts have no candidates and no rows; equal candidates in a text are separate rows;
repeated rows are scanned row by row; long texts are scanned whole. Input columns stay; those named like an
output are kept as ``<name>_``. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import aside, written

RUN = r"(?<![A-Za-z0-9+/_=\-])[A-Za-z0-9+/_=\-]{16,}"
#: Words of code whose letters count as covered, besides the most used words of the corpus.
DICTIONARY = (
    "about access account action admin after again align amount and answer api app area article auto back base basic before begin block body "
    "book border bottom box build button call card case center change check child class clear click client close code color column comment "
    "common config contact content control copy count create current custom data date default delete design detail device dialog display "
    "document down edit email empty end enter error event example false field file filter first font footer form frame from function general "
    "get group handle head header height help hidden home icon image index info inner input install internal item java key label language "
    "large layer left level library license light line link list local location log login main make manager map margin max media menu message "
    "method middle min mobile mode module more name native network new next none normal not number object offset only open option order "
    "other output package page panel parent part password path place plain player point position post prefix print private product profile "
    "project public query random range read record region remove render report request require reset resource response result right root row "
    "sample save screen script search section select server service session set setting share show sidebar simple single site size sort source "
    "space standard start state static status step stop string style sub submit success super support system tab table tag target template "
    "test text theme this time title token toggle tool top total transform true type under unit update upload user utils value version view "
    "warning web width window with word wrapper your").split()
NEAR = "secret|token|api.?key|access.?key|private.?key|passw(?:or)?d|passwd|credential|bearer|auth"
_KEY = rf"(?i:{NEAR})[A-Za-z0-9_.\-]{{0,24}}"
_CLASS, _VALUE = r"[A-Za-z0-9+/_\-]", r"""[^\s"'`,;=<>(){}\[\]][^\s"'`,;]{5,}"""
#: Values assigned to a key word; runs without ``=`` but at their end; other runs, unless they are an assignment to one of those.
ASSIGNED = "|".join((
    rf"""(?<=[=:"'\s])(?<=[=:]\s{{0,3}}["']?)(?<={_KEY}["']?\s{{0,3}}:?[=:]\s{{0,3}}["']?){_VALUE}""",
    rf"(?<!{_CLASS})(?!{_KEY}={_VALUE}){_CLASS}{{16,}}+(?:={{1,2}}(?![A-Za-z0-9+/_=\-]))?",
    rf"(?<![A-Za-z0-9+/_=\-])(?=[A-Za-z0-9+/_=\-]{{16}})(?!{_CLASS}*=+{_CLASS}{{16}})(?![A-Za-z0-9_\-]{{0,24}}?{_KEY}={_VALUE})[A-Za-z0-9+/_=\-]{{16,}}"))
FAR = "commit|sha-?[0-9]*|md5|checksum|digest|uuid|guid|hash|revision|build|integrity|version|etag|blob|tree"
FEATURES = (
    "length", "digits", "capitals", "marks", "hexadecimal", "class_changes", "vowel_changes", "dictionary", "slashes", "dashed",
    "near_word", "far_word", "assigned", "quoted", "dotted", "repeated", "path_code", "path_config", "path_sample")
#: Columns that a scan adds.
MADE = ("ordinal", "value", "before", "after", "score", "is_secret")
#: Most words of the corpus in the dictionary, and most of its findings in training.
CORPUS_WORDS, MAX_LABELLED = 300, 20_000
#: Three kinds of path.
PATHS = {
    "path_code": r"\.(?:py|js|ts|java|go|rs|c|cc|cpp|h|rb|php|cs|sh|scala|kt|sql)\z",
    "path_config": r"(?:\.(?:env|ini|cfg|conf|toml|ya?ml|json|properties|pem|key)\z)|(?:config|settings|secrets?|credentials?)",
    "path_sample": r"test|example|sample|fixture|mock|docs?/|readme",
}


def candidates(docs: DataFrame, text: str = "text", assigned: bool = False, path: str | None = None) -> DataFrame:
    """(row: the other columns of ``docs`` in a struct, path, ordinal, value, before, after): a row per candidate."""
    run = ASSIGNED if assigned else RUN
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    own = docs.where(F.col(text).rlike(run)).select(
        F.struct(*rest).alias("row") if rest else F.struct(F.lit(0).alias("_")).alias("row"), (F.col(path) if path else F.lit(None)).cast("string").alias("path"),
        F.regexp_extract_all(text, F.lit(run), 0).alias("values"), F.split(text, run, -1).alias("parts"))

    def before(i: Column) -> Column:
        """The gap; with ``assigned`` also earlier candidates and gaps, of which eight pairs hold more than 40 characters."""
        gap = F.element_at("parts", i + 1)
        if not assigned:
            return gap
        first = F.greatest(i - 7, F.lit(1))
        pairs = F.zip_with(F.slice("parts", first, i - first + 1), F.slice("values", first, i - first + 1), lambda a, b: F.concat(a, b))
        return F.concat(F.array_join(pairs, ""), gap)

    item = F.transform(F.col("values"), lambda v, i: F.struct(
        v.alias("value"), F.right(before(i), F.lit(40)).alias("before"),
        F.left(F.element_at("parts", i + 2), F.lit(24)).alias("after")))
    return own.select("row", "path", F.posexplode(item).alias("ordinal", "item")).select("row", "path", "ordinal", "item.*")


def corpus_words(docs: DataFrame, text: str = "text", most: int = CORPUS_WORDS) -> list[str]:
    """The words of four to twelve small ASCII letters that most documents use, ``most`` of them at most."""
    words = F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(?<![a-z])[a-z]{4,12}(?![a-z])"), 0))).alias("word")
    counts = docs.select(words).groupBy("word").count().where("count > 1")
    return [r.word for r in counts.orderBy(F.desc("count"), "word").limit(most).collect()]


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


def features(found: DataFrame, words: list[str] | None = None) -> DataFrame:
    """``found`` (value, before, after, path) with the struct ``features`` of FEATURES, doubles. ``words`` join DICTIONARY."""
    v, low = F.col("value"), F.lower("value")
    before, after, path = F.lower(F.coalesce("before", F.lit(""))), F.coalesce("after", F.lit("")), F.lower(F.coalesce("path", F.lit("")))
    known = {w for w in [*DICTIONARY, *(words or [])] if len(w) > 3}
    words = "|".join(sorted(known, key=lambda w: (-len(w), w)))
    steps = r"(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]|(?<=[^A-Za-z0-9])[A-Za-z0-9]"
    flag = lambda c: c.cast("int")
    made = {
        "length": F.length(v), "digits": _share(v, "[0-9]"), "capitals": _share(v, "[A-Z]"), "marks": _share(v, "[^A-Za-z0-9]"),
        "hexadecimal": flag(v.rlike(r"\A(?:[0-9a-f]+|[0-9A-F]+)\z")), "class_changes": _share(v, steps),
        "vowel_changes": _share(low, "[aeiouy](?=[b-df-hj-np-tv-xz])|[b-df-hj-np-tv-xz](?=[aeiouy])"),
        "dictionary": 1 - F.length(F.regexp_replace(low, words, "")) / F.length(v),
        "slashes": F.regexp_count(v, F.lit("/")), "dashed": flag(v.rlike(r"\A[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\z")),
        "near_word": flag(before.rlike(NEAR)), "far_word": flag(before.rlike(rf"(?<![a-z])(?:{FAR})(?![a-z])")),
        "assigned": flag(before.rlike(r"[=:]\s*[\"']?\z")), "quoted": flag(before.rlike(r"[\"']\z")), "dotted": flag(before.rlike(r"[.@]\z") | after.rlike(r"\A[.@]\w")),
        "repeated": flag(v.rlike(r"(.)\1{4,}")), **{k: flag(path.rlike(p)) for k, p in PATHS.items()},
    }
    return found.withColumn("features", F.struct(*[made[k].cast("double").alias(k) for k in FEATURES]))


def document_findings(found: DataFrame) -> DataFrame:
    """``found`` with ``secret``: what the form of a value and the text before it decide, null where they do not."""
    v, before = F.col("value"), F.lower("before")
    keyed = before.rlike(rf"(?:{NEAR})[a-z0-9_.\-]{{0,24}}[\"']?\s*:?[=:]\s*[\"']?\z")
    summed = before.rlike(rf"(?<![a-z])(?:{FAR})(?![a-z])[^a-z]*\z")
    mixed = v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]")
    strong = v.rlike(r"\A(?:[0-9a-f]{32,}|[0-9A-F]{32,}|AKIA[0-9A-Z]{16}|(?:ghp_|glpat-|xox[abp]-|sk-)[A-Za-z0-9+/_-]{16,}=*)\z") | (mixed & (F.length(v) >= 20))
    plain = v.rlike(r"\A(?:[A-Za-z]+|[0-9]+|[A-Za-z]+(?:[_\-][A-Za-z]+)+|/?(?:[a-z_]+/)+[a-z_]*)\z") | v.rlike(r"(.)\1{5,}")
    return found.withColumn("secret", F.when(keyed & strong, True).when(plain & ~keyed, False).when(summed & strong, False))


def labelled_sample(docs: DataFrame, assigned: bool = True, path: str | None = None, most: int = MAX_LABELLED, seed: str = "secret") -> DataFrame:
    """(value, before, after, path, secret, held_out) of at most ``most`` findings of ``docs`` that their form decides,
    those with the smallest hashes, as many of either kind. All findings of a document share ``held_out``."""
    own = document_findings(candidates(docs.select("text", F.xxhash64(F.lit(seed), "text").alias("own"), (F.col(path) if path else F.lit(None)).cast("string").alias("path")),
                                       assigned=assigned, path="path")).where("secret is not null")
    own = own.select("value", "before", "after", "path", "secret", (F.pmod(F.col("row.own"), F.lit(3)) == 0).alias("held_out"), F.xxhash64("value", "before", "row.own", "ordinal").alias("h"))
    own = written(own, "decided")  # texts are read once for both kinds
    half = lambda kind: own.where(F.col("secret") == kind).orderBy("h", "value").limit(most // 2)
    return half(True).union(half(False)).drop("h")


def made_findings(spark: SparkSession, rows: int = 6000, assigned: bool = False) -> DataFrame:
    """Findings by rule: each id picks a kind of string, its neighbours and the letters by hash. ``assigned`` adds
    short values and long key names."""
    md = lambda k: F.md5(F.concat(F.lit(f"{k}:"), F.col("id").cast("string")))
    sha = F.sha1(F.concat(F.lit("s"), F.col("id").cast("string")))
    pick = lambda k, *of: F.element_at(F.array(*map(F.lit, of)), (F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(len(of))) + 1).cast("int"))
    b64 = F.base64(F.unhex(F.concat(sha, F.substring(md("b"), 1, 8))))
    upper = F.upper(F.substring(F.base64(F.unhex(md("u"))), 1, 16))
    word = lambda k: pick(k, *DICTIONARY)
    made = lambda k, n: F.translate(F.substring(md(k), 1, n), "0123456789", "aeiourntsl")  # noqa: E731  pronounceable
    key = F.concat(pick("k", "token", "secret", "api_key", "apikey", "access_key", "password", "auth_token", "private_key", "client_secret"),
                   pick("e", " = \"", "=", ": \"", "=\"", ": ", " = '", " := \""))
    plain = F.concat(word("p1"), F.lit(" "), word("p2"), F.lit(" "))
    sums = F.concat(pick("h", "commit ", "sha1: ", "md5 = ", "checksum: ", "digest=", "revision ", "uuid: ", "etag: \"", "integrity=\"", "build "))
    uuid = F.concat_ws("-", *[F.substring(md("d"), a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    path = F.concat_ws("/", F.lit(""), word("a1"), word("a2"), word("a3"), word("a4"))
    name = F.concat_ws("_", word("n1"), word("n2"), word("n3"), word("n4"))
    long = F.concat(made("w", 10), word("w2"), made("w3", 6))
    case = F.pmod(F.xxhash64(F.lit("case"), "id"), F.lit(21 if assigned else 15))
    rules = [
        (sha, key, True), (md("a"), key, True), (b64, key, True), (F.concat(F.lit("AKIA"), upper), plain, True),
        (F.concat(pick("g", "ghp_", "sk-", "xoxb-", "glpat-"), F.substring(F.base64(F.unhex(F.concat(sha, md("g")))), 1, 36)), plain, True),
        (F.upper(sha), F.upper(key), True), (sha, sums, False), (md("c"), sums, False), (uuid, pick("uu", "id ", "uuid: ", "request ", "id = \""), False),
        (path, pick("pa", "in ", "open(", "path = \"", "file: "), False), (name, pick("na", "def ", "call ", "key = ", "token = \""), False),
        (long, plain, False), (F.concat(long, made("w4", 8)), plain, False),
        (F.upper(long), F.upper(plain), False),
        (F.rpad(pick("pl", "your_api_key_", "xxxx", "0000", "----", "====", "REPLACE_ME_"), 24, "x"), key, False),
    ]
    short = F.concat(F.initcap(word("v1")), F.substring(md("v"), 1, 2), pick("v2", "-", "!", "#", "$", "_", ""), F.initcap(word("v3")), F.substring(md("v4"), 1, 3))
    keys = pick("lk", "aws_secret_access_key = \"", "aws_secret_access_key=", "github_personal_access_token=", "database_root_password: ", "export API_KEY=", "DB_PASSWORD=")
    names = pick("sv", "required", "undefined", "optional", "${TOKEN}", "process.env.TOKEN", "os.environ", "get_token()", "string", "config.token", "self.password")
    if assigned:
        rules += [(short, key, True), (F.substring(b64, 1, 10), key, True), (F.substring(sha, 1, 12), keys, True), (short, keys, True), (sha, keys, True),
                  (names, key, False)]
    value, before, secret = (F.coalesce(*[F.when(case == i, F.lit(r[j]) if isinstance(r[j], bool) else r[j]) for i, r in enumerate(rules)]) for j in range(3))
    after = pick("af", "\"", "'", " ", "\n", "")
    return spark.range(0, rows, 1, 4).select(
        F.when(case >= 15, F.substring(value, 1, 80)).otherwise(F.substring(F.regexp_replace(F.rpad(value, F.greatest(F.length(value), F.lit(16)), "e"), r"[^A-Za-z0-9+/_=\-]", ""), 1, 80)).alias("value"),
        before.alias("before"), after.alias("after"), secret.alias("secret"))


def train(labelled: DataFrame, words: list[str] | None = None, trees: int = 24, depth: int = 7, seed: int = 10):
    """A forest over FEATURES, fitted on ``labelled`` (value, before, after, secret, and path if there is one)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    if "path" not in labelled.columns:
        labelled = labelled.withColumn("path", F.lit(None).cast("string"))
    rows = features(labelled.where("value is not null and secret is not null"), words).select("features.*", F.col("secret").cast("double").alias("label"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="_features")
    return Pipeline(stages=[VectorAssembler(inputCols=list(FEATURES), outputCol="_features"), forest]).fit(rows)


def fit(docs: DataFrame, assigned: bool = True, path: str | None = None):
    """(model, words of the corpus, labelled findings of the corpus): trained on those not held out and the made ones."""
    words = corpus_words(docs)
    sample = written(labelled_sample(docs, assigned, path), "findings")
    cols = ["value", "before", "after", "path", "secret"]
    made = made_findings(docs.sparkSession, assigned=assigned).withColumn("path", F.lit(None).cast("string"))
    own = sample.where("not held_out").orderBy(*cols)  # a fixed order, so reruns grow the same trees
    return train(own.select(*cols).coalesce(1).union(made.select(*cols)), words), words, sample


def _scored(found: DataFrame, model, words: list[str] | None) -> DataFrame:
    """``found`` in a struct ``found``, with ``score``."""
    from pyspark.ml.functions import vector_to_array

    own = features(found, words)
    own = own.select(F.struct(*found.columns).alias("found"), "features.*")
    return model.transform(own).select("found", vector_to_array("probability")[1].alias("score"))


def quality(sample: DataFrame, model, words: list[str] | None = None) -> dict[str, float]:
    """Findings, precision and recall over the held-out findings of a sample."""
    own = _scored(sample.where("held_out"), model, words).select("found.secret", (F.col("score") >= 0.5).alias("named"))
    n, named, secret, both = own.agg(F.count("*"), F.count_if("named"), F.count_if("secret"), F.count_if(F.col("named") & F.col("secret"))).head()
    return {"findings": n, "secrets": secret, "precision": both / named if named else 1.0, "recall": both / secret if secret else 1.0}


def scan(docs: DataFrame, labelled: DataFrame | None = None, model=None, assigned: bool = False, words: list[str] | None = None, path: str | None = None) -> DataFrame:
    """(the columns of ``docs`` but its text, ordinal, value, before, after, score, is_secret).

    Without ``labelled`` or a ``model`` the forest is fitted on ``docs`` (``fit``)."""
    if model is None and labelled is None:
        model, words, _ = fit(docs, assigned, path)
    model = model or train(labelled, words)
    rest = [c for c in docs.columns if c != "text"]
    names = aside(docs.select(*[F.col(f"`{c}`") for c in rest]), *MADE).columns
    own = _scored(candidates(docs, assigned=assigned, path=path), model, words)
    score = F.col("score")
    return own.select(*[F.col(f"found.row.`{c}`").alias(n) for c, n in zip(rest, names, strict=True)], *[f"found.{c}" for c in MADE[:4]],
                      F.round(score, 6).alias("score"), (score >= 0.5).alias("is_secret"))
