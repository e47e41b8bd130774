"""Queries over the test tables that exercise each operator, with the same in SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpmill.functions import text as X
from dumpmill.functions.canon import canonical_json, content_hash, envelope, record
from dumpmill.functions.values import resolve
from dumpmill.operators import blocks, report, state
from dumpmill.operators.normalize import strip_prefixes, unwrap_container
from dumpmill.operators.policy import apply_filters, split_skipped, violations, violations_long
from dumpmill.plans.policy import EntityPolicy, parse_policy
from dumpmill.registry import ORACLES, QUERIES, query, spread, table, work_folder
from dumpmill.sinks import events as E
from dumpmill.sources import files

#: The policy of these queries, in the language of ``parse_policy``.
POLICY = parse_policy({
    "skip_records": {
        "documents": [{"field": "text", "contains": "LICENSE", "reason": "licence notice"}, {"field": "lang", "contains": "De", "reason": "german"}],
        "part": [{"field": "p_name", "contains": "RED", "reason": "red"}, {"field": "p_type", "contains": "brass", "reason": "brass"}]},
    "filters": {
        "documents": [{"field": "words", "remove_matching": r"^[0-9]+$", "reason": "numbers"}, {"field": "source", "remove_matching": r"^src1$", "reason": "source"}],
        "customer": [{"field": "c_acctbal", "nullify_when": {"type": "range", "below": 0, "above": 9000}, "reason": "balance"}],
        "orders": [{"field": "day", "nullify_when": {"type": "range", "below": 1993, "above": 1997}, "reason": "year"}]},
    "rules": {
        "documents": [
            {"name": "has-text", "field": "text", "severity": "error", "condition": {"type": "required"}},
            {"name": "length", "field": "text", "severity": "warning", "condition": {"type": "length", "min": 50, "max": 5000}},
            {"name": "digits", "field": "text", "severity": "info", "condition": {"type": "regex", "pattern": "[0-9]{6,}"}},
            {"name": "language", "field": "lang", "severity": "warning", "condition": {"type": "enum", "values": ["en", "de", "fr"]}}],
        "part": [
            {"name": "size", "field": "p_size", "severity": "error", "condition": {"type": "range", "min": 5, "max": 45}},
            {"name": "brand", "field": "p_brand", "severity": "warning", "condition": {"type": "enum", "values": ["Brand#11", "Brand#12", "Brand#13"]}},
            {"name": "name", "field": "p_name", "severity": "info", "condition": {"type": "regex", "pattern": "^l|[gt]$"}},
            {"name": "short", "field": "p_name", "severity": "info", "condition": {"type": "length", "max": 10}}],
        "orders": [{"name": "has-priority", "field": "priority", "severity": "error", "condition": {"type": "required"}}],
        "customer": [{"name": "segment", "field": "c_mktsegment", "severity": "error", "condition": {"type": "enum", "values": ["BUILDING", "MACHINERY"]}},
                     {"name": "balance", "field": "c_acctbal", "severity": "warning", "condition": {"type": "range", "min": 0}}],
    }}, ("documents", "part", "customer", "orders"))


def flagged(df: DataFrame, entity: str) -> DataFrame:
    return df.withColumn("data_type", F.lit(entity)).withColumn("violations", violations(df, POLICY.of(entity).rules))


# --- policy -----------------------------------------------------------------------------------


@query("""SELECT doc_id, CASE WHEN contains(lower(text), 'license') THEN 'licence notice' ELSE 'german' END AS reason,
CASE WHEN contains(lower(text), 'license') THEN 'text' ELSE 'lang' END AS field FROM documents WHERE contains(lower(text), 'license') OR contains(lower(lang), 'de')""")
def skip_contains_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first condition that holds gives the reason."""
    _, skipped = split_skipped(table(spark, sf_dir, "documents"), POLICY.of("documents").skips)
    return skipped.select("doc_id", "_skip.reason", "_skip.field")


@query("""WITH s AS (SELECT CASE WHEN contains(lower(p_name), 'red') THEN 'red' WHEN contains(lower(p_type), 'brass') THEN 'brass' END AS reason FROM part)
SELECT 'part' AS data_type, reason, count(*) AS skipped FROM s WHERE reason IS NOT NULL GROUP BY reason""")
def skip_reason_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, counts; ``skip_reason_ids`` has the ids."""
    _, skipped = split_skipped(table(spark, sf_dir, "part"), POLICY.of("part").skips)
    return report.skip_counts(skipped.select(F.lit("part").alias("data_type"), F.col("p_partkey").cast("string").alias("id"), "_skip"), sample=0)


@query("""WITH s AS (SELECT p_partkey, CASE WHEN contains(lower(p_name), 'red') THEN 'red' WHEN contains(lower(p_type), 'brass') THEN 'brass' END AS reason FROM part)
SELECT 'part' AS data_type, reason, cast(floor(p_partkey / 1000) AS BIGINT) AS block, count(*) AS skipped, string_agg(cast(p_partkey AS VARCHAR), ', ' ORDER BY cast(p_partkey AS VARCHAR)) AS ids
FROM s WHERE reason IS NOT NULL GROUP BY ALL""")
def skip_reason_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, all ids of a reason in blocks of at most 1,000."""
    _, skipped = split_skipped(table(spark, sf_dir, "part"), POLICY.of("part").skips)
    own = skipped.select(F.lit("part").alias("data_type"), F.col("p_partkey").cast("string").alias("id"), "p_partkey", "_skip")
    return report.skip_ids(own, F.floor(F.col("p_partkey") / 1000))


@query("SELECT p_partkey, p_name FROM part WHERE NOT contains(lower(p_name), 'red') AND NOT contains(lower(p_type), 'brass')")
def skip_kept_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = split_skipped(table(spark, sf_dir, "part"), POLICY.of("part").skips)
    return kept.select("p_partkey", "p_name")


@query(r"""WITH w AS (SELECT doc_id, source, string_split(text, ' ') AS words FROM documents)
SELECT doc_id, len(list_filter(words, lambda x: NOT regexp_matches(x, '^[0-9]+$'))) AS kept_words, len(list_filter(words, lambda x: regexp_matches(x, '^[0-9]+$'))) AS removed_words,
coalesce(array_to_string(list_filter(words, lambda x: regexp_matches(x, '^[0-9]+$')), ','), '') AS removed, CASE WHEN source <> 'src1' THEN source END AS source FROM w""")
def filter_remove_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 on lists, P4 on a lone value, P8 in order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.split("text", " ").alias("words"))
    out = apply_filters(docs, POLICY.of("documents"))
    gone = F.flatten(F.transform(F.filter("actions", lambda a: a["field"] == "words"), lambda a: a["removed_values"]))
    return out.select("doc_id", F.size("words").cast("long").alias("kept_words"), F.size(gone).cast("long").alias("removed_words"), F.array_join(gone, ",").alias("removed"), "source")


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_acctbal > 9000 THEN NULL ELSE c_acctbal END AS c_acctbal,
CASE WHEN c_acctbal < 0 OR c_acctbal > 9000 THEN 1 ELSE 0 END AS repairs FROM customer""")
def filter_nullify_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6."""
    out = apply_filters(table(spark, sf_dir, "customer"), POLICY.of("customer"))
    return out.select("c_custkey", "c_acctbal", F.size("actions").alias("repairs"))


@query("""SELECT o_orderkey, CASE WHEN year(o_orderdate) < 1993 OR year(o_orderdate) > 1997 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""")
def nullify_leading_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date string is compared by its year."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return apply_filters(orders, POLICY.of("orders")).select("o_orderkey", "day")


def _rule_query(name: str, entity: str, key: str, rule: str, sql: str, prepared=lambda df: df) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = prepared(table(spark, sf_dir, entity))
        own = tuple(r for r in POLICY.of(entity).rules if r.name == rule)
        out = df.withColumn("violations", violations(df, own))
        return violations_long(out, key).select(key, "rule", "severity", "value")

    QUERIES[name], ORACLES[name] = run, sql


_rule_query("rule_required", "orders", "o_orderkey", "has-priority",
            "SELECT o_orderkey, 'has-priority' AS rule, 'error' AS severity, '' AS value FROM orders WHERE o_orderstatus <> 'F'",
            lambda df: df.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).when(F.col("o_orderstatus") == "O", "").alias("priority")))
_rule_query("rule_range", "part", "p_partkey", "size",
            "SELECT p_partkey, 'size' AS rule, 'error' AS severity, cast(p_size AS VARCHAR) AS value FROM part WHERE p_size < 5 OR p_size > 45")
_rule_query("rule_regex", "part", "p_partkey", "name",
            "SELECT p_partkey, 'name' AS rule, 'info' AS severity, p_name AS value FROM part WHERE regexp_matches(p_name, '^l|[gt]$')")
_rule_query("rule_length", "documents", "doc_id", "length",
            "SELECT doc_id, 'length' AS rule, 'warning' AS severity, text AS value FROM documents WHERE length(text) < 50 OR length(text) > 5000")
_rule_query("rule_enum", "customer", "c_custkey", "segment",
            "SELECT c_custkey, 'segment' AS rule, 'error' AS severity, c_mktsegment AS value FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")

_PART_VIOLATIONS = """SELECT p_partkey, 'size' AS rule, 'error' AS severity, 'p_size' AS field, cast(p_size AS VARCHAR) AS value FROM part WHERE p_size < 5 OR p_size > 45
UNION ALL SELECT p_partkey, 'brand', 'warning', 'p_brand', p_brand FROM part WHERE p_brand NOT IN ('Brand#11', 'Brand#12', 'Brand#13')
UNION ALL SELECT p_partkey, 'name', 'info', 'p_name', p_name FROM part WHERE regexp_matches(p_name, '^l|[gt]$')
UNION ALL SELECT p_partkey, 'short', 'info', 'p_name', p_name FROM part WHERE length(p_name) > 10"""
_COUNTS = "count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings, count(*) FILTER (severity = 'info') AS infos"


@query(_PART_VIOLATIONS)
def violations_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules of an entity in one pass, as a second output."""
    return violations_long(flagged(table(spark, sf_dir, "part"), "part"), "p_partkey")


@query(f"SELECT 'part' AS data_type, rule, {_COUNTS} FROM ({_PART_VIOLATIONS}) GROUP BY rule")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1."""
    return report.violation_counts(violations_long(flagged(table(spark, sf_dir, "part"), "part"), "data_type"))


_DOC_VIOLATIONS = """SELECT 'has-text' AS rule, 'error' AS severity FROM documents WHERE coalesce(text, '') = ''
UNION ALL SELECT 'length', 'warning' FROM documents WHERE length(text) < 50 OR length(text) > 5000
UNION ALL SELECT 'digits', 'info' FROM documents WHERE regexp_matches(text, '[0-9]{6,}')
UNION ALL SELECT 'language', 'warning' FROM documents WHERE lang NOT IN ('en', 'de', 'fr')"""


@query(f"SELECT 'documents' AS data_type, rule, {_COUNTS} FROM ({_DOC_VIOLATIONS}) GROUP BY rule")
def quality_report_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.violation_counts(violations_long(flagged(table(spark, sf_dir, "documents"), "documents"), "data_type"))


@query("""SELECT 'customer' AS data_type, count(*) AS total FROM customer UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'documents', count(*) FROM documents""")
def record_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, A8."""
    own = [table(spark, sf_dir, t).select(F.lit(t).alias("data_type")) for t in ("customer", "part", "documents")]
    return report.record_totals(own[0].union(own[1]).union(own[2]))


@query("""SELECT 'customer' AS data_type, 'c_acctbal' AS field, 'balance' AS reason, count(*) AS records, count(*) AS "values" FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000 HAVING count(*) > 0
UNION ALL SELECT 'orders', 'day', 'year', count(*), count(*) FROM orders WHERE year(o_orderdate) < 1993 OR year(o_orderdate) > 1997 HAVING count(*) > 0""")
def filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4."""
    orders = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    parts = [apply_filters(df, POLICY.of(e)).select(F.lit(e).alias("data_type"), "actions") for e, df in (("customer", table(spark, sf_dir, "customer")), ("orders", orders))]
    return report.repair_counts(parts[0].union(parts[1]))


@query("""SELECT 'orders' AS data_type, o_orderpriority AS rule, count(*) FILTER (o_totalprice > 100000) AS errors, count(*) FILTER (o_totalprice <= 100000) AS warnings, cast(0 AS BIGINT) AS infos
FROM orders GROUP BY o_orderpriority""")
def report_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: reports of two parts added up."""
    orders = table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("data_type"), F.col("o_orderpriority").alias("rule"), F.when(F.col("o_totalprice") > 100000, "error").otherwise("warning").alias("severity"), "o_orderkey")
    parts = [report.violation_counts(orders.where(F.col("o_orderkey") % 2 == i)) for i in (0, 1)]
    return report.merged(parts, ["data_type", "rule"])


@query("""SELECT (SELECT count(*) > 0 FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') OR c_acctbal < 0) AS has_violations,
(SELECT count(*) > 0 FROM part WHERE contains(lower(p_name), 'red') OR contains(lower(p_type), 'brass')) AS has_skipped,
(SELECT count(*) > 0 FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000) AS has_filtered""")
def report_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6."""
    customer = table(spark, sf_dir, "customer")
    v = report.violation_counts(violations_long(flagged(customer, "customer"), "data_type"))
    _, skipped = split_skipped(table(spark, sf_dir, "part"), POLICY.of("part").skips)
    s = report.skip_counts(skipped.select(F.lit("part").alias("data_type"), F.col("p_partkey").cast("string").alias("id"), "_skip"))
    return report.flags(v, s, report.repair_counts(apply_filters(customer.withColumn("data_type", F.lit("customer")), POLICY.of("customer"))))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def path_resolve_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 over VARIANT."""
    events = table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("v"))
    return events.select("event_id", F.explode(resolve(F.col("v"), events.schema["v"].dataType, "k")).alias("k"))


@query("SELECT p_partkey, w.x AS value FROM part, (SELECT unnest(string_split(p.p_name, ' ')) AS x, p.p_partkey AS k FROM part p) w WHERE w.k = p_partkey")
def path_resolve_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 over typed structs and lists."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.struct(F.transform(F.split("p_name", " "), lambda w: F.struct(w.alias("word"))).alias("names")).alias("a"))
    return part.select("p_partkey", F.explode(resolve(F.col("a"), part.schema["a"].dataType, "names.word")).alias("value"))


# --- vocabularies and blocks ------------------------------------------------------------------

_EVENT_MAP = {"view": "seen", "click": "touched", "purchase": "bought"}


@query("""SELECT event_type, CASE event_type WHEN 'view' THEN 'seen' WHEN 'click' THEN 'touched' WHEN 'purchase' THEN 'bought' ELSE 'other' END AS mapped, count(*) AS n FROM events GROUP BY 1, 2""")
def vocab_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed lookup with a default."""
    events = table(spark, sf_dir, "events")
    return events.groupBy("event_type", F.coalesce(blocks.lookup(_EVENT_MAP, F.col("event_type")), F.lit("other")).alias("mapped")).agg(F.count("*").alias("n"))


@query("SELECT c_mktsegment AS unmapped, count(*) AS n FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE') GROUP BY 1")
def vocab_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = blocks.lookup({"BUILDING": "b", "AUTOMOBILE": "a"}, F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").where(known.isNull()).groupBy(F.col("c_mktsegment").alias("unmapped")).agg(F.count("*").alias("n"))


_MEDIA_ROWS = """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'Vinyl' WHEN 1 THEN 'Shellac' WHEN 2 THEN 'CD' ELSE 'Wire' END AS fmt,
CASE p_size % 3 WHEN 0 THEN '7"' WHEN 1 THEN '10"' ELSE 'LP' END AS size_word, p_size FROM part"""


@query(f"""WITH m AS ({_MEDIA_ROWS})
SELECT p_partkey, CASE fmt WHEN 'Vinyl' THEN 'vinyl' WHEN 'Shellac' THEN 'shellac' WHEN 'CD' THEN 'optical' ELSE '' END AS families,
CASE WHEN fmt = 'Vinyl' AND size_word = '7"' THEN 'vinyl_7' WHEN fmt = 'Vinyl' AND size_word = 'LP' THEN 'vinyl_12' WHEN fmt = 'Vinyl' THEN 'vinyl_unspecified'
WHEN fmt = 'Shellac' AND size_word = '10"' THEN 'shellac_10' WHEN fmt = 'Shellac' THEN 'shellac_unspecified' WHEN fmt = 'CD' THEN 'optical_cd' END AS medium,
CASE WHEN fmt <> 'Wire' THEN greatest(p_size, 1) END AS qty, CASE WHEN fmt = 'Shellac' THEN '78' END AS speed, CASE WHEN fmt = 'Wire' THEN 'Wire' ELSE '' END AS unmapped FROM m""")
def resolve_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1, V3 to V7: medium by family and attribute, defaults, quantities."""
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.to_json(F.array(F.struct(
            F.when(F.col("p_size") % 4 == 0, "Vinyl").when(F.col("p_size") % 4 == 1, "Shellac").when(F.col("p_size") % 4 == 2, "CD").otherwise("Wire").alias("name"),
            F.concat(F.col("p_size").cast("string"), F.lit(" pieces")).alias("qty"),
            F.struct(F.array(F.when(F.col("p_size") % 3 == 0, '7"').when(F.col("p_size") % 3 == 1, '10"').otherwise("LP")).alias("description")).alias("descriptions")))).alias("j"))
    own = part.select("p_partkey", blocks.media_block(F.parse_json("j")).cast("variant").alias("m"))
    get = lambda p, t="string": F.try_variant_get("m", p, t)
    return own.select(
        "p_partkey", F.array_join(get("$.families", "array<string>"), ",").alias("families"), get("$.items[0].medium").alias("medium"),
        get("$.items[0].qty", "int").alias("qty"), get("$.items[0].speed_rpm").alias("speed"), F.array_join(get("$.unmapped.formats", "array<string>"), ",").alias("unmapped"))


@query("""SELECT conv_id, turn, array_to_string(list_sort(list_distinct(string_split(text, ' '))), ' ') AS words, list_extract(list_filter(string_split(text, ' '), lambda x: length(x) > 6), 1) AS first_long
FROM conversations""")
def first_wins_sorted_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3, V4, V8."""
    words = F.split("text", " ")
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.array_join(X.sorted_unique(words), " ").alias("words"), F.get(F.filter(words, lambda w: F.char_length(w) > 6), F.lit(0)).alias("first_long"))


@query(r"""SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits, regexp_replace(c_mktsegment || '  ' || c_name || ' ', '^\s+|\s+$', '', 'g') AS trimmed,
upper(regexp_replace(trim(c_mktsegment || '  ' || c_name || ' '), '\s+', ' ', 'g')) AS upper_collapsed FROM customer""")
def alias_normalizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three rules."""
    padded = F.concat("c_mktsegment", F.lit("  "), "c_name", F.lit(" "))
    rule = lambda name, c: blocks.normalize_alias(F.lit(name), c)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", rule("digits_only", F.col("c_name")).alias("digits"), X.utrim(padded).alias("trimmed"), rule("upper_collapse_space", padded).alias("upper_collapsed"))


@query("""SELECT c_custkey, 'barcode' AS provider, regexp_replace(c_name, '[^0-9]', '', 'g') AS external_id FROM customer
UNION ALL SELECT c_custkey, 'catalog_number', upper(c_mktsegment) FROM customer""")
def alias_mint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9 to V11 as one block: typed identifiers and catalogue numbers mint aliases."""
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.parse_json(F.to_json(F.array(F.struct(F.lit("Barcode").alias("type"), F.col("c_name").alias("value"))))).alias("i"),
        F.parse_json(F.to_json(F.array(F.struct(F.lower("c_mktsegment").alias("catno")), F.struct(F.lit("none").alias("catno"))))).alias("l"))
    own = customer.select("c_custkey", blocks.identifiers_block(F.col("i"), F.col("l")).cast("variant").alias("b"))
    aliases = F.try_variant_get("b", "$.aliases", "array<struct<provider:string,external_id:string>>")
    return own.select("c_custkey", F.explode(aliases).alias("a")).select("c_custkey", "a.provider", "a.external_id")


@query("""SELECT s_suppkey, s_name AS name, CASE WHEN s_nationkey % 3 = 0 THEN 'pressing' WHEN s_nationkey % 3 = 1 THEN 'mastering' ELSE 'other' END AS category,
CASE WHEN s_nationkey % 3 = 2 THEN 'Blessed By' ELSE '' END AS unmapped, cast(nullif(s_suppkey, 0) AS VARCHAR) AS company FROM supplier""")
def company_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V12 to V14."""
    role = F.when(F.col("s_nationkey") % 3 == 0, "Pressed By").when(F.col("s_nationkey") % 3 == 1, "Mastered At").otherwise("Blessed By")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.parse_json(F.to_json(F.array(F.struct(
        F.concat(F.lit(" "), "s_name").alias("name"), role.alias("entity_type_name"), F.col("s_suppkey").cast("string").alias("id"))))).alias("c"))
    own = supplier.select("s_suppkey", blocks.companies_block(F.col("c")).cast("variant").alias("b"))
    get = lambda p, t="string": F.try_variant_get("b", p, t)
    return own.select("s_suppkey", get("$.items[0].name").alias("name"), get("$.items[0].role_category").alias("category"),
                      F.array_join(get("$.unmapped.roles", "array<string>"), ",").alias("unmapped"), get("$.items[0].catalog_id").alias("company"))


@query(r"SELECT p_partkey, greatest(p_size, 1) AS quantity, coalesce(try_cast(nullif(regexp_extract(p_name, '^\s*([+-]?[0-9]+)', 1), '') AS BIGINT), 1) AS from_name FROM part")
def leading_int_qty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7."""
    return table(spark, sf_dir, "part").select(
        "p_partkey", X.leading_quantity(F.concat(F.lit(" "), F.col("p_size").cast("string"), F.lit(" discs"))).cast("int").alias("quantity"), X.leading_quantity(F.col("p_name")).alias("from_name"))


# --- hashes and events ------------------------------------------------------------------------

_CUSTOMER_JSON = """'{"id":"' || c_custkey || '","name":"' || c_name || '","segment":' || CASE WHEN c_acctbal < 0 THEN 'null' ELSE '"' || c_mktsegment || '"' END || '}'"""


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.when(F.col("c_acctbal") < 0, F.parse_json(F.lit("null"))).otherwise(F.col("c_mktsegment").cast("variant"))
    return table(spark, sf_dir, "customer").select("c_custkey", record(segment=segment, name=F.col("c_name"), id=F.col("c_custkey").cast("string"), gone=F.lit(None).cast("string")).alias("data"))


@query(f"SELECT c_custkey, {_CUSTOMER_JSON} AS document, sha256({_CUSTOMER_JSON}) AS sha256 FROM customer")
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: keys sorted, absent fields left out, nulls kept."""
    return _customers(spark, sf_dir).select("c_custkey", canonical_json(F.col("data")).alias("document"), content_hash(F.col("data")).alias("sha256"))


@query(f"""SELECT c_custkey, '{{"id":"' || c_custkey || '","name":"' || c_name || '","segment":' || CASE WHEN c_acctbal < 0 THEN 'null' ELSE '"' || c_mktsegment || '"' END
|| ',"sha256":"' || sha256({_CUSTOMER_JSON}) || '","type":"data"}}' AS value FROM customer""")
def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2."""
    return _customers(spark, sf_dir).select("c_custkey", envelope(F.col("data"), F.lit("data")).alias("value"))


@query("""SELECT o_orderstatus AS data_type, '{"data_type":"' || o_orderstatus || '","file":"dump.xml.gz","timestamp":"2024-01-02T03:04:05Z","total_processed":' || count(*) || ',"type":"file_complete"}' AS value
FROM orders GROUP BY 1""")
def file_complete_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6."""
    own = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("data_type")).agg(F.count("*").alias("records")).withColumn("file", F.lit("in/dump.xml.gz"))
    return E.file_complete_events(own, F.lit("2024-01-02 03:04:05").cast("timestamp"))


@query("""WITH c AS (SELECT string_agg('"' || event_type || '":' || n, ',' ORDER BY event_type) AS m FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1))
SELECT e.data_type, '{"record_counts":{' || m || '},"started_at":"2024-01-01T00:00:00Z","timestamp":"2024-01-02T03:04:05Z","type":"extraction_complete","version":"20240101"}' AS value
FROM c, (SELECT unnest(['artists', 'labels', 'masters', 'releases']) AS data_type) e""")
def extraction_complete_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7, A9."""
    progress = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("data_type")).agg(F.count("*").alias("records"))
    at = lambda s: F.lit(s).cast("timestamp")
    return E.extraction_complete_events(report.record_counts(progress), "20240101", at("2024-01-01 00:00:00"), now=at("2024-01-02 03:04:05"))


@query("""WITH v AS (SELECT c_custkey, 'balance' AS rule, 'warning' AS severity, 'c_acctbal' AS field FROM customer WHERE c_acctbal < 0
UNION ALL SELECT c_custkey, 'segment', 'error', 'c_mktsegment' FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY'))
SELECT cast(c_custkey AS VARCHAR) AS record_id, rule, severity, field, c_custkey || '.xml' AS xml_file, c_custkey || '.json' AS json_file FROM v""")
def flagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8."""
    own = flagged(table(spark, sf_dir, "customer"), "customer").withColumn("id", F.col("c_custkey").cast("string"))
    lines = E.violation_lines(violations_long(own, "data_type", "id"))
    get = lambda k: F.get_json_object("value", f"$.{k}").alias(k)
    return lines.select(*map(get, ("record_id", "rule", "severity", "field", "xml_file", "json_file")))


@query("SELECT event_id, cast(floor(event_id / 100) AS BIGINT) AS batch FROM events")
def batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches by place in the file; no global sort."""
    events = table(spark, sf_dir, "events").withColumn("seq", F.col("event_id"))
    return events.select("event_id", E.batch_ids(events, 100).alias("batch"))


@query(r"SELECT page_id, replace(regexp_replace(url, '[^\p{L}\p{N}._-]', '', 'g'), '..', '_') AS safe FROM pages")
def sanitize_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4, K9."""
    return table(spark, sf_dir, "pages").select("page_id", X.sanitize_filename(F.col("url")).alias("safe"))


# --- files and state --------------------------------------------------------------------------


_LISTED = """SELECT 'f' || o_orderkey || CASE WHEN o_orderkey % 5 = 2 THEN '.txt' ELSE '.xml.gz' END AS file, lpad(cast(o_orderkey // 5 AS VARCHAR), 9, '0') AS version FROM orders"""


@query(f"""WITH f AS ({_LISTED}) SELECT file, version FROM f WHERE version = (SELECT max(version) FROM (
SELECT version FROM f GROUP BY version HAVING count(*) = 5 AND count(*) FILTER (file LIKE '%.xml.gz') = 4))""")
def latest_complete_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five orders in a row make a version, one of them a checksum list."""
    key = F.col("o_orderkey")
    name = F.concat(F.lit("f"), key.cast("string"), F.when(key % 5 == 2, ".txt").otherwise(".xml.gz"))
    listed = table(spark, sf_dir, "orders").select(name.alias("file"), F.lpad(F.floor(key / 5).cast("string"), 9, "0").alias("version"))
    return files.latest_complete(listed).select("file", "version")


@query("SELECT c_custkey AS file FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: an anti-join."""
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("file"))
    return state.pending_files(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("file")), done)


@query("""SELECT a.p_partkey AS file, md5(cast(p_size AS VARCHAR)) AS old_sha256, md5(cast(p_size % 7 AS VARCHAR)) AS sha256 FROM part a WHERE p_size <> p_size % 7""")
def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3."""
    part = table(spark, sf_dir, "part")
    now = part.select(F.col("p_partkey").alias("file"), F.md5((F.col("p_size") % 7).cast("string").cast("binary")).alias("sha256"))
    old = part.select(F.col("p_partkey").alias("file"), F.md5(F.col("p_size").cast("string").cast("binary")).alias("sha256"))
    return state.changed_files(now, old)


@query("""SELECT p_partkey AS file, CASE WHEN p_size % 5 = 0 THEN 'missing' WHEN p_size % 3 = 0 THEN 'unknown' ELSE 'changed' END AS reason FROM part
WHERE p_size % 5 = 0 OR p_size % 3 = 0 OR p_size % 2 = 1""")
def files_to_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing, unknown or changed files."""
    part = table(spark, sf_dir, "part")
    want = part.select(F.col("p_partkey").alias("file"), F.lit("a").alias("sha256"), (F.col("p_size") % 5 != 0).alias("landed"))
    known = part.where(F.col("p_size") % 3 != 0).select(F.col("p_partkey").alias("file"), F.when(F.col("p_size") % 2 == 1, "b").otherwise("a").alias("checksum"))
    return files.to_fetch(want, known)


@query("SELECT 'part' || p_partkey || '.xml.gz' AS file, sha256(p_name) AS sha256 FROM part WHERE p_partkey % 4 <> 0")
def checksum_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with and without a star, in folders, and ones that are no checksum."""
    part = table(spark, sf_dir, "part")
    gap = F.when(F.col("p_partkey") % 4 == 1, "  dir/").when(F.col("p_partkey") % 4 == 2, " *").otherwise("  ")
    digest = F.when(F.col("p_partkey") % 4 == 0, "no checksum").otherwise(F.upper(F.sha2(F.col("p_name").cast("binary"), 256)))
    return files.checksum_lines(part.select(F.concat(digest, gap, F.lit("part"), F.col("p_partkey").cast("string"), F.lit(".xml.gz")).alias("value")))


@query("""SELECT page_id, sha256(html) AS sha256 FROM pages""")
def file_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3."""
    return table(spark, sf_dir, "pages").select("page_id", files.file_sha256(F.col("html").cast("binary")).alias("sha256"))


@query("""SELECT cast(sum(cast(floor(value) AS BIGINT)) AS BIGINT) AS records, cast(sum(user_id) AS BIGINT) AS messages, count(*) FILTER (event_type = 'view') AS files FROM events""")
def phase_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10."""
    events = table(spark, sf_dir, "events")
    return report.phase_totals(events.select(
        F.floor("value").cast("long").alias("records"), F.col("user_id").alias("messages"), F.when(F.col("event_type") == "view", "completed").otherwise("pending").alias("status")))


@query("""SELECT event_type AS data_type, max(ts) AS last FROM events GROUP BY 1 HAVING date_diff('second', max(ts), TIMESTAMP '2030-01-01 00:00:00') > 120 AND NOT bool_and(event_type = 'view')""")
def stalled_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11."""
    progress = table(spark, sf_dir, "events").select(F.col("event_type").alias("data_type"), "ts", (F.col("event_type") == "view").alias("completed"))
    return report.stalled(progress, F.lit("2030-01-01 00:00:00").cast("timestamp"))


@query("SELECT o_custkey AS file, max(o_orderdate) AS ts FROM orders GROUP BY 1")
def state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4: the latest row of each key."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("file"), F.col("o_orderdate").alias("ts"))
    early = F.col("ts") < F.lit("1995-01-01").cast("timestamp")
    return state.upserted(orders.where(early), orders.where(~early))


@query("""SELECT p_partkey, regexp_extract(f, '_([0-9]{8})_', 1) AS version, regexp_extract(f, '_([a-z]+)\\.xml\\.gz$', 1) AS data_type, substring(regexp_extract(f, '_([0-9]{8})_', 1), 1, 6) AS month
FROM (SELECT p_partkey, 'cat_2024010' || (p_size % 10) || '_' || ['artists', 'labels', 'masters', 'releases'][p_size % 4 + 1] || '.xml.gz' AS f FROM part)""".replace("\\\\", "\\"))
def dump_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    from dumpmill.sources.xml import file_parts

    kinds = F.array(*map(F.lit, ("artists", "labels", "masters", "releases")))
    name = F.concat(F.lit("in/cat_2024010"), (F.col("p_size") % 10).cast("string"), F.lit("_"), F.get(kinds, F.col("p_size") % 4), F.lit(".xml.gz"))
    version, kind = file_parts(name)
    return table(spark, sf_dir, "part").select("p_partkey", version, kind, X.month_prefix(version).alias("month"))


# --- normalization and XML --------------------------------------------------------------------


@query("""SELECT p_partkey, p_name AS name, CAST(p_size AS VARCHAR) AS size, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END AS brands, CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END AS n FROM part""")
def unwrap_and_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute prefixes, containers and lone values."""
    part = table(spark, sf_dir, "part")
    one = record(**{"@size": F.col("p_size").cast("string"), "#text": F.col("p_name"), "brands": F.parse_json(
        F.when(F.col("p_size") % 2 == 0, F.to_json(F.struct(F.col("p_brand").alias("brand")))).otherwise("null"))})
    own = spread(part).select("p_partkey", strip_prefixes(one).alias("m"))
    get = lambda k: F.try_element_at("m", F.lit(k))
    brands = F.transform(unwrap_container(get("brands"), "brand"), lambda b: F.try_variant_get(b, "$", "string"))
    return own.select("p_partkey", get("name").cast("string").alias("name"), get("size").cast("string").alias("size"), F.array_join(brands, ",").alias("brands"), F.size(brands).alias("n"))


@query("SELECT n_nationkey AS id, n_name AS name, CASE WHEN n_regionkey = 0 THEN NULL ELSE n_regionkey END AS region FROM nation")
def xml_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as gzip XML to the shared work folder and read back."""
    path = work_folder(spark)
    region = F.when(F.col("n_regionkey") == 0, "<region/>").otherwise(F.concat(F.lit("<region>"), F.col("n_regionkey").cast("string"), F.lit("</region>")))
    rows = table(spark, sf_dir, "nation").select(F.concat(F.lit('<artist id="'), F.col("n_nationkey").cast("string"), F.lit('"><name>'), "n_name", F.lit("</name>"), region, F.lit("</artist>")).alias("value"))
    rows.write.option("compression", "gzip").text(path)
    from dumpmill.sources.xml import read_dump

    own = read_dump(spark, path, "artists").where("error is null")
    get = lambda k: F.try_variant_get(F.try_element_at("data", F.lit(k)), "$", "string")
    return own.select(F.col("id").cast("int").alias("id"), get("name").alias("name"), get("region").cast("int").alias("region"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skip, filter, check and count documents: the quality report of one entity."""
    own = POLICY.of("documents")
    kept, _ = split_skipped(table(spark, sf_dir, "documents"), own.skips)
    out = apply_filters(kept, EntityPolicy(filters=own.filters, rules=own.rules))
    return report.violation_counts(violations_long(flagged(out, "documents"), "data_type"))


@query(r"""WITH d AS (SELECT * FROM documents WHERE NOT (contains(lower(text), 'license') OR contains(lower(lang), 'de')))
SELECT 'documents' AS data_type, rule, """ + _COUNTS + " FROM (" + _DOC_VIOLATIONS.replace("FROM documents", "FROM d") + ") GROUP BY rule")
def policy_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagship(spark, sf_dir)
