"""Queries that run records through XML, normalization, blocks, events and restart state, with the same in SQL."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpmill.functions.canon import RECORD, canonical_json
from dumpmill.operators import report, state
from dumpmill.operators.blocks import attach_blocks
from dumpmill.operators.normalize import normalize
from dumpmill.operators.policy import apply_filters, split_skipped, violations, violations_long
from dumpmill.plans.policy import EntityPolicy, RemoveMatching
from dumpmill.queries import POLICY, flagged
from dumpmill.registry import query, spread, table, work_folder
from dumpmill.run import prepare
from dumpmill.sinks import events as E
from dumpmill.sources import files
from dumpmill.sources.xml import check_faults, read_dump


def shaped(df: DataFrame, key: str, template: str, *values: Column | str) -> DataFrame:
    """(key, data): records from a JSON template with %s for the values."""
    text = F.format_string(template, *[F.col(v) if isinstance(v, str) else v for v in values])
    return spread(df).select(key, F.parse_json(text).cast(RECORD).alias("data"))


def documents_of(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, canonical_json(F.col("data")).alias("document"))


# --- normalization ----------------------------------------------------------------------------


@query("""SELECT c_custkey, '{"@id":"' || c_custkey || '","aliases":[{"id":"' || c_mktsegment || '"},{"id":"' || c_nationkey || '"}],"members":[{"id":"' || c_nationkey || '","name":"' || c_name
|| '"}],"profile":"kept"}' AS document FROM customer""")
def normalize_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists under ``name``, bare strings as ids, empty lists left out, own attributes kept."""
    raw = '{"@id":"%s","members":{"name":{"@id":"%s","#text":"%s"}},"groups":null,"namevariations":{},"aliases":{"name":["%s",{"@id":"%s"}]},"profile":"kept"}'
    own = shaped(table(spark, sf_dir, "customer"), "c_custkey", raw.replace(',"namevariations":{}', ""), "c_custkey", "c_nationkey", "c_name", "c_mktsegment", "c_nationkey")
    return documents_of(normalize(own, "artists"), "c_custkey")


@query("""SELECT s_suppkey, '{"@id":"' || s_suppkey || '","parentLabel":{"id":"' || s_nationkey || '","name":"' || s_name || '"}'
|| CASE WHEN s_nationkey % 2 = 0 THEN ',"sublabels":[{"id":"1","name":"' || s_name || '"},{"id":"2","name":"b"}]' ELSE '' END || '}' AS document FROM supplier""")
def normalize_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parent's attributes, sublabels under ``label``."""
    subs = F.when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit('{"label":[{"@id":"1","#text":"'), "s_name", F.lit('"},{"@id":"2","#text":"b"}]}'))).otherwise('""')
    subs = F.when(F.col("s_nationkey") % 2 == 0, subs).otherwise("{}")
    own = shaped(table(spark, sf_dir, "supplier"), "s_suppkey", '{"@id":"%s","parentLabel":{"@id":"%s","#text":"%s"},"sublabels":%s}', "s_suppkey", "s_nationkey", "s_name", subs)
    return documents_of(normalize(own, "labels"), "s_suppkey")


@query("""SELECT p_partkey, '{"artists":[{"id":"' || p_size || '","name":"' || p_brand || '"}],"genres":["' || p_type || '"],"id":"' || p_partkey || '"'
|| CASE WHEN p_size % 2 = 0 THEN ',"styles":["' || p_name || '","x"]' ELSE '' END || ',"year":"' || (1900 + p_size) || '"}' AS document FROM part""")
def normalize_masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Own attributes stripped, artists, genres and styles as lists."""
    styles = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit('{"style":["'), "p_name", F.lit('","x"]}'))).otherwise("null")
    own = shaped(table(spark, sf_dir, "part"), "p_partkey", '{"@id":"%s","artists":{"artist":{"id":"%s","name":"%s"}},"genres":{"genre":"%s"},"styles":%s,"year":"%s"}',
                 "p_partkey", "p_size", "p_brand", "p_type", styles, (F.col("p_size") + 1900).cast("string"))
    return documents_of(normalize(own, "masters"), "p_partkey")


@query("""SELECT p_partkey, '{"companies":[{"id":"1","name":"' || p_brand || '"}],"extraartists":[{"id":"9","role":"' || p_type || '"}],"formats":[{"name":"CD","qty":"' || p_size
|| '"},"bare"],"id":"' || p_partkey || '","identifiers":[{"type":"Barcode","value":"' || p_size || '"}],"labels":[{"catno":"' || p_size || '","name":"' || p_brand || '"}],"master_id":"'
|| CASE WHEN p_size % 3 = 0 THEN 'm' || p_size WHEN p_size % 3 = 1 THEN 'i' || p_size ELSE 's' || p_size END || '","title":"' || p_name || '"}' AS document FROM part""")
def normalize_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every list of a release, the three shapes of a master's id, bare formats kept."""
    kind = F.col("p_size") % 3
    size = F.col("p_size").cast("string")
    master = F.when(kind == 0, F.concat(F.lit('{"@is_main_release":"true","#text":"m'), size, F.lit('"}'))).when(
        kind == 1, F.concat(F.lit('{"id":"i'), size, F.lit('"}'))).otherwise(F.concat(F.lit('"s'), size, F.lit('"')))
    raw = ('{"@id":"%s","title":"%s","master_id":%s,"labels":{"label":{"@name":"%s","@catno":"%s"}},"extraartists":{"artist":{"id":"9","role":"%s"}},"styles":{},'
           '"identifiers":{"identifier":{"@type":"Barcode","@value":"%s"}},"companies":{"company":[{"id":"1","name":"%s"}]},"formats":{"format":[{"@name":"CD","@qty":"%s"},"bare"]}}')
    own = shaped(table(spark, sf_dir, "part"), "p_partkey", raw, "p_partkey", "p_name", master, "p_brand", "p_size", "p_type", "p_size", "p_brand", "p_size")
    return documents_of(normalize(own, "releases"), "p_partkey")


@query("""SELECT n_nationkey, '{"@id":"' || n_nationkey || '","genres":{"genre":"' || n_name || '"}}' AS document FROM nation""")
def normalize_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of an unknown entity stay as they are."""
    own = shaped(table(spark, sf_dir, "nation"), "n_nationkey", '{"@id":"%s","genres":{"genre":"%s"}}', "n_nationkey", "n_name")
    return documents_of(normalize(own, "videos"), "n_nationkey")


@query("""SELECT c_custkey, '{"genres":["' || c_mktsegment || '"],"id":"' || c_custkey || '"}' AS document,
sha256('{"genres":["' || c_mktsegment || '"],"id":"' || c_custkey || '"}') AS sha256 FROM customer""")
def normalized_without_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records are normalized and hashed whether or not a policy is given."""
    own = shaped(table(spark, sf_dir, "customer"), "c_custkey", '{"@id":"%s","genres":{"genre":"%s"}}', "c_custkey", "c_mktsegment")
    own = own.withColumn("id", F.col("c_custkey").cast("string")).withColumn("error", F.lit(None).cast("string"))
    return prepare(own, "masters").records.select("c_custkey", canonical_json(F.col("data")).alias("document"), "sha256")


# --- blocks -----------------------------------------------------------------------------------


def _block(df: DataFrame, key: str, path: str, kind: str = "string", name: str = "value") -> Column:
    return F.try_variant_get(F.try_element_at("data", F.lit(key)), path, kind).alias(name)


@query("""SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN 'box_set' END AS container, CASE WHEN c_nationkey % 3 = 0 THEN 'all_media' ELSE '' END AS flags,
CASE WHEN c_nationkey % 2 = 0 THEN 'album' ELSE 'ep' END AS release_kind, CASE WHEN c_nationkey % 2 = 0 THEN 'gatefold' END AS packaging,
CASE WHEN c_nationkey % 2 = 0 THEN 'promo,reissue' ELSE 'promo' END AS edition, CASE WHEN c_nationkey % 2 = 0 THEN '' ELSE 'Glow' END AS unmapped FROM customer""")
def release_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2, V3: facts of the release from formats that give no medium; the first kind counts."""
    odd = F.col("c_nationkey") % 2 != 0
    words = F.when(odd, '["EP","Album","Promo","Glow","Promo"]').otherwise('["Album","EP","Reissue","Gatefold","Promo"]')
    name = F.when(F.col("c_nationkey") % 3 == 0, '{"name":"Box Set"},{"name":"All Media"},').otherwise("")
    own = attach_blocks(shaped(table(spark, sf_dir, "customer"), "c_custkey", '{"formats":[%s{"name":"CD","descriptions":%s}]}', name, words))
    lists = lambda path, name: F.array_join(_block(own, "media", path, "array<string>"), ",").alias(name)
    return own.select("c_custkey", *[_block(own, "media", f"$.{k}", name=k) for k in ("container", "release_kind", "packaging")],
                      lists("$.flags", "flags"), lists("$.edition", "edition"), lists("$.unmapped.descriptions", "unmapped"))


@query("""SELECT s_suppkey, CASE WHEN s_nationkey % 3 = 0 THEN cast(s_nationkey AS VARCHAR) END AS entity_type, s_suppkey + 1 AS company, 'c' || s_nationkey AS catno FROM supplier""")
def company_entity_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A type is digits only, an id a whole number of at least one, both trimmed."""
    kind = F.when(F.col("s_nationkey") % 3 == 0, F.concat(F.lit(" "), F.col("s_nationkey").cast("string"), F.lit(" "))).when(
        F.col("s_nationkey") % 3 == 1, F.concat(F.lit("-"), F.col("s_nationkey").cast("string"))).otherwise("x1")
    raw = '{"companies":[{"name":"n","entity_type_name":"Pressed By","entity_type":"%s","id":" %s ","catno":" c%s"}]}'
    own = attach_blocks(shaped(table(spark, sf_dir, "supplier"), "s_suppkey", raw, kind, (F.col("s_suppkey") + 1).cast("string"), "s_nationkey"))
    return own.select("s_suppkey", _block(own, "companies", "$.items[0].source.entity_type", name="entity_type"), _block(own, "companies", "$.items[0].catalog_id", "long", "company"),
                      _block(own, "companies", "$.items[0].catno", name="catno"))


@query("""SELECT n_nationkey, '{"companies":{"companies_version":"1","items":[],"role_categories":[],"unmapped":{"roles":[]}},"id":"' || n_nationkey
|| '","identifiers":{"aliases":[],"identifiers_version":"1","items":[],"types":[],"unmapped":{"types":[]}},"media":{"container":null,"edition":[],"families":[],"flags":[],"items":[],"packaging":null,'
|| '"release_kind":null,"taxonomy_version":"1","traits":[],"unmapped":{"descriptions":[],"formats":[]}}}' AS document FROM nation""")
def empty_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A release without lists gets all three blocks; raw lists of odd shapes give way to them."""
    own = shaped(table(spark, sf_dir, "nation"), "n_nationkey", '{"id":"%s","companies":"odd","identifiers":7}', "n_nationkey")
    return documents_of(attach_blocks(own), "n_nationkey")


# --- policy paths, report ---------------------------------------------------------------------


@query("""SELECT p_partkey, '{"a":[{"b":["x' || p_size || '"]},{"b":["7","y"]}],"c":{"d":' || CASE WHEN p_size % 2 = 0 THEN '["z"]' ELSE '["z","q"]' END || '}}' AS document,
CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END AS removed FROM part""")
def filter_pointer_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: a path names objects and list positions and expands no list."""
    last = F.when(F.col("p_size") % 2 == 0, '"5","z"').otherwise('"z","q"')
    own = shaped(table(spark, sf_dir, "part"), "p_partkey", '{"a":[{"b":["x%s","6"]},{"b":["7","y"]}],"c":{"d":[%s]}}', "p_size", last)
    filters = tuple(RemoveMatching(field, "^[0-9]+$", "number") for field in ("a.0.b", "c.d", "a.b"))
    out = apply_filters(own, EntityPolicy(filters=filters), "data")
    removed = F.aggregate(F.transform("actions", lambda a: a["removed_count"]), F.lit(0), lambda x, y: x + y)
    return out.select("p_partkey", canonical_json(F.col("data")).alias("document"), removed.alias("removed"))


@query("""WITH v AS (SELECT 'brand' AS rule, 'warning' AS severity FROM part WHERE p_brand NOT IN ('Brand#11', 'Brand#12', 'Brand#13')
UNION ALL SELECT 'name', 'info' FROM part WHERE regexp_matches(p_name, '^l|[gt]$') UNION ALL SELECT 'short', 'info' FROM part WHERE length(p_name) > 10
UNION ALL SELECT 'size', 'error' FROM part WHERE p_size < 5 OR p_size > 45),
r AS (SELECT rule, count(*) FILTER (severity = 'error') AS e, count(*) FILTER (severity = 'warning') AS w, count(*) FILTER (severity = 'info') AS i FROM v GROUP BY rule)
SELECT 'Data quality report' || chr(10) || 'part: ' || (SELECT count(*) FROM part) || ' records, ' || sum(e) || ' errors, ' || sum(w) || ' warnings' || chr(10)
|| string_agg('  ' || rule || ': ' || e || ' errors, ' || w || ' warnings, ' || i || ' infos' || chr(10), '' ORDER BY rule) AS text FROM r""")
def report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of one entity as text."""
    part = table(spark, sf_dir, "part").withColumn("data_type", F.lit("part"))
    none = spark.createDataFrame([], "data_type string, field string, reason string, records long, values long")
    text = report.render(report.record_totals(part), report.violation_counts(violations_long(flagged(part, "part"), "data_type")), none.selectExpr("data_type", "reason", "records as skipped").limit(0), none)
    return spark.createDataFrame([(text,)], "text string")


@query("""SELECT p_partkey AS file, least(coalesce(b, 0), p_size * 100) AS bytes, p_size * 100 AS size,
cast(CASE WHEN p_size > 0 THEN floor(least(coalesce(b, 0), p_size * 100) * 100 / (p_size * 100)) ELSE 100 END AS INT) AS percent, least(coalesce(b, 0), p_size * 100) // 512 AS steps
FROM part LEFT JOIN (SELECT event_id % 500 AS k, sum(event_id) AS b FROM events GROUP BY 1) ON k = p_partkey""".replace("p_size * 100", "cast(p_size * 100 AS BIGINT)"))
def byte_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes read against the sizes of files, in steps."""
    read = table(spark, sf_dir, "events").select((F.col("event_id") % 500).alias("file"), F.col("event_id").alias("bytes"))
    sizes = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("file"), (F.col("p_size") * 100).cast("long").alias("size"))
    return report.byte_progress(read, sizes, 512)


# --- sources ----------------------------------------------------------------------------------


@query("""SELECT DISTINCT 'cat_2024010' || (p_size % 10) || '_' || CASE WHEN p_size % 5 = 0 THEN 'CHECKSUM.txt' ELSE ['artists', 'labels', 'masters', 'releases'][p_size % 4 + 1] || '.xml.gz' END AS file,
'2024010' || (p_size % 10) AS version FROM part""")
def listing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of listing pages, URL-decoded, without their folders and repeats."""
    kinds = F.array(*map(F.lit, ("artists.xml.gz", "labels.xml.gz", "masters.xml.gz", "releases.xml.gz")))
    name = F.concat(F.lit("cat_2024010"), (F.col("p_size") % 10).cast("string"), F.lit("_"), F.when(F.col("p_size") % 5 == 0, "CHECKSUM.txt").otherwise(F.get(kinds, F.col("p_size") % 4)))
    html = F.concat(F.lit('<a href="../">up</a> <a href="?download=data%2F2024%2F'), name, F.lit('">x</a> <a href="note.pdf">n</a>'))
    return files.listing(table(spark, sf_dir, "part").select(html.alias("html")))


@query("""SELECT cast(y AS VARCHAR) AS year FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders ORDER BY 1 DESC LIMIT 2)""")
def newest_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two newest year folders of a listing."""
    year = F.date_format("o_orderdate", "yyyy")
    return files.newest_years(table(spark, sf_dir, "orders").select(F.concat(F.lit('<a href="'), year, F.lit('/">'), year, F.lit("/</a>")).alias("html")))


@query("""SELECT 'p' || p_partkey || '.xml.gz' AS file, cast(p_partkey // 5 AS VARCHAR) AS version,
CASE WHEN p_partkey // 5 IN (SELECT p_partkey // 5 FROM part WHERE p_partkey % 5 = 3 AND p_partkey % 3 = 0) THEN 'p' || (p_partkey // 5 * 5 + 3) || '_Checksum.txt' END AS checksum_file
FROM part WHERE p_partkey % 5 <> 3""")
def checksum_by_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each dump with the checksum list of its version, if it has one."""
    key = F.col("p_partkey")
    end = F.when(key % 5 != 3, ".xml.gz").when(key % 3 == 0, "_Checksum.txt").otherwise("_notes.txt")
    own = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), key.cast("string"), end).alias("file"), F.floor(key / 5).cast("string").alias("version"))
    return files.checksum_file(own).select("file", "version", "checksum_file")


@query("""SELECT c_custkey AS id, '<label id="' || c_custkey || '"><name>' || c_name || ' &amp; Co</name><sublabels><label id="' || c_nationkey || '">' || c_mktsegment || '</label><label id="x"/></sublabels></label>'
AS raw_xml, c_mktsegment AS first_sub, 2 AS subs FROM customer""")
def xml_nested_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with nested elements of their own name, written as gzip XML, read and written out again."""
    path = work_folder(spark)
    cell = lambda a, c, b: F.concat(F.lit(a), F.col(c).cast("string"), F.lit(b))
    one = F.concat(cell('<label id="', "c_custkey", '">'), cell("<name>", "c_name", " &amp; Co</name>"), cell('<sublabels><label id="', "c_nationkey", '">'),
                   cell("", "c_mktsegment", '</label><label id="x"/></sublabels></label>'))
    table(spark, sf_dir, "customer").select(one.alias("value")).write.option("compression", "gzip").text(path)
    own = read_dump(spark, path, "labels", capture_raw=True).where("error is null")
    subs = F.try_variant_get(F.try_element_at("data", F.lit("sublabels")), "$.label", "array<variant>")
    return own.select(F.col("id").cast("int").alias("id"), "raw_xml", F.try_variant_get(subs[0], "$['#text']", "string").alias("first_sub"), F.size(subs).alias("subs"))


@query("""SELECT cast(s_suppkey AS VARCHAR) AS id, s_name AS name FROM supplier WHERE s_suppkey % 4 <> 1""")
def xml_faulty_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed records are counted against the budget, and their neighbours survive."""
    path = work_folder(spark)
    key = F.col("s_suppkey").cast("string")
    name = F.concat(F.lit("<name>"), F.col("s_name"), F.when(F.col("s_suppkey") % 4 == 1, "</nome>").otherwise("</name>"))
    table(spark, sf_dir, "supplier").select(F.concat(F.lit('<artist id="'), key, F.lit('">'), name, F.lit("</artist>")).alias("value")).write.option("compression", "gzip").text(path)
    own = read_dump(spark, path, "artists")
    check_faults(own, budget=max(100, table(spark, sf_dir, "supplier").count()))
    return own.where("error is null").select("id", F.try_variant_get(F.try_element_at("data", F.lit("name")), "$", "string").alias("name"))


def landed(rows: DataFrame, folder: str, entity: str) -> None:
    """Lines of a column ``value`` as gzip dumps of ``entity``, a version for each file that Spark writes."""
    spark = rows.sparkSession
    rows.write.option("compression", "gzip").text(f"{folder}_parts")
    named = spark._jvm.org.apache.hadoop.fs.Path
    fs = named(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(named(folder))
    parts = sorted(str(f.getPath()) for f in fs.listStatus(named(f"{folder}_parts")) if f.getPath().getName().endswith(".gz"))
    for i, part in enumerate(parts):
        if not fs.rename(named(part), named(f"{folder}/cat_{20240101 + i}_{entity}.xml.gz")):
            raise OSError(f"could not move {part}")
    E.removed(spark, f"{folder}_parts")


@query("""SELECT cast(p_partkey AS VARCHAR) AS id, cast(p_size AS VARCHAR) AS size, p_name || ' & Co' AS title FROM part""")
def xml_source_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named fields and an attribute of dumps through the data source, two tasks a dump; what is not named is not built."""
    from dumpmill.sources import catalog

    path = f"{work_folder(spark)}/in"
    head = F.concat(F.lit('<release id="'), F.col("p_partkey").cast("string"), F.lit('" size="'), F.col("p_size").cast("string"), F.lit('"><title>'), "p_name", F.lit(" &amp; Co</title>"))
    rest = F.concat(F.lit("<tracklist><track><title>"), "p_type", F.lit("</title></track></tracklist><notes>"), "p_brand", F.lit("</notes></release>"))
    landed(table(spark, sf_dir, "part").select(F.concat(head, rest).alias("value")).repartition(4), path, "releases")
    catalog.register(spark)
    own = spark.read.format(catalog.FORMAT).schema("id string, `@size` string, title string").option("splits", 2).load(path)
    return own.select("id", F.col("`@size`").alias("size"), "title")


@query("""SELECT cast(o_orderkey AS VARCHAR) AS id, '{"@id":"' || o_orderkey || '","status":"' || o_orderstatus || '"}' AS json FROM orders WHERE o_orderkey IN (1, 7, 32, 33, 71, 103)""")
def xml_source_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of asked ids out of all orders as dumps; the others are not parsed."""
    from dumpmill.sources import catalog

    path = f"{work_folder(spark)}/in"
    one = F.concat(F.lit('<master id="'), F.col("o_orderkey").cast("string"), F.lit('"><status>'), "o_orderstatus", F.lit("</status></master>"))
    landed(table(spark, sf_dir, "orders").select(one.alias("value")).repartition(4), path, "masters")
    catalog.register(spark)
    own = spark.read.format(catalog.FORMAT).schema("data_type string, id string, json string").load(path)
    return own.where("data_type = 'masters' and id in ('1', '7', '32', '33', '71', '103')").select("id", "json")


@query("""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 1 THEN 'json' WHEN 2 THEN 'fields' WHEN 3 THEN 'contract' WHEN 4 THEN 'path' WHEN 5 THEN 'name'
WHEN 6 THEN 'sha256' WHEN 7 THEN 'scope' END AS fault FROM orders""")
def manifest_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests made of all orders, good ones and seven kinds of bad ones, and what each is refused for."""
    from dumpmill.sources.manifest import CONTRACT, MEDIA, SCOPE, manifest_fault

    kind, date = F.col("o_orderkey") % 8, F.date_format("o_orderdate", "yyyyMMdd")
    name = F.concat(F.lit("in/cat_"), date, F.when(kind == 5, "_labels").otherwise("_releases"), F.lit(".xml.gz"))
    raw = F.to_json(F.struct(
        F.when(kind == 3, "other/v2").otherwise(CONTRACT).alias("contract"), date.alias("version"), F.lit("releases").alias("data_type"),
        F.when(kind == 7, "folder").otherwise(SCOPE).alias("scope"), F.when(kind == 4, F.concat(F.lit("../"), name)).otherwise(name).alias("file"), F.lit(MEDIA).alias("media_type"),
        F.when(kind == 6, "no hash").when(kind != 2, F.sha2(F.col("o_orderkey").cast("string"), 256)).alias("sha256")))
    text = F.when(kind == 1, F.concat(raw, F.lit("}"))).otherwise(raw)
    return table(spark, sf_dir, "orders").select("o_orderkey", manifest_fault(text).alias("fault"))


@query("SELECT 'cat_20240101_releases.xml.gz' AS file, sha256(string_agg(n_name || chr(10), '' ORDER BY n_nationkey)) AS sha256, true AS ok FROM nation")
def landed_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed file of a folder source, hashed by tasks and as a stream, against its checksum list."""
    from dumpmill.sources import FolderSource

    path = work_folder(spark)
    text = "".join(f"{r.n_name}\n" for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect())  # a fixed table of 25 rows
    E.write_text(spark, f"{path}/cat_20240101_releases.xml.gz", text)
    sha = files.stream_sha256(spark, f"{path}/cat_20240101_releases.xml.gz")
    E.write_text(spark, f"{path}/cat_20240101_CHECKSUM.txt", f"{sha} *dir/cat_20240101_releases.xml.gz\n")
    source = FolderSource(spark, path)
    return files.verified(spark, source.paths("20240101")[0], source.checksums("20240101")).select("file", "sha256", "ok")


# --- events and state -------------------------------------------------------------------------


@query("SELECT 'catalog-' || event_type AS exchange, count(*) AS n FROM events GROUP BY 1")
def exchange_per_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, K2: frames in one place for each entity, written and read back."""
    path = work_folder(spark)
    E.write_events(table(spark, sf_dir, "events").select(F.col("event_type").alias("data_type"), F.col("props").alias("value")), path)
    return spark.read.text(path).groupBy("exchange").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS sent FROM events")
def published_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, K3: all frames confirmed, in batches of ten of one exchange, from several tasks."""
    def send(exchange: str, frames: list[str]) -> int:
        if not 0 < len(frames) <= 10 or not exchange.startswith("catalog-"):
            raise ValueError(exchange)
        return len(frames)

    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("data_type"), F.lit("f").alias("file"), F.col("event_id").alias("seq"), F.col("props").alias("value"))
    return spark.createDataFrame([(E.publish(events, send, 10),)], "sent long")


@query("""SELECT 'customer' AS data_type, 'id' || c_custkey AS name, '<c id="' || c_custkey || '"/>' AS raw_xml, '{"id":"id/' || c_custkey || '"}' AS json FROM customer
WHERE c_acctbal < 0 OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""")
def capture_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: a capture for each flagged record, once, though two rules and a repeated row name it."""
    df = table(spark, sf_dir, "customer")
    df = df.withColumn("id", F.concat(F.lit("id/"), F.col("c_custkey").cast("string"))).withColumn("data_type", F.lit("customer"))
    df = df.withColumn("raw_xml", F.concat(F.lit('<c id="'), F.col("c_custkey").cast("string"), F.lit('"/>'))).withColumn("data", F.create_map(F.lit("id"), F.col("id").cast("variant")))
    flags = violations_long(df.withColumn("violations", violations(df, POLICY.of("customer").rules)), "data_type", "id").select("data_type", "id", "severity")
    return E.captures(df, flags.union(flags))


_STATES = (state.PENDING, state.RUNNING, state.DONE, state.FAILED)


@query("""WITH s AS (SELECT unnest(['pending', 'in_progress', 'completed', 'failed']) AS s), b AS (SELECT unnest([true, false]) AS b)
SELECT d.s AS download, p.s AS processing, o.s AS overall, f.b AS some_done, x.b AS force, CASE WHEN x.b THEN 'reprocess'
WHEN d.s IN ('failed', 'in_progress') THEN CASE WHEN f.b THEN 'continue' ELSE 'reprocess' END
WHEN p.s NOT IN ('failed', 'in_progress') AND o.s = 'completed' THEN 'skip' ELSE 'continue' END AS decision FROM s d, s p, s o, b f, b x""")
def restart_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: what a run does, for every combination of what a marker can hold."""
    rows = []
    for download, processing, overall, done, force in product(_STATES, _STATES, _STATES, (True, False), (True, False)):
        own = state.Marker("v", status=overall, files={"a": state.FileProgress(state.DONE if done else state.RUNNING)})
        own.phases["download"].status, own.phases["processing"].status = download, processing
        rows.append((download, processing, overall, done, force, own.decide(force)))
    return spark.createDataFrame(rows, "download string, processing string, overall string, some_done boolean, force boolean, decision string")


@query("""SELECT r_name AS file, r_regionkey % 2 = 0 AS reopened, CASE WHEN r_regionkey % 2 = 0 THEN 0 ELSE r_regionkey + 1 END AS records FROM region""")
def reopened_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A marker written, read back, and told the hashes of files that are others now; broken text is a fresh marker."""
    path, marker = work_folder(spark), state.Marker("20240101")
    rows = table(spark, sf_dir, "region").orderBy("r_regionkey").collect()  # a fixed table of five rows
    for r in rows:
        marker.start_file(r.r_name)
        marker.file_verified(r.r_name, "old")
        marker.complete_file(r.r_name, r.r_regionkey + 1, 1)
    marker.complete()
    state.save_marker(spark, path, marker)
    own = state.load_marker(spark, path, "20240101")
    changed = {r.r_name: own.file_verified(r.r_name, "new" if r.r_regionkey % 2 == 0 else "old") for r in rows}
    E.write_text(spark, f"{path}/state_20240102.json", own.to_json()[:50])
    if own.decide() != state.CONTINUE or state.load_marker(spark, path, "20240102").files:
        raise AssertionError("a reopened version goes on, a broken marker is fresh")
    return spark.createDataFrame([(r.r_name, changed[r.r_name], own.files[r.r_name].records) for r in rows], "file string, reopened boolean, records long")


@query("""SELECT c_custkey, datediff('day', timestamp '2024-01-01 00:00:00', timestamp '2024-01-01 00:00:00' + to_days(cast(c_nationkey AS INT))) * 86400 + c_custkey AS seconds FROM customer""")
def phase_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """how long a phase took."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    end = start + F.make_dt_interval(F.col("c_nationkey"), F.lit(0), F.lit(0), F.col("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", state.duration_seconds(start, end).alias("seconds"))


@query("""SELECT p_partkey, CASE WHEN contains(lower(p_name), 'red') THEN 0 ELSE 1 END AS kept, CASE WHEN p_size % 2 = 0 THEN 'dash' ELSE '' END AS rules FROM part WHERE NOT contains(lower(p_name), 'red')""")
def policy_on_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2, P11 over VARIANT records: the same policy language on trees as on tables."""
    from dumpmill.plans.policy import parse_policy

    own = parse_policy({
        "skip_records": {"masters": [{"field": "names.name", "contains": "RED", "reason": "red"}]},
        "rules": {"masters": [{"name": "dash", "field": "marks.mark.@v", "severity": "info", "condition": {"type": "regex", "pattern": "^-"}}]}}).of("masters")
    mark = F.when(F.col("p_size") % 2 == 0, "-a").otherwise("a-")
    df = shaped(table(spark, sf_dir, "part"), "p_partkey", '{"names":{"name":["x","%s"]},"marks":{"mark":{"@v":"%s"}}}', "p_name", mark)
    kept, _ = split_skipped(df, own.skips, "data")
    rules = F.array_join(F.transform(violations(kept, own.rules, "data"), lambda v: v["rule"]), ",")
    return kept.select("p_partkey", F.lit(1).alias("kept"), rules.alias("rules"))


@query("""WITH s AS (SELECT o_custkey AS version, ['pending', 'in_progress', 'completed', 'failed'] AS names, min(o_orderkey) AS k FROM orders GROUP BY 1),
f AS (SELECT o_custkey AS version, count(*) FILTER (o_orderstatus = 'F' AND o_orderkey % 3 <> 0) AS done, count(*) FILTER (NOT (o_orderstatus = 'F' AND o_orderkey % 3 <> 0)) AS open_files FROM orders GROUP BY 1),
p AS (SELECT version, names[k % 4 + 1] AS download, names[k // 4 % 4 + 1] AS processing, names[k // 16 % 4 + 1] AS overall, k % 7 = 0 AS force FROM s)
SELECT version, CASE WHEN force THEN 'reprocess' WHEN download IN ('failed', 'in_progress') THEN CASE WHEN done > 0 THEN 'continue' ELSE 'reprocess' END
WHEN processing NOT IN ('failed', 'in_progress') AND overall = 'completed' THEN 'skip' ELSE 'continue' END AS decision, open_files FROM p JOIN f USING (version)""")
def version_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1, L2: what a run does with each version of a control table, and how many of its files are open."""
    orders = table(spark, sf_dir, "orders")
    names = F.array(*map(F.lit, _STATES))
    at = lambda n: F.get(names, (F.floor(F.col("k") / n) % 4).cast("int"))
    phases = orders.groupBy(F.col("o_custkey").alias("version")).agg(F.min("o_orderkey").alias("k"))
    phases = phases.select("version", at(1).alias("download"), at(4).alias("processing"), at(16).alias("overall"), (F.col("k") % 7 == 0).alias("force"))
    status = F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 3 != 0), state.DONE).when(F.col("o_orderstatus") == "O", state.RUNNING)
    files_ = orders.select(F.col("o_custkey").alias("version"), F.col("o_orderkey").cast("string").alias("file"), status.alias("status"))
    return state.version_decisions(files_, phases, F.col("force"))


#: Policy patterns whose meaning DuckDB shares, for texts with every kind of line end and letters beyond ASCII.
PATTERNS = (r"^C.*r#", r"1$", r"^[^\n]*$", r"(?m)^é", r"\pL\PL\pL", r"(?i)É", r"[[:digit:]]{3}.[A-Z]", r"G|ß$", r"^(?P<all>.+)$", r"^[^\s\x{2028}\x{85}]+$")


@query(f"""WITH t AS (SELECT c_custkey, 'Customer#' || c_custkey || CASE c_nationkey % 5 WHEN 0 THEN chr(13) WHEN 1 THEN chr(10) WHEN 2 THEN chr(8232) WHEN 3 THEN chr(133) ELSE '' END
|| CASE c_nationkey % 3 WHEN 0 THEN 'é' WHEN 1 THEN 'É' ELSE 'ß' END || c_mktsegment || CASE WHEN c_nationkey % 2 = 0 THEN chr(10) ELSE 'ß' END AS t FROM customer)
SELECT c_custkey, array_to_string([{", ".join(f"CASE WHEN regexp_matches(t, '{p}') THEN '1' ELSE '0' END" for p in PATTERNS)}], '') AS hits FROM t""")
def pattern_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns over texts with carriage returns, line and paragraph separators and letters beyond ASCII."""
    from dumpmill.functions.patterns import java_pattern

    pick = lambda n, *values: F.get(F.array(*map(F.lit, values)), (F.col("c_nationkey") % n).cast("int"))
    text = F.concat(F.lit("Customer#"), F.col("c_custkey").cast("string"), pick(5, "\r", "\n", "\u2028", "\x85", ""), pick(3, "é", "É", "ß"), "c_mktsegment", pick(2, "\n", "ß"))
    own = table(spark, sf_dir, "customer").select("c_custkey", text.alias("t"))
    return own.select("c_custkey", F.concat(*[F.when(F.col("t").rlike(java_pattern(p)), "1").otherwise("0") for p in PATTERNS]).alias("hits"))


@query(r"""SELECT p_partkey, replace(regexp_replace('किताब ' || p_name || '/..' || CASE WHEN p_size % 2 = 0 THEN 'é' ELSE 'e' || chr(769) END || '½' || p_type || 'ဃါ', '[^\pL\pN\x{93E}-\x{94C}\x{102B}._-]', '', 'g'), '..', '_') AS safe FROM part""")
def sanitize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names whose vowel signs are letters by Unicode, though of the category of marks; accents that stand alone go."""
    from dumpmill.functions.text import sanitize_filename

    accent = F.when(F.col("p_size") % 2 == 0, "é").otherwise("e\u0301")
    raw = F.concat(F.lit("किताब "), "p_name", F.lit("/.."), accent, F.lit("½"), "p_type", F.lit("ဃါ"))
    return table(spark, sf_dir, "part").select("p_partkey", sanitize_filename(raw).alias("safe"))


@query("""SELECT event_type AS data_type, user_id % 2 AS lane, count(*) // 20 AS batches, count(*) // 20 * 20 AS frames, 'size' AS cause FROM events
GROUP BY 1, 2 HAVING count(*) >= 20""")
def batches_of_a_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream, cut into batches of 20 frames a type and lane; what does not fill one waits in the state."""
    from dumpmill.streaming.timers import timed_batches

    schema, path = table(spark, sf_dir, "events").schema, work_folder(spark)
    landed = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    frames = landed.select(F.col("event_type").alias("data_type"), F.col("event_id").alias("seq"), F.col("props").alias("value"), F.col("user_id").alias("lane"))
    own = timed_batches(frames, 20, 86400.0, F.col("lane") % 2).writeStream.format("parquet").outputMode("append")
    own.option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(once=True).start().awaitTermination()
    E.removed(spark, f"{path}/state")
    sent = spark.read.parquet(f"{path}/out")
    return sent.groupBy("data_type", "lane", "cause").agg(F.count("*").alias("batches"), F.sum(F.size("frames")).alias("frames"))
