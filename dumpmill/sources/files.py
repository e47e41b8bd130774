"""Listings, versions and checksums of dump files, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files of a complete version: four dumps and a checksum list.
FILES, DUMPS = 5, 4


def listing(html: DataFrame, text: str = "html", pattern: str = r'href="([^"]*_[0-9]{8}_[A-Za-z]+\.(?:xml\.gz|txt))"') -> DataFrame:
    """(file, version) of the links in listing pages, URL-decoded, without their folders."""
    links = html.select(F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), 1))).alias("link"))
    file = F.regexp_extract(F.url_decode("link"), r"([^/]*)\z", 1)
    return links.select(file.alias("file"), F.regexp_extract(file, "_([0-9]{8})_", 1).alias("version")).distinct()


def newest_years(html: DataFrame, text: str = "html", years: int = 2) -> DataFrame:
    """The latest ``years`` year folders of a listing page."""
    found = html.select(F.explode(F.regexp_extract_all(text, F.lit(r"\b([0-9]{4})/"), 1)).alias("year")).distinct()
    return found.orderBy(F.desc("year")).limit(years)


def list_folder(spark: SparkSession, path: str) -> DataFrame:
    """(path, file, version, size) of the dump files in a folder of any store Spark reads."""
    own = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("size"))
    file = F.regexp_extract("path", r"([^/]*)\z", 1)
    return own.select("path", file.alias("file"), F.nullif(F.regexp_extract(file, "_([0-9]{8})_", 1), F.lit("")).alias("version"), "size")


def latest_complete(files: DataFrame) -> DataFrame:
    """The rows of the newest version with exactly FILES files, DUMPS of them dumps."""
    versions = files.groupBy("version").agg(F.count("*").alias("n"), F.count_if(F.col("file").endswith(".xml.gz")).alias("dumps"))
    newest = versions.where((F.col("n") == FILES) & (F.col("dumps") == DUMPS)).agg(F.max("version").alias("version"))
    return files.join(F.broadcast(newest), "version", "left_semi")


def checksum_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """(file, sha256) of the lines of a checksum list: 64 hex digits, two blanks or a blank and ``*``, a path."""
    hexes = F.regexp_extract(text, r"\A\s*([0-9A-Fa-f]{64})\s+\*?(?:.*/)?([^/]+?)\s*\z", 1)
    file = F.regexp_extract(text, r"\A\s*([0-9A-Fa-f]{64})\s+\*?(?:.*/)?([^/]+?)\s*\z", 2)
    return lines.select(file.alias("file"), F.lower(hexes).alias("sha256")).where("sha256 <> ''")


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """``checksum_lines`` of a file, which must hold one at least."""
    own = checksum_lines(spark.read.text(path))
    if own.isEmpty():
        raise ValueError(f"no checksums in {path}")
    return own


def checksum_file(files: DataFrame) -> DataFrame:
    """Each dump with the checksum list of its version."""
    lists = files.where(F.upper("file").contains("CHECKSUM")).select("version", F.col("file").alias("checksum_file"))
    return files.where(F.col("file").endswith(".xml.gz")).join(lists, "version", "left")


def file_sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def stream_sha256(spark: SparkSession, path: str) -> str:
    """The hash of one file of any size, read as a stream by the driver's JVM (``binaryFile`` ends at 2 GB)."""
    jvm = spark._jvm
    own = jvm.org.apache.hadoop.fs.Path(path)
    stream = own.getFileSystem(spark._jsc.hadoopConfiguration()).open(own)
    try:
        return jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
    finally:
        stream.close()


def verified(spark: SparkSession, path: str, checksums: DataFrame) -> DataFrame:
    """(file, sha256, expected, ok) of landed files of up to 2 GB, hashed by the tasks that read them;
    ``stream_sha256`` takes larger ones."""
    own = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", r"([^/]*)\z", 1).alias("file"), file_sha256(F.col("content")).alias("sha256"))
    want = checksums.select("file", F.col("sha256").alias("expected"))
    return own.join(want, "file", "left").withColumn("ok", F.coalesce(F.col("sha256") == F.col("expected"), F.lit(False)))


def to_fetch(files: DataFrame, known: DataFrame) -> DataFrame:
    """Files to fetch with the reason: missing (not landed), unknown (no record) or changed (other hash).

    ``files`` has (file, sha256: expected, landed boolean), ``known`` (file, checksum)."""
    own = files.join(known.select("file", "checksum"), "file", "left")
    reason = (
        F.when(~F.col("landed"), "missing").when(F.col("checksum").isNull(), "unknown")
        .when(F.col("sha256").isNotNull() & (F.col("checksum") != F.col("sha256")), "changed"))
    return own.select("file", reason.alias("reason")).where("reason is not null")
