"""Event output: newline-delimited JSON by entity, in batches, with completion events.

An output has one folder per entity (``<prefix>-<entity>``), the place of a broker's fan-out
exchange; a broker adapter only has to take the same frames in the same order. Writing is
at-least-once: a file that is read again is written again under the same keys (id, sha256).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dumpmill.functions.canon import content_hash, envelope
from dumpmill.plans.policy import ENTITIES
from dumpmill.sinks.broker import TIMEOUT, Send, Sender, publish  # noqa: F401  publish is used by callers


def exchange(prefix: str, entity: str) -> str:
    return f"{prefix}-{entity}"


def queue(prefix: str, entity: str, consumer: str) -> str:
    return f"{prefix}-{entity}-{consumer}"


def with_hash(records: DataFrame, record: str = "data") -> DataFrame:
    """``records`` with the fields ``id`` and ``sha256``; the hashed document holds the id."""
    own = F.map_concat(F.map_filter(F.col(record), lambda k, v: ~k.isin("id")), F.create_map(F.lit("id"), F.col("id").cast("variant")))
    return records.withColumn(record, own).withColumn("sha256", content_hash(F.col(record)))


def data_events(records: DataFrame, record: str = "data") -> DataFrame:
    """(data_type, file, seq, id, sha256, value): one JSON event per record, as ``with_hash`` left it."""
    return records.select("data_type", "file", "seq", "id", "sha256", envelope(F.col(record), F.lit("data"), F.col("sha256")).alias("value"))


def batch_ids(events: DataFrame, size: int) -> Column:
    """The number of the batch of a record within its file: ``size`` records by their place."""
    return F.floor(F.col("seq") / F.lit(size)).cast("long")


def _stamp(c: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def file_complete_events(progress: DataFrame, now: Column | None = None) -> DataFrame:
    """(data_type, value) of files (file, data_type, records: all that the parser read)."""
    now = now if now is not None else F.current_timestamp()
    own = F.struct(
        F.lit("file_complete").alias("type"), "data_type", _stamp(now).alias("timestamp"), F.col("records").alias("total_processed"),
        F.regexp_extract("file", r"([^/]*)\z", 1).alias("file"))
    return progress.select("data_type", F.to_json(F.to_variant_object(own)).alias("value"))


def extraction_complete_events(counts: DataFrame, version: str, started_at: Column, entities: Iterable[str] = ENTITIES, now: Column | None = None) -> DataFrame:
    """(data_type, value): the same event for every entity; ``counts`` is ``report.record_counts``."""
    now = now if now is not None else F.current_timestamp()
    own = F.struct(
        F.lit("extraction_complete").alias("type"), F.lit(version).alias("version"), _stamp(now).alias("timestamp"), _stamp(started_at).alias("started_at"), "record_counts")
    made = counts.select(F.to_json(F.to_variant_object(own)).alias("value"))
    return made.select(F.explode(F.array(*map(F.lit, entities))).alias("data_type"), "value")


def append(rows: DataFrame, path: str, by: str, form: str = "text") -> None:
    """Add files to the folders ``path/<by>=...``. They are written to a folder of this call and renamed at the end, as writers
    that run side by side must not share a path: the first to commit removes what others still write."""
    spark, staged = rows.sparkSession, f"{path}/_staged-{uuid.uuid4().hex}"
    named = spark._jvm.org.apache.hadoop.fs.Path
    fs = named(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        rows.write.partitionBy(by).format(form).save(staged)
        for folder in fs.listStatus(named(staged)):
            if not folder.isDirectory():
                continue
            target = named(f"{path}/{folder.getPath().getName()}")
            fs.mkdirs(target)
            for part in fs.listStatus(folder.getPath()):
                if not fs.rename(part.getPath(), named(target, part.getPath().getName())):
                    raise OSError(f"could not move {part.getPath()} to {target}")
    finally:
        fs.delete(named(staged), True)


def write_events(events: DataFrame, path: str, prefix: str = "catalog", mode: str = "append") -> None:
    """Frames as text files in ``path/exchange=<prefix>-<entity>/``."""
    own = events.select(F.concat(F.lit(f"{prefix}-"), "data_type").alias("exchange"), "value")
    if mode == "append":
        append(own, path, "exchange")
    else:
        own.write.mode(mode).partitionBy("exchange").text(path)


def confirmed(send: Send, name: str, frames: list[str], timeout: float = TIMEOUT) -> int:
    """The frames that were sent; raises if some were not confirmed, or not in time."""
    own = Sender(send, timeout)
    try:
        return own(name, frames)
    finally:
        own.close()


def publish_completion(events: DataFrame, send: Send, prefix: str = "catalog") -> None:
    """The one frame of each entity (data_type, value) to its exchange. All are tried before the errors are raised."""
    errors = []
    for entity, frame in events.select("data_type", "value").orderBy("data_type").collect():
        try:
            confirmed(send, exchange(prefix, entity), [frame])
        except Exception as e:  # noqa: BLE001  other consumers must still hear of the end
            errors.append(f"{entity}: {e}")
    if errors:
        raise RuntimeError(f"completion was not sent to {len(errors)} exchange(s): {'; '.join(errors)}")


def violation_lines(long: DataFrame, now: Column | None = None) -> DataFrame:
    """(data_type, value): flagged output of (data_type, id, file, rule, severity, field, value)."""
    return _lines(long, {"rule": F.col("rule"), "severity": F.col("severity"), "field": F.col("field"), "field_value": F.col("value")}, now)


def skip_lines(skipped: DataFrame, now: Column | None = None) -> DataFrame:
    """(data_type, value) of skipped records."""
    return _lines(skipped, {"reason": F.col("_skip.reason"), "field": F.col("_skip.field"), "field_value": F.col("_skip.value")}, now)


def _lines(rows: DataFrame, fields: dict[str, Column], now: Column | None) -> DataFrame:
    from dumpmill.functions.text import sanitize_filename

    safe = sanitize_filename(F.col("id"))
    own = F.struct(
        F.col("id").alias("record_id"), *[c.alias(k) for k, c in fields.items()], F.concat(safe, F.lit(".xml")).alias("xml_file"),
        F.concat(safe, F.lit(".json")).alias("json_file"), _stamp(now if now is not None else F.current_timestamp()).alias("timestamp"))
    return rows.select("data_type", F.to_json(F.to_variant_object(own)).alias("value"))


def captures(records: DataFrame, flagged: DataFrame) -> DataFrame:
    """(data_type, name, raw_xml, json) once per entity and safe name of the records in ``flagged``
    (data_type, id, severity: errors, warnings and skips count)."""
    from dumpmill.functions.canon import canonical_json
    from dumpmill.functions.text import sanitize_filename

    ids = flagged.where("severity is null or severity in ('error', 'warning')").select("data_type", "id").distinct()
    own = records.join(ids, ["data_type", "id"], "left_semi")
    own = own.select("data_type", sanitize_filename(F.col("id")).alias("name"), "raw_xml", canonical_json(F.col("data")).alias("json"))
    return own.groupBy("data_type", "name").agg(F.min_by("raw_xml", "json").alias("raw_xml"), F.min("json").alias("json"))


def write_lines(lines: DataFrame, path: str, mode: str = "append") -> None:
    if mode == "append":
        append(lines, path, "data_type")
    else:
        lines.write.mode(mode).partitionBy("data_type").text(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text (a report, a marker) written whole: to ``path.part`` first, then renamed. A crash in between
    leaves the text under either name, and ``read_text`` looks for both."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    fs = target.getFileSystem(conf)
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
        out.hsync()
    finally:
        out.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None where there is none."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in (path, f"{path}.part"):
        target = jvm.org.apache.hadoop.fs.Path(name)
        if target.getFileSystem(conf).exists(target):
            row = spark.read.text(name, wholetext=True).head()
            return row[0] if row else ""
    return None


def removed(spark: SparkSession, path: str) -> None:
    """Remove a folder of working tables."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)
