"""Catalog dumps as a data source: ``spark.read.format("catalogxml").schema(...).load(folder)``, batch and stream.

Columns of the schema: ``file``, ``version``, ``data_type``, ``seq`` (place in the file), ``id``, ``json`` (the whole tree),
``error`` (why a record is malformed) and fields of records by their names, ``@name`` for attributes. A field is its text, or JSON
where it is no lone text; null where it is absent or empty. Without a schema the seven columns are read. Children of a record that
the schema does not name are passed over by the parser and not built.

Options: ``path`` (a folder or one dump in a store that Arrow's file systems reach), ``splits`` (tasks per dump: each decompresses
the whole dump, as gzip is read from its start, but parses only its share of the records; 1 if not set), ``mode`` (PERMISSIVE:
malformed records are rows with ``error``; DROPMALFORMED; FAILFAST).

Conditions on version, data_type and file leave dumps out before any is opened. Those on id (``=``, ``in``) leave records
unparsed that cannot have such an id. Spark pushes them where ``spark.sql.python.filterPushdown.enabled`` is set.

The offset of a stream is all dumps of the folder, so one that lands late, or with an older time, is not missed; a monthly catalog
has some fifty a year. A trigger takes all that are new. Dumps must land whole, by a rename, and neither change nor go afterwards.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from dumpmill.sources.xml import NAME, SINGULAR, Assembler, parse_record

FORMAT = "catalogxml"
SCHEMA = "file string, version string, data_type string, seq long, id string, json string, error string"
#: Columns that are no fields of records.
OWN = ("file", "version", "data_type", "seq", "id", "json", "error")
MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")
#: Neighbouring records that one split parses, rows of a batch, and bytes read at once.
SHARE, ROWS, CHUNK = 256, 2000, 1 << 20
_DUMP = re.compile(NAME)


class MalformedRecordError(RuntimeError):
    pass


@dataclass(frozen=True)
class Dump(InputPartition):
    """The records of ``path`` that fall to ``part`` of ``parts``; only those with one of ``ids`` where it is given."""

    path: str
    version: str
    data_type: str
    part: int = 0
    parts: int = 1
    ids: tuple[str, ...] | None = None
    size: int = 0

    @property
    def value(self) -> str:  # what Spark shows of a partition
        return f"{self.path}#{self.part}/{self.parts}"


def _store(path: str):
    from pyarrow import fs

    if not re.match(r"[A-Za-z][\w+.-]*:/", path):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def list_dumps(path: str) -> list[Dump]:
    """The dumps directly in a folder, or the one at ``path``, by path. Other files are passed over."""
    from pyarrow import fs

    path = path.rstrip("/")
    store, own = _store(path)
    if not path.endswith(own):
        raise ValueError(f"no plain path: {path}")
    info = store.get_file_info(own)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    files = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(own))
    head = path[: len(path) - len(own)]
    found = [(f"{head}{f.path}", m, f.size) for f in files if f.type == fs.FileType.File and (m := _DUMP.search(f.path))]
    return [Dump(p, m[2], m[3], size=n) for p, m, n in sorted(found, key=lambda x: x[0])]


def _pieces(path: str, end: str) -> Iterator[tuple[str, bool]]:
    """(text between two end tags, whether it is the file's last), read and decompressed as a stream."""
    store, own = _store(path)
    decoder, held = codecs.getincrementaldecoder("utf-8")("replace"), ""
    with store.open_input_stream(own, compression="gzip", buffer_size=CHUNK) as stream:
        while True:
            chunk = stream.read(CHUNK)
            text = decoder.decode(chunk, not chunk)
            # an end tag may lie across two chunks; what was held before is not searched again
            seen = max(0, len(held) - len(end))
            held += text
            at = held.find(end, seen)
            start = 0
            while at >= 0:
                yield held[start:at], False
                start = at + len(end)
                at = held.find(end, start)
            held = held[start:]
            if not chunk:
                yield held, True
                return


def records(dump: Dump) -> Iterator[tuple[int, str, str | None]]:
    """(seq, text, why it is malformed or None) of the records of a dump that its part holds."""
    name = SINGULAR[dump.data_type]
    own, seq = Assembler(name), 0
    for piece, last in _pieces(dump.path, f"</{name}>"):
        for xml, error in own.feed(piece, last):
            if seq // SHARE % dump.parts == dump.part:
                yield seq, xml, error
            seq += 1


def _may_have(xml: str, ids: tuple[str, ...]) -> bool:
    """False only if no id of ``ids`` can be the record's: references and sections may spell an id otherwise."""
    return "&" in xml or "<!" in xml or any(i in xml for i in ids)


def rows(dump: Dump, schema: StructType, mode: str = "PERMISSIVE") -> Iterator[pa.RecordBatch]:
    """Batches of ``schema`` of a dump, of at most ROWS rows."""
    fields = [f.name for f in schema if f.name not in OWN]
    wanted = None if "json" in schema.names else frozenset(["id", *fields])
    kinds = {f.name: {LongType(): pa.int64(), IntegerType(): pa.int32()}.get(f.dataType, pa.string()) for f in schema}
    held: list[dict] = []

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in held], kinds[n]) for n in schema.names], names=schema.names)
        held.clear()
        return made

    fixed = {"file": dump.path, "version": dump.version, "data_type": dump.data_type}
    for seq, xml, error in records(dump):
        if dump.ids is not None and (error is not None or not _may_have(xml, dump.ids)):
            continue  # a malformed record has no id
        row = fixed | {"seq": seq}
        if error is None:
            try:
                tree = parse_record(xml, wanted)
            except Exception as e:  # noqa: BLE001  any fault of one record stays with it
                error = f"{type(e).__name__}: {e}"
        if error is not None:
            if mode == "FAILFAST":
                raise MalformedRecordError(f"{dump.path}, record {seq}: {error}")
            if mode == "PERMISSIVE" and dump.ids is None:
                held.append(row | {"error": error})
        elif isinstance(tree, dict) or (wanted is not None and isinstance(parse_record(xml), dict)):
            tree = tree if isinstance(tree, dict) else {}
            if "@id" in tree:
                tree.pop("id", None)
            own = tree.get("@id", tree.get("id"))
            row["id"] = own if isinstance(own, str) else "unknown"
            if wanted is None:
                row["json"] = json.dumps(tree, ensure_ascii=False, separators=(",", ":"))
            for n in fields:
                if (v := tree.get(n)) is not None:
                    row[n] = v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, separators=(",", ":"))
            held.append(row)
        if len(held) >= ROWS:
            yield batch()
    if held:
        yield batch()


class _Options:
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path = schema, options.get("path")
        self.mode = options.get("mode", "PERMISSIVE").upper()
        self.splits = int(options.get("splits", 1))
        if not self.path:
            raise ValueError("a path is needed")
        if self.mode not in MODES:
            raise ValueError(f"mode is one of {', '.join(MODES)}")
        if self.splits < 1:
            raise ValueError("splits is 1 or more")
        kinds = {f.name: f.dataType for f in schema}
        wrong = [n for n, t in kinds.items() if t != StringType() and not (n == "seq" and t in (LongType(), IntegerType()))]
        if wrong:
            raise ValueError(f"columns are strings, and seq a long: {', '.join(wrong)}")

    def parts(self, dumps: list[Dump], ids: tuple[str, ...] | None = None) -> list[Dump]:
        return [Dump(d.path, d.version, d.data_type, i, self.splits, ids) for d in dumps for i in range(self.splits)]


class CatalogReader(_Options, DataSourceReader):
    """Dumps that the conditions leave, ``splits`` tasks each."""

    def __init__(self, schema: StructType, options: dict):
        super().__init__(schema, options)
        self.only: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]):  # noqa: N802  the name is Spark's
        """Keeps conditions of one of several values. Those on places of dumps are met here in full; Spark tests the rest again."""
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            name = f.attribute[0] if values is not None and len(f.attribute) == 1 else None
            if name in ("version", "data_type", "file") or (name == "id" and "unknown" not in values):
                self.only[name] = self.only.get(name, values) & values
            if name not in ("version", "data_type", "file"):
                yield f

    def partitions(self) -> list[Dump]:
        dumps = list_dumps(self.path)
        for name, own in (("version", "version"), ("data_type", "data_type"), ("file", "path")):
            dumps = [d for d in dumps if name not in self.only or getattr(d, own) in self.only[name]]
        ids = self.only.get("id")
        return self.parts(dumps, None if ids is None else tuple(sorted(i for i in ids if isinstance(i, str))))

    def read(self, partition: Dump) -> Iterator[pa.RecordBatch]:
        return rows(partition, self.schema, self.mode) if partition else iter(())


class CatalogStream(_Options, DataSourceStreamReader):
    """The dumps of a folder that have not been taken. An offset holds all dumps so far by path with their size."""

    def initialOffset(self) -> dict:  # noqa: N802  the name is Spark's
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        return {d.path: d.size for d in list_dumps(self.path)}

    def partitions(self, start: dict, end: dict) -> list[Dump]:
        return self.parts([d for p in sorted(end) if p not in start for d in list_dumps(p)])

    def commit(self, end: dict) -> None:
        """Nothing is held back."""

    def read(self, partition: Dump) -> Iterator[pa.RecordBatch]:
        return rows(partition, self.schema, self.mode)


class CatalogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> CatalogReader:
        return CatalogReader(schema, dict(self.options))

    def streamReader(self, schema: StructType) -> CatalogStream:  # noqa: N802
        return CatalogStream(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    """Makes ``catalogxml`` known to a session, and lets Spark push conditions to it."""
    spark.dataSource.register(CatalogSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def with_data(df: DataFrame) -> DataFrame:
    """``df`` with ``data``, its ``json`` as map<string,variant>, as ``run.prepare`` takes it."""
    return df.withColumn("data", F.parse_json("json").try_cast("map<string,variant>")).drop("json")
