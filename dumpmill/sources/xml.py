"""Gzip XML dumps as DataFrames of records.

Reading has two steps. Spark's text reader streams each file (gzip cannot be split, so one task per
file) cut at the end tags of records; a small assembler joins what nested elements of the same name
tore apart. The records are then dealt out again and parsed in parallel into JSON trees.

Trees: attributes are ``@name``, text next to attributes or children is ``#text``, a repeated child
is a list, an empty element null. Text is kept untrimmed, but blank text is none. A bare ``&`` and
unknown entities are kept as text, impossible character references become U+FFFD, and so do invalid
bytes. A malformed record is a row with ``error`` and no data; its neighbours survive.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SINGULAR = {"artists": "artist", "labels": "label", "masters": "master", "releases": "release"}
NAME = r"([^/_]+)_([0-9]{8})_(artists|labels|masters|releases)\.xml\.gz$"
#: Malformed records that a file may have.
BUDGET = 100
_TAG = r"<{0}(?:\s(?:[^<>\"']|\"[^\"]*\"|'[^']*')*)?/?>"
_REFERENCE = re.compile(r"<!\[CDATA\[.*?\]\]>|<!--.*?-->|&(#[^;\s<&]*;|[A-Za-z_][\w.-]*;)?", re.S)


class TooManyFaults(RuntimeError):
    pass


def _reference(m: re.Match) -> str:
    if not m[0].startswith("&"):
        return m[0]
    if m[1] is None:
        return "&amp;"
    body = m[1][:-1]
    if not body.startswith("#"):
        return m[0] if body in ("amp", "lt", "gt", "quot", "apos") else f"&amp;{body};"
    try:
        code = int(body[2:], 16) if body[1:2] in ("x", "X") else int(body[1:])
    except ValueError:
        return "�"
    legal = code in (9, 10, 13) or 32 <= code < 0xD800 or 0xE000 <= code < 0xFFFE or 0x10000 <= code < 0x110000
    return f"&#{code};" if legal else "�"


def parse_record(xml: str, fields: frozenset[str] | None = None):
    """The tree of one element; raises on malformed XML. With ``fields``, children of other names are not built."""
    from xml.parsers import expat

    top: list = []
    stack: list[tuple[dict, list[str]]] = []

    passed = 0  # depth inside a child that is not built

    def start(name, attributes):
        nonlocal passed
        if passed or (fields is not None and len(stack) == 1 and name not in fields):
            passed += 1
            parser.CharacterDataHandler = None
            return
        stack.append(({f"@{k}": v for k, v in attributes.items()}, []))

    def text(data):
        stack[-1][1].append(data)

    def end(name):
        nonlocal passed
        if passed:
            passed -= 1
            if not passed:
                parser.CharacterDataHandler = text
            return
        own, texts = stack.pop()
        words = "".join(texts)
        value: object = own or None
        if words.strip():
            value = own | {"#text": words} if own else words
        if not stack:
            top.append(value)
            return
        parent = stack[-1][0]
        if name not in parent:
            parent[name] = value
        elif isinstance(parent[name], _Repeated):
            parent[name].append(value)
        else:
            parent[name] = _Repeated([parent[name], value])

    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text
    parser.Parse(_REFERENCE.sub(_reference, xml), True)
    return top[0]


class _Repeated(list):
    """Children of one name."""


def record_of(xml: str) -> tuple[str, dict] | None:
    """(id, tree) of a record, None if it holds no fields. An ``@id`` replaces a child ``id``."""
    tree = parse_record(xml)
    if not isinstance(tree, dict):
        return None
    if "@id" in tree:
        tree.pop("id", None)
    own = tree.get("@id", tree.get("id"))
    return own if isinstance(own, str) else "unknown", tree


def to_xml(name: str, tree) -> str:
    """A tree written out again, attributes first."""
    from xml.sax.saxutils import escape, quoteattr

    if isinstance(tree, list):
        return "".join(to_xml(name, x) for x in tree)
    if tree is None:
        return f"<{name}/>"
    if not isinstance(tree, dict):
        return f"<{name}>{escape(str(tree))}</{name}>"
    head = "".join(f" {k[1:]}={quoteattr(str(v))}" for k, v in tree.items() if k.startswith("@"))
    body = escape(tree["#text"]) if isinstance(tree.get("#text"), str) else ""
    body += "".join(to_xml(k, v) for k, v in tree.items() if not k.startswith("@") and k != "#text")
    return f"<{name}{head}>{body}</{name}>" if body else f"<{name}{head}/>"


class Assembler:
    """Records from the pieces between end tags of one file."""

    def __init__(self, name: str):
        self.name, self.end = name, f"</{name}>"
        self.tag = re.compile(_TAG.format(re.escape(name)))
        self.held, self.depth = "", 0

    def feed(self, piece: str, last: bool) -> Iterator[tuple[str, str | None]]:
        """(text of a record, why it is malformed or None) for each one that the piece completes."""
        at = 0
        for m in self.tag.finditer(piece):
            closed = m[0].endswith("/>")
            if self.depth:
                inside = self.held + piece[at : m.start()]
                if inside.count("<sublabels>") > inside.count("</sublabels>"):
                    self.depth += not closed
                    continue
                yield inside, "no end tag"
                self.depth, self.held, at = 0, "", m.start()
            if closed:
                yield m[0], None
            else:
                self.depth, self.held, at = 1, "", m.start()
        if self.depth:
            self.held += piece[at:] + ("" if last else self.end)
            self.depth -= not last
            if not self.depth:
                yield self.held, None
                self.held = ""
            elif last:
                yield self.held, "no end tag"


def _assemble(name: str, budget: int | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces come in the order of their files; the last piece of a file is known when the next begins. A file is
    passed over from the fault on that exceeds the budget."""
    file, own, seq, waiting, faults = None, None, 0, None, 0
    out: list[tuple] = []

    def take(last: bool) -> None:
        nonlocal seq, faults
        if budget is not None and faults > budget:
            return
        for xml, error in own.feed(waiting, last):
            out.append((file, seq, xml, error))
            seq += 1
            faults += error is not None
            if budget is not None and faults > budget:
                return

    def batch() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) or [(), (), (), ()]
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
        done = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["file", "seq", "xml", "error"])
        out.clear()
        return done

    size = 0
    for b in batches:
        for path, piece in zip(b.column("file").to_pylist(), b.column("value").to_pylist(), strict=True):
            if path != file:
                if own:
                    take(True)
                file, own, seq, waiting, faults = path, Assembler(name), 0, None, 0
            if waiting is not None:
                take(False)
            waiting = piece
            size += len(piece)
            if size > 1 << 22:
                yield batch()
                size = 0
    if own:
        take(True)
    yield batch()


def _parsed(name: str, capture: bool, budget: int | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    faults: dict[str, int] = {}
    for b in batches:
        keep, ids, trees, raws, errors = [], [], [], [], []
        for i, (file, xml, error) in enumerate(zip(*(b.column(c).to_pylist() for c in ("file", "xml", "error")), strict=True)):
            if budget is not None and faults.get(file, 0) > budget:
                continue
            own = None
            if error is None:
                try:
                    own = record_of(xml)
                    if own is None:  # no fields: no record
                        continue
                except Exception as e:  # noqa: BLE001  any fault of one record stays with it
                    error = f"{type(e).__name__}: {e}"
            if error is not None:
                faults[file] = faults.get(file, 0) + 1
            keep.append(i)
            ids.append(own and own[0])
            trees.append(own and json.dumps(own[1], ensure_ascii=False, separators=(",", ":")))
            raws.append(to_xml(name, own[1]) if own and capture else xml if error else None)
            errors.append(error)
        at = pa.array(keep, pa.int64())
        cols = [b.column("file").take(at), b.column("seq").take(at), *(pa.array(x, pa.string()) for x in (ids, trees, raws, errors))]
        yield pa.RecordBatch.from_arrays(cols, names=["file", "seq", "id", "json", "raw_xml", "error"])


def file_parts(path: Column) -> list[Column]:
    """version and data_type of a dump's file name, null where it is none."""
    return [F.nullif(F.regexp_extract(path, NAME, i), F.lit("")).alias(k) for i, k in ((2, "version"), (3, "data_type"))]


def read_dump(
    spark: SparkSession, paths: str | list[str], entity: str, capture_raw: bool = False, partitions: int | None = None, budget: int | None = None,
) -> DataFrame:
    """Records of dumps of one entity: (file, version, data_type, seq, id, data, raw_xml, error).

    ``data`` is map<string,variant>. ``seq`` is the place in the file. ``raw_xml`` is written from the
    tree if asked for, and holds the source of malformed records.

    With ``budget`` each task gives a file up at the malformed record that exceeds it: rows after that one are missing, and
    ``check_faults`` with the same budget is sure to refuse the file, so it must be called. Without, all records are read.
    """
    name = SINGULAR[entity]
    pieces = spark.read.option("lineSep", f"</{name}>").text(paths)
    pieces = pieces.select(F.col("_metadata.file_path").alias("file"), F.make_valid_utf8("value").alias("value"))
    records = pieces.mapInArrow(lambda batches: _assemble(name, budget, batches), "file string, seq long, xml string, error string")
    records = records.repartition(partitions) if partitions else records.repartition("file", (F.col("seq") / 1000).cast("long"))
    parsed = records.mapInArrow(lambda batches: _parsed(name, capture_raw, budget, batches), "file string, seq long, id string, json string, raw_xml string, error string")
    data = F.parse_json("json").try_cast("map<string,variant>")
    return parsed.select("file", *file_parts(F.col("file")), "seq", "id", data.alias("data"), "raw_xml", "error")


def check_faults(records: DataFrame, budget: int | None = BUDGET) -> dict[str, int]:
    """Malformed records per file; raises for files with more than ``budget`` (None: no bound)."""
    counts = {r[0]: r[1] for r in records.where("error is not null").groupBy("file").count().collect()}
    if over := {f: n for f, n in counts.items() if budget is not None and n > budget}:
        raise TooManyFaults(f"more than {budget} malformed records: {over}")
    return counts


def rejects(records: DataFrame) -> DataFrame:
    """(file, data_type, seq, cause, raw_xml) of malformed records, an output of their own."""
    return records.where("error is not null").select("file", "data_type", "seq", F.col("error").alias("cause"), "raw_xml")
