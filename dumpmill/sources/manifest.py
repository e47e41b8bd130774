"""One-shot manifests: a JSON file that names a single dump to read, with its checksum.

``{"contract", "version", "data_type", "scope", "file", "media_type", "sha256"}``; the file lies next
to the manifest or below. Everything is checked before a job starts.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from dumpmill.sources.files import stream_sha256

CONTRACT, SCOPE, MEDIA = "catalog-dump/v1", "single-file", "application/gzip"
FIELDS = {"contract", "version", "data_type", "scope", "file", "media_type", "sha256"}
#: A flat object of strings and nothing after it.
_WHOLE = r"""\A[ \t\r\n]*+\{(?:[ \t\r\n,:]++|"[^"\\]*+(?:\\.[^"\\]*+)*+")*+\}[ \t\r\n]*+\z"""


class ManifestError(ValueError):
    pass


@dataclass(frozen=True)
class Manifest:
    version: str
    data_type: str
    path: str
    sha256: str


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    """Read by Spark, so manifests can lie in any store; the named file is hashed and compared."""
    text = spark.read.text(path, wholetext=True).head()
    own = parse_manifest(text[0] if text else "", path.rsplit("/", 1)[0] if "/" in path else ".")
    got = stream_sha256(spark, own.path)
    if got != own.sha256:
        raise ManifestError(f"{own.path} has SHA-256 {got}, the manifest says {own.sha256}")
    return own


def parse_manifest(text: str, folder: str) -> Manifest:
    try:
        raw = json.loads(text)
    except ValueError as e:
        raise ManifestError(f"no JSON: {e}") from e
    if not isinstance(raw, dict) or set(raw) != FIELDS or not all(isinstance(v, str) for v in raw.values()):
        raise ManifestError(f"a manifest has exactly the string fields {sorted(FIELDS)}")
    for key, want in (("contract", CONTRACT), ("scope", SCOPE), ("media_type", MEDIA)):
        if raw[key] != want:
            raise ManifestError(f"{key} is {raw[key]!r}, not {want!r}")
    file = raw["file"]
    if file.startswith("/") or "\\" in file or "://" in file or any(p in ("", ".", "..") for p in file.split("/")):
        raise ManifestError(f"the file leaves the manifest's folder: {file!r}")
    name = re.fullmatch(r"([^_/]+)_([0-9]{8})_(artists|labels|masters|releases)\.xml\.gz", file.rsplit("/", 1)[-1])
    if not name or name[2] != raw["version"] or name[3] != raw["data_type"]:
        raise ManifestError(f"{file!r} is no dump of {raw['data_type']} {raw['version']}")
    if not re.fullmatch("[0-9a-f]{64}", raw["sha256"]):
        raise ManifestError("sha256 is no lower-case hash")
    return Manifest(raw["version"], raw["data_type"], f"{folder}/{file}", raw["sha256"])


def manifest_fault(text: Column) -> Column:
    """What ``parse_manifest`` would refuse the manifests of a column for: json, fields, contract, scope, media_type, path, name,
    sha256 or null. A repeated key is no JSON here."""
    tree = F.try_parse_json(text)
    own = F.try_variant_get(tree, "$", "map<string,variant>")
    fields = (F.array_sort(F.map_keys(own)) == F.array(*map(F.lit, sorted(FIELDS)))) & F.forall(F.map_values(own), lambda v: F.schema_of_variant(v) == "STRING")
    get = lambda k: F.try_variant_get(tree, f"$.{k}", "string")
    file = get("file")
    leaves = file.startswith("/") | file.contains("\\") | file.contains("://") | F.exists(F.split(file, "/"), lambda p: p.isin("", ".", ".."))
    part = lambda i: F.regexp_extract(F.element_at(F.split(file, "/"), -1), r"\A([^_/]+)_([0-9]{8})_(artists|labels|masters|releases)\.xml\.gz\z", i)
    named = (part(2) == get("version")) & (part(3) == get("data_type")) & (part(1) != "")
    fault = F.when(tree.isNull(), "json").when(~F.coalesce(fields, F.lit(False)), "fields")
    fault = fault.when(~text.rlike(_WHOLE), "json")  # the parser of variants leaves what follows a value unread
    for key, want in (("contract", CONTRACT), ("scope", SCOPE), ("media_type", MEDIA)):
        fault = fault.when(get(key) != want, key)
    return fault.when(leaves, "path").when(~named, "name").when(~get("sha256").rlike(r"\A[0-9a-f]{64}\z"), "sha256")
