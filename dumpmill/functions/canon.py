"""Canonical JSON and content hashes.

A record is a map from field names to VARIANT. A field that is absent has no key (SQL NULL here),
one that was set to null holds a variant null; serializing a variant object sorts keys and keeps
nulls, so equal records have equal text whatever order their fields came in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RECORD = "map<string,variant>"


def record(**fields: Column) -> Column:
    """A record of columns of any type; SQL NULL leaves the field out."""
    pairs = [x for k, c in fields.items() for x in (F.lit(k), c.cast("variant"))]
    return present(F.create_map(*pairs))


def present(own: Column) -> Column:
    return F.map_filter(own, lambda k, v: v.isNotNull())


def json_null() -> Column:
    return F.parse_json(F.lit("null"))


def canonical_json(own: Column) -> Column:
    """The record as compact JSON with sorted keys."""
    return F.to_json(F.to_variant_object(own))


def content_hash(own: Column) -> Column:
    """SHA-256 of the canonical JSON; the record includes ``id`` and neither ``type`` nor ``sha256``."""
    return F.sha2(canonical_json(own), 256)


def envelope(own: Column, data_type: Column, sha256: Column | None = None) -> Column:
    """The data event: the record with ``type`` and ``sha256`` (its content hash, if not given) next to its fields."""
    inner = F.map_filter(own, lambda k, v: ~k.isin("type", "sha256"))
    digest = content_hash(own) if sha256 is None else sha256
    head = F.create_map(F.lit("type"), data_type.cast("variant"), F.lit("sha256"), digest.cast("variant"))
    return canonical_json(F.map_concat(inner, head))
