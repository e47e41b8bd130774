"""Canonical blocks of releases: media, identifiers and companies, mapped by closed vocabularies.

The vocabularies are data files; code only knows the kinds of targets. They become literal maps, as
lookups happen inside list expressions. Every field of a block is always there, null or empty where
nothing is known.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from importlib.resources import files

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpmill.functions import values as V
from dumpmill.functions.text import collapse_space, digit_code, digits_only, leading_quantity, sorted_unique, trimmed, whole_number

NONE = "array<string>"


@lru_cache(maxsize=8)
def vocabulary(name: str) -> dict:
    return json.loads(files("dumpmill.data").joinpath(f"{name}.json").read_text("utf-8"))


def changed_vocabularies() -> list[str]:
    """Names of the vocabularies whose content is not what ``digests.json`` holds. A change of a vocabulary changes
    events, so its digest is to be changed knowingly."""
    known = json.loads(files("dumpmill.data").joinpath("digests.json").read_text("utf-8"))
    return sorted(n for n, digest in known.items() if hashlib.sha256(canonical(vocabulary(n)).encode()).hexdigest() != digest)


def canonical(tree) -> str:
    return json.dumps(tree, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _constant(table: dict, dtype: str) -> Column:
    """A literal map, handed over as one JSON text that is folded into a constant: thousands of calls into the JVM, one for
    each literal, would take longer than the blocks of ten thousand releases."""
    return F.from_json(F.lit(json.dumps(table, ensure_ascii=False)), f"map<string,{dtype}>")


def lookup(table: dict[str, str | None], key: Column) -> Column:
    """The table's value for a key, null where it has none."""
    own = {k: v for k, v in table.items() if v is not None}
    return F.try_element_at(_constant(own, "string"), key) if own else F.lit(None).cast("string")


def rows(table: dict[str, dict], fields: tuple[str, ...]) -> Column:
    """A literal map from keys to structs of ``fields``: one lookup gives all that is known of a key."""
    text = lambda v: None if v is None else str(v)
    return _constant({k: {f: text(own.get(f)) for f in fields} for k, own in table.items()}, f"struct<{','.join(f'`{f}`:string' for f in fields)}>")


def _field(obj: Column, name: str) -> Column:
    return trimmed(V.text_of(F.try_element_at(obj, F.lit(name))))


def _objects(trees: Column) -> Column:
    """The objects of a list as maps; null and what is no list give none."""
    listed = F.coalesce(V.as_list(trees), F.array().cast("array<variant>"))
    return F.filter(F.transform(listed, V.as_object), lambda o: o.isNotNull())


def _strings(c: Column) -> Column:
    return F.coalesce(c, F.array().cast(NONE))


def normalize_alias(rule: Column, value: Column) -> Column:
    """External id of a value under a rule; null for unknown rules and empty results."""
    own = (
        F.when(rule == "digits_only", digits_only(value)).when(rule == "collapse_space", collapse_space(value))
        .when(rule == "upper_collapse_space", F.upper(collapse_space(value))))
    return F.nullif(own, F.lit(""))


def identifiers_block(identifiers: Column, labels: Column, provider: str = "catalog") -> Column:
    """Variant block from the normalized lists ``identifiers`` and ``labels`` (variants or null)."""
    v = vocabulary("identifier_types")
    owned = {t["id"]: t["alias_provider"] for t in v["types"]}
    spaces = {n["type"]: n for n in v["namespaces"] if owned.get(n["type"]) == n["provider"]}
    raw = F.filter(
        F.transform(_objects(identifiers), lambda o: F.struct(
            _field(o, "type").alias("raw"), _field(o, "value").alias("value"), _field(o, "description").alias("description"))),
        lambda x: x["raw"].isNotNull() & x["value"].isNotNull())

    def made(kind: Column, value: Column, description: Column, raw_type: Column, field: str) -> Column:
        source = F.struct(F.lit(provider).alias("provider"), raw_type.alias("type"), F.lit(field).alias("field"))
        return F.struct(kind.alias("type"), value.alias("value"), description.alias("description"), source.alias("source"))

    null = F.lit(None).cast("string")
    typed = lambda raw: F.transform(raw, lambda x: made(
        F.coalesce(lookup(v["raw"], x["raw"]), F.lit(v["unmapped"])), x["value"], x["description"], x["raw"], v["identifier_field"]))
    numbers = F.filter(F.transform(_objects(labels), lambda o: _field(o, "catno")), lambda c: c.isNotNull() & (F.lower(c) != v["absent_catalog_number"]))
    lifted = F.transform(numbers, lambda c: made(F.lit("catalog_number"), c, null, null, v["catalog_number_field"]))
    rule = {k: n["normalization"] for k, n in spaces.items()}
    names = {k: n["provider"] for k, n in spaces.items()}
    alias = lambda i: F.struct(
        lookup(names, i["type"]).alias("provider"), normalize_alias(lookup(rule, i["type"]), i["value"]).alias("external_id"))

    def block(raw: Column, items: Column) -> Column:
        aliases = F.filter(F.transform(items, alias), lambda a: a["provider"].isNotNull() & a["external_id"].isNotNull())
        unmapped = F.filter(F.transform(raw, lambda x: x["raw"]), lambda t: lookup(v["raw"], t).isNull())
        return F.struct(
            F.lit(v["version"]).alias("identifiers_version"), items.alias("items"), sorted_unique(F.transform(items, lambda i: i["type"])).alias("types"),
            sorted_unique(aliases).alias("aliases"), F.struct(sorted_unique(unmapped).alias("types")).alias("unmapped"))

    return F.to_variant_object(V.let(raw, lambda r: V.let(F.concat(typed(r), lifted), lambda items: block(r, items))))


def companies_block(companies: Column, provider: str = "catalog") -> Column:
    """Variant block from the normalized list ``companies``; the company's id is ``<provider>_id``."""
    v = vocabulary("company_roles")

    def item(o: Column) -> Column:
        number = F.try_element_at(o, F.lit("id"))
        kind = F.try_element_at(o, F.lit("entity_type"))
        scalar = lambda t: F.when(V.kind(t).isin("string", "number"), F.try_variant_get(t, "$", "string"))
        role = _field(o, "entity_type_name")
        return F.struct(
            _field(o, "name").alias("name"), whole_number(scalar(number)).alias(f"{provider}_id"), role.alias("role"),
            F.coalesce(lookup(v["raw"], role), F.lit(v["unmapped"])).alias("role_category"), _field(o, "catno").alias("catno"),
            F.struct(F.lit(provider).alias("provider"), digit_code(scalar(kind)).alias("entity_type")).alias("source"))

    items = F.filter(F.transform(_objects(companies), item), lambda i: i["name"].isNotNull() & i["role"].isNotNull())
    unmapped = lambda items: F.filter(F.transform(items, lambda i: i["role"]), lambda r: lookup(v["raw"], r).isNull())
    return F.to_variant_object(V.let(items, lambda own: F.struct(
        F.lit(v["version"]).alias("companies_version"), own.alias("items"),
        sorted_unique(F.transform(own, lambda i: i["role_category"])).alias("role_categories"),
        F.struct(sorted_unique(unmapped(own)).alias("roles")).alias("unmapped"))))


def flat_descriptions(tree: Column) -> Column:
    """The strings of a list, of a lone string, or of either under ``description``."""
    def plain(t: Column) -> Column:
        return F.coalesce(F.filter(F.transform(V.as_list(t), V.text_of), lambda s: s.isNotNull()), F.when(V.text_of(t).isNotNull(), F.array(V.text_of(t))))

    return F.coalesce(plain(tree), plain(V.child(tree, "description")), F.array().cast(NONE))


ATTRIBUTES = ("size_inches", "speed_rpm", "channels", "codec")


def media_block(formats: Column, provider: str = "catalog") -> Column:
    """Variant block from the normalized list ``formats``.

    Per format: its name names a medium or family (an item), a container (the last one wins) or a
    flag. Its descriptions go to item attributes and lists, to release lists, or to release facts
    (the first one wins); those for the release count even where the format gives no item.
    """
    v = vocabulary("media_taxonomy")
    names = rows(v["formats"], ("family", "medium", "variant", "container", "flag"))
    targets = rows(v["descriptions"], ("target", "value"))
    defaults = rows({m: {**d.get("defaults", {}), "family": d.get("family")} for m, d in v["media"].items()}, (*ATTRIBUTES, "family"))
    resolve = {f"{f}|{a}|{k}": m for f, r in v["families"].items() for a, pairs in r.get("resolve", {}).items() for k, m in pairs.items()}
    deciding = [a for a in ATTRIBUTES if any(a in r.get("resolve", {}) for r in v["families"].values())]

    def read(o: Column) -> Column:
        name, text = V.text_of(F.try_element_at(o, F.lit("name"))), V.text_of(F.try_element_at(o, F.lit("text")))
        quantity = V.let(F.try_element_at(o, F.lit("qty")), lambda q: F.when(V.kind(q).isin("string", "number"), F.try_variant_get(q, "$", "string")))
        words = F.transform(flat_descriptions(F.try_element_at(o, F.lit("descriptions"))), lambda d: F.struct(d.alias("word"), F.try_element_at(targets, d).alias("rule")))
        return V.let(F.struct(name.alias("name"), words.alias("words")), lambda x: F.struct(
            x["name"].alias("name"), text.alias("text"), leading_quantity(F.coalesce(quantity, F.lit("1"))).alias("qty"), x["words"].alias("words"),
            F.filter(F.transform(x["words"], lambda w: w["rule"]), lambda r: r.isNotNull()).alias("rules"), F.try_element_at(names, x["name"]).alias("known")))

    read_all = F.transform(_objects(formats), read)
    first = lambda rules, t: F.get(F.filter(rules, lambda r: r["target"] == t), F.lit(0))["value"]
    every = lambda rules, t: F.transform(F.filter(rules, lambda r: r["target"] == t), lambda r: r["value"])
    number = lambda c: F.try_parse_json(c)

    def item(x: Column) -> Column:
        family = F.coalesce(x["known"]["family"], F.try_element_at(defaults, x["known"]["medium"])["family"])
        stated = F.struct(family.alias("family"), *[first(x["rules"], a).alias(a) for a in ATTRIBUTES])
        found = lambda s: [lookup(resolve, F.concat(s["family"], F.lit(f"|{a}|"), s[a])) for a in deciding]
        return V.let(stated, lambda s: V.let(
            F.coalesce(x["known"]["medium"], *found(s), F.concat(s["family"], F.lit("_unspecified"))),
            lambda medium: V.let(F.try_element_at(defaults, medium), lambda d: made(x, s, medium, d))))

    def made(x: Column, stated: Column, medium: Column, default: Column) -> Column:
        own = {a: F.coalesce(stated[a], default[a]) for a in ATTRIBUTES}
        null = F.lit(None).cast("string")
        variants = F.concat(F.filter(F.array(x["known"]["variant"]), lambda s: s.isNotNull()), every(x["rules"], "variant"))
        return F.struct(
            stated["family"].alias("family"), medium.alias("medium"), x["qty"].alias("qty"), number(own["size_inches"]).alias("size_inches"),
            number(own["speed_rpm"]).alias("speed_rpm"), own["channels"].alias("channels"), own["codec"].alias("codec"),
            sorted_unique(variants).alias("variants"), sorted_unique(every(x["rules"], "appearance")).alias("appearance"), null.alias("position"),
            F.lit(None).cast("long").alias("track_count"),
            F.struct(F.lit(provider).alias("provider"), x["name"].alias("name"), F.transform(x["words"], lambda w: w["word"]).alias("descriptions"),
                     x["text"].alias("text")).alias("source"))

    def block(entries: Column, items: Column, rules: Column) -> Column:
        container = F.aggregate(entries, F.lit(None).cast("string"), lambda acc, x: F.coalesce(x["known"]["container"], acc, first(x["rules"], "container")))
        flags = F.filter(F.transform(entries, lambda x: x["known"]["flag"]), lambda s: s.isNotNull())
        strange = F.filter(F.transform(entries, lambda x: F.when(x["known"].isNull(), x["name"])), lambda s: s.isNotNull())
        words = F.filter(F.flatten(F.transform(entries, lambda x: x["words"])), lambda w: w["rule"].isNull())
        return F.struct(
            F.lit(v["version"]).alias("taxonomy_version"), items.alias("items"),
            sorted_unique(F.filter(F.transform(items, lambda i: i["family"]), lambda s: s.isNotNull())).alias("families"),
            first(rules, "release_kind").alias("release_kind"), sorted_unique(every(rules, "trait")).alias("traits"),
            sorted_unique(every(rules, "edition")).alias("edition"), first(rules, "packaging").alias("packaging"), container.alias("container"),
            sorted_unique(F.concat(flags, every(rules, "flag"))).alias("flags"),
            F.struct(sorted_unique(strange).alias("formats"), sorted_unique(F.transform(words, lambda w: w["word"])).alias("descriptions")).alias("unmapped"))

    named = lambda entries: F.filter(entries, lambda x: x["known"]["family"].isNotNull() | x["known"]["medium"].isNotNull())
    return F.to_variant_object(V.let(read_all, lambda entries: V.let(F.transform(named(entries), item), lambda items: V.let(
        F.flatten(F.transform(entries, lambda x: x["rules"])), lambda rules: block(entries, items, rules)))))


def attach_blocks(df: DataFrame, record: str = "data", provider: str = "catalog") -> DataFrame:
    """Releases with the three blocks; ``identifiers`` and ``companies`` take the place of the raw lists."""
    own = F.col(record)
    get = lambda k: F.try_element_at(own, F.lit(k))
    blocks = F.create_map(
        F.lit("media"), media_block(get("formats"), provider), F.lit("identifiers"), identifiers_block(get("identifiers"), get("labels"), provider),
        F.lit("companies"), companies_block(get("companies"), provider))
    return df.withColumn(record, F.map_concat(F.map_filter(own, lambda k, v: ~k.isin("media", "identifiers", "companies")), blocks))
