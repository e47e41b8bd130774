"""Normalization of parsed records to flat shapes, as expressions over map<string,variant>.

Attribute keys lose their ``@``; ``#text`` becomes ``name`` unless there is one. A container such as
``{"genre": [...]}`` becomes its list; empty lists leave the field out. What is not named here stays
as it was, so unknown fields reach the output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dumpmill.functions import values as V

#: Entity: list fields with the key of their container and the kind of their items.
LISTS = {
    "artists": {"members": ("name", "item"), "groups": ("name", "item"), "aliases": ("name", "item")},
    "labels": {"sublabels": ("label", "item")},
    "masters": {"artists": ("artist", "item"), "genres": ("genre", "plain"), "styles": ("style", "plain")},
    "releases": {
        "artists": ("artist", "item"), "labels": ("label", "item"), "extraartists": ("artist", "item"), "genres": ("genre", "plain"),
        "styles": ("style", "plain"), "identifiers": ("identifier", "item"), "companies": ("company", "item"), "formats": ("format", "object"),
    },
}
#: Entities whose own attributes are stripped too.
STRIPPED = ("masters", "releases")


def strip_prefixes(obj: Column) -> Column:
    """A map without ``@`` on its keys; such a key replaces one of the same name. ``#text`` becomes
    ``name`` unless the map has that key, and gives way to ``@name``."""
    attributes = F.transform_keys(F.map_filter(obj, lambda k, v: k.startswith("@")), lambda k, v: F.substring(k, 2, 1 << 30))
    named = F.map_contains_key(obj, "name")
    plain = F.map_filter(obj, lambda k, v: ~k.startswith("@") & ~F.map_contains_key(obj, F.concat(F.lit("@"), k)) & ((k != "#text") | named))
    text = F.map_filter(obj, lambda k, v: (k == "#text") & ~named & ~F.map_contains_key(obj, "@name"))
    return F.map_concat(plain, attributes, F.transform_keys(text, lambda k, v: F.lit("name")))


def stripped(tree: Column) -> Column:
    """``strip_prefixes`` of an object, anything else as it is."""
    return V.let(V.as_object(tree), lambda obj: F.when(obj.isNotNull(), F.to_variant_object(strip_prefixes(obj))).otherwise(tree))


def ensure_list(tree: Column) -> Column:
    """array<variant>: a list's items, nothing for null, else the value alone."""
    none = F.array().cast("array<variant>")
    return F.coalesce(V.as_list(tree), F.when(tree.isNull() | F.is_variant_null(tree), none), F.array(tree))


def unwrap_container(tree: Column, key: str) -> Column:
    """The list in an object's ``key`` (empty if it lacks it), or ``ensure_list`` of anything else."""
    return V.let(V.as_object(tree), lambda obj: F.when(obj.isNotNull(), ensure_list(F.try_element_at(obj, F.lit(key)))).otherwise(ensure_list(tree)))


def item(tree: Column) -> Column:
    """Objects stripped; a bare string is an id."""
    return V.let(V.text_of(tree), lambda text: F.when(text.isNotNull(), F.to_variant_object(F.create_map(F.lit("id"), text))).otherwise(stripped(tree)))


_ITEMS: dict[str, Callable[[Column], Column]] = {"item": item, "object": stripped, "plain": lambda tree: tree}


def normalize(df: DataFrame, entity: str, record: str = "data") -> DataFrame:
    """``df`` with the records of an entity in their flat shape; unknown entities stay as they are.

    The steps are projections of their own, so that each field reads a record that is there already.
    """
    fields = LISTS.get(entity, {})
    own = F.col(record)
    if entity in STRIPPED:
        df = df.withColumn(record, strip_prefixes(own))
    if entity == "labels":
        df = df.withColumn(record, F.transform_values(own, lambda k, v: F.when(k == "parentLabel", stripped(v)).otherwise(v)))
    if entity == "releases":
        df = df.withColumn(record, F.transform_values(own, lambda k, v: F.when(k == "master_id", F.coalesce(V.child(v, "#text"), V.child(v, "id"), v)).otherwise(v)))
    if not fields:
        return df
    lists = []
    for name, (key, kind) in fields.items():
        items = F.transform(unwrap_container(F.try_element_at(own, F.lit(name)), key), _ITEMS[kind])
        lists += [F.lit(name), V.let(items, lambda x: F.when(F.size(x) > 0, F.to_variant_object(x)))]
    rest = F.map_filter(own, lambda k, v: ~k.isin(*fields))
    return df.withColumn(record, F.map_concat(rest, F.map_filter(F.create_map(*lists), lambda k, v: v.isNotNull())))
