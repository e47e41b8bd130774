"""Paths into records: typed columns (structs, arrays, maps) and VARIANT trees alike."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TREE = T.VariantType()


def let(value: Column, body) -> Column:
    """``body(value)`` with the value made once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_list(tree: Column) -> Column:
    """The variant's elements if it is an array, else null."""
    return F.try_variant_get(tree, "$", "array<variant>")


def as_object(tree: Column) -> Column:
    return F.try_variant_get(tree, "$", "map<string,variant>")


def kind(tree: Column) -> Column:
    """string, number, boolean, null, array or object."""
    return let(F.schema_of_variant(tree), lambda own: (
        F.when(own == "STRING", "string").when(own == "VOID", "null").when(own == "BOOLEAN", "boolean")
        .when(own.startswith("ARRAY"), "array").when(own.startswith("OBJECT"), "object").otherwise("number")))


def child(tree: Column, name: str) -> Column:
    """The child of a variant object, SQL NULL where there is none (a JSON null stays a variant)."""
    return F.try_element_at(as_object(tree), F.lit(name))


def text_of(tree: Column) -> Column:
    """Strings as they are, else null."""
    return F.when(F.schema_of_variant(tree) == "STRING", F.try_variant_get(tree, "$", "string"))


def scalar_text(tree: Column) -> Column:
    """Strings and numbers as text, JSON null as "", else SQL NULL."""
    own = kind(tree)
    return F.when(own == "null", "").when(own.isin("string", "number"), F.try_variant_get(tree, "$", "string"))


def resolve(source: Column, dtype: T.DataType, path: str) -> Column:
    """All values at a dotted path as array<string>.

    Each step goes into objects only; an array found there is expanded by one level. Null is "",
    numbers are text; booleans, objects and arrays are left out. Absent fields give no value: in a
    typed column a null field counts as absent, unless the column is a top-level scalar's own null.
    """
    return _walk(F.array(source), dtype, path.split("."))


def _walk(values: Column, dtype: T.DataType, steps: list[str]) -> Column:
    if isinstance(dtype, T.VariantType):
        for step in steps:
            values = F.flatten(F.transform(values, _stepper(step)))
        return F.filter(F.transform(values, scalar_text), lambda v: v.isNotNull())
    if not steps:
        if isinstance(dtype, T.StringType):
            return F.transform(values, lambda v: F.coalesce(v, F.lit("")))
        if isinstance(dtype, T.NumericType | T.NullType):
            return F.transform(values, lambda v: F.coalesce(v.cast("string"), F.lit("")))
        return F.array().cast("array<string>")
    step, rest = steps[0], steps[1:]
    if isinstance(dtype, T.MapType):
        if isinstance(dtype.valueType, T.VariantType):
            values = F.flatten(F.transform(values, lambda v: _children(F.try_element_at(v, F.lit(step)))))
            return _walk(values, dtype.valueType, rest)
        inner, get = dtype.valueType, lambda v: F.try_element_at(v, F.lit(step))
        has = lambda v: F.coalesce(F.map_contains_key(v, step), F.lit(False))
    elif isinstance(dtype, T.StructType) and step in dtype.names:
        inner, get, has = dtype[step].dataType, lambda v: v[step], lambda v: v.isNotNull()
    else:
        return F.array().cast("array<string>")
    values = F.filter(values, has)
    if isinstance(inner, T.ArrayType):
        listed = F.transform(values, lambda v: F.coalesce(get(v), F.array().cast(inner)))
        return _walk(F.flatten(listed), inner.elementType, rest)
    values = F.transform(values, get)
    if isinstance(inner, T.StructType | T.MapType):
        values = F.filter(values, lambda v: v.isNotNull())
    return _walk(values, inner, rest)


def _stepper(step: str):
    return lambda tree: let(child(tree, step), _children)


def _children(tree: Column) -> Column:
    none = F.array().cast("array<variant>")
    return F.coalesce(as_list(tree), F.when(tree.isNotNull(), F.array(tree)), none)
