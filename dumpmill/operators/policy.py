"""Applying a compiled policy to DataFrames: record skips, value filters and observation rules.

Everything becomes Column expressions, so one projection evaluates the whole policy. Sources are
either typed tables (paths go through the schema) or records in a column of map<string,variant>.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dumpmill.functions import values as V
from dumpmill.functions.canon import json_null
from dumpmill.functions.patterns import java_pattern
from dumpmill.functions.text import number_or_year, parse_number
from dumpmill.plans.policy import EntityPolicy, NullifyRange, RemoveMatching, Rule, Skip

VIOLATION = "array<struct<rule:string,severity:string,field:string,value:string>>"
ACTION = "array<struct<field:string,reason:string,removed_count:int,removed_values:array<string>>>"


def _source(df: DataFrame, record: str | None) -> tuple[Column, T.DataType]:
    if record:
        return F.col(record), df.schema[record].dataType
    return F.struct(*df.columns), df.schema


def skip_reason(df: DataFrame, skips: tuple[Skip, ...], record: str | None = None) -> Column:
    """struct(reason, field, value) of the first condition with a value that contains its text,
    whatever the case; null if the record stays."""
    source, dtype = _source(df, record)
    found = []
    for s in skips:
        hit = F.filter(V.resolve(source, dtype, s.field), _containing(s.contains.lower()))
        value = F.get(hit, F.lit(0))
        found.append(F.when(value.isNotNull(), F.struct(F.lit(s.reason).alias("reason"), F.lit(s.field).alias("field"), value.alias("value"))))
    return F.coalesce(*found) if found else F.lit(None).cast("struct<reason:string,field:string,value:string>")


def _containing(needle: str):
    return lambda v: F.contains(F.lower(v), F.lit(needle))


def split_skipped(df: DataFrame, skips: tuple[Skip, ...], record: str | None = None, name: str = "_skip") -> tuple[DataFrame, DataFrame]:
    """(records that stay, skipped records with the column ``name``)."""
    own = df.withColumn(name, skip_reason(df, skips, record))
    return own.where(F.col(name).isNull()).drop(name), own.where(F.col(name).isNotNull())


def broken(rule: Rule, values: Column) -> Column:
    """The values that violate a rule."""
    if rule.kind == "required":
        return F.when(F.size(values) == 0, F.array(F.lit(""))).otherwise(F.filter(values, lambda v: v == ""))
    if rule.kind == "regex":
        return F.filter(values, lambda v: v.rlike(java_pattern(rule.pattern)))
    if rule.kind == "enum":
        allowed = F.array(*map(F.lit, rule.values)).cast("array<string>")
        return F.filter(values, lambda v: ~v.isin(*rule.values) if rule.values else ~F.array_contains(allowed, v))
    measure = F.char_length if rule.kind == "length" else parse_number

    def outside(v: Column) -> Column:
        n = measure(v)
        tests = [n < F.lit(rule.low)] if rule.low is not None else []
        tests += [n > F.lit(rule.high)] if rule.high is not None else []
        return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False)) if tests else F.lit(False)

    return F.filter(values, outside)


def _violation(r: Rule):
    head = [F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"), F.lit(r.field).alias("field")]
    return lambda v: F.struct(*head, v.alias("value"))


def violations(df: DataFrame, rules: tuple[Rule, ...], record: str | None = None) -> Column:
    """All violations of a row, in rule order; rows themselves are never changed or dropped."""
    source, dtype = _source(df, record)
    parts = []
    for r in rules:
        parts.append(F.transform(broken(r, V.resolve(source, dtype, r.field)), _violation(r)))
    return F.concat(*parts).cast(VIOLATION) if parts else F.array().cast(VIOLATION)


def violations_long(df: DataFrame, *keep: str, name: str = "violations") -> DataFrame:
    """One row per violation with the columns ``keep``."""
    return df.select(*keep, F.explode(name).alias("_v")).select(*keep, "_v.*")


def _action(f: RemoveMatching | NullifyRange, removed: Column) -> Column:
    own = F.struct(F.lit(f.field).alias("field"), F.lit(f.reason).alias("reason"), F.size(removed).alias("removed_count"), removed.alias("removed_values"))
    return F.when(F.size(removed) > 0, F.array(own)).otherwise(F.array().cast(ACTION)).cast(ACTION)


def _out_of_range(f: NullifyRange, text: Column) -> Column:
    n = number_or_year(text)
    tests = [n < F.lit(f.below)] if f.below is not None else []
    tests += [n > F.lit(f.above)] if f.above is not None else []
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def apply_filters(df: DataFrame, policy: EntityPolicy, record: str | None = None, name: str = "actions") -> DataFrame:
    """``df`` with its filtered fields, in file order, and ``name``: what was removed and why."""
    out = df.withColumn(name, F.array().cast(ACTION))
    for f in policy.filters:
        if record:
            own = F.col(record)
            if isinstance(f, NullifyRange):
                value = F.try_element_at(own, F.lit(f.field))
                text = F.when(V.kind(value).isin("string", "number"), F.try_variant_get(value, "$", "string"))
                hit = _out_of_range(f, text)
                new = F.when(hit, F.map_concat(_without(own, f.field), F.create_map(F.lit(f.field), json_null()))).otherwise(own)
                removed = F.when(hit, F.array(text)).otherwise(F.array().cast("array<string>"))
            else:
                new, removed = _removed_in_map(own, f.field.split("."), java_pattern(f.pattern))
            out = out.withColumn("_removed", removed).withColumn(record, F.when(F.size("_removed") > 0, new).otherwise(own))
        else:
            top = f.field.split(".")[0]
            if top not in df.columns:
                continue
            if isinstance(f, NullifyRange):
                if f.field not in df.columns:
                    continue
                text = F.col(f.field).cast("string")
                hit = _out_of_range(f, text)
                removed = F.when(hit, F.array(text)).otherwise(F.array().cast("array<string>"))
                new = F.when(~hit, F.col(f.field))
            else:
                new, removed = _removed_in_column(F.col(top), df.schema[top].dataType, f.field.split(".")[1:], java_pattern(f.pattern))
            # a field that loses nothing is matched once only
            out = out.withColumn("_removed", removed).withColumn(top, F.when(F.size("_removed") > 0, new).otherwise(F.col(top)))
        out = out.withColumn(name, F.concat(name, _action(f, F.col("_removed")))).drop("_removed")
    return out


def _removed_in_column(own: Column, dtype: T.DataType, steps: list[str], pattern: str) -> tuple[Column, Column]:
    none = F.array().cast("array<string>")
    if steps:
        if not isinstance(dtype, T.StructType) or steps[0] not in dtype.names:
            return own, none
        inner, removed = _removed_in_column(own[steps[0]], dtype[steps[0]].dataType, steps[1:], pattern)
        return F.when(own.isNotNull(), own.withField(steps[0], inner)), F.coalesce(removed, none)
    if isinstance(dtype, T.ArrayType):
        hit = lambda v: F.coalesce(v.rlike(pattern), F.lit(False))
        return F.filter(own, lambda v: ~hit(v)), F.coalesce(F.filter(own, hit), none)
    hit = F.coalesce(own.rlike(pattern), F.lit(False))
    return F.when(~hit, own), F.when(hit, F.array(own)).otherwise(none)


def _without(own: Column, key: str) -> Column:
    return F.map_filter(own, lambda k, v: k != key)


def _removed_in_map(own: Column, steps: list[str], pattern: str) -> tuple[Column, Column]:
    """The record without matching strings in the list (or lone string) at a path of objects and list
    positions, and those strings. Lists on the way are not expanded."""
    none = F.array().cast("array<string>")
    step, rest = steps[0], steps[1:]
    value = F.try_element_at(own, F.lit(step))
    without = _without(own, step)
    put = lambda tree: F.map_concat(without, F.create_map(F.lit(step), tree))
    if rest:
        inner = V.as_object(value)
        new, removed = _removed_in_map(inner, rest, pattern)
        result, gone = put(F.to_variant_object(new).cast("variant")), F.coalesce(removed, none)
        if rest[0].isdigit() and len(rest) > 1:  # a position in a list
            items, at = V.as_list(value), int(rest[0])
            picked, picked_gone = _removed_in_map(V.as_object(F.get(items, F.lit(at))), rest[1:], pattern)
            listed = F.transform(items, lambda v, i: F.when(i == at, F.to_variant_object(picked).cast("variant")).otherwise(v))
            result = F.when(items.isNotNull(), put(F.to_variant_object(listed).cast("variant"))).otherwise(result)
            gone = F.when(items.isNotNull(), F.coalesce(picked_gone, none)).otherwise(gone)
        return result, gone
    items = V.as_list(value)
    hit = lambda v: F.coalesce(V.text_of(v).rlike(pattern), F.lit(False))
    lone = F.coalesce(V.text_of(value).rlike(pattern), F.lit(False))
    removed = F.when(items.isNotNull(), F.transform(F.filter(items, hit), V.text_of)).when(lone, F.array(V.text_of(value))).otherwise(none)
    new = F.when(items.isNotNull(), put(F.to_variant_object(F.filter(items, lambda v: ~hit(v))).cast("variant"))).when(lone, without).otherwise(own)
    return new, removed
