"""String and number functions as Column expressions, with the edge cases of the policy language.

Spark's own casts, ``trim`` and ``$`` are laxer than these: see each function.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A number as the policy reads it: no surrounding space, no type suffix such as "5d".
NUMBER = r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
SPECIAL = r"(?i)\A[+-]?(?:inf|infinity|nan)\z"


def utrim(c: Column) -> Column:
    """Without Unicode white space at both ends (``trim`` only knows U+0020)."""
    return F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")


def trimmed(c: Column) -> Column:
    """``utrim``, null where nothing is left."""
    return F.nullif(utrim(c), F.lit(""))


def collapse_space(c: Column) -> Column:
    """Trimmed, with one space for each run of white space."""
    return F.regexp_replace(utrim(c), r"(?U)\s+", " ")


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def parse_number(c: Column) -> Column:
    """The double that all of the string spells, else null. Infinities parse; a not-a-number fails
    every comparison, so it is null here."""
    special = F.when(F.lower(c).endswith("nan"), F.lit(None)).when(c.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(c.rlike(NUMBER), c.try_cast("double")).when(c.rlike(SPECIAL), special)


def leading_year(c: Column) -> Column:
    """The number before the first of ``- / . space T``."""
    return parse_number(utrim(F.get(F.split(c, "[-/. T]", 2), F.lit(0))))


def number_or_year(c: Column) -> Column:
    return F.when(c.rlike(NUMBER) | c.rlike(SPECIAL), parse_number(c)).otherwise(leading_year(c))


def leading_quantity(c: Column) -> Column:
    """The whole number at the start, 1 where there is none, it is below 1 or it does not fit a long."""
    own = F.regexp_extract(F.regexp_replace(c, r"(?U)\A\s+", ""), r"\A([+-]?[0-9]+)", 1).try_cast("long")
    return F.when(own >= 1, own).otherwise(F.lit(1).cast("long"))


def whole_number(c: Column) -> Column:
    """A trimmed string of digits, at least 1, as decimal(20,0) (unsigned 64 bits), else null."""
    own = F.regexp_extract(utrim(c), r"\A\+?([0-9]+)\z", 1).try_cast("decimal(38,0)")
    return F.when((own >= 1) & (own <= F.lit(str((1 << 64) - 1)).cast("decimal(38,0)")), own.cast("decimal(20,0)"))


def digit_code(c: Column) -> Column:
    own = utrim(c)
    return F.when(own.rlike(r"\A[0-9]+\z"), own)


def sanitize_filename(c: Column) -> Column:
    """Letters (with the vowel signs that count as alphabetic), digits, ``-``, ``_`` and ``.`` only, then every ``..`` as ``_``."""
    return F.replace(F.regexp_replace(c, r"[^\p{IsAlphabetic}\p{N}._-]", ""), F.lit(".."), F.lit("_"))


def sorted_unique(c: Column) -> Column:
    return F.array_sort(F.array_distinct(c))


def month_prefix(version: Column) -> Column:
    """The first six characters of a version, the current month where they are not a year and month."""
    own = F.substring(version, 1, 6)
    return F.when(own.rlike(r"\A[0-9]{4}(?:0[1-9]|1[0-2])\z"), own).otherwise(F.date_format(F.current_timestamp(), "yyyyMM"))
