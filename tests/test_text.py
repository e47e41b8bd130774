import pytest
from pyspark.sql import functions as F

from dumpmill.functions import text as X

CASES = {
    X.utrim: {" a ": "a", " x ": "x", "a\n": "a", "": "", None: None},
    X.trimmed: {"  ": None, " a": "a"},
    X.collapse_space: {" a \t b c ": "a b c"},
    X.digits_only: {"5 012-3": "50123", "x": ""},
    X.parse_number: {"5": 5.0, "5d": None, " 5 ": None, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "+2": 2.0, "nan": None, "-inf": float("-inf"), "Infinity": float("inf"), "1\n": None, "": None},
    X.leading_year: {"1969-09-26": 1969.0, "0400": 400.0, "Sep 1969": None, "1999T": 1999.0, "": None},
    X.number_or_year: {"1969": 1969.0, "1969-01": 1969.0, "NaN": None, "-5": -5.0, "x": None},
    X.leading_quantity: {"2 discs": 2, " 3": 3, "-4": 1, "0": 1, "x": 1, "+7": 7, "99999999999999999999": 1},
    X.digit_code: {" 17 ": "17", "1a": None, "": None},
    X.sanitize_filename: {"a/../b": "a_b", "é-1_.x": "é-1_.x", "a b": "ab", "किताब": "किताब", "e\u0301": "e", "日本 Ⅷ½²": "日本Ⅷ½²", "../../etc": "__etc", "ა·b\u200d": "აb"},
}


@pytest.mark.parametrize("function", CASES, ids=lambda f: f.__name__)
def test_values(spark, function):
    want = CASES[function]
    df = spark.createDataFrame([(k,) for k in want], "s string")
    got = {r[0]: r[1] for r in df.select("s", function(F.col("s"))).collect()}
    assert got == want


def test_whole_number_takes_unsigned_longs(spark):
    df = spark.createDataFrame([("18446744073709551615",), ("18446744073709551616",), ("0",), (" 7 ",), ("7.0",)], "s string")
    assert [None if r[0] is None else int(r[0]) for r in df.select(X.whole_number(F.col("s"))).collect()] == [2**64 - 1, None, None, 7, None]


def test_month_prefix(spark):
    got = spark.sql("select 1").select(X.month_prefix(F.lit("20240102")), X.month_prefix(F.lit("junk"))).head()
    assert got[0] == "202401" and len(got[1]) == 6
