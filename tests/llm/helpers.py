"""Small tables with the odd cases that every operator must take, and brute-force versions."""
import random

from pyspark.sql import functions as F

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, copies int, row string, kept boolean, label int, h long, value string"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ".", ","]) for _ in range(n))


def texts(seed=1, n=60):
    """Prose, exact and near copies, repeated lines, junk, odd characters, empty and null."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        lines = [prose(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 5))]
        out.append("\n".join(lines))
    near = out[0].split(" ")
    near[len(near) // 2] = "changed"
    out += [out[0], out[0], " ".join(near), out[1].upper(), "# % | " * 30, "go " * 40, "é ü 日本   x́ '٠'", "a", "  \n\t ", "", None, None]
    out += ["token = \"" + "0123456789abcdef" * 3 + "\" here", prose(rng, 30) + "\nLicensed under the Apache License, Version 2.0.", "x" * 5000, prose(rng, 6000)]
    return out


def documents(spark, rows=None):
    """A table with extra columns whose names clash with what operators use inside."""
    values = texts() if rows is None else rows
    data = [(i if i != 3 else None, t, "en", None if i % 11 == 5 else f"s{i % 4 if i % 3 else 0}", len(t or ""), 7, 1, "r", True, 5, 9, "v") for i, t in enumerate(values)]
    return spark.createDataFrame(data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def same(a, b):
    key = lambda r: tuple(repr(x) for x in r)
    assert sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)


class Groups:
    """Union-find for brute force."""

    def __init__(self, n):
        self.up = list(range(n))

    def top(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)


def with_ids(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string")


__all__ = ["F", "Groups", "documents", "empty", "prose", "rows_of", "same", "texts", "with_ids"]
