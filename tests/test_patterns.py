"""The pattern language: hand-written answers, refusals when read, and random patterns against Python's own engine."""
import random
import re

import pytest
from pyspark.sql import functions as F

from dumpmill.functions.patterns import PatternError, java_pattern
from dumpmill.plans.policy import PolicyError, parse_policy

#: pattern: (texts that it matches, texts that it does not)
ANSWERS = {
    r"^a.b$": (["a\rb", "a\u2028b", "a\u0085b", "aéb"], ["a\nb", "ab", "a\rb\n"]),
    r"a$": (["a", "ba"], ["a\n", "a\r\n", "ab"]),
    r"^\d+$": (["12", "١٢"], ["12\n", "1a", ""]),
    r"(?m)^b$": (["a\nb", "b\nc", "b"], ["a\rb", "ab"]),
    r"(?m)^$": (["", "a\n", "a\n\nb"], ["a", "\ra"]),
    r"(?mR)^b$": (["a\r\nb", "a\rb\rc", "b\r\n"], ["ab"]),
    r"(?R)a.": (["ab"], ["a\r", "a\n"]),
    r"(?s)a.b": (["a\nb"], ["ab"]),
    r"(?s:a.)b.c": (["a\nbxc"], ["a\nb\nc"]),
    r"(?i)straße": (["STRAßE", "straße"], ["strasse"]),
    r"(?i:k)x": (["Kx", "\u212ax"], ["kX"]),
    r"a(?i)b": (["aB", "ab"], ["AB"]),
    r"(a(?i)b)c": (["aBc"], ["aBC"]),
    r"(?i)[a-c]+z": (["ABCZ"], ["dz"]),
    r"(?i)\p{Lu}": (["a", "A"], ["1"]),
    r"\p{Lu}": (["A", "É"], ["a", "é"]),
    r"[]$]": (["]", "$"], ["a", "["]),
    r"[^]a]": (["b"], ["]", "a", "]a"]),
    r"[]-a]": (["]", "-", "a"], ["b", "^", "_"]),
    r"[a-]": (["a", "-"], ["b"]),
    r"[-a]": (["a", "-"], ["b"]),
    r"[--a]": (["-", "a"], ["b"]),
    r"[a\]b]+c": (["]c"], ["xc"]),
    r"[$]\$": (["$$"], ["$"]),
    r"[a[bc]d]{2}x": (["bdx"], ["bex"]),
    r"[a-z&&[^aeiou]]": (["b"], ["a", "B"]),
    r"[a-z--[aeiou]]": (["b"], ["e"]),
    r"[a-c~~b-d]": (["a", "d"], ["b", "c"]),
    r"[^a-z&&b-d]": (["a", "x", "1"], ["b", "d"]),
    r"[\w&&\p{Greek}]": (["α"], ["a"]),
    r"[[:alpha:]]": (["a"], ["é", "1"]),
    r"[[:^digit:]x]": (["a", "x"], ["1"]),
    r"[[:punct:]]": (["[", "]", "`", "~", "/"], ["a", " "]),
    r"\bcat\b": (["a cat.", "cat"], ["cats", "écat", "cat_"]),
    r"\Bat": (["cat"], ["at", " at"]),
    r"\b{start}at": (["at", "x at"], ["cat"]),
    r"\<a\>": (["a", "b a c"], ["ab"]),
    r"(?-u:\b)a(?-u:\d)": (["a1", "éa1"], ["a١", "ba1"]),
    r"(?-u:\w)x": (["ax"], ["éx"]),
    r"\s": (["\u00a0", " ", "\u2003", "\x0b"], ["a", "\u200b"]),
    r"^\S+$": (["aé"], ["a\u00a0b"]),
    r"^\w+$": (["a_1é", "किताब", "a\u200db"], ["a-b", ""]),
    r"\W": (["-", " "], ["a", "é"]),
    r"a++b": (["aaab"], ["b"]),
    r"a**b": (["b", "aab"], ["a"]),
    r"^(a+)+$": (["aaa"], ["aaab", ""]),
    r"a{2}b": (["aab"], ["ab"]),
    r"^a{2,}?$": (["aa", "aaaa"], ["a"]),
    r"^a{1,2}$": (["a", "aa"], ["aaa"]),
    r"a}": (["a}"], ["a"]),
    r"(?P<n>a)b": (["ab"], ["b"]),
    r"(?<n>a)b": (["ab"], ["b"]),
    r"\x{41}\x42\u0043\u{44}\U00000045": (["ABCDE"], ["ABCD"]),
    r"\x{1F600}": (["\U0001F600"], ["x"]),
    r"\a|\f|\v|\t": (["\x07", "\x0c", "\x0b", "\t"], ["a", "\n"]),
    r"\-\#\&\~\/\@\'": (["-#&~/@'"], ["-#"]),
    r"a|": (["", "b"], []),
    r"": (["", "x"], []),
    r"()x(|y)z": (["xz", "xyz"], ["yz"]),
    r"(?x) a b # note" + "\n c [ d e ]": (["abcd", "abce"], ["a b c d", "abc "]),
    r"(?x) a\ b": (["a b"], ["ab"]),
    r"(?U)a+b": (["aab"], ["b"]),
    r"\Aab\z": (["ab"], ["ab\n", "xab"]),
    r"^*a": (["a", "ba"], ["b"]),
    r"\p{sc=Greek}|\p{gc:Sc}": (["β", "€"], ["b"]),
    r"^\PL$": (["1"], ["a"]),
    r"\p{gc!=Lu}": (["a"], ["A"]),
    r"\p{IsAlphabetic}|\p{white space}": (["a", " "], ["-"]),
    r"日本|[あ-ん]": (["日本", "い"], ["日"]),
    r"[^\n]": (["\r"], ["\n"]),
    r"\p{Any}": (["\n"], [""]),
}
REFUSED = [
    "(", ")", "a)", "[a", "[]", "[^]", "*a", "+", "?a", "a{,3}", "a{2,1}", "a{", "a{x}", "{2}", "(*a)", "a|*", r"\Z", r"\G", r"\1", r"\0", r"\k<n>", r"\Qa\E", r"\h", r"\e", r"\cA",
    "(?=a)", "(?!a)", "(?<=a)", "(?<!a)", "(?>a)", "(?#x)", "(?)", "(?-)", "(?i-)", "(?ii)", "(?z)", "(?P=n)", "(?<1>a)", "(?<n>a)(?<n>b)", r"\x{110000}", r"\x{D800}", r"\x4", r"\x{}", r"\xZZ",
    r"\p{Nope}", r"\p{sc=Nope}", r"\p", "[b-a]", r"[\d-z]", r"[a-\d]", "[[:nope:]]", "[a", "(?-u:.)", r"(?-u:\W)", "(?-u:[^a])", r"\é", "(" * 300 + ")" * 300, "\\", "[a\\"]


def test_answers(spark):
    rows = [(i, t, yes) for i, (good, bad) in enumerate(ANSWERS.values()) for yes, own in ((True, good), (False, bad)) for t in own]
    df = spark.createDataFrame(rows, "i int, t string, want boolean")
    hit = F.coalesce(*[F.when(F.col("i") == i, F.col("t").rlike(java_pattern(p))) for i, p in enumerate(ANSWERS)])
    wrong = [(list(ANSWERS)[r.i], java_pattern(list(ANSWERS)[r.i]), r.t, r.want) for r in df.withColumn("hit", hit).where("hit <> want").collect()]
    assert wrong == [] and len(ANSWERS) >= 60


@pytest.mark.parametrize("pattern", REFUSED)
def test_refusals(pattern):
    with pytest.raises(PatternError):
        java_pattern(pattern)


def test_random_patterns(spark):
    """Patterns that both languages read alike, over short texts."""
    rng = random.Random(1)

    def made(depth):
        kind = rng.randrange(9 if depth else 5)
        if kind < 3:
            return rng.choice(["a", "b", "c", ".", r"\d", r"\w", r"[ab]", r"[^a]", r"\n", r"\-"])
        if kind == 3:
            return rng.choice([r"\b", "^", "a", "[a-c]"])
        if kind == 4:
            return rng.choice(["[^\\n-c]", "[\\]x]", "é", "(?:)"])
        if kind == 5:
            return f"(?:{made(depth - 1)}|{made(depth - 1)})"
        if kind == 6:
            return f"(?:{made(depth - 1)})" + rng.choice(["*", "+", "?", "{2}", "{0,2}", "{1,}"]) + rng.choice(["", "?"])
        return made(depth - 1) + made(depth - 1)

    patterns = [rng.choice(["", "(?i)", "(?s)"]) + made(4) + rng.choice(["", r"\Z"]) for _ in range(250)]
    texts = ["".join(rng.choice("abcAB1-é\n ") for _ in range(rng.randint(0, 6))) for _ in range(60)] + [""]
    own = [p[:-2] + r"\z" if p.endswith(r"\Z") else p for p in patterns]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for at in range(0, len(own), 50):
        part = own[at : at + 50]
        for row in df.select("t", F.array(*[F.col("t").rlike(java_pattern(p)) for p in part])).collect():
            for k, hit in enumerate(row[1]):
                assert hit == bool(re.search(patterns[at + k], row[0])), (patterns[at + k], row[0])


def test_policies_name_what_they_refuse():
    rule = {"name": "odd-name", "field": "x", "severity": "info", "condition": {"type": "regex", "pattern": "a{,3}"}}
    with pytest.raises(PolicyError, match="odd-name.*count"):
        parse_policy({"rules": {"artists": [rule]}})
    with pytest.raises(PolicyError, match="filter of genres.genre"):
        parse_policy({"filters": {"artists": [{"field": "genres.genre", "remove_matching": "[", "reason": "r"}]}})
