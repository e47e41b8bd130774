"""The pattern language of policies, read into a tree and printed for ``rlike``.

It is a language of regular expressions without look-around and back references: Unicode classes, ``.`` for all but a line feed,
``^`` and ``$`` for the ends of the text (of lines, split at line feeds, under ``m``), nested classes with ``&&``, ``--`` and
``~~``, flags ``i m s x u U R``, named groups. Java reads some of this otherwise (``$`` before a final line break, ``.``
without other line ends, ``a++`` as possessive) or not at all, so every node is printed in explicit terms. As only
the presence of a match counts, groups lose their names and repeats their laziness.

What is no pattern of the language raises PatternError when it is read, with the place. Two bounds are ours: of scripts only those
in SCRIPTS are known, and Java looks for a match by backtracking, which nested repeats can make slow; repeats of repeats
such as ``(a+)+`` are joined to one for that reason.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


class PatternError(ValueError):
    pass


# Names of general categories, properties and scripts as Unicode spells them.
CATEGORIES = {
    "L": "Letter", "Lu": "Uppercase_Letter", "Ll": "Lowercase_Letter", "Lt": "Titlecase_Letter", "Lm": "Modifier_Letter", "Lo": "Other_Letter",
    "M": "Mark", "Mn": "Nonspacing_Mark", "Mc": "Spacing_Mark", "Me": "Enclosing_Mark", "N": "Number", "Nd": "Decimal_Number", "Nl": "Letter_Number", "No": "Other_Number",
    "P": "Punctuation", "Pc": "Connector_Punctuation", "Pd": "Dash_Punctuation", "Ps": "Open_Punctuation", "Pe": "Close_Punctuation", "Pi": "Initial_Punctuation",
    "Pf": "Final_Punctuation", "Po": "Other_Punctuation", "S": "Symbol", "Sm": "Math_Symbol", "Sc": "Currency_Symbol", "Sk": "Modifier_Symbol", "So": "Other_Symbol",
    "Z": "Separator", "Zs": "Space_Separator", "Zl": "Line_Separator", "Zp": "Paragraph_Separator", "C": "Other", "Cc": "Control", "Cf": "Format", "Co": "Private_Use", "Cn": "Unassigned"}
PROPERTIES = ("Alphabetic", "Lowercase", "Uppercase", "White_Space", "Ideographic", "Join_Control", "Emoji", "Emoji_Presentation", "Emoji_Modifier", "Emoji_Modifier_Base", "Extended_Pictographic")
SCRIPTS = (
    "Arabic", "Armenian", "Bengali", "Bopomofo", "Braille", "Canadian_Aboriginal", "Cherokee", "Common", "Coptic", "Cyrillic", "Devanagari", "Ethiopic", "Georgian", "Gothic", "Greek",
    "Gujarati", "Gurmukhi", "Han", "Hangul", "Hebrew", "Hiragana", "Inherited", "Kannada", "Katakana", "Khmer", "Lao", "Latin", "Malayalam", "Mongolian", "Myanmar", "Ogham", "Oriya",
    "Runic", "Sinhala", "Syriac", "Tamil", "Telugu", "Thaana", "Thai", "Tibetan", "Yi")
POSIX = {
    "alnum": "0-9A-Za-z", "alpha": "A-Za-z", "ascii": r"\x00-\x7F", "blank": r"\x09\x20", "cntrl": r"\x00-\x1F\x7F", "digit": "0-9", "graph": "!-~", "lower": "a-z", "print": " -~",
    "punct": r"!-/:-@\[-`{-~", "space": r"\x09-\x0D\x20", "upper": "A-Z", "word": "0-9A-Za-z_", "xdigit": "0-9A-Fa-f"}
CONTROLS = {"a": 7, "f": 12, "t": 9, "n": 10, "r": 13, "v": 11}
WORD, SPACE, DIGIT = r"[\p{IsAlphabetic}\p{M}\p{Nd}\p{Pc}\p{IsJoin_Control}]", r"\p{IsWhite_Space}", r"\p{Nd}"
ASCII = {"w": "[0-9A-Za-z_]", "s": r"[\x09-\x0D\x20]", "d": "[0-9]"}
#: Groups within groups at most.
DEPTH = 250


def _plain(name: str) -> str:
    return name.lower().replace("_", "").replace("-", "").replace(" ", "")


_BY_NAME = {_plain(x): rf"\p{{{short}}}" for short, long in CATEGORIES.items() for x in (short, long)}
_SCRIPT = {_plain(x): rf"\p{{Is{x}}}" for x in SCRIPTS}
_PROPERTY = {_plain(x): rf"\p{{Is{x}}}" for x in PROPERTIES} | {"any": r"[\x{0}-\x{10FFFF}]", "ascii": r"[\x{0}-\x{7F}]", "assigned": r"\P{Cn}"}


@dataclass(frozen=True)
class Flags:
    i: bool = False
    m: bool = False
    s: bool = False
    x: bool = False
    u: bool = True
    U: bool = False
    R: bool = False


@dataclass(frozen=True)
class Text:
    """Java for one character, class or assertion."""

    java: str


@dataclass(frozen=True)
class Repeat:
    of: object
    low: int
    high: int | None


@dataclass(frozen=True)
class Sequence:
    parts: tuple


@dataclass(frozen=True)
class Choice:
    parts: tuple


def printed(node) -> str:
    if isinstance(node, Text):
        return node.java
    if isinstance(node, Sequence):
        return "".join(f"(?:{printed(p)})" if isinstance(p, Choice) else printed(p) for p in node.parts)
    if isinstance(node, Choice):
        return "|".join(map(printed, node.parts))
    span = {(0, None): "*", (1, None): "+", (0, 1): "?"}.get((node.low, node.high)) or (f"{{{node.low}}}" if node.low == node.high else f"{{{node.low},{'' if node.high is None else node.high}}}")
    return f"(?:{printed(node.of)}){span}"


def literal(code: int) -> str:
    c = chr(code)
    return c if c.isascii() and c.isalnum() else rf"\x{{{code:X}}}"


def repeated(node, low: int, high: int | None):
    if isinstance(node, Repeat) and node.high is None and high is None and node.low < 2 and low < 2:
        return Repeat(node.of, node.low * low, None)
    return Repeat(node, low, high)


class Reader:
    def __init__(self, pattern: str):
        self.text, self.at, self.depth, self.names = pattern, 0, 0, set()

    def fail(self, why: str):
        raise PatternError(f"{why} at {self.at} of pattern {self.text!r}")

    def peek(self, s: str) -> bool:
        return self.text.startswith(s, self.at)

    def take(self, s: str) -> bool:
        if found := self.peek(s):
            self.at += len(s)
        return found

    def next(self) -> str:
        if self.at >= len(self.text):
            self.fail("the pattern ends too early")
        self.at += 1
        return self.text[self.at - 1]

    def until(self, end: str) -> str:
        stop = self.text.find(end, self.at)
        if stop < 0:
            self.fail(f"no {end!r}")
        out, self.at = self.text[self.at : stop], stop + len(end)
        return out

    def skip(self, flags: Flags) -> None:
        """White space and comments under x."""
        while flags.x and self.at < len(self.text):
            if self.text[self.at].isspace():
                self.at += 1
            elif self.peek("#"):
                end = self.text.find("\n", self.at)
                self.at = len(self.text) if end < 0 else end + 1
            else:
                return

    # --- groups and repeats

    def whole(self):
        out = self.choice(Flags())
        if self.at < len(self.text):
            self.fail("unopened group")
        return out

    def choice(self, flags: Flags):
        self.depth += 1
        if self.depth > DEPTH:
            self.fail("too many nested groups")
        ways, own = [], []
        while True:
            self.skip(flags)
            if self.at >= len(self.text) or self.peek(")"):
                break
            if self.take("|"):
                ways.append(Sequence(tuple(own)))
                own = []
            elif self.take("("):
                flags, node = self.group(flags)
                own += [node] if node is not None else []
            elif (c := self.text[self.at]) in "*+?{":
                self.at += 1
                low, high = self.counts(flags) if c == "{" else {"*": (0, None), "+": (1, None), "?": (0, 1)}[c]
                if not own or getattr(own[-1], "java", "") is None:
                    self.fail("nothing to repeat")
                self.take("?")  # lazy or not, there is a match or none
                own[-1] = repeated(own[-1], low, high)
            else:
                own.append(Text(self.atom(flags)))
        self.depth -= 1
        return Choice((*ways, Sequence(tuple(own)))) if ways else Sequence(tuple(own))

    def group(self, flags: Flags):
        """What follows an opening bracket: (flags from here on, node or None)."""
        inner = flags
        if self.take("?"):
            if self.peek("<=") or self.peek("<!") or self.peek("=") or self.peek("!") or self.peek(">"):
                self.fail("look-around and atomic groups are not part of the language")
            if self.take("P<") or self.take("<"):
                name = self.until(">")
                if not name or not (name[0].isalpha() or name[0] == "_") or not all(c.isalnum() or c in "_.[]" for c in name):
                    self.fail(f"{name!r} is no name of a group")
                if name in self.names:
                    self.fail(f"two groups are named {name!r}")
                self.names.add(name)
            else:
                inner = self.flags(flags)
                if self.text[self.at - 1] == ")":
                    return inner, None
        node = self.choice(inner)
        if not self.take(")"):
            self.fail("unclosed group")
        return flags, node if isinstance(node, Choice) else Sequence((node,)) if node.parts else Text("(?:)")

    def flags(self, flags: Flags) -> Flags:
        on, seen, last = True, set(), ""
        while (c := self.next()) not in ":)":
            if c == "-" and on:
                on = False
            elif c in "imsxuUR" and c not in seen:
                flags = replace(flags, **{c: on})
                seen.add(c)
            else:
                self.fail(f"{c!r} is no flag here")
            last = c
        if last == "-" or c == ")" and not seen:
            self.fail("no flags")
        return flags

    def counts(self, flags: Flags) -> tuple[int, int | None]:
        low, comma, high = "".join(self.until("}").split() if flags.x else [self.until("}")]).partition(",")
        low, high = low.strip(), high.strip()
        if not (low.isascii() and low.isdigit()) or high and not (high.isascii() and high.isdigit()):
            self.fail("a count needs numbers")
        top = int(low) if not comma else int(high) if high else None
        if top is not None and top < int(low) or max(int(low), top or 0) > 1_000_000:
            self.fail("a count out of range")
        return int(low), top

    # --- single characters

    def atom(self, flags: Flags) -> str:
        c = self.next()
        if c == ".":
            if not flags.u:
                self.fail("without u, '.' could match half a character")
            return r"[\x{0}-\x{10FFFF}]" if flags.s else r"[^\n\r]" if flags.R else r"[^\n]"
        if c == "^":
            return (r"(?:\A|(?<=\n)|(?<=\r)(?!\n))" if flags.R else r"(?:\A|(?<=\n))") if flags.m else r"\A"
        if c == "$":
            return (r"(?:\z|(?=\r)|(?<!\r)(?=\n))" if flags.R else r"(?=\n|\z)") if flags.m else r"\z"
        if c == "[":
            return self.cased(self.set(flags), flags)
        if c == "\\":
            code, java = self.escape(flags, False)
            return self.cased(literal(code), flags) if code is not None else java
        return self.cased(literal(ord(c)), flags)

    @staticmethod
    def cased(java: str, flags: Flags) -> str:
        return f"(?i{'u' if flags.u else ''}:{java})" if flags.i else java

    def escape(self, flags: Flags, inside: bool) -> tuple[int | None, str]:
        """(code point, "") of an escaped character, or (None, Java) of a class or assertion."""
        c = self.next()
        if c in "dswDSW":
            own = {"d": DIGIT, "s": SPACE, "w": WORD}[c.lower()] if flags.u else ASCII[c.lower()]
            if c.isupper() and not flags.u:
                self.fail("without u, a negated class could match half a character")
            return None, f"[^{own}]" if c.isupper() else own
        if c in "pP":
            return None, self.property(c == "P", flags)
        if c in "xuU":
            return self.code(c), ""
        if c in CONTROLS:
            return CONTROLS[c], ""
        if not inside and c in "AzbB<>":
            return None, self.assertion(c, flags)
        if c.isascii() and not c.isalnum() and c not in "<>":
            return ord(c), ""
        self.at -= 1
        self.fail(f"\\{c} is not part of the language")

    def code(self, kind: str) -> int:
        if self.take("{"):
            digits = self.until("}")
        else:
            size = {"x": 2, "u": 4, "U": 8}[kind]
            digits, self.at = self.text[self.at : self.at + size], self.at + size
            if len(digits) < size:
                self.fail("a code is too short")
        if not digits or not all(c in "0123456789abcdefABCDEF" for c in digits):
            self.fail(f"{digits!r} is no code")
        code = int(digits, 16)
        if code > 0x10FFFF or 0xD800 <= code < 0xE000:
            self.fail(f"{digits!r} is no character")
        return code

    def assertion(self, c: str, flags: Flags) -> str:
        w = WORD if flags.u else ASCII["w"]
        start, end = f"(?<!{w})(?={w})", f"(?<={w})(?!{w})"
        if c in "Az":
            return f"\\{c}"
        if c in "<>":
            return start if c == "<" else end
        if c == "B":
            return f"(?:(?<={w})(?={w})|(?<!{w})(?!{w}))"
        named = {"{start}": start, "{end}": end, "{start-half}": f"(?<!{w})", "{end-half}": f"(?!{w})"}
        for name, java in named.items():
            if self.take(name):
                return java
        return f"(?:{start}|{end})"

    def property(self, negated: bool, flags: Flags) -> str:
        name = self.until("}") if self.take("{") else self.next()
        key, value = "", name
        for mark in ("!=", "=", ":"):
            if mark in name:
                key, _, value = name.partition(mark)
                negated ^= mark == "!="
                break
        plain, key = _plain(value), _plain(key)
        known = {"": _PROPERTY | _SCRIPT | _BY_NAME, "gc": _BY_NAME, "generalcategory": _BY_NAME, "sc": _SCRIPT, "script": _SCRIPT}.get(key, {})
        own = known.get(plain) or known.get(plain.removeprefix("is"))
        if own is None:
            self.fail(f"unknown property {name!r}")
        if flags.i and own in (r"\p{Lu}", r"\p{Ll}", r"\p{Lt}", r"\p{IsUppercase}", r"\p{IsLowercase}"):
            own = r"[\p{Lu}\p{Ll}\p{Lt}\p{IsUppercase}\p{IsLowercase}]"
        return f"[^{own}]" if negated else own

    # --- classes

    def set(self, flags: Flags) -> str:
        """A class after its opening bracket, as a class of Java."""
        self.depth += 1
        if self.depth > DEPTH:
            self.fail("too many nested classes")
        negated = self.take("^")
        if negated and not flags.u:
            self.fail("without u, a negated class could match half a character")
        left, how, items = "", "", []
        self.skip(flags)
        while self.take("-"):
            items.append(literal(ord("-")))
        if not items and self.take("]"):
            items.append(literal(ord("]")))
        while True:
            self.skip(flags)
            if self.at >= len(self.text):
                self.fail("unclosed class")
            if self.take("]"):
                break
            if (mark := self.text[self.at : self.at + 2]) in ("&&", "--", "~~"):
                self.at += 2
                left, how, items = self.joined(left, how, items), mark, []
            elif self.take("[:"):
                items.append(self.posix())
            elif self.take("["):
                items.append(self.set(flags))
            else:
                items.append(self.item(flags))
        self.depth -= 1
        java = self.joined(left, how, items)
        return f"[^{java}]" if negated else java

    @staticmethod
    def joined(left: str, how: str, items: list[str]) -> str:
        right = f"[{''.join(items)}]" if items else r"[^\x{0}-\x{10FFFF}]"
        if not how:
            return right
        if how == "&&":
            return f"[{left}&&{right}]"
        if how == "--":
            return f"[{left}&&[^{right}]]"
        return f"[[{left}&&[^{right}]][{right}&&[^{left}]]]"

    def posix(self) -> str:
        negated, name = self.take("^"), self.until(":]")
        if name not in POSIX:
            self.fail(f"unknown class {name!r}")
        return f"[^{POSIX[name]}]" if negated else f"[{POSIX[name]}]"

    def item(self, flags: Flags) -> str:
        low, java = self.point(flags)
        self.skip(flags)
        if self.peek("-") and not self.peek("--") and not self.peek("-]"):
            self.at += 1
            self.skip(flags)
            if low is None:
                self.fail("a range begins with a class")
            high, _ = self.point(flags)
            if high is None or high < low:
                self.fail("a range out of order")
            return f"{literal(low)}-{literal(high)}"
        return literal(low) if low is not None else java

    def point(self, flags: Flags) -> tuple[int | None, str]:
        c = self.next()
        return self.escape(flags, True) if c == "\\" else (ord(c), "")


def java_pattern(pattern: str) -> str:
    """The pattern for ``rlike``; raises PatternError if it is none."""
    try:
        return printed(Reader(pattern).whole())
    except RecursionError as e:
        raise PatternError(f"too many nested groups in pattern {pattern[:60]!r}") from e
