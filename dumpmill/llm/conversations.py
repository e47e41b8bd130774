"""Repair of conversation structure by a bidirectional tight-arc DAG (operator 12).

The initials of the roles of a repaired conversation read ``(s?(ua)+)?``. Rows are kept (cost 0), given the role user or
assistant (3), deleted (4; blank and repeated rows must be), and empty user or assistant rows are inserted anywhere (3);
a truncated row that stays costs 3 more. Nodes of the graph are (rows done, state of the pattern). The minimum cost from
the start to a node and from it to the end tell whether an arc lies on a cheapest repair. A traversal carries
the set of nodes that a string of edits reaches over such arcs and takes the least letter that any of them has, which
gives the cheapest repair whose string of edits (D, I, K, R) is least. The letters decide the roles as well, as the
pattern leaves one role for each place and length.

Rows are dealt to tasks by ranges of (conversation, turn, ...) and sorted, so a conversation of any size is spread over
tasks, and cut into blocks of at most ``MOST`` rows. A conversation within one block is solved there. Of others each
block gives its 4 x 4 matrix of minimum costs, then, with costs from both ends known, where each set of nodes leads;
only these few numbers of each block, one row per ``MOST`` rows of a conversation, meet in a task. Rows that repeat an
earlier one are found by a minimum per role and text (128 bits of hash), after each block has left its own repeats out.
SHA-256 of a repaired conversation is a chain over its bytes: those of one conversation pass one task as a stream.

Order: by turn (nulls first); rows that share a turn go by role, the first ``PREFIX`` characters of the text and a hash
of it. Nulls: a null role or text is one space; a null turn takes no part in gaps; rows without a conversation are one
conversation. Roles count by their first character, so a role of another initial, or an empty one, is never kept as it
is. Repeated rows are duplicates. An empty table gives no rows, texts of any length are kept whole, and only the four
columns named are read, so that other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch, written

#: Rows and bytes of text of a block at most (a longer row is a block of its own); characters that order rows of a turn.
MOST, BYTES, PREFIX = 8192, 1 << 23, 64
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
FAR = 1 << 60
#: States of the pattern: nothing yet, after s, after u, after a. A repair may end in the first and the last.
STATES, ENDS = range(4), (0, 3)
KEEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The state after a row that takes the role which comes next; the role s is only ever kept.
NEXT = (2, 2, 3, 2)


def step(vector: tuple[int, ...]) -> tuple[int, ...]:
    """Costs of states after any insertions. Two in a row lead back to a state of the same kind."""
    own = list(vector)
    for _ in STATES:
        for q in STATES:
            own[NEXT[q]] = min(own[NEXT[q]], own[q] + INSERT)
    return tuple(own)


def arcs(q: int, code: str):
    """(letter, state after, cost) of the ways to take a row in state q. ``code`` is the initial of its role, in upper
    case if it is truncated, or x if it has to go, o for other initials."""
    yield "D", q, DELETE
    if code != "x":
        more, initial = (CUT_OFF if code.isupper() else 0), code.lower()
        if initial in KEEPS[q]:
            yield "K", KEEPS[q][initial], more
        yield "R", NEXT[q], REROLE + more


@lru_cache(maxsize=1 << 16)
def forward(vector: tuple[int, ...], code: str) -> tuple[tuple[int, ...], int]:
    """Costs up to and with a row, the least of them apart."""
    out, before = [FAR] * 4, step(vector)
    for q in STATES:
        for _, to, cost in arcs(q, code):
            out[to] = min(out[to], before[q] + cost)
    return levelled(out)


@lru_cache(maxsize=1 << 16)
def backward(vector: tuple[int, ...], code: str) -> tuple[tuple[int, ...], int]:
    """Costs from before a row to the end, given those from after it."""
    own = [min(vector[to] + cost for _, to, cost in arcs(q, code)) for q in STATES]
    return levelled(inserted(own))


def inserted(own) -> list[int]:
    """Costs to the end where rows may be inserted first."""
    own = list(own)
    for _ in STATES:
        for q in STATES:
            own[q] = min(own[q], own[NEXT[q]] + INSERT)
    return own


def levelled(vector) -> tuple[tuple[int, ...], int]:
    """A vector with its least cost taken off, and that cost; what cannot be reached stays FAR."""
    low = min(vector)
    return tuple(min(x - low, FAR) if x < FAR // 2 else FAR for x in vector), low


#: Costs from each state to the end when no row is left.
LAST = tuple(inserted([0 if q in ENDS else FAR for q in STATES]))
START = (0, FAR, FAR, FAR)


@lru_cache(maxsize=1 << 18)
def moves(reached: frozenset, code: str, fore: tuple[int, ...], back: tuple[int, ...], after: tuple[int, ...], gain: int) -> tuple[str, frozenset]:
    """Letters, and the states then, of the least cheapest way from ``reached`` over insertions and one row.

    ``fore`` has costs from the start to before the row, ``back`` and ``after`` costs to the end from before and after it, all
    levelled; ``gain`` is what was taken off ``back`` beyond ``after``. An arc is tight if costs to it, of it and
    from it add up to the least cost of all."""
    fore = step(fore)
    least_cost = min(x + y for x, y in zip(fore, back, strict=True))
    letters = ""
    while True:
        tight = [(letter, to) for q in reached for letter, to, cost in arcs(q, code) if fore[q] + cost + after[to] == least_cost + gain]
        tight += [("I", NEXT[q]) for q in reached if fore[q] + INSERT + back[NEXT[q]] == least_cost]
        letter = min(tight)[0]
        letters, reached = letters + letter, frozenset(to for x, to in tight if x == letter)
        if letter != "I":
            return letters, reached


def ending(reached: frozenset) -> str:
    """The insertions after the last row."""
    letters = ""
    while not any(LAST[q] == 0 for q in reached):
        reached, letters = frozenset(NEXT[q] for q in reached if LAST[q] == INSERT + LAST[NEXT[q]]), letters + "I"
    return letters


def backs(codes: str, last: tuple[int, ...] = LAST) -> tuple[list, list, int]:
    """Levelled costs to the end before each row and after the last, what each took off, and the sum of that."""
    vector, low = levelled(last)
    vectors, gains, total = [vector], [], low
    for code in reversed(codes):
        vector, low = backward(vector, code)
        vectors.append(vector)
        gains.append(low)
        total += low
    return vectors[::-1], gains[::-1], total


def walked(codes: str, reached: frozenset, first: tuple[int, ...], vectors: list, gains: list) -> tuple[list[str], frozenset]:
    """The letters at each row and the states after the last; ``first`` are costs from the start to the first row."""
    out, fore = [], levelled(first)[0]
    for i, code in enumerate(codes):
        letters, reached = moves(reached, code, fore, vectors[i], vectors[i + 1], gains[i])
        fore = forward(fore, code)[0]
        out.append(letters)
    return out, reached


def costs(codes: str) -> list[list[int]]:
    """The matrix of a block: the minimum cost from each state before its rows to each state after them."""
    out = []
    for q in STATES:
        vector, total = tuple(0 if p == q else FAR for p in STATES), 0
        for code in codes:
            vector, low = forward(vector, code)
            total += low
        out.append([x + total if x < FAR else FAR for x in vector])
    return out


def solved(codes: str) -> tuple[int, str]:
    """Cost and letters of a whole conversation."""
    vectors, gains, total = backs(codes)
    letters, reached = walked(codes, frozenset([0]), START, vectors, gains)
    return total + vectors[0][0], "".join(letters) + ending(reached)


def rebuilt(letters, roles, texts, place: int, odd: bool):
    """(place, edit, role, text) of the repaired rows from ``place`` on. ``odd``: whether the repaired conversation has an
    odd number of rows, and so begins with s."""
    i = 0
    for letter in letters:
        if letter in "DKR":
            i += 1
        if letter == "D":
            continue
        yield place, letter, roles[i - 1] if letter == "K" else ("user", "assistant")[(place + odd) % 2], "" if letter == "I" else texts[i - 1]
        place += 1


# --- blocks of rows -----------------------------------------------------------------------------------------------

_BLOCK = ("conv {kind}, part int, block int, edge boolean, codes string, roles array<string>, texts array<string>, keys array<binary>, "
          "first_turn long, last_turn long, turns long, blank long, duplicate long, truncated long, illegal long, first_role string, last_role string")
SPACE = "\t\n\x0b\x0c\r "


def prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str, live: Column | None) -> DataFrame:
    """(conv, turn, role, text, code, key, live), nulls replaced. A row that is not ``live`` lends its conversation only."""
    own = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"), (F.lit(True) if live is None else live).alias("live"))
    own = own.withColumns({c: F.when(F.col("live"), F.col(c)).otherwise("") for c in ("role", "text")})
    initial = F.substring("role", 1, 1)
    code = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    end = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    code = F.when(end == "", "x").when(end.isin(".", "!", "?"), code).otherwise(F.upper(code))
    key = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    return own.withColumn("code", code).withColumn("key", key)


def blocks(rows: DataFrame) -> DataFrame:
    """One row per block of ``prepared`` rows, in order of (part, block). ``edge``: the conversation may have
    other blocks. Rows that repeat one of their block have the code x; ``keys`` has the 128 bits of the others' role and text, null
    for rows that go, where there may be other blocks."""
    kind = rows.schema["conv"].dataType.simpleString()
    order = ["conv", "turn", "role", F.substring("text", 1, PREFIX), "key", "row_number"]
    own = rows.withColumn("row_number", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    own = own.select("conv", "turn", "role", "text", "code", "key", "live", F.spark_partition_id().alias("part"))

    def run(batches):
        now, n, edge = None, 0, True  # the block at hand, its number, whether it is the first or a later one of its conversation here

        for batch in batches:
            for conv, turn, role, text, code, key, live, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and (conv != now.conv or now.full()):
                    split = conv == now.conv
                    yield now.row(n, edge or split)
                    n, edge, now = n + 1, split, None
                if now is None:
                    now = _Rows(conv, part)
                if live:
                    now.add(turn, role, text, code, key)
        if now is not None:
            yield now.row(n, True)

    def batched(batches):
        held, size = [], 0
        for row in run(batches):
            held.append(row)
            size += row["size"]
            if size > BYTES or len(held) >= 4096:
                yield _batch(held, schema)
                held, size = [], 0
        if held:
            yield _batch(held, schema)

    schema = rows.sparkSession.createDataFrame([], _BLOCK.format(kind=kind)).schema
    return own.mapInArrow(batched, schema)


class _Rows:
    """A block while it grows."""

    def __init__(self, conv, part):
        self.conv, self.part, self.size, self.seen = conv, part, 0, set()
        self.codes, self.roles, self.texts, self.keys, self.turns = [], [], [], [], []
        self.blank = self.duplicate = self.illegal = 0

    def full(self) -> bool:
        return len(self.codes) >= MOST or self.size >= BYTES

    def add(self, turn, role, text, code, key) -> None:
        self.illegal += bool(self.roles) and self.roles[-1][:1] + role[:1] not in ("su", "ua", "au")
        self.blank += code == "x"
        if code == "x":
            key = None
        elif key in self.seen:
            self.duplicate, code, key = self.duplicate + 1, "x", None
        else:
            self.seen.add(key)
        self.size += len(text) + 64
        for own, x in zip((self.codes, self.roles, self.texts, self.keys), (code, role, text, key), strict=True):
            own.append(x)
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)

    def row(self, block: int, edge: bool) -> dict:
        return {
            "conv": self.conv, "part": self.part, "block": block, "edge": edge, "codes": "".join(self.codes), "roles": self.roles, "texts": self.texts,
            "keys": self.keys if edge else [], "first_turn": min(self.turns, default=None), "last_turn": max(self.turns, default=None), "turns": len(self.turns),
            "blank": self.blank, "duplicate": self.duplicate, "truncated": sum(c.isupper() for c in self.codes), "illegal": self.illegal,
            "first_role": self.roles[0][:1] if self.roles else None, "last_role": self.roles[-1][:1] if self.roles else None, "size": self.size}


def _batch(rows: list[dict], schema) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.RecordBatch.from_pylist([{k: v for k, v in r.items() if k != "size"} for r in rows], to_arrow_schema(schema))


# --- conversations of several blocks ------------------------------------------------------------------------------

_AT = ["part", "block"]


def _of_block(own: DataFrame, more: DataFrame, how: str = "inner") -> DataFrame:
    """Blocks with what ``more``, a row per block, has of them."""
    more = more.withColumnsRenamed({c: f"_{c}" for c in _AT})
    return own.join(more, (F.col("part") == F.col("_part")) & (F.col("block") == F.col("_block")), how).drop("_part", "_block")


def without_repeats(own: DataFrame) -> DataFrame:
    """Blocks whose rows that repeat a row of an earlier block have the code x. Each block gives each of its keys once, so
    a text that all blocks share makes a row per block."""
    keys = own.select("conv", *_AT, F.posexplode("keys").alias("at", "key")).where("key is not null")
    first = keys.groupBy("conv", "key").agg(F.min(F.struct(*_AT)).alias("first")).withColumnsRenamed({"conv": "_c", "key": "_k"})
    again = keys.join(first, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("key") == F.col("_k"))).where(F.struct(*_AT) > F.col("first"))
    again = again.groupBy(*_AT).agg(F.collect_list("at").alias("again"))  # at most MOST places of a block

    @F.udf("struct<codes: string, repeats: long, cut_off: long>", useArrow=True)
    def recoded(codes, again):
        own = list(codes)
        for at in again if again is not None else ():
            own[at] = "x"
        return "".join(own), codes.count("x") - own.count("x"), sum(c.isupper() for c in own)

    out = _of_block(own.drop("keys"), again, "left").withColumn("x", recoded("codes", "again"))
    return out.withColumns({"codes": F.col("x.codes"), "duplicate": F.col("duplicate") - F.col("x.repeats"), "truncated": F.col("x.cut_off")}).drop("x", "again")


def _scanned(small: DataFrame, run, made: str) -> DataFrame:
    """``run`` over the rows of a conversation's blocks in order, a dict for each in and out; columns ``made`` are new."""
    import pandas as pd

    def of(pdf):
        pdf = pdf.sort_values(_AT)
        return pd.DataFrame([{"part": p, "block": b} | x for p, b, x in zip(pdf["part"], pdf["block"], run(pdf.to_dict("records")), strict=True)])

    return small.groupBy("conv").applyInPandas(of, f"part int, block int, {made}")


def ends(rows: list[dict]) -> list[dict]:
    """Levelled costs from the start to each block and from behind it to the end, and the cost of the whole at every one."""
    out, last, first = [], LAST, START
    for r in reversed(rows):
        out.append({"last": list(levelled(last)[0])})
        last = tuple(min(FAR, *(int(x) + y for x, y in zip(m, last, strict=True))) for m in r["matrix"])
    out = [x | {"cost": inserted(last)[0]} for x in reversed(out)]
    for x, r in zip(out, rows, strict=True):
        x["first"] = list(levelled(first)[0])
        first = tuple(min(FAR, *(first[q] + int(r["matrix"][q][p]) for q in STATES)) for p in STATES)
    return out


def entries(rows: list[dict]) -> list[dict]:
    """The states in which each block begins, the place of its first repaired row, the parity of all, insertions at the end."""
    reached, place, out = frozenset([0]), 0, []
    for r in rows:
        key = sum(1 << q for q in reached)
        out.append({"reached": key, "place": place, "closing": ""})
        reached, place = _states(r["leads"][key]), place + int(r["grows"][key])
    out[-1]["closing"] = ending(reached)
    return [x | {"odd": (place + len(out[-1]["closing"])) % 2} for x in out]


def _states(key: int) -> frozenset:
    return frozenset(q for q in STATES if key >> q & 1)


def long_ones(own: DataFrame) -> DataFrame:
    """``edge`` blocks with letters, cost (of the whole), place and odd."""
    own = written(without_repeats(own), "edges")

    @F.udf("array<array<long>>", useArrow=True)
    def matrix(codes):
        return costs(codes)

    sides = written(_scanned(own.select("conv", *_AT, matrix("codes").alias("matrix")), ends, "first array<long>, last array<long>, cost long"), "ends")
    own = _of_block(own, sides)

    @F.udf("struct<leads: array<int>, grows: array<long>>", useArrow=True)
    def leads(codes, first, last):
        vectors, gains, _ = backs(codes, tuple(last))
        fore = step(tuple(first))
        least = min(x + y for x, y in zip(fore, vectors[0], strict=True))
        leads, grows = [0] * 16, [0] * 16
        for key in range(1, 16):
            if all(fore[q] + vectors[0][q] == least for q in _states(key)):  # nodes of cheapest repairs
                letters, to = walked(codes, _states(key), tuple(first), vectors, gains)
                leads[key], grows[key] = sum(1 << q for q in to), sum(len(x) - x.count("D") for x in letters)
        return leads, grows

    begin = _scanned(own.select("conv", *_AT, leads("codes", "first", "last").alias("x")).select("conv", *_AT, "x.*"), entries, "reached int, place long, closing string, odd int")

    @F.udf("string", useArrow=True)
    def letters(codes, first, last, reached, closing):
        vectors, gains, _ = backs(codes, tuple(last))
        return "".join(walked(codes, _states(reached), tuple(first), vectors, gains)[0]) + closing

    return _of_block(own, written(begin, "begins")).withColumn("letters", letters("codes", "first", "last", "reached", "closing"))


# --- results ------------------------------------------------------------------------------------------------------

_RESULT = ["conv", "part", "block", "edge", "roles", "texts", "letters", "cost", "place", "odd", "first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal", "first_role", "last_role"]


def short_ones(own: DataFrame) -> DataFrame:
    """Blocks that are whole conversations with letters, cost, place and odd."""

    @F.udf("struct<cost: long, letters: string, place: long, odd: int>", useArrow=True)
    def solve(codes):
        cost, letters = solved(codes)
        return cost, letters, 0, (len(letters) - letters.count("D")) % 2

    return own.withColumn("x", solve("codes")).select(*own.columns, "x.*")


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", live: Column | None = None) -> DataFrame:
    """Solved blocks of the conversations (written), for ``report`` and ``messages``. Rows that are not ``live`` take no
    part, but a conversation of such rows alone is reported."""
    with scratch() as made:
        own = written(blocks(prepared(rows, conv, turn, role, text, live)), "blocks")
        done = short_ones(own.where("not edge")).select(*_RESULT).unionByName(long_ones(own.where("edge")).select(*_RESULT))
        return made.kept(written(done, "solved"))


def messages(done: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, place, edit, role, text): the repaired conversations, a row each, places from 0."""

    @F.udf("array<struct<place: long, edit: string, role: string, text: string>>", useArrow=True)
    def rows(letters, roles, texts, place, odd):
        return list(rebuilt(letters, roles, texts, place, odd))

    own = done.select("conv", F.explode(rows("letters", "roles", "texts", "place", "odd")).alias("x"))
    return own.select(F.col("conv").alias(conv), "x.*")


def report(done: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256.

    Whole conversations are taken where they are; blocks of others come to one task in order, and one at a time."""
    kind = done.schema["conv"].dataType.simpleString()
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    schema = done.sparkSession.createDataFrame([], f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string").schema

    def run(batches):
        now = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if now is not None and row["conv"] != now.conv:
                    out.append(now.result())
                    now = None
                now = now or _Sum(row["conv"])
                now.add(row)
            if out:
                yield _batch([dict(zip(names, r, strict=True)) for r in out], schema)
        if now is not None:
            yield _batch([dict(zip(names, now.result(), strict=True))], schema)

    parts = done.where("edge").repartition("conv").sortWithinPartitions("conv", *_AT).select(*done.columns)
    return done.where("not edge").mapInArrow(run, schema).unionByName(parts.mapInArrow(run, schema)).withColumnRenamed("conv", conv)


class _Sum:
    """What is reported of a conversation, block after block."""

    def __init__(self, conv):
        self.conv, self.hash, self.audit, self.rows = conv, hashlib.sha256(), [], 0
        self.sums, self.cost, self.turns, self.first, self.last, self.role = [0, 0, 0, 0], 0, 0, None, None, None

    def add(self, row: dict) -> None:
        self.sums = [x + row[k] for x, k in zip(self.sums, ("blank", "duplicate", "truncated", "illegal"), strict=True)]
        if row["first_role"] is not None:
            self.sums[3] += self.role is not None and self.role + row["first_role"] not in ("su", "ua", "au")
            self.role = row["last_role"]
        if row["turns"]:
            self.turns += row["turns"] - (self.last == row["first_turn"])
            self.first = row["first_turn"] if self.first is None else self.first
            self.last = row["last_turn"]
        self.cost = row["cost"]
        self.audit.append(row["letters"])
        for _, _, role, text in rebuilt(row["letters"], row["roles"], row["texts"], row["place"], row["odd"]):
            self.hash.update((b"\n" if self.rows else b"") + f"{role}:{text}".encode())
            self.rows += 1

    def result(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.sums, self.cost, "".join(self.audit), self.hash.hexdigest())


# --- the damage of the registered query ---------------------------------------------------------------------------


def damaged(convs: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, live) of ``conversations`` with known faults: by crc32(conv_id:turn) % 20 a row is
    dropped (not live), emptied, robbed of its sentence ends, repeated or given to the user. Nulls are one space there."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    own = convs.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("fault") == 3, 2).otherwise(1)
    own = own.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                     (F.col("fault") != 0).alias("live"), F.explode(F.array_repeat(F.lit(1), times)).alias("time"))
    return own.drop("time")
