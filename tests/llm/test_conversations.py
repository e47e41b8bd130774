"""Conversation repair against plain dynamic programming over whole strings of edits."""
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from dumpmill.llm import conversations as c
from dumpmill.llm import queries
from tests.llm.helpers import rows_of

SCHEMA = "conv_id long, turn long, role string, text string, edge string, cost long"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def slow_damage(rows):
    """(conv, turn, role, text) after damage and all conversations."""
    out, known = [], set()
    for conv, turn, role, text in rows:
        known.add(conv)
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out, known


def slow_repair(rows):
    """Least (cost, letters, repaired rows) by keeping the least (cost, letters) of every node."""
    seen, own, counts = set(), [], [0, 0, 0]
    for role, text in rows:
        blank = not BLANK.search(text)
        again = not blank and (role, text) in seen
        seen.add((role, text))
        cut = not blank and not again and BLANK.findall(text)[-1] not in ".!?"
        for i, x in enumerate((blank, again, cut)):
            counts[i] += x
        own.append((role, text, blank or again, cut))
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}

    def inserts(nodes):
        for _ in range(4):
            for q, (cost, letters, made) in list(nodes.items()):
                for to in set(follows[q]) - {"s"}:
                    new = (cost + 3, letters + "I", [*made, (full[to], "")])
                    if to not in nodes or new[:2] < nodes[to][:2]:
                        nodes[to] = new
        return nodes

    nodes = inserts({"": (0, "", [])})
    for role, text, gone, cut in own:
        new = {}
        for q, (cost, letters, made) in nodes.items():
            ways = [(q, 4, "D", made)]
            if not gone:
                for to in follows[q]:
                    if role[:1] == to:
                        ways.append((to, 3 * cut, "K", [*made, (role, text)]))
                    if to != "s":
                        ways.append((to, 3 + 3 * cut, "R", [*made, (full[to], text)]))
            for to, more, letter, rest in ways:
                got = (cost + more, letters + letter, rest)
                if to not in new or got[:2] < new[to][:2]:
                    new[to] = got
        nodes = inserts(new)
    return min(nodes[q] for q in ("", "a") if q in nodes), counts


def slow_report(rows):
    after, known = slow_damage(rows)
    out = {}
    for conv in known:
        mine = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        (cost, letters, made), counts = slow_repair([r[2:] for r in mine])
        turns = {r[1] for r in mine} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        out[conv] = (gaps, *counts, illegal, cost, letters, hashlib.sha256("\n".join(f"{a}:{b}" for a, b in made).encode()).hexdigest())
    return out


def made_rows(seed, convs, longest):
    rng, out = random.Random(seed), []
    for conv in range(convs):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.4 else ("user", "assistant")[turn % 2]
            role = rng.choice(["system", "tool", "", " ", None, "User", "sage"]) if rng.random() < 0.15 else role
            text = rng.choice(["Yes.", "No!", "Why?", "so", "  ", "", None, "é。", f"Line {turn}.", f"line {turn}", "a.\n\t", "x\x0b"])
            out.append((conv if conv else None, rng.choice([turn, turn, turn, turn * 2, None]), role, text))
    return out


def got(df):
    return {r.conv_id: tuple(r[1:]) for r in df.collect()}


def repaired(spark, rows):
    df = spark.createDataFrame([(*r, "e", 5) for r in rows], SCHEMA)
    return c.repair(c.damaged(df), live=F.col("live"))


def test_codes_by_brute_force():
    rng = random.Random(3)
    kinds = {"x": ("user", "  "), "s": ("system", "{}."), "u": ("user", "{}."), "a": ("assistant", "{}."), "o": ("tool", "{}."), "S": ("system", "{}"), "U": ("user", "{}"), "A": ("assistant", "{}"), "O": ("", "{}")}
    for _ in range(1500):
        codes = "".join(rng.choice("xsuaoSUAOuaua") for _ in range(rng.randint(0, 9)))
        rows = [(kinds[k][0], kinds[k][1].format(i)) for i, k in enumerate(codes)]
        (cost, letters, made), _ = slow_repair(rows)
        assert c.solved(codes) == (cost, letters), codes
        roles, texts = [r for r, _ in rows], [t for _, t in rows]
        own = list(c.rebuilt(letters, roles, texts, 0, len(made) % 2 == 1))
        assert [(r, t) for _, _, r, t in own] == made and [x[0] for x in own] == list(range(len(made)))


@pytest.mark.parametrize("most", [8192, 3, 1])
def test_tables_by_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(c, "MOST", most)  # blocks of a few rows: every conversation is put together from parts
    rows = made_rows(7, 60, 9)
    assert got(c.report(repaired(spark, rows))) == slow_report(rows)


def test_one_large_conversation(spark, monkeypatch):
    monkeypatch.setattr(c, "MOST", 64)
    rng = random.Random(5)
    rows = [(1, i, rng.choice(["user", "assistant"]), rng.choice([f"Line {i}.", "Same to all.", f"cut {i}"])) for i in range(3000)] + [(2, 0, "user", "Hi.")]
    assert got(c.report(repaired(spark, rows))) == slow_report(rows)


def test_rows_that_are_equal(spark):
    rows = [(1, 1, "user", "Hi.")] * 40 + [(None, None, None, None)] * 5 + [(2, 3, "system", "x" * 200_000 + ".")]
    assert got(c.report(repaired(spark, rows))) == slow_report(rows)


def test_messages(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 2, "user", "Hi."), (1, 2, "user", "Hi."), (1, 9, "assistant", "Hello"), (2, 1, "assistant", "Yes.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    own = sorted(map(tuple, c.messages(c.repair(df)).collect()))
    assert own[:3] == [(1, 0, "K", "system", "Be kind."), (1, 1, "K", "user", "Hi."), (1, 2, "K", "assistant", "Hello")]
    assert own[3:] == [(2, 0, "I", "user", ""), (2, 1, "K", "assistant", "Yes.")]


def test_no_rows(spark):
    assert rows_of(c.report(repaired(spark, []))) == []
    gone = next((i, 0) for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert got(c.report(repaired(spark, [(*gone, "user", "Hi.")]))) == {gone[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = queries.QUERIES["op12_conversation_repair"](spark, sf_dir)
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got(df) == slow_report(rows)
