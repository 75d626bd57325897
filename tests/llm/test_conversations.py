"""Repairs against all ways to edit short conversations, and long ones in pieces against one search."""

import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from ripplelog.llm import conversations as conv
from ripplelog.llm.conversations import ASSISTANT, BLANK, CUT, DUPLICATE, FINE, START, Ways, damaged, repair_conversations, repair_damaged, search

TYPE = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()
CHARACTER = re.compile(r"[^\x20\x09-\x0D]")


def conversations(n=150):
    """Turns with gaps, nulls, repeats, blank and cut texts, odd roles, and one conversation that is a long one."""
    rng, rows = random.Random(9), []
    texts = ["Hello there.", "No end", "Why?", " \t\n", "", "Ja!\n", "Größe. ", None, "one:two.", "日本。"]
    for c in range(n):
        turn = rng.randrange(3)
        for _ in range(rng.randrange(1, 7)):
            rows.append((c, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "", "tool", None]), rng.choice(texts)))
            turn += rng.choice([1, 1, 1, 2, 5])
    rows += [(500, None, "user", "Where?"), (500, 3, "assistant", "There."), (None, 1, "user", "Who?"), (None, 2, "assistant", "I."), (501, None, None, None)]
    return rows + [(502, i, "user" if i % 7 else "system", f"{i % 400}." if i % 5 else f"{i}") for i in range(1000)]


def damage(rows):
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        part = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if part:
            text = "" if part == 1 else re.sub("[.!?]", "", text) if part == 2 else text
            yield from [(c, t, "user" if part == 4 else role, text)] * (2 if part == 3 else 1)


def faults(turns):
    seen = set()
    for role, text in turns:
        chars = CHARACTER.findall(text)
        yield BLANK if not chars else DUPLICATE if (role, text) in seen else CUT if chars[-1] not in ".!?" else FINE
        seen.add((role, text))


def outcome(audit, turns, flags):
    """Cost and turns that the edits lead to, or None if they are not allowed. Written turn by turn, without states."""
    made, cost, left = [], 0, list(zip(turns, flags, strict=True))
    for edit in audit:
        follows = "assistant" if made and made[-1][0][:1] == "u" else "user"
        if edit == "I":
            made.append((follows, ""))
            cost += 2
            continue
        if not left:
            return None
        (role, text), flag = left.pop(0)
        if edit == "D":
            cost += 3
        elif flag in (BLANK, DUPLICATE):
            return None
        else:
            made.append((role if edit == "K" else follows, text))
            cost += (flag == CUT) + (0 if edit == "K" else 2)
    initials = "".join(r[:1] or "-" for r, _ in made)
    return (cost, made) if not left and re.fullmatch("(s?(ua)+)?", initials) else None


def brute(turns):
    """The best of all edits with up to three turns inserted; no way with more is cheaper for the rows tried."""
    flags, best = list(faults(turns)), None
    for n in range(4):
        for letters in itertools.product("DKR", repeat=len(turns)):
            for at in itertools.combinations_with_replacement(range(len(turns) + 1), n):
                audit = "".join("I" * at.count(i) + (letters[i] if i < len(turns) else "") for i in range(len(turns) + 1))
                if (found := outcome(audit, turns, flags)) and (best is None or (found[0], audit) < best[:2]):
                    best = (found[0], audit, found[1])
    return best


def test_short_conversations_against_all_ways():
    rng = random.Random(1)
    for _ in range(120):
        turns = [(rng.choice(["user", "assistant", "system", "tool", "umpire", ""]), rng.choice(["a.", "b", "c!", " ", "d."])) for _ in range(rng.randrange(0, 5))]
        rows = [(r[:1], f) for (r, _), f in zip(turns, faults(turns), strict=True)]
        assert Ways().end(rows) == brute(turns)[:2], turns


def test_pieces_make_the_same_way():
    rng = random.Random(2)
    for n in (0, 1, 5, 40, 300):
        for size in (1, 2, 7, 64):
            rows = [(rng.choice("uuaas-"), rng.choice([FINE, FINE, FINE, BLANK, DUPLICATE, CUT])) for _ in range(n)]
            ways = Ways()
            cuts = range(0, n, size)
            for i in cuts[:-1]:
                ways.add(rows[i : i + size])
            assert ways.end(rows[cuts[-1] :] if n else []) == min(search(rows, START, (START, ASSISTANT), 1).values())


def expected(rows, change):
    by = {c: [] for c, *_ in rows}
    for c, t, role, text in change(rows):
        by[c].append((t, role, text))
    out = {}
    for c, mine in by.items():
        mine.sort(key=lambda x: (x[0] is not None, x[0] or 0))
        turns, numbers = [x[1:] for x in mine], [x[0] for x in mine if x[0] is not None]
        flags = list(faults(turns))
        cost, audit = min(search([(r[:1], f) for (r, _), f in zip(turns, flags, strict=True)], START, (START, ASSISTANT), 1).values())
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(x[0][:1] + y[0][:1] not in ("su", "ua", "au") for x, y in itertools.pairwise(turns))
        made = outcome(audit, turns, flags)
        assert made[0] == cost
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made[1]).encode()).hexdigest()
        out[c] = (gaps, flags.count(BLANK), flags.count(DUPLICATE), flags.count(CUT), illegal, cost, audit, digest)
    return out


def test_tables_with_and_without_damage(spark):
    rows = conversations()
    table = spark.createDataFrame(rows, TYPE).repartition(5)
    assert {r[0]: tuple(r[1:]) for r in repair_damaged(table).collect()} == expected(rows, damage)
    plain = lambda rs: [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rs]
    found = repair_conversations(table)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == expected(rows, plain)
    assert len(rows) > 1000 > conv.PIECE  # the long one is searched in pieces


def test_damage(spark):
    rows = conversations()
    table = spark.createDataFrame(rows, TYPE)
    assert sorted(map(str, (tuple(r) for r in damaged(table).select("conv_id", "turn", "role", "text").collect()))) == sorted(map(str, damage(rows)))


def test_a_conversation_that_loses_all_rows_stays(spark):
    gone = next(c for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(gone, 0, "user", "Hi.")], TYPE)
    assert [tuple(r) for r in repair_damaged(table).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", EMPTY)]


def test_empty_tables_repeated_rows_and_columns_of_clashing_names(spark):
    empty = spark.createDataFrame([], TYPE)
    assert repair_conversations(empty).collect() == [] and repair_damaged(empty).collect() == []
    rows = [(1, 1, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes.")]
    table = spark.createDataFrame(rows, TYPE).withColumns({c: F.lit("odd") for c in ("copy", "part", "audit", "h1", "kind", "cost", "fault", "a.b")})
    (found,) = repair_conversations(table).collect()
    assert (found.duplicate, found.gaps, found.cost, found.audit) == (1, 0, 3, "KDK")
    text = "long " * 2_000_000 + "."
    (found,) = repair_conversations(spark.createDataFrame([("x", 1, "user", text), ("x", 2, "assistant", "ok")], TYPE.replace("conv_id long", "conv_id string"))).collect()
    assert (found.conv_id, found.truncated, found.cost, found.audit) == ("x", 1, 1, "KK")
    assert found.repaired_sha256 == hashlib.sha256(f"user:{text}\nassistant:ok".encode()).hexdigest()
