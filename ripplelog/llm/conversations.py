"""Repair of the structure of conversations by the cheapest edits, found by A* on the lattice of edits.

A conversation's rows are walked in order. Before each row a turn may be inserted; the row is kept, given another role or
deleted. What the roles so far allow next is one of four states, so the lattice has four nodes before each row and four
behind the last. The search is keyed by (cost + least cost of the rest, edits so far): the least cost of the rest are suffix
sums of what no path avoids, the deletions that are required and the charge of 1 for a truncated row, be it kept or deleted.

A long conversation is searched in pieces of PIECE rows. A piece is searched from each state it can begin in to each it can
end in, and the best ways of the pieces are put together: ways of one cost between the same two nodes are never each
other's beginning (inserts cost something), so the least way as a whole is made of the least ways of its pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelog.llm.common import SPACES

PIECE = 256
DELETE, INSERT, RELABEL, TRUNCATED = 3, 2, 2, 1
#: States: nothing yet, behind the system's turn, behind a user's, behind an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a role's initial leads to from each state.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The initial that an inserted or relabelled turn gets in each state.
MADE = ("u", "u", "a", "u")
ENDS = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}
#: First faults of rows.
FINE, BLANK, DUPLICATE, CUT = range(4)


def search(rows: list[tuple[str, int]], start: int, ends: tuple[int, ...], enough: int) -> dict[int, tuple[int, str]]:
    """The cheapest edits of `rows` (initial of the role, first fault) from a state to the cheapest `enough` of `ends` that
    can be reached, as (cost, edits), the least edits where several cost the same."""
    n = len(rows)
    rest = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        rest[i] = rest[i + 1] + (0, DELETE, DELETE, TRUNCATED)[rows[i][1]]
    found: dict[int, tuple[int, str]] = {}
    closed: set[tuple[int, int]] = set()
    queue = [(rest[0], "", 0, 0, start)]
    while queue and len(found) < enough:
        _, edits, cost, i, state = heappop(queue)
        if (i, state) in closed:
            continue
        closed.add((i, state))
        if i == n and state in ends:
            found[state] = (cost, edits)
        made = NEXT[state][MADE[state]]
        steps = [("I", INSERT, i, made)]
        if i < n:
            initial, fault = rows[i]
            steps.append(("D", DELETE, i + 1, state))
            if fault in (FINE, CUT):
                more = TRUNCATED if fault == CUT else 0
                steps.append(("R", RELABEL + more, i + 1, made))
                if initial in NEXT[state]:
                    steps.append(("K", more, i + 1, NEXT[state][initial]))
        for edit, price, at, to in steps:
            if (at, to) not in closed:
                heappush(queue, (cost + price + rest[at], edits + edit, cost + price, at, to))
    return found


class Ways:
    """The best ways to each state behind the pieces so far. A way is a chain of pieces, so that common parts are held once."""

    def __init__(self):
        self.at: dict[int, tuple[int, tuple | None]] = {START: (0, None)}

    @staticmethod
    def _less(x: tuple, y: tuple) -> bool:
        """Whether way x comes before way y: both have as many pieces, and what they share needn't be compared."""
        left, right = [], []
        while x is not y:
            left.append(x[1])
            right.append(y[1])
            x, y = x[0], y[0]
        return "".join(reversed(left)) < "".join(reversed(right))

    def add(self, rows: list[tuple[str, int]], ends: tuple[int, ...] = (START, SYSTEM, USER, ASSISTANT), enough: int = 4) -> None:
        new: dict[int, tuple[int, tuple]] = {}
        for state, (cost, way) in self.at.items():
            for to, (more, edits) in search(rows, state, ends, enough).items():
                this = (cost + more, (way, edits))
                old = new.get(to)
                if old is None or this[0] < old[0] or (this[0] == old[0] and self._less(this[1], old[1])):
                    new[to] = this
        self.at = new

    def end(self, rows: list[tuple[str, int]]) -> tuple[int, str]:
        """Adds the last piece: cost and edits of the best way to where a conversation may end."""
        self.add(rows, ENDS, 1)
        ends = []
        for cost, way in self.at.values():
            parts = []
            while way is not None:
                parts.append(way[1])
                way = way[0]
            ends.append((cost, "".join(reversed(parts))))
        return min(ends)


class Conversation:
    """What is found out about one conversation, row by row in order."""

    def __init__(self):
        self.ways, self.piece = Ways(), []
        self.first = self.last = self.initial = None
        self.turns = self.illegal = 0
        self.faults = [0, 0, 0, 0]

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        self.illegal += self.initial is not None and self.initial + initial not in LEGAL
        self.initial = initial
        self.faults[fault] += 1
        if len(self.piece) == PIECE:  # more rows follow
            self.ways.add(self.piece)
            self.piece = []
        self.piece.append((initial, fault))

    def result(self) -> tuple[int, int, int, int, int, int, str]:
        """gaps, blank, duplicate, truncated, illegal, cost and audit."""
        cost, audit = self.ways.end(self.piece)
        gaps = 0 if self.last is None else self.last - self.first + 1 - self.turns
        return gaps, *self.faults[1:], self.illegal, cost, audit


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_ORDER = ("turn", "role", "h1", "h2", "copy")


def _by_conversation(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[object, bool, tuple]]:
    """The values of `columns` of all rows as (conv_id, whether it is another one than before, values)."""
    before, some = None, False
    for x in batches:
        for conv, *values in zip(x.column("conv_id").to_pylist(), *(x.column(c).to_pylist() for c in columns), strict=True):
            yield conv, not some or conv != before, values
            before, some = conv, True


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 2000) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 100 + len(r[-1])
        if len(held) >= most or size > 1 << 20:
            yield pa.RecordBatch.from_pydict({f.name: pa.array(c, f.type) for f, c in zip(schema, zip(*held, strict=True), strict=True)}, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pydict({f.name: pa.array(c, f.type) for f, c in zip(schema, zip(*held, strict=True), strict=True)}, schema=schema)


def _faults(rows: DataFrame) -> DataFrame:
    """The rows in narrow form: place in the conversation, initial of the role and first fault. No text."""
    bare = F.rtrim("text", F.lit(SPACES))
    narrow = rows.select("conv_id", *_ORDER, F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "h1", "h2").orderBy(F.col("turn").asc_nulls_first(), "copy"))
    fault = F.when(F.col("blank"), BLANK).when(seen > 1, DUPLICATE).when(F.col("cut"), CUT).otherwise(FINE)
    return narrow.select("conv_id", *_ORDER, "initial", fault.alias("fault"))


def repair_conversations(rows: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    rows: conv_id, turn (a whole number), role and text; other columns are not read. A null role or text counts as one
    space. Rows stand in the order of their turns, those without one first; rows of one turn by role and a hash of the text,
    so that repeated rows are neighbours. Rows without conv_id are one conversation. A role whose initial is not s, u or a,
    or which is empty, fits nowhere and has to be relabelled or deleted. An empty table has no conversations.

    Edits (their initials in order are the audit): Keep 0, Rerole to user or assistant 2, Delete 3, Insert a turn of the user
    or the assistant without text 2; 1 more for each truncated row that isn't deleted. Rows without anything but white space
    and rows whose role and text were there before have to be deleted. The result's roles are `(s?(ua)+)?` by initials.

    First the faults are found from narrow rows (repeats by 128 bits of the text), sorted by conversation and walked; a task
    holds PIECE rows and the edits so far, a letter or so for each row, which are a value of the result anyway. Then the
    edits meet the texts in the same order, and the repaired turns go into the hash one after the other. So a conversation
    of any length is a stream through one task, as its audit and its hash are; nothing of its text is held.
    """
    conv = rows.schema["conv_id"].dataType
    space = F.lit(" ")
    whole = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), F.lit(0).alias("copy"))
    return _repair(whole, conv)


def _repair(whole: DataFrame, conv: T.DataType) -> DataFrame:
    hashed = whole.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})
    audit_type = T.StructType([T.StructField("conv_id", conv), *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("audit", T.StringType())])
    final_type = T.StructType([*audit_type.fields, T.StructField("repaired_sha256", T.StringType())])

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        def each():
            now, of = None, None
            for c, new, (turn, initial, fault) in _by_conversation(batches, ["turn", "initial", "fault"]):
                if new:
                    if now is not None:
                        yield of, *now.result()
                    now, of = Conversation(), c
                now.add(turn, initial, fault)
            if now is not None:
                yield of, *now.result()

        yield from _batches(each(), to_arrow_schema(audit_type))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        def each():
            # each conversation begins with the row that has its edits; the state of the walk is kept from row to row
            head, digest, begun, at, state = None, None, False, 0, START

            def put(role: str, text: str) -> None:
                nonlocal begun, state
                digest.update(("\n" if begun else "").encode() + role.encode() + b":" + text.encode())
                begun, state = True, NEXT[state][role[:1]]

            def inserted() -> None:
                nonlocal at
                while at < len(head[-1]) and head[-1][at] == "I":
                    put({"u": "user", "a": "assistant"}[MADE[state]], "")
                    at += 1

            for c, _, (edits, role, text, *counts) in _by_conversation(batches, ["audit", "role", "text", *COUNTS]):
                if edits is not None:
                    if head is not None:
                        yield *head, digest.hexdigest()
                    head, digest, begun, at, state = (c, *counts, edits), hashlib.sha256(), False, 0, START
                    inserted()
                    continue
                edit = head[-1][at]
                at += 1
                if edit != "D":
                    put(role if edit == "K" else {"u": "user", "a": "assistant"}[MADE[state]], text)
                inserted()
            if head is not None:
                yield *head, digest.hexdigest()

        yield from _batches(each(), to_arrow_schema(final_type))

    order = [F.col("turn").asc_nulls_first(), *_ORDER[1:]]
    placed = _faults(hashed).repartition("conv_id").sortWithinPartitions("conv_id", *order)
    audits = placed.select("conv_id", "turn", "initial", "fault").mapInArrow(walked, audit_type)
    counts = [F.lit(None).cast("long").alias(c) for c in COUNTS]
    null = {c: F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("h1", "long"), ("h2", "long"), ("copy", "int"), ("text", "string"), ("audit", "string"))}
    rows = hashed.select("conv_id", F.lit(1).alias("kind"), *_ORDER, "text", null["audit"], *counts)
    heads = audits.select("conv_id", F.lit(0).alias("kind"), *[null[c] for c in _ORDER], null["text"], "audit", *COUNTS)
    met = heads.union(rows).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *order)
    return met.select("conv_id", "audit", "role", "text", *COUNTS).mapInArrow(texts, final_type)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, by crc32 of `conv_id:turn` (null: one space) modulo 20: 0 drops the row, 1 empties its text,
    2 takes `[.!?]` out of it, 3 repeats it (column copy is 1 in the second), 4 makes it the user's."""
    space = F.lit(" ")
    part = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text: Column = F.coalesce("text", space)
    changed = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), part.alias("part"),
        F.when(part == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(part == 1, "").when(part == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
    ).where("part <> 0")
    return changed.select("conv_id", "turn", "role", "text", F.explode(F.when(F.col("part") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def repair_damaged(rows: DataFrame) -> DataFrame:
    """repair_conversations of damaged(rows), with a row for every conv_id of `rows`: those that lost all their rows have
    zeros, no edits and the hash of the empty string."""
    found = _repair(damaged(rows), rows.schema["conv_id"].dataType)
    named = rows.select(F.col("conv_id").alias("_conv")).distinct()
    joined = named.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    return joined.select(
        F.col("_conv").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
