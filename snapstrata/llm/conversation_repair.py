"""Conversation structure repair by depth-first branch-and-bound.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``.  Rows are kept
(cost 0), get the role user or assistant (1), or are deleted (2); rows with empty text may be put in
anywhere (5 each).  Blank rows and repeats of an earlier row must go; a truncated row that stays
costs 5 more.  The cheapest edits are sought, of equal cost those whose initials (D, I, K, R) come
first in ASCII.

The search goes depth first over an explicit stack.  A node is (rows done, state of the role
pattern).  A prefix is dropped if its cost and the lower bound of the suffix exceed the incumbent,
if they reach it with a larger audit, or if the node's dominance table holds a prefix that is not
worse in (cost, audit).  The search ends when the stack is empty, which proves the incumbent.  What comes next in the pattern
is decided by the state and the edit, so an audit says everything about a repair, and two
audits of one node and cost never begin one with the other: cutting by the table is exact.

How it runs: rows are range-partitioned by (conversation, turn), and a task streams them into blocks
of bounded rows and bytes, so a conversation may hold any share of the table.  First rows of
equal (role, text) are found by an aggregation.  Each block is searched from every state it may be
entered in to every state it may be left in; a stream over the blocks of a conversation, a few
values each, chains the results, which is exact as (cost, audit) adds up from block to block.
The digest of a repaired conversation runs over its text in order, block by block, in bounded memory.

Null roles and texts count as one blank, in the row's key a null conversation or turn does too.
Rows without a conversation form one.  Rows of one turn are ordered by role, text and copy, null
turns first.  An empty role has no initial and can't be kept.  A conversation whose rows are all
dropped stays with zeros.  An empty table gives an empty result; other columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from snapstrata.llm.shared import stored

#: rows and bytes of text of a block
BLOCK_ROWS, BLOCK_BYTES = 64, 1 << 20

#: characters that don't count as text
SPACE = " \t\n\x0b\f\r"

#: prices of edits
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: states of the role pattern: nothing yet, after s, after u, after a; what an edited row becomes in each, and the state then
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
ENDS = (START, ASSISTANT)
ROLES = ("user", "assistant")
LEGAL = ("su", "ua", "au")

#: what a row is, as the search sees it: must go, truncated, or sound
GONE, CUT, SOUND = "-", "?", "."


def moves(state: int, initial: str, fault: str) -> list[tuple[int, str, int]]:
    """(cost, letter, next state) of what can be done with a row in a state."""
    out = [(DELETE, "D", state)]
    if fault == GONE:
        return out
    more = TRUNCATED if fault == CUT else 0
    expected, then = NEXT[state]
    if initial == expected:
        out.append((more, "K", then))
    elif state == START and initial == "s":
        out.append((more, "K", SYSTEM))
    out.append((more + RENAME, "R", then))
    return out


def lower_bounds(rows: list[tuple[str, str]], goal: int) -> list[list[float]]:
    """For each suffix and state the cost below which no way from there to the goal lies, whatever its audit."""
    n = len(rows)
    never = float("inf")
    bound = [[never] * 4 for _ in range(n + 1)]
    bound[n][goal] = 0
    for at in range(n, -1, -1):
        here = bound[at]
        if at < n:
            for state in NEXT:
                here[state] = min(price + bound[at + 1][then] for price, _, then in moves(state, *rows[at]))
        # two insertions lead from any state of the alternation back to it, so no way has more of them in a place
        for _ in range(2):
            for state in NEXT:
                here[state] = min(here[state], INSERT + here[NEXT[state][1]])
    return bound


def search(rows: list[tuple[str, str]], entry: int, goal: int) -> tuple[int, str] | None:
    """The cheapest (cost, audit) from the entry state to the goal state; rows are (initial, fault)."""
    n, bound = len(rows), lower_bounds(rows, goal)
    incumbent: tuple[float, str] = (float("inf"), "")
    table: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, "", 0, entry)]
    while stack:
        cost, audit, at, state = stack.pop()
        least = cost + bound[at][state]
        # nothing below costs less than the incumbent, or as much with a smaller audit
        if least == float("inf") or least > incumbent[0] or least == incumbent[0] and audit > incumbent[1][: len(audit)]:
            continue
        held = table.get((at, state))
        if held is not None and held <= (cost, audit):
            continue
        table[at, state] = (cost, audit)
        if at == n and state == goal:
            incumbent = min(incumbent, (cost, audit))
        branches = [(cost + INSERT, audit + "I", at, NEXT[state][1])]
        if at < n:
            branches += [(cost + price, audit + letter, at + 1, then) for price, letter, then in moves(state, *rows[at])]
        # the branch of the lowest bound, of equal ones the first letter, is pushed last and so is tried first
        branches.sort(key=lambda b: (b[0] + bound[b[2]][b[3]], b[1]), reverse=True)
        stack.extend(branches)
    return incumbent if table and incumbent[0] < float("inf") else None


def block_table(rows: list[tuple[str, str]], entries: tuple[int, ...]) -> dict[tuple[int, int], tuple[int, str]]:
    """The search's results for the entry states and all states that a block may be left in."""
    found = {(entry, goal): search(rows, entry, goal) for entry in entries for goal in NEXT}
    return {way: best for way, best in found.items() if best is not None}


def applied(edits: str, emitted: int, system: bool, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str]]:
    """(role, text) of a block's repaired rows; emitted: rows before them, system: does the conversation begin with s?"""
    at = 0
    for letter in edits:
        new = ROLES[(emitted - system) % 2]
        if letter == "I":
            yield new, ""
        else:
            if letter != "D":
                yield (roles[at] if letter == "K" else new), texts[at]
            at += 1
        emitted += letter != "D"


def pieces_of(audit: str, blocks: list[tuple[int, int]]) -> list[dict]:
    """The audit cut at the blocks, given as (block, rows); insertions go with the row behind them."""
    system = (len(audit) - audit.count("D")) % 2 == 1
    out, at, emitted = [], 0, 0
    for k, (block, n) in enumerate(blocks):
        first = at
        while n:
            n -= audit[at] != "I"
            at += 1
        if k == len(blocks) - 1:
            at = len(audit)
        out.append({"block": block, "edits": audit[first:at], "emitted": emitted, "system": system})
        emitted += at - first - audit.count("D", first, at)
    return out


def _blocks(rows: DataFrame, most_rows: int, most_bytes: int) -> DataFrame:
    """Stored (conv, block, fresh, turns, roles, texts): neighbouring rows of one conversation, in order.

    block is the number of the first row, so blocks and their rows are numbered in the
    conversation's order.  fresh: nothing of the conversation comes before for certain.
    """
    kind = rows.schema["conv"]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the last key lets rows that are equal in all columns spread over tasks
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text", "tie")]
    laid = tied.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys).drop("tie")
    laid = laid.withColumn("mark", F.monotonically_increasing_id())
    schema = T.StructType([kind]).add("block", "long").add("fresh", "boolean")
    schema = schema.add("turns", T.ArrayType(T.LongType())).add("roles", T.ArrayType(T.StringType())).add("texts", T.ArrayType(T.StringType()))
    fields = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        fresh, size, full = False, 0, []

        def closed() -> dict:
            turns, roles, texts = (list(c) for c in zip(*(r[1:4] for r in held)))
            return {"conv": held[0][0], "block": held[0][4], "fresh": fresh, "turns": turns, "roles": roles, "texts": texts}

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "mark"))):
                other = bool(held) and row[0] != held[0][0]
                if held and (other or len(held) == most_rows or size + len(row[3]) > most_bytes):
                    full.append(closed())
                    held, size, fresh = [], 0, other
                held.append(row)
                size += len(row[3])
            if full:
                yield pa.RecordBatch.from_pylist(full, fields)
                full = []
        if held:
            yield pa.RecordBatch.from_pylist([closed()], fields)

    return stored(laid.mapInArrow(run, schema), "turns")


def _first_rows(blocks: DataFrame) -> DataFrame:
    """(block, firsts): in each block the places of rows whose (role, text) no earlier row of the conversation has."""
    rows = blocks.select("conv", "block", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row"))
    rows = rows.select("conv", "row.roles", F.sha2("row.texts", 256).alias("text"), F.struct("block", "place").alias("at"))
    first = rows.groupBy("conv", "roles", "text").agg(F.min("at").alias("at"))
    return first.groupBy(F.col("at.block").alias("block")).agg(F.collect_list("at.place").alias("firsts"))


_WAYS = "array<struct<entry: int, goal: int, cost: long, audit: string>>"


def _own_fault(text: Column) -> Column:
    end = F.substring(F.rtrim(text, F.lit(SPACE)), -1, 1)
    return F.when(end == "", GONE).when(end.isin(".", "!", "?"), SOUND).otherwise(CUT)


def _judged(blocks: DataFrame) -> DataFrame:
    """Per block its counts, its ends, and the best way through it from each state to each."""
    rows = blocks.select(
        "conv", "block", "fresh", "turns",
        F.transform("roles", lambda x: F.substring(x, 1, 1)).alias("initials"),
        F.transform("texts", _own_fault).alias("faults"),
    )
    rows = rows.join(_first_rows(blocks), "block", "left")
    schema = T.StructType([blocks.schema["conv"]])
    for name in ("block", "rows", "blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn"):
        schema = schema.add(name, "long")
    schema = schema.add("first", "string").add("last", "string").add("ways", T.StructType.fromDDL(f"ways {_WAYS}")["ways"].dataType)
    fields = to_arrow_schema(schema)

    def judge(row: dict) -> dict:
        initials, firsts = row["initials"], set(row["firsts"] or ())
        faults = [f if f == GONE or k in firsts else "2" for k, f in enumerate(row["faults"])]
        turns = [t for t in row["turns"] if t is not None]
        search_rows = [(i, GONE if f == "2" else f) for i, f in zip(initials, faults)]
        ways = block_table(search_rows, (START,) if row["fresh"] else tuple(NEXT))
        return {
            "conv": row["conv"], "block": row["block"], "rows": len(faults),
            "blank": faults.count(GONE), "duplicate": faults.count("2"), "truncated": faults.count(CUT),
            "illegal": sum(x + y not in LEGAL for x, y in zip(initials, initials[1:])),
            "turns": len(set(turns)), "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
            "first": initials[0], "last": initials[-1],
            "ways": [{"entry": e, "goal": g, "cost": c, "audit": a} for (e, g), (c, a) in ways.items()],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([judge(row) for row in batch.to_pylist()], fields)

    return rows.mapInArrow(run, schema)


def _in_order(rows: DataFrame, *order: str) -> DataFrame:
    """Each conversation in one task, as a stream in order."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "conv").sortWithinPartitions("conv", *order)


class Chain:
    """A conversation's blocks, one after another."""

    def __init__(self):
        self.best, self.blocks = {START: (0, "")}, []
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.distinct, self.low, self.high, self.end = 0, None, None, None

    def add(self, row: dict) -> None:
        best: dict[int, tuple[int, str]] = {}
        for way in row["ways"]:
            if way["entry"] in self.best:
                cost, audit = self.best[way["entry"]]
                new = (cost + way["cost"], audit + way["audit"])
                best[way["goal"]] = min(new, best.get(way["goal"], new))
        self.best = best
        self.blocks.append((row["block"], row["rows"]))
        for name in self.sums:
            self.sums[name] += row[name]
        if self.end is not None and self.end + row["first"] not in LEGAL:
            self.sums["illegal"] += 1
        self.end = row["last"]
        if row["first_turn"] is not None:
            self.low = row["first_turn"] if self.low is None else self.low
            self.distinct += row["turns"] - (row["first_turn"] == self.high)
            self.high = row["last_turn"]

    def result(self, conv) -> dict:
        cost, audit = min(self.best[goal] for goal in ENDS if goal in self.best)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return {"conv": conv, "gaps": gaps, **self.sums, "cost": cost, "audit": audit, "pieces": pieces_of(audit, self.blocks)}


def _chained(judged: DataFrame) -> DataFrame:
    """Stored (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, pieces), a row for each conversation."""
    schema = T.StructType([judged.schema["conv"]])
    for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"):
        schema = schema.add(name, "long")
    piece = "pieces array<struct<block: long, edits: string, emitted: long, system: boolean>>"
    schema = schema.add("audit", "string").add(T.StructType.fromDDL(piece)["pieces"])
    fields = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, chain = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if chain is None or row["conv"] != held:
                    if chain is not None:
                        out.append(chain.result(held))
                    held, chain = row["conv"], Chain()
                chain.add(row)
            yield pa.RecordBatch.from_pylist(out, fields)
        if chain is not None:
            yield pa.RecordBatch.from_pylist([chain.result(held)], fields)

    return stored(_in_order(judged, "block").mapInArrow(run, schema), "chains")


_PIECE = ("block", "edits", "emitted", "system")


def _digests(blocks: DataFrame, chains: DataFrame) -> DataFrame:
    """(conv, digest): sha256 over the repaired rows; a block's edits come just before its rows in the stream."""
    pieces = chains.select("conv", F.explode("pieces").alias("piece")).select("conv", *(F.col(f"piece.{c}") for c in _PIECE))
    both = blocks.select("conv", "block", "roles", "texts").unionByName(pieces, allowMissingColumns=True)
    schema = T.StructType([chains.schema["conv"], T.StructField("digest", T.StringType())])
    fields = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, running, lines, piece = None, None, 0, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if running is None or row["conv"] != held:
                    if running is not None:
                        out.append({"conv": held, "digest": running.hexdigest()})
                    held, running, lines = row["conv"], sha256(), 0
                if row["edits"] is not None:
                    piece = row
                    continue
                for role, text in applied(piece["edits"], piece["emitted"], piece["system"], row["roles"], row["texts"]):
                    running.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1
            yield pa.RecordBatch.from_pylist(out, fields)
        if running is not None:
            yield pa.RecordBatch.from_pylist([{"conv": held, "digest": running.hexdigest()}], fields)

    return _in_order(both, "block", F.col("edits").isNull()).mapInArrow(run, schema)


class Repair:
    """Repaired conversations: ``summary`` has a row for each, ``rows`` their rows, as lazy tables over stored ones.

    rows is any table; conv, turn, role and text name its columns or give their expressions.
    """

    def __init__(self, rows: DataFrame, conv="conv_id", turn="turn", role="role", text="text", block_rows=BLOCK_ROWS, block_bytes=BLOCK_BYTES):
        def column(c):
            return F.col(c) if isinstance(c, str) else c

        blank = F.lit(" ")
        read = rows.select(
            column(conv).alias("conv"),
            column(turn).cast("long").alias("turn"),
            F.coalesce(column(role).cast("string"), blank).alias("role"),
            F.coalesce(column(text).cast("string"), blank).alias("text"),
        )
        self.blocks = _blocks(read, block_rows, block_bytes)
        self.chains = _chained(_judged(self.blocks))

    @property
    def summary(self) -> DataFrame:
        """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, digest)."""
        digests = _digests(self.blocks, self.chains).withColumnRenamed("conv", "own")
        return self.chains.drop("pieces").join(digests, F.col("conv").eqNullSafe(F.col("own"))).drop("own")

    @property
    def rows(self) -> DataFrame:
        """(conv, place, role, text) of the repaired conversations; places rise from 0."""
        pieces = self.chains.select(F.explode("pieces").alias("piece")).select(*(F.col(f"piece.{c}") for c in _PIECE))
        joined = self.blocks.select("conv", "block", "roles", "texts").join(pieces, "block")
        schema = T.StructType([joined.schema["conv"]]).add("place", "long").add("role", "string").add("text", "string")
        fields = to_arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    lines = applied(row["edits"], row["emitted"], row["system"], row["roles"], row["texts"])
                    out += [{"conv": row["conv"], "place": row["emitted"] + k, "role": r, "text": t} for k, (r, t) in enumerate(lines)]
                yield pa.RecordBatch.from_pylist(out, fields)

        return joined.mapInArrow(run, schema)
