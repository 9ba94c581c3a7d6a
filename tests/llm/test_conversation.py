from __future__ import annotations

import random
import re
from hashlib import sha256
from itertools import product

import pytest
from pyspark.sql import functions as F

from snapstrata.llm import conversation_repair as repair
from snapstrata.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def edited(rows, letters):
    """Repaired rows and cost of each way to read the letters; rows are (role, text, fault)."""
    choices = [("user", "assistant") if x in "RI" else (None,) for x in letters]
    for roles in product(*choices):
        at, cost, out, fine = 0, 0, [], True
        for letter, role in zip(letters, roles):
            if letter == "I":
                out.append((role, ""))
                cost += 5
                continue
            own, text, fault = rows[at]
            at += 1
            if letter == "D":
                cost += 2
                continue
            fine &= fault not in ("blank", "duplicate") and (letter != "R" or role != own)
            cost += (letter == "R") + 5 * (fault == "truncated")
            out.append((role or own, text))
        if fine:
            yield cost, out


def cheapest(rows):
    """By trying all edits with up to three insertions."""
    best = None
    for own in product("DKR", repeat=len(rows)):
        for places in product(range(4), repeat=len(rows) + 1):
            if sum(places) > 3:
                continue
            letters = "".join("I" * n + x for n, x in zip(places, (*own, "")))
            for cost, out in edited(rows, letters):
                if re.fullmatch("(s?(ua)+)?", "".join(role[:1] or "?" for role, _ in out)):
                    best = min(best or (cost, letters, out), (cost, letters, out))
    return best


def plainly(rows):
    """The summary of each conversation; rows are (conv, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(
            ((t is not None, t or 0, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv)
        )
        seen, judged = set(), []
        for _, _, role, text in own:
            end = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1:]
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "" if end in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [t for known, t, _, _ in own if known]
        initials = [r[:1] for r, _, _ in judged]
        cost, audit, lines = cheapest(judged)
        digest = sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        counts = [sum(f == kind for *_, f in judged) for kind in ("blank", "duplicate", "truncated")]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = ((gaps, *counts, illegal, cost, audit, digest), lines)
    return out


def compared(spark, rows, **sizes):
    done = repair.Repair(spark.createDataFrame(rows, SCHEMA).repartition(3), **sizes)
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "digest")
    got = {r.conv: tuple(r[c] for c in names) for r in done.summary.collect()}
    want = plainly(rows)
    assert got == {conv: summary for conv, (summary, _) in want.items()}
    lines = {}
    for r in sorted(done.rows.collect(), key=lambda r: r.place):
        assert r.place == len(lines.setdefault(r.conv, []))
        lines[r.conv].append((r.role, r.text))
    assert lines == {conv: x for conv, (_, x) in want.items() if x}
    return got


def drawn(rng, convs, most):
    texts = ["Fine.", "Well!", "cut", "", " \t", "What? \n", "é.", None, "end. \x0b"]
    roles = ["user", "assistant", "system", "tool", "", None, "u", "supervisor"]
    rows = []
    for conv in convs:
        for k in range(rng.randrange(1, most)):
            role = rng.choice(roles) if rng.random() < 0.2 else ("user", "assistant")[k % 2]
            rows.append((conv, rng.choice([k, k, k, k + 1, None]), role, rng.choice(texts) if rng.random() < 0.4 else f"{rng.randrange(99)}."))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 1}, {"block_rows": 2}, {"block_bytes": 4}])
def test_repairs_equal_brute_force_in_blocks_of_any_size(spark, sizes):
    rng = random.Random(len(str(sizes)))
    compared(spark, drawn(rng, [None, *range(14)], 6), **sizes)


def backwards(rows, entry, goal):
    """Least (cost, audit) by steps over all states, as a check on longer rows than all edits can be tried on."""
    def inserted(best):
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                then = repair.NEXT[state][1]
                best[then] = min(best.get(then, (1 << 40, "")), (cost + 5, audit + "I"))
        return best

    best = inserted({entry: (0, "")})
    for row in rows:
        after = {}
        for state, (cost, audit) in best.items():
            for price, letter, then in repair.moves(state, *row):
                after[then] = min(after.get(then, (1 << 40, "")), (cost + price, audit + letter))
        best = inserted(after)
    return best.get(goal)


def test_search_proves_the_optimum_on_long_and_hostile_rows():
    rng = random.Random(5)
    cases = [[(x, ".")] * 120 for x in "usax"] + [[("u", "?")] * 90, [("u", "-")] * 90, []]
    cases += [[(rng.choice("suax"), rng.choice("-?....")) for _ in range(n)] for n in (3, 30, 200)]
    for rows in cases:
        for entry, goal in product(range(4), repeat=2):
            assert repair.search(rows, entry, goal) == backwards(rows, entry, goal)


def test_bounds_never_exceed_what_is_left():
    rng = random.Random(6)
    rows = [(rng.choice("suax"), rng.choice("-?...")) for _ in range(25)]
    for goal in range(4):
        bounds = repair.lower_bounds(rows, goal)
        for at in range(len(rows) + 1):
            for state in range(4):
                best = backwards(rows[at:], state, goal)
                assert bounds[at][state] <= (float("inf") if best is None else best[0])


def test_one_conversation_over_many_blocks_and_partitions(spark):
    rng = random.Random(7)
    rows = [(1, k, ("user", "assistant")[(k + (rng.random() < 0.1)) % 2], rng.choice(["cut", "a.", f"{k}!", ""])) for k in range(900)]
    rows += [(1, None, "user", "same.")] * 300
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    small, large = (repair.Repair(frame, block_rows=n) for n in (7, 5000))
    assert small.blocks.count() > 100 and large.blocks.count() < 9
    assert small.summary.collect() == large.summary.collect()
    assert sorted(map(tuple, small.rows.collect())) == sorted(map(tuple, large.rows.collect()))
    assert large.summary.first().duplicate >= 299


def test_a_hopeless_conversation_ends_empty_and_tables_may_be_empty(spark):
    got = compared(spark, [(1, 0, "user", " "), (2, 5, "system", "Only."), (3, 1, "user", "x" * 50_000)])
    assert got[1][-2:] == ("D", sha256().hexdigest()) and got[2][-2] == "D"
    empty = repair.Repair(spark.createDataFrame([], SCHEMA))
    assert empty.summary.collect() == [] and empty.rows.collect() == []


def test_query_returns_conversations_that_the_damage_empties(spark, tmp_path):
    from zlib import crc32

    gone = next(k for k in range(1000) if crc32(f"{k}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hello."), (None, 0, "user", "Hi."), (None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).withColumn("conv", F.lit(3)).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r for r in QUERIES["op12_conversation_repair"](spark, str(tmp_path)).collect()}
    assert set(got) == {gone, None}
    assert (got[gone].cost, got[gone].audit, got[gone].repaired_sha256) == (0, "", sha256().hexdigest())
