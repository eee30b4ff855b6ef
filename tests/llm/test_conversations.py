"""Conversation repair against a search over all edits."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from starloom.llm import conversations, roles

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SOLID = re.compile(r"[^\x20\x09-\x0D]")
FULL = {"u": "user", "a": "assistant"}
#: state -> initial -> state of (s?(ua)+)?; states 0 and 3 may end
MOVES = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest(rows):
    """Least (cost, audit) over all edits, row by row: whole audits are kept for each state."""
    best = {0: (0, "", ())}

    def put(into, state, entry):
        if state not in into or entry < into[state]:
            into[state] = entry
            return True

    def inserts(best):
        todo = list(best)
        while todo:
            state = todo.pop()
            cost, audit, lines = best[state]
            for x in "ua":
                if x in MOVES[state] and put(best, MOVES[state][x], (cost + 2, audit + "I", (*lines, f"{FULL[x]}:"))):
                    todo.append(MOVES[state][x])
        return best

    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, lines) in inserts(dict(best)).items():
            put(after, state, (cost + 3, audit + "D", lines))
            if fault in (1, 2):
                continue
            more = fault == 3
            if role[:1] in MOVES[state]:
                put(after, MOVES[state][role[:1]], (cost + more, audit + "K", (*lines, f"{role}:{text}")))
            for x in "ua":
                if x in MOVES[state]:
                    put(after, MOVES[state][x], (cost + 2 + more, audit + "R", (*lines, f"{FULL[x]}:{text}")))
        best = after
    return min(e for s, e in inserts(best).items() if s in (0, 3))


def brute(rows):
    by_conv = {r[0]: [] for r in rows}
    for r in damaged(rows):
        by_conv[r[0]].append(r)
    out = []
    for conv, mine in by_conv.items():
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        seen, faults = set(), []
        for _, _, role, text in mine:
            solid = SOLID.findall(text)
            faults.append(1 if not solid else 2 if (role, text) in seen else 3 * (solid[-1] not in ".!?"))
            seen.add((role, text))
        initials = [r[2][:1] for r in mine]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, lines = cheapest([(r[2], r[3], f) for r, f in zip(mine, faults)])
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, audit, sha))
    return Counter(out)


def got(df):
    return Counter(tuple(r) for r in conversations.report(conversations.damage(df)).collect())


def rows_of(rng, convs, longest):
    texts = ["Yes.", "No", "", " \t", "Why?", "Fine! ", "x.\n", "é", "Long " * 40 + "."]
    names = ["user", "assistant", "system", "user", "assistant", "tool", "", "u", None, "𝒰ser"]
    out = []
    for conv in range(convs):
        turn = rng.randrange(3)
        for _ in range(rng.randint(1, longest)):
            turn += rng.choice((1, 1, 1, 1, 2, 5))
            role = rng.choice(names) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            out.append((conv, turn, role, rng.choice(texts) if rng.random() < 0.5 else f"T{rng.random()}."))
    return out


def test_random_conversations(spark):
    rows = rows_of(random.Random(1), 400, 9)
    rows += [(None, k, "user", "a.") for k in range(3)] + [(None, None, None, None), (7000, None, "user", "z.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("at", "mark", "fault", "block", "dropped", "n", "whole")})
    assert got(df.repartition(6)) == brute(rows)
    assert got(df.limit(0)) == Counter()


def test_conversations_over_many_tasks_and_parts(spark):
    """Two conversations hold most rows; repeated rows, equal turns and one text a third of all."""
    rng = random.Random(2)
    rows = [r for r in rows_of(rng, 3, 4)]
    for conv, n in ((50, 3000), (51, 1500)):
        for k in range(n):
            turn = None if rng.random() < 0.01 else k // rng.choice((1, 1, 2))
            text = "Same." if rng.random() < 0.33 else f"{rng.random()}{rng.choice(['.', '', '?'])}"
            rows.append((conv, turn, rng.choice(("user", "assistant", "user", "assistant", "system")), text))
    rows += [(60, 5, "user", "again.")] * 700
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(9)) == brute(rows)


def test_lines_of_parts_are_the_conversation(spark):
    rows = rows_of(random.Random(3), 30, 8) + [(99, k, "user", f"{k}.") for k in range(900)]
    parts = conversations.repaired(conversations.damage(spark.createDataFrame(rows, SCHEMA))).collect()
    want = {r[0]: (r[7], r[8]) for r in brute(rows)}
    by_conv = {}
    for p in sorted(parts, key=lambda p: p["at"]):
        audit, lines = by_conv.setdefault(p["conv_id"], ([], []))
        audit.append(p["audit"])
        lines += [f"{x['role']}:{x['text']}" for x in p["lines"]]
    for conv, (audit, lines) in by_conv.items():
        assert ("".join(audit), hashlib.sha256("\n".join(lines).encode()).hexdigest()) == want[conv]
    assert set(by_conv) == set(want)


@pytest.mark.parametrize("seed", range(4))
def test_stacks_against_whole_audits(seed):
    """Any cut of a sequence gives the same result as the whole; few configurations are ever met."""
    rng, repair = random.Random(seed), roles.RoleRepair()
    for _ in range(200):
        rows = [(rng.choice(("user", "assistant", "system", "tool", "")), "t", rng.choice((0, 0, 0, 1, 3))) for _ in range(rng.randrange(12))]
        codes = bytes(roles.row_code(r[:1], (0, 2, 2, 1)[f]) for r, _, f in rows)
        tops, cost, trail = repair.run(codes)
        more, place, tail, _ = repair.finish(tops)
        edits, _ = repair.way(trail, place)
        assert (cost + more, "".join(edits) + tail) == cheapest(rows)[:2]
    assert repair.size == 12 and len(repair.known) < 3000


def test_registered_query_on_whole_table(spark, folder):
    from starloom.llm.queries import QUERIES

    df = spark.read.parquet(f"{folder}/conversations.parquet")
    found = Counter(tuple(r) for r in QUERIES["op13_lr_conversation_repair"](spark, folder).collect())
    assert found == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
