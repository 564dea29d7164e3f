"""Repair of conversations against all edits tried one by one, and over pieces."""

import itertools
import random
import re
import zlib
from hashlib import sha256

import pytest
from helpers import frame

from casefeatures.llm import conversations as C

SPACE = " \t\n\x0b\x0c\r"
TURNS = "conv_id long, turn long, role string, text string"


def faults(rows):
    """Of (role, text) rows: blank, duplicate, truncated or None."""
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def every_repair(rows):
    """(cost, audit, lines) of the least repair, by trying all; few rows only."""
    found = faults(rows)
    options = []
    for (role, text), fault in zip(rows, found, strict=True):
        here = [("D", 3, None)]
        if fault not in ("blank", "duplicate"):
            more = fault == "truncated"
            here += [("K", 0 + more, (role, text)), ("R", 2 + more, ("user", text)), ("R", 2 + more, ("assistant", text))]
        options.append(here)
    gaps = [(), *itertools.product(("user", "assistant")), *itertools.product(("user", "assistant"), repeat=2)]
    best = None
    for inserts in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product(*options):
            audit, cost, lines = "", 0, []
            for i in range(len(rows) + 1):
                audit, cost, lines = audit + "I" * len(inserts[i]), cost + 2 * len(inserts[i]), lines + [(r, "") for r in inserts[i]]
                if i < len(rows):
                    audit, cost = audit + edits[i][0], cost + edits[i][1]
                    lines += [edits[i][2]] if edits[i][2] else []
            if (best is None or (cost, audit) < best[:2]) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in lines)):
                best = cost, audit, lines
    return best


def least_repair(rows):
    """The same by a plain search from the end: (cost, audit) of the best rest for each state of the pattern."""
    found, steps = faults(rows), {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    rest = {0: (0, "", ()), 3: (0, "", ())}

    def with_inserts(rest):
        changed = True
        while changed:
            changed = False
            for q in steps:
                for role, c in (("user", "u"), ("assistant", "a")):
                    after = rest.get(steps[q].get(c))
                    if after is not None:
                        way = (after[0] + 2, "I" + after[1], ((role, ""), after[2]))
                        if q not in rest or way[:2] < rest[q][:2]:
                            rest[q], changed = way, True
        return rest

    rest = with_inserts(rest)
    for (role, text), fault in reversed(list(zip(rows, found, strict=True))):
        new = {}
        for q in steps:
            ways = [] if q not in rest else [(rest[q][0] + 3, "D" + rest[q][1], rest[q][2])]
            if fault not in ("blank", "duplicate"):
                for letter, cost, name in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                    after = rest.get(steps[q].get(name[:1]))
                    if after is not None:
                        ways.append((after[0] + cost + (fault == "truncated"), letter + after[1], ((name, text), after[2])))
            if ways:
                new[q] = min(ways, key=lambda w: w[:2])
        rest = with_inserts(new)
    cost, audit, chain = rest[0]
    lines = []
    while chain:
        lines.append(chain[0])
        chain = chain[1]
    return cost, audit, lines


def expected(turns):
    """SUMMARY of one conversation's (turn, role, text) rows."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in turns), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    found = faults([r[1:] for r in rows])
    at = [r[0] for r in rows if r[0] is not None]
    cost, audit, lines = least_repair([r[1:] for r in rows])
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    digest = sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return (max(at) - min(at) + 1 - len(set(at)) if at else 0, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, digest)


def damage(rows):
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        yield from [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)


ROLES = ("user", "assistant", "system", "user", "assistant", "", "tool", "Ua", None)
TEXTS = ("Yes.", "No", "so?", "", " \t\x0b", None, "é!", "a\nb. ", "Yes.")


def random_rows(rng, n):
    return [(rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice(ROLES), rng.choice(TEXTS)) for _ in range(n)]


def test_plain_search_is_right():
    rng = random.Random(1)
    for _ in range(60):
        rows = [(r or " ", x or " ") for _, r, x in random_rows(rng, rng.randrange(0, 3))]
        assert least_repair(rows)[:2] == every_repair(rows)[:2]
        assert least_repair(rows)[2] == every_repair(rows)[2]


def turns_of(rows):
    seen, out = set(), []
    for role, text in rows:
        out.append(C.Turn(None, role, text, 1, (role, text) not in seen))
        seen.add((role, text))
    return out


def test_repair_is_the_least():
    rng = random.Random(2)
    for _ in range(1500):
        rows = [(r or " ", x or " ") for _, r, x in random_rows(rng, rng.randrange(0, 9))]
        p = C.repaired(turns_of(rows))
        cost, audit, lines = least_repair(rows)
        assert (p.cost, p.audit, [x[1:] for x in p.lines]) == (cost, audit, lines)


def test_parts_join_to_the_whole():
    rng = random.Random(3)
    for _ in range(300):
        rows = turns_of([(r or " ", x or " ") for _, r, x in random_rows(rng, 12)])
        at = sorted(rng.sample(range(1, 12), rng.randrange(1, 4)))
        parts = [rows[s:e] for s, e in zip([0, *at], [*at, 12])]
        ways = C.joined([C.passages(C.rows_of(p)) for p in parts])
        done = [C.repaired(p, *way) for p, way in zip(parts, ways)]
        whole = C.repaired(rows)
        assert "".join(p.audit for p in done) == whole.audit and sum(p.cost for p in done) == whole.cost
        assert [x for p in done for x in p.lines] == whole.lines


def conversations(seed, many=30):
    """Short ones, one with half of all rows, repeated rows, null ids."""
    rng = random.Random(seed)
    rows = [(c if c else None, *x) for c in range(many) for x in random_rows(rng, rng.randrange(1, 8))]
    rows += [(many, *(i // 2, rng.choice(ROLES), f"{rng.randrange(60)} {rng.choice(('.', '', '?'))}")) for i in range(len(rows))]
    return rows + [(many + 1, 0, "user", "Same.")] * 40


def by_conversation(rows):
    out = {}
    for conv, *rest in rows:
        out.setdefault(conv, []).append(tuple(rest))
    return out


@pytest.mark.parametrize("seed", [4, 5])
def test_repairs(spark, seed):
    rows = conversations(seed)
    got = {r[0]: tuple(r)[1:] for r in C.repairs(frame(spark, rows, TURNS)).collect()}
    assert got == {c: expected(x) for c, x in by_conversation(rows).items()}


def test_turns_after_repair(spark):
    rows, got = conversations(6), {}
    for r in sorted(C.repaired_turns(frame(spark, rows, TURNS)).collect(), key=lambda r: (r["piece"], r["place"])):
        got.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv, x in by_conversation(rows).items():
        assert sha256("\n".join(got.get(conv, [])).encode()).hexdigest() == expected(x)[-1]


def test_damage_and_repair(spark):
    rng = random.Random(7)
    rows = [(c, i, "user" if i % 2 == 0 else "assistant", f"{c} {i}{rng.choice('.!?')}") for c in range(60) for i in range(rng.randrange(1, 7))]
    rows += [(None, None, "user", None), (None, 1, None, "x."), (500, 3, "system", "S.")]
    dropped = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "Gone."))
    left = by_conversation(damage(rows))
    want = {c: expected(left.get(c, [])) for c in {r[0] for r in rows}}
    df = frame(spark, rows, TURNS).selectExpr("*", "1 AS piece", "2 AS _head", "'x' AS audit")
    got = {r[0]: tuple(r)[1:] for r in C.damaged_and_repaired(df).collect()}
    assert got == want
    assert dropped not in left and got[dropped] == (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())


def test_no_rows(spark):
    df = spark.createDataFrame([], TURNS)
    assert C.repairs(df).collect() == [] and C.damaged_and_repaired(df).collect() == [] and C.repaired_turns(df).collect() == []
