"""Repair of conversation structure by a generalised LR parse that may delete, rerole and insert turns.

The role grammar is ``S -> (nothing) | s P | P``, ``P -> P u a | u a`` for the first letters of roles. Its LR(0) states are built from the
productions. All parses go on side by side on a graph-structured stack: a node is a state on another node, lower parts are shared, and of
parses that reach an equal node after the same row only that with the least (cost, audit) stays. Since a row's letters and the inserts between
rows decide a parse's cost, equal costs at a node come from audits none of which begins with the other, so keeping the least one is exact.

Rows are sorted once, in range pieces. A conversation inside a piece is repaired there. Those at the edges of pieces may go on in the next
piece, one with a third of all rows through many: of each piece they cover, a table says for every node they may enter with, which
nodes they may leave with, at what cost and in what order of audits. These tables (two conversations a piece) are put together in order,
which gives every piece its way in and out; then all pieces of a conversation are repaired independently.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache
from hashlib import sha256
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefeatures.sources.files import scratch_path, written

GOAL = "S"
PRODUCTIONS = (("S", ()), ("S", ("s", "P")), ("S", ("P",)), ("P", ("P", "u", "a")), ("P", ("u", "a")))
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Roles that can be given, by their letter.
GIVEN = {"u": "user", "a": "assistant"}
#: Neighbouring letters that are legal.
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
SPACES = " \t\n\x0b\x0c\r"


def _closure(items: frozenset) -> frozenset:
    found, more = set(items), list(items)
    while more:
        rule, dot = more.pop()
        body = PRODUCTIONS[rule][1]
        for r, (head, _) in enumerate(PRODUCTIONS):
            if dot < len(body) and head == body[dot] and (r, 0) not in found:
                found.add((r, 0))
                more.append((r, 0))
    return frozenset(found)


def _goto(state: frozenset, symbol: str) -> frozenset:
    return _closure(frozenset((r, dot + 1) for r, dot in state if PRODUCTIONS[r][1][dot : dot + 1] == (symbol,)))


_FIRST = _closure(frozenset((r, 0) for r, (head, _) in enumerate(PRODUCTIONS) if head == GOAL))


def _complete(state: frozenset) -> list[tuple[str, int]]:
    return [(PRODUCTIONS[r][0], dot) for r, dot in state if dot == len(PRODUCTIONS[r][1])]


def _reduce(node: tuple, head: str, length: int) -> tuple | None:
    """The node after popping ``length`` states and going on with ``head``."""
    for _ in range(length):
        node = node[1]
    state = _goto(node[0], head)
    return (state, node) if state else None


def _shift(node: tuple, token: str) -> tuple | None:
    """The node after a token, with the reductions of states that allow nothing else."""
    state = _goto(node[0], token)
    if not state:
        return None
    node = (state, node)
    while len(node[0]) == 1 and _complete(node[0]):
        node = _reduce(node, *_complete(node[0])[0])
    return node


def _accepts(node: tuple) -> bool:
    """Whether reductions bring all of the stack to the goal."""
    for head, length in _complete(node[0]):
        below = node
        for _ in range(length):
            below = below[1]
        if head == GOAL and below[1] is None:
            return True
        after = _reduce(node, head, length)
        if after is not None and after != node and _accepts(after):
            return True
    return False


def _stacks() -> tuple[list[dict[str, int]], list[bool]]:
    """All stacks the grammar can reach (left recursion keeps them few), as numbers: moves by token, and whether a parse may end."""
    start = (_FIRST, None)
    nodes, moves = {start: 0}, []
    for node in (order := [start]):
        moves.append({})
        for token in ("s", "u", "a"):
            after = _shift(node, token)
            if after is not None:
                if after not in nodes:
                    nodes[after] = len(nodes)
                    order.append(after)
                moves[-1][token] = nodes[after]
    return moves, [_accepts(node) for node in order]


MOVES, ENDS = _stacks()
START, END = 0, -1


def _inserted(node: int) -> list[tuple[int, int]]:
    """Nodes reached by inserting turns, with the least number of them."""
    found, more = {node: 0}, [node]
    for here in more:
        for token in GIVEN:
            after = MOVES[here].get(token)
            if after is not None and after not in found:
                found[after] = found[here] + 1
                more.append(after)
    return list(found.items())


INSERTED = [_inserted(n) for n in range(len(MOVES))]


class Row(NamedTuple):
    """What the grammar needs of a row: its role's letter, whether it must go, whether it is truncated; ``times`` rows that must go count as one."""

    letter: str
    gone: bool
    truncated: bool
    times: int = 1


Tops = dict[int, tuple[int, int]]


def _step(tops: Tops, row: Row) -> tuple[Tops, dict[int, tuple[int, str]]]:
    """Stack tops after a row: (cost, place among the audits); and of each the node before it and the letters since."""
    if row.gone:  # deletions come before insertions of the same cost, D being less than I
        return {n: (cost + DELETE * row.times, rank) for n, (cost, rank) in tops.items()}, {n: (n, "D" * row.times) for n in tops}
    best: dict[int, tuple[int, int, str, int]] = {}

    def offer(node: int | None, *way) -> None:
        if node is not None and (node not in best or way < best[node]):
            best[node] = way

    more = TRUNCATED * row.truncated
    for node, (cost, rank) in tops.items():
        for here, k in INSERTED[node]:
            now, letters = cost + INSERT * k, "I" * k
            offer(MOVES[here].get(row.letter), now + more, rank, letters + "K", node)
            offer(here, now + DELETE, rank, letters + "D", node)
            for token in GIVEN:
                if token != row.letter:
                    offer(MOVES[here].get(token), now + REROLE + more, rank, letters + "R", node)
    order = {way: i for i, way in enumerate(sorted({(w[1], w[2], w[3]) for w in best.values()}))}
    return {n: (w[0], order[w[1:]]) for n, w in best.items()}, {n: (w[3], w[2]) for n, w in best.items()}


def _ended(tops: Tops) -> tuple[int, int, int] | None:
    """Cost, node and inserts of the least complete parse."""
    least = min(((cost + INSERT * k, rank, "I" * k, node) for node, (cost, rank) in tops.items() for here, k in INSERTED[node] if ENDS[here]), default=None)
    return None if least is None else (least[0], least[3], len(least[2]))


def route(rows: Sequence[Row], entry: int = START, leave: int | None = None) -> tuple[int, list[str]]:
    """Cost of the least repair and its letters row by row (inserts before a row stand with it); the last item holds inserts at the end.

    With ``leave``, the parse ends at that node and the conversation goes on.
    """
    tops, ways = {entry: (0, 0)}, []
    for row in rows:
        tops, back = _step(tops, row)
        ways.append(back)
    cost, node, tail = (tops[leave][0], leave, 0) if leave is not None else _ended(tops)
    letters = ["I" * tail]
    for back in reversed(ways):
        node, some = back[node]
        letters.append(some)
    return cost, letters[::-1]


def passages(rows: Sequence[Row]) -> list[tuple[int, int, int, int]]:
    """Of a part of a conversation: entry, leave, cost, place among the audits of this entry."""
    out = []
    for entry in range(len(MOVES)):
        tops = {entry: (0, 0)}
        for row in rows:
            tops, _ = _step(tops, row)
        out += [(entry, n, *found) for n, found in tops.items()]
    return out


def joined(parts: Sequence[list[tuple[int, int, int, int]]]) -> list[tuple[int, int]]:
    """Entry and leave of each part in turn on the least repair; the last leaves at END."""
    tops, ways = {START: (0, 0)}, []
    for part in parts:
        best: dict[int, tuple[int, int, int, int]] = {}
        for entry, leave, cost, rank in part:
            if entry in tops:
                way = (tops[entry][0] + cost, tops[entry][1], rank, entry)
                best[leave] = min(best.get(leave, way), way)
        order = {way: i for i, way in enumerate(sorted({w[1:] for w in best.values()}))}
        tops = {n: (w[0], order[w[1:]]) for n, w in best.items()}
        ways.append({n: w[3] for n, w in best.items()})
    node, out = _ended(tops)[1], []
    for back in reversed(ways):
        out.append((back[node], node))
        node = back[node]
    out = out[::-1]
    return [*out[:-1], (out[-1][0], END)]


class Turn(NamedTuple):
    """``times`` equal rows of a conversation. ``first``: no row before has this role and text."""

    turn: int | None
    role: str
    text: str
    times: int
    first: bool


class Part(NamedTuple):
    """Counts of a part of a conversation, its cheapest edits, and the repaired turns as (edit, role, text)."""

    turns: tuple[int | None, int | None, int]
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    cost: int
    audit: str
    lines: list[tuple[str, str, str]]


def _faults(t: Turn) -> tuple[bool, bool, bool]:
    """Blank, truncated, and whether all of the rows must go."""
    body = t.text.rstrip(SPACES)
    return not body, bool(body) and body[-1] not in ".!?", not body or not t.first


def rows_of(turns: Sequence[Turn]) -> list[Row]:
    """The grammar's rows: of equal rows the first may stay, the others must go."""
    out = []
    for t in turns:
        blank, truncated, gone = _faults(t)
        letter = t.role[:1]
        if gone:
            out.append(Row(letter, True, False, t.times))
        else:
            out.append(Row(letter, False, truncated))
            if t.times > 1:
                out.append(Row(letter, True, False, t.times - 1))
    return out


def repaired(turns: Sequence[Turn], entry: int = START, leave: int = END, before: tuple[str | None, int | None] = (None, None), remembered=route) -> Part:
    """A part of a conversation, repaired; ``before`` holds the letter and the turn of the row before it. ``remembered`` may be a ``route`` that keeps what it found."""
    rows = rows_of(turns)
    find = remembered if len(rows) <= 64 else route
    cost, letters = find(tuple(rows), entry, None if leave == END else leave)
    blank = duplicate = truncated = illegal = distinct = 0
    letter, turn = before
    least = most = None
    for t in turns:
        is_blank, is_truncated, gone = _faults(t)
        blank += t.times * is_blank
        duplicate += 0 if is_blank else t.times - (not gone)
        truncated += is_truncated and not gone
        illegal += t.times - 1 + (letter is not None and (letter, t.role[:1]) not in LEGAL)
        letter = t.role[:1]
        if t.turn is not None:
            distinct += t.turn != turn
            turn = t.turn
            least, most = t.turn if least is None else least, t.turn
    # The nodes on the way say which roles are given.
    lines, node, at = [], entry, 0

    def give(edit: str, text: str) -> None:
        nonlocal node
        token = next(x for x in GIVEN if x in MOVES[node])
        lines.append((edit, GIVEN[token], text))
        node = MOVES[node][token]

    whole = []
    for t in turns:
        gone = _faults(t)[2]
        for _ in range(1 if gone or t.times == 1 else 2):
            for edit in letters[at]:
                if edit == "I":
                    give("I", "")
                elif edit == "R":
                    give("R", t.text)
                elif edit == "K":
                    lines.append(("K", t.role, t.text))
                    node = MOVES[node][t.role[:1]]
            whole.append(letters[at])
            at += 1
    for _ in letters[at]:
        give("I", "")
    return Part((least, most, distinct), blank, duplicate, truncated, illegal, cost, "".join(whole) + letters[at], lines)


_TURNS = "conv_id long, turn long, role string, text string, times long"
_PIECES = f"piece int, at long, {_TURNS}, edit string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
SUMMARY = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _batch(schema: str, rows: list[dict]) -> pa.RecordBatch:
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], _KINDS[k]) for n, k in fields], [n for n, _ in fields])


def _gaps(least: int | None, most: int | None, distinct: int) -> int:
    return 0 if least is None else most - least + 1 - distinct


def digest(lines: Sequence[tuple[str, str, str]]) -> str:
    return sha256("\n".join(f"{role}:{text}" for _, role, text in lines).encode()).hexdigest()


def _numbers(p: Part) -> dict:
    return {"blank": p.blank, "duplicate": p.duplicate, "truncated": p.truncated, "illegal": p.illegal, "cost": p.cost, "audit": p.audit}


def _sorted_rows(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[n].to_pylist() for n in names), strict=True)


def _inner(as_rows: bool):
    """Sorted rows of a piece: repairs of the conversations inside it, and the rows of its first and last ones as they are."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, at, out, held, conv, seen, some, first = TaskContext.get().partitionId(), 0, [], [], None, set(), False, True
        remembered = lru_cache(maxsize=1 << 14)(route)  # few kinds of rows, short conversations: most have been met

        def done() -> Iterator[dict]:
            p = repaired(held, remembered=remembered)
            if as_rows:
                for i, (edit, role, text) in enumerate(p.lines):
                    yield {"conv_id": conv, "turn": i, "role": role, "text": text, "edit": edit}
            else:
                yield {"conv_id": conv, "gaps": _gaps(*p.turns), **_numbers(p), "repaired_sha256": digest(p.lines)}

        def raw(t: Turn, place: int) -> dict:
            return {"piece": piece, "at": (piece << 33) + place, "conv_id": conv, "turn": t.turn, "role": t.role, "text": t.text, "times": t.times}

        for key, turn, role, text, times in _sorted_rows(batches, ("conv_id", "turn", "role", "text", "times")):
            if not some or key != conv:
                if some and not first:
                    out += done()
                first, some, conv, held, seen = not some, True, key, [], set()
            t = Turn(turn, role, text, times, (role, text) not in seen)
            if first:
                out.append(raw(t, at))
            else:
                seen.add((role, text))
                held.append(t)
            at += 1
            if len(out) >= 1000:
                yield _batch(_PIECES, out)
                out = []
        if held:
            out += [raw(t, at - len(held) + i) for i, t in enumerate(held)]
        yield _batch(_PIECES, out)

    return work


_PARTS = "piece int, conv_id long, entry int, leave int, cost long, rank int, letter string, turn long"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int | None, list[Turn]]]:
    """Sorted rows of pieces, by (piece, conversation)."""
    here, held = None, []
    for piece, conv, turn, role, text, times, first in _sorted_rows(batches, ("piece", "conv_id", "turn", "role", "text", "times", "first")):
        if here != (piece, conv):
            if held:
                yield *here, held
            here, held = (piece, conv), []
        held.append(Turn(turn, role, text, times, first))
    if held:
        yield *here, held


def _passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece, conv, turns in _parts(batches):
        last = {"piece": piece, "conv_id": conv, "letter": turns[-1].role[:1], "turn": turns[-1].turn}
        yield _batch(_PARTS, [last | {"entry": e, "leave": n, "cost": c, "rank": r} for e, n, c, r in passages(rows_of(turns))])


def _ways(found: list) -> dict[tuple[int, int | None], tuple[int, int, tuple]]:
    """Of each (piece, conversation): entry, leave, and the letter and turn before it."""
    by: dict[int | None, dict[int, list]] = defaultdict(lambda: defaultdict(list))
    for r in found:
        by[r["conv_id"]][r["piece"]].append(r)
    out = {}
    for conv, pieces in by.items():
        before: tuple = (None, None)
        order = sorted(pieces)
        for piece, way in zip(order, joined([[(r["entry"], r["leave"], r["cost"], r["rank"]) for r in pieces[p]] for p in order]), strict=True):
            out[piece, conv] = (*way, before)
            before = (pieces[piece][0]["letter"], pieces[piece][0]["turn"] if pieces[piece][0]["turn"] is not None else before[1])
    return out


_LINES = "piece int, at long, conv_id long, role string, text string, edit string, least long, most long, distinct long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _through(sent):
    """Repaired turns of every part (``at`` counts them), and one row of its counts (without an edit)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, conv, turns in _parts(batches):
            p = repaired(turns, *sent.value[piece, conv])
            here = {"piece": piece, "conv_id": conv}
            yield _batch(_LINES, [here | dict(zip(("least", "most", "distinct"), p.turns, strict=True)) | _numbers(p)])
            for s in range(0, len(p.lines), 1000):
                yield _batch(_LINES, [here | {"at": s + i, "edit": e, "role": r, "text": t} for i, (e, r, t) in enumerate(p.lines[s : s + 1000])])

    return work


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each conversation's lines, which come in order."""
    here, total, many, schema = None, None, 0, "conv_id long, repaired_sha256 string"
    for conv, role, text in _sorted_rows(batches, ("conv_id", "role", "text")):
        if total is None or conv != here:
            if total is not None:
                yield _batch(schema, [{"conv_id": here, "repaired_sha256": total.hexdigest()}])
            here, total, many = conv, sha256(), 0
        total.update(("\n" * (many > 0) + f"{role}:{text}").encode())
        many += 1
    if total is not None:
        yield _batch(schema, [{"conv_id": here, "repaired_sha256": total.hexdigest()}])


def _prepared(turns: DataFrame, as_rows: bool) -> tuple[DataFrame, DataFrame]:
    """What is finished inside pieces, and the parts of conversations at their edges (see _LINES)."""
    spark = turns.sparkSession
    text = F.coalesce("text", F.lit(" "))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("times"))
    by = ["conv_id", "turn", "role", "_head", "_hash"]
    rows = rows.withColumns({"_head": F.left("text", F.lit(64)), "_hash": F.xxhash64("text")}).repartitionByRange(*by).sortWithinPartitions(*by)
    made = written(rows.select("conv_id", "turn", "role", "text", "times").mapInArrow(_inner(as_rows), _PIECES), scratch_path(spark, "conversations"))
    edges = made.where(F.col("at").isNotNull()).select("piece", "at", *[c.split()[0] for c in _TURNS.split(", ")])
    firsts = edges.groupBy("conv_id", "role", F.sha2("text", 256)).agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    edges = written(edges.join(firsts, "at", "left").withColumn("first", F.coalesce("first", F.lit(False))), scratch_path(spark, "edges"))
    ordered = edges.repartition("piece").sortWithinPartitions("piece", "at")
    # Two conversations a piece, a few dozen numbers each.
    ways = spark.sparkContext.broadcast(_ways(ordered.mapInArrow(_passing, _PARTS).collect()))
    return made.where(F.col("at").isNull()), written(ordered.mapInArrow(_through(ways), _LINES), scratch_path(spark, "parts"))


def repairs(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``): SUMMARY's columns.

    Rows are taken by turn (nulls first), then by role, the first 64 characters of the text and a hash of it; equal rows are one after
    another. A null role or text is one space, a null conv_id a conversation of its own. No rows give no rows; further columns are not read.
    The hash of a conversation that runs over several pieces is made by one task that reads its lines in order, one at a time, since a hash has no other order.
    """
    inside, edges = _prepared(turns, False)
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    gaps = F.coalesce(F.max("most") - F.min("least") + 1 - F.sum("distinct"), F.lit(0)).alias("gaps")
    audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "audit"))), lambda x: x["audit"]), "").alias("audit")
    parts = edges.where(F.col("edit").isNull()).groupBy("conv_id").agg(gaps, *sums, audit).withColumnRenamed("conv_id", "_conv")
    lines = edges.where(F.col("edit").isNotNull()).select("conv_id", "piece", "at", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "piece", "at")
    hashes = lines.mapInArrow(_digests, "conv_id long, repaired_sha256 string")
    parts = parts.join(hashes, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    parts = parts.select(F.col("_conv").alias("conv_id"), *SUMMARY[1:-1], F.coalesce("repaired_sha256", F.lit(digest([]))).alias("repaired_sha256"))
    return inside.select(*SUMMARY).unionByName(parts)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The turns of all conversations after their repair: ``conv_id``, ``piece`` and ``place`` (both ascend in a conversation), ``role``, ``text``, ``edit`` (K, R or I)."""
    inside, edges = _prepared(turns, True)
    inside = inside.select("conv_id", F.lit(0).alias("piece"), F.col("turn").alias("place"), "role", "text", "edit")
    return inside.unionByName(edges.where(F.col("edit").isNotNull()).select("conv_id", "piece", F.col("at").alias("place"), "role", "text", "edit"))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of ``turns`` with planted faults, chosen by crc32 of conversation and turn: dropped, emptied, cut ends, repeated, role user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))

    def by(kind: int, then: Column, otherwise: Column) -> Column:
        return F.when(fault == kind, then).otherwise(otherwise)

    out = turns.where(fault != 0).select(
        "conv_id", "turn", by(4, F.lit("user"), role).alias("role"), by(1, F.lit(""), by(2, F.translate(text, ".!?", ""), text)).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    )
    return out.drop("_copy")


def damaged_and_repaired(turns: DataFrame) -> DataFrame:
    """``repairs`` of the damaged rows for every conv_id of ``turns``; one without rows after the damage has zeros, an empty audit and the hash of an empty string."""
    found = repairs(damaged(turns)).withColumnRenamed("conv_id", "_conv")
    every = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    out = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    none = {c: F.lit(0) for c in SUMMARY[1:-2]} | {"audit": F.lit(""), "repaired_sha256": F.lit(digest([]))}
    return out.select("conv_id", *[F.coalesce(F.col(c), none[c]).alias(c) for c in SUMMARY[1:]])
