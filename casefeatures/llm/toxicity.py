"""Toxicity by a weighted finite-state pattern grammar over clauses.

A lexical transducer turns words into classes (insult with the weight of its stem, target, negation, verb of report, and what threats are
made of). Five weighted machines read the classes: insults and threats find matches, negations scale what they reach, targets and reported
speech weigh the clause at its end. They are composed once into one machine; a clause's score is the sum of what its arcs weigh times what
its last state weighs, and a text's score comes from its clauses. So a bare word, a denied one and a quoted one differ. A threat is an intent,
an act of harm and whom it is meant for, or an act against "you" alone. Reported speech goes on over a colon and a quotation mark.

Insult stems are learned from labelled texts beside the listed ones: beginnings of words that stand nearly always in toxic texts, and
words shorter than a beginning, which count as whole words only. Listed ones match as words, with an ending of ``ENDINGS`` at most.
Texts are searched with one automaton of all stems and acts, and only clauses with a hit are read by the grammar.
"""

from __future__ import annotations

import math
import operator
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Hashable, Iterator
from typing import Any, NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefeatures.llm.frames import bounded_batches, with_fields
from casefeatures.llm.jaccard import sets_of
from casefeatures.sources.files import scratch_path, written

INSULTS = ("idiot", "moron", "loser", "scum", "pathetic", "worthless", "stupid", "disgusting", "trash", "clown", "imbecile", "dumbass")
ENDINGS = ("", "s", "es", "y", "ly", "ish", "ity", "ness", "ic", "ical", "ically", "ally", "bag", "bags", "er", "est", "ed", "ing")
#: Words of each class the grammar knows, in English, German, French and Spanish.
CLASSES = {
    "you": ("you", "yourself", "u", "dich", "euch", "te", "toi", "vous", "ti"),
    "others": ("your", "ur", "him", "her", "them", "people", "everyone", "ihn", "ihnen", "dein", "deine", "tes"),
    "subject": ("he", "she", "they", "you're", "youre", "du", "ihr", "tu", "usted", "ustedes"),
    "negation": ("not", "no", "never", "isn't", "aren't", "don't", "won't", "without", "nor", "nicht", "kein", "keine", "nie", "pas", "jamais", "nunca"),
    "report": ("said", "says", "called", "calls", "wrote", "quoted", "claimed", "allegedly", "sagte", "schrieb", "nannte", "angeblich", "dijo"),
    "self": ("i", "we", "ich", "wir", "je", "nous", "yo"),
    "intent": ("will", "gonna", "going", "shall", "werde", "werden", "vais", "allons", "voy", "vamos"),
    "oath": ("i'll", "we'll"),
    "harm": ("kill", "hurt", "destroy", "beat", "murder", "stab", "shoot", "strangle", "crush", "töten", "umbringen", "tuer", "matar"),
    "make": ("make",),
    "pay": ("pay",),
}
#: Labelled texts that are learned from, about; stems kept, at most; lengths of a stem.
SAMPLE, MAX_STEMS, STEM = 20_000, 5000, (4, 5, 6, 7, 8)
#: A stem needs so many toxic texts, such odds against the others, and such evidence (log-likelihood ratio).
LEAST_TEXTS, LEAST_ODDS, LEAST_EVIDENCE = 8, 20.0, 40.0
#: Weight of a listed stem, factors of the machines, words a negation reaches.
LISTED, NAMED, DENIED, QUOTED, REACH = 4.0, 1.25, 0.4, 0.6, 3
#: Characters before a colon or around a quotation that are looked at for a verb of report.
NEAR = 200
PREDICT = 0.3
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_END = re.compile(r"[.!?;:\n]")
_CLOSING = {'"': '"', "“": "”", "„": "“", "«": "»"}
_MARKS = re.compile('["“”„«»\n]')
#: Class of a word; what is between words is a break if it is more than white space.
_CLASS = {word: name for name, words in CLASSES.items() for word in words}
_SYMBOLS = (*CLASSES, "insult", "other", "break")
_LISTED, _ENDINGS = frozenset(INSULTS), frozenset(ENDINGS)


class Machine(NamedTuple):
    """A weighted transducer over word classes: per state and class the next state and the arc's weight, and what a state weighs at the end."""

    start: Hashable
    arcs: dict[Hashable, dict[str, tuple[Hashable, float]]]
    final: dict[Hashable, float]


def machine(start: Hashable, step: Callable[[Any, str], tuple[Hashable, float]], final: Callable[[Any], float] = lambda _: 1.0) -> Machine:
    """The machine of all states that ``step`` leads to."""
    arcs, todo = {}, [start]
    while todo:
        state = todo.pop()
        if state not in arcs:
            arcs[state] = {symbol: step(state, symbol) for symbol in _SYMBOLS}
            todo += [after for after, _ in arcs[state].values()]
    return Machine(start, arcs, {state: final(state) for state in arcs})


def composed(a: Machine, b: Machine, weigh: Callable[[float, float], float] = operator.mul) -> Machine:
    """Both machines over the same classes, weights of arcs multiplied (or added, for a union of matches), those of ends multiplied."""

    def step(state: tuple, symbol: str) -> tuple[Hashable, float]:
        (x, v), (y, w) = a.arcs[state[0]][symbol], b.arcs[state[1]][symbol]
        return (x, y), weigh(v, w)

    return machine((a.start, b.start), step, lambda state: a.final[state[0]] * b.final[state[1]])


def _threat(state: tuple[str, int], symbol: str) -> tuple[tuple[str, int], float]:
    """Intent, act, target ("i will kill him", "ich werde dich töten"), or an act against "you" ("kill you", "make you pay")."""
    kind, left = state
    start = ("start", 0)
    met = symbol == "you" and kind in ("bare", "meant") or symbol == "others" and kind == "meant"
    if met or kind == "aimed" and symbol == "harm" or kind == "made" and symbol == "pay":
        return start, LISTED
    if symbol == "break":
        return start, 0.0
    if symbol == "oath" or kind == "self" and symbol == "intent":
        return ("intent", REACH), 0.0
    if symbol == "self":
        return ("self", REACH), 0.0
    if symbol == "harm":
        return ("meant" if kind == "intent" else "bare", 0), 0.0
    if symbol == "make":
        return ("make", 0), 0.0
    if kind == "make" and symbol in ("you", "others"):
        return ("made", 0), 0.0
    if kind == "intent" and left == REACH and symbol in ("you", "others"):
        return ("aimed", 0), 0.0
    return ((kind, left - 1) if kind in ("self", "intent") and left > 1 else start), 0.0


def _denied(left: int, symbol: str) -> tuple[int, float]:
    if symbol == "break":
        return left, 1.0
    return (REACH if symbol == "negation" else max(0, left - 1)), (DENIED if left else 1.0)


def _seen(*symbols: str) -> Callable[[bool, str], tuple[bool, float]]:
    return lambda seen, symbol: (seen or symbol in symbols, 1.0)


def grammar() -> Machine:
    """Insults and threats united, composed with negation, target and reported speech; states are numbers, 0 the first."""
    insult = machine(0, lambda state, symbol: (state, float(symbol == "insult")))
    out = composed(insult, machine(("start", 0), _threat), operator.add)
    out = composed(out, machine(0, _denied))
    out = composed(out, machine(False, _seen("you", "others", "subject"), lambda seen: NAMED if seen else 1.0))
    out = composed(out, machine(False, _seen("report"), lambda seen: QUOTED if seen else 1.0))
    number = {state: i for i, state in enumerate([out.start, *(s for s in out.arcs if s != out.start)])}
    arcs = {number[s]: {symbol: (number[after], w) for symbol, (after, w) in row.items()} for s, row in out.arcs.items()}
    return Machine(0, arcs, {number[s]: w for s, w in out.final.items()})


_GRAMMAR = grammar()


class Grammar(NamedTuple):
    """Stem to weight, and the coefficients of a text's features."""

    stems: dict[str, float]
    coefficients: tuple[float, ...]


def lexical(word: str, stems: dict[str, float], lengths: tuple[int, ...]) -> tuple[str, float]:
    """Class and weight of a word in lower case: an insult weighs as much as its heaviest stem."""
    weight = 0.0
    for n in lengths:
        if n == len(word) or STEM[0] <= n < len(word):
            stem = word[:n]
            if stem in stems and (stem not in _LISTED or word[n:].replace("’", "'").removesuffix("'s") in _ENDINGS):
                weight = max(weight, stems[stem])
    return ("insult", weight) if weight else (_CLASS.get(word.replace("’", "'"), "other"), 1.0)


def clause_score(clause: str, stems: dict[str, float], lengths: tuple[int, ...], reported: bool = False) -> float:
    """What the grammar makes of a clause in lower case. ``reported``: by what stands around it."""
    arcs, total, done = _GRAMMAR.arcs, 0.0, 0
    state = arcs[0]["report"][0] if reported else 0
    for found in _WORD.finditer(clause):
        if clause[done : found.start()].strip():
            state = arcs[state]["break"][0]
        symbol, weight = lexical(found[0], stems, lengths)
        state, arc = arcs[state][symbol]
        total += arc * weight
        done = found.end()
    return total * _GRAMMAR.final[state]


def _reports(piece: str) -> bool:
    return any(_CLASS.get(w) == "report" for w in _WORD.findall(piece))


def _quotations(low: str) -> tuple[list[int], list[int]]:
    """Where quotations begin and where each ends, a line's end closing them."""
    begins, ends, mark = [], [], ""
    for found in _MARKS.finditer(low):
        c = found[0]
        if not mark and c in _CLOSING:
            begins.append(found.start())
            mark = _CLOSING[c]
        elif mark and (c in mark or c == "\n"):
            ends.append(found.start())
            mark = ""
    return begins, [*ends, *[len(low)] * (len(begins) - len(ends))]


def _reported_around(low: str, a: int, b: int, quotations: tuple[list[int], list[int]]) -> bool:
    """Whether the clause stands after a colon or in a quotation, and a verb of report in the clause before that, or in the one after the quotation."""

    def before(end: int) -> bool:
        piece = low[max(0, end - NEAR) : end].rstrip(" ,:\t")
        return _reports(_END.split(piece)[-1])

    def after(start: int) -> bool:
        piece = low[start : start + NEAR]
        return _reports(_END.split(piece)[0])

    if a and low[a - 1] == ":" and before(a - 1):
        return True
    begins, ends = quotations
    i = bisect_left(begins, b) - 1  # the last that begins before the clause ends
    return i >= 0 and ends[i] >= a and (before(begins[i]) or after(ends[i] + 1))


def _automaton(stems: dict[str, float]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for stem in {*stems, *CLASSES["harm"], *CLASSES["make"]}:
        found.add_word(stem, len(stem))
    found.make_automaton()
    return found


def features(text: str, stems: dict[str, float], automaton: ahocorasick.Automaton, lengths: tuple[int, ...]) -> tuple[float, float, float]:
    """Of a text's clauses: the best score, the sum's logarithm, and the number of matched clauses per thousand characters."""
    low = text.lower()
    spans: list[tuple[int, int]] = []
    for end, n in automaton.iter(low):
        start = end - n + 1
        if start and (low[start - 1].isalpha() or low[start - 1] in "'’"):
            continue  # within a word
        if n < STEM[0] and _WORD.match(low, start).end() > end + 1:
            continue  # a short word is no beginning
        if spans and start < spans[-1][1]:
            continue
        after = _END.search(low, end)
        after = after.start() if after else len(low)
        begin = spans[-1][1] if spans else 0
        begin = max(begin, *(low.rfind(c, begin, start) + 1 for c in ".!?;:\n"))
        spans.append((begin, after))
    quotations = _quotations(low) if spans else ([], [])
    scores = [s for a, b in spans if (s := clause_score(low[a:b], stems, lengths, _reported_around(low, a, b, quotations))) > 0]
    if not scores:
        return 0.0, 0.0, 0.0
    return max(scores), math.log1p(sum(scores)), 1000 * len(scores) / max(100, len(low))


def _evidence(a: np.ndarray, b: np.ndarray, toxic: int, other: int) -> tuple[np.ndarray, np.ndarray]:
    """Odds ratio and log-likelihood ratio of stems in ``a`` of the toxic and ``b`` of the other texts."""
    odds = ((a + 0.5) / (toxic - a + 0.5)) / ((b + 0.5) / (other - b + 0.5))
    n, share = toxic + other, (a + b) / (toxic + other)

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0)

    g = 2 * (part(a, toxic * share) + part(b, other * share) + part(toxic - a, toxic * (1 - share)) + part(other - b, other * (1 - share)))
    return odds, np.where(n > 0, g, 0)


def _drawn(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``text``, ``toxic`` of about ``sample`` labelled texts drawn by hash, of near copies (equal smallest shingle) one."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    share = min(1.0, sample / n) if n else 0.0
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share * 1_000_000)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = [int(x[0].view(np.int64)) if len(x) else 0 for _, x in sets_of(batch.column(0))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64())], ["text", "toxic", "least"])

    rows = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(drawn) if n * share <= 4 * sample else drawn, "doc_id")
    rows = rows.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(named, "text string, toxic int, least long")
    return written(rows.dropDuplicates(["least"]).drop("least"), scratch_path(docs.sparkSession, "labelled"))


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Grammar:
    """Stems and coefficients from labelled texts. Without a label of both kinds, the listed stems and plain coefficients."""
    rows = _drawn(docs, labels, sample)
    listed = dict.fromkeys(INSULTS, LISTED)
    kinds = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, other = kinds.get(1, 0), kinds.get(0, 0)
    if not toxic or not other:
        return Grammar(listed, (-3.0, 1.0, 0.0, 0.0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (Counter(), Counter())
            for text, kind in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                whole = set(_WORD.findall(text.lower()))
                found[kind == 1].update({w[:n] for w in whole for n in STEM if n <= len(w)} | {w for w in whole if len(w) < STEM[0]})
            stems = list(found[1])
            yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array([found[1][s] for s in stems], pa.int64()), pa.array([0] * len(stems), pa.int64())], ["stem", "a", "b"])
            stems = list(found[0])
            yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array([0] * len(stems), pa.int64()), pa.array([found[0][s] for s in stems], pa.int64())], ["stem", "a", "b"])

    counts = rows.mapInArrow(count, "stem string, a long, b long").groupBy("stem").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    # What is surely rarer than the least evidence asks for stays on the executors.
    counts = counts.where((F.col("a") >= LEAST_TEXTS) & (F.col("a") * other > F.col("b") * toxic * 5)).orderBy(F.desc("a"), "stem").limit(20 * MAX_STEMS).toPandas()
    odds, g = _evidence(counts["a"].to_numpy(float), counts["b"].to_numpy(float), toxic, other)
    counts = counts.assign(odds=odds, g=g)[(odds >= LEAST_ODDS) & (g >= LEAST_EVIDENCE)]
    stems = dict(listed)
    counts = counts.sort_values(["g", "stem"], ascending=[False, True])[:MAX_STEMS]  # those of most evidence
    for stem, weight in sorted(zip(counts["stem"], np.log(counts["odds"]), strict=True), key=lambda x: (len(x[0]), x[0])):
        if not any(stem[:n] in stems for n in range(min(STEM[0], len(stem)), len(stem) + 1)):
            stems[stem] = float(weight)
    # A longer stem is no evidence of its own where a shorter one stands.
    x = _features(rows.select("text", "toxic"), stems)
    return Grammar(stems, _fitted(x[:, 1:], x[:, 0]))


def _features(rows: DataFrame, stems: dict[str, float]) -> np.ndarray:
    """Label and features of every sampled text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, lengths = _automaton(stems), tuple(sorted({len(s) for s in stems}))
        for batch in batches:
            x = [features(t, stems, automaton, lengths) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.float64()), *(pa.array([v[i] for v in x], pa.float64()) for i in range(3))], ["y", "a", "b", "c"])

    return rows.mapInArrow(work, "y double, a double, b double, c double").toPandas().to_numpy(float)


def _fitted(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> tuple[float, ...]:
    """Logistic regression by Newton's method, with a ridge on all but the constant."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, penalty = np.zeros(x.shape[1]), np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(b) for b in beta)


def scored(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """Every row and column of ``docs`` with ``_score`` (0 to 1). Null and empty texts have the score of a text without a match. Whole texts count."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        automaton, lengths = _automaton(g.stems), tuple(sorted({len(s) for s in g.stems}))
        beta = np.array(g.coefficients)
        for batch in batches:
            x = np.array([(1.0, *features(t or "", g.stems, automaton, lengths)) for t in batch.column(at).to_pylist()]).reshape(-1, 4)
            score = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, "_score"])

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(work, with_fields(docs, _score="double"))


def held_out(fold: int = 2, of: int = 4) -> F.Column:
    """Whether crc32 of the doc_id as text leaves this remainder; a null id is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == fold, F.lit(True))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` (score of at least 0.3) of every row, learned from labels of rows not held out.

    Null and empty texts have the score of a text without a match; rows of null doc_id are held out; repeated rows are scored alike; null labels
    and labels of a null doc_id are left out; of several labels of a doc_id the largest counts; without labels of both kinds the listed stems and plain coefficients are used; no rows give no rows. Further columns are not read.
    """
    grammar = learned(docs.where(~held_out()), labels, sample)
    found = scored(docs.select("doc_id", "text"), grammar)
    return found.select("doc_id", held_out().alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= PREDICT).cast("int").alias("predicted"))
