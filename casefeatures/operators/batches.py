"""Groups of sorted rows reduced in Arrow batches.

Hundreds of aggregates in one ``agg`` cost a virtual call or two each, for every row. Here Spark deals the rows by key and sorts them, tasks hand
them on in batches, and every reduction is one numpy operation over a column of a batch. Aggregates are written as before
(``operators.aggregates``): while ``collected`` is open, the basic ones give the name of a reduced column in place of a Spark aggregate, and
what is made of them becomes an expression over reduced columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefeatures.functions.schema import FLOAT_TYPES, INTEGER_TYPES, quoted

# Rows that are worked on at a time, at least; a group is never divided.
ROWS_AT_ONCE = 10_000
# Values of a group that a task's Python holds, at most: rows times columns. Larger groups are hot.
MAX_VALUES = 32_000_000
_PLACE, _KNOWN, _DOUBLES = "_place", "_known", "_doubles"
_NUMBERS = (*INTEGER_TYPES, *FLOAT_TYPES)
_ORDERED = (*_NUMBERS, T.DateType, T.BooleanType)
# What each kind of reduction takes, and the type it gives (None: that of its input).
KINDS = {
    "count": ((*_ORDERED, T.StringType), "bigint"),
    "count_if": ((T.BooleanType,), "bigint"),
    "sum": (_NUMBERS, None),
    "mean": (_NUMBERS, "double"),
    "std": (_NUMBERS, "double"),
    "median": (_NUMBERS, "double"),
    "min": (_ORDERED, None),
    "max": (_ORDERED, None),
    "mode": (_ORDERED, None),
    "first": ((*_ORDERED, T.StringType), None),
    "last": ((*_ORDERED, T.StringType), None),
    "first_nonnull": ((*_ORDERED, T.StringType), None),
    "last_nonnull": ((*_ORDERED, T.StringType), None),
    "tail_mean": (_NUMBERS, "double"),
    "tail_max": (_NUMBERS, None),
    "diffmean": (_NUMBERS, "double"),
    "diffstd": (_NUMBERS, "double"),
    "difflast": (_NUMBERS, None),
    "maxidx": (_NUMBERS, "bigint"),
}


@dataclass
class Collected:
    """Columns of rows, by the name they get, and the reductions of each: kind and name of the result."""

    inputs: dict[str, Column] = field(default_factory=dict)
    reductions: dict[str, dict[str, str]] = field(default_factory=dict)
    _names: dict[str, str] = field(default_factory=dict)

    def add(self, kind: str, c: Column) -> Column:
        name = self._names.setdefault(str(c), f"_in{len(self._names)}")
        self.inputs.setdefault(name, c)
        return quoted(self.reductions.setdefault(name, {}).setdefault(kind, f"{name}_{kind}"))


_OPEN: ContextVar[Collected | None] = ContextVar("collected", default=None)


@contextmanager
def collected() -> Iterator[Collected]:
    """Basic aggregates that are made inside are noted, not made."""
    token = _OPEN.set(Collected())
    try:
        yield _OPEN.get()
    finally:
        _OPEN.reset(token)


def reduction(kind: str, c: Column, plain: Callable[[], Column]) -> Column:
    """A basic aggregate of ``c``: noted if ``collected`` is open, else Spark's own."""
    noted = _OPEN.get()
    return plain() if noted is None else noted.add(kind, c)


def _types(rows: T.StructType, wanted: Mapping[str, Mapping[str, str]]) -> list[T.StructField] | None:
    """The fields of all results; None where a column is of a type that is not reduced here."""
    out = []
    for name, kinds in wanted.items():
        own = rows[name].dataType
        for kind, result in kinds.items():
            takes, gives = KINDS[kind]
            if not isinstance(own, takes):
                return None
            if kind == "sum":
                gives = "bigint" if isinstance(own, INTEGER_TYPES) else "double"
            out.append(T.StructField(result, own if gives is None else {"bigint": T.LongType(), "double": T.DoubleType()}[gives]))
    return out


def reduce_batches(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], inputs: Mapping[str, Column], reductions: Mapping[str, Mapping[str, str]], tail: int
) -> DataFrame | None:
    """One row per key: the keys and every result of ``reductions`` (input: kind: result), or None where a type is not reduced here.

    Rows are dealt by key and numbered in their order; the number 1 begins a group. Rows without a place in the order count as the window puts
    them, first, and are no first or last value.
    """
    by = [quoted(k) for k in keys]
    known = quoted(order[0]).isNotNull().alias(_KNOWN)
    kinds = df.select(*[c.alias(n) for n, c in inputs.items()]).schema
    fields = _types(kinds, reductions)
    if fields is None:
        return None
    place = F.row_number().over(W.partitionBy(*by).orderBy(*[quoted(o) for o in order])).alias(_PLACE)
    # Doubles go as one array: Spark looks at the size of a batch after every row, column by column.
    doubles = [n for n in inputs if isinstance(kinds[n].dataType, T.DoubleType)]
    others = [c.alias(n) for n, c in inputs.items() if n not in set(doubles)]
    packed = F.array(*[inputs[n] for n in doubles]).cast("array<double>").alias(_DOUBLES)
    rows = df.select("*", place).select(*by, _PLACE, known, packed, *others)
    schema = T.StructType([*[df.schema[k] for k in keys], *fields])
    return rows.mapInArrow(_reducer(list(keys), {n: dict(k) for n, k in reductions.items()}, doubles, tail, ROWS_AT_ONCE), schema)


def _reducer(keys: list[str], reductions: dict[str, dict[str, str]], doubles: list[str], tail: int, at_least: int) -> Callable:
    """The function of a task: batches of sorted rows to batches of reduced groups. ``doubles`` are the columns held in one array. It travels by value."""

    def groups(batches):
        import numpy as np
        import pyarrow as pa

        waiting, begun = [], 0
        for batch in batches:
            first = np.flatnonzero(batch.column(len(keys)).to_numpy(zero_copy_only=False) == 1)
            if len(first) and begun + first[-1] >= at_least:
                yield reduced(pa.Table.from_batches([*waiting, batch.slice(0, int(first[-1]))]))
                waiting, begun = [], 0
                batch = batch.slice(int(first[-1]))
            waiting.append(batch)
            begun += batch.num_rows
        if begun:
            yield reduced(pa.Table.from_batches(waiting))

    def reduced(table):
        import numpy as np
        import pyarrow as pa

        begins = np.flatnonzero(table.column("_place").to_numpy() == 1)
        n, rows = len(begins), table.num_rows
        group = np.zeros(rows, np.int64)
        group[begins[1:]] = 1
        group = np.cumsum(group)
        known = table.column("_known").to_numpy()
        all_known = bool(known.all())
        ends = np.append(begins[1:], rows)

        def spread(some, values, zero=0):
            out = np.full(n, zero, values.dtype)
            out[some] = values
            return out

        def spans(at):
            counts = np.bincount(group[at], minlength=n)
            upto = np.cumsum(counts)
            return counts, upto - counts, upto, counts > 0

        packed = table.column("_doubles").combine_chunks()
        packed = (packed.chunk(0) if isinstance(packed, pa.ChunkedArray) else packed).flatten()
        numbers = packed.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(rows, len(doubles))
        absent = packed.is_null().to_numpy(zero_copy_only=False).reshape(rows, len(doubles))
        where = {name: i for i, name in enumerate(doubles)}

        def values_of(name):
            if name in where:
                return pa.array(np.ascontiguousarray(numbers[:, where[name]]), mask=np.ascontiguousarray(absent[:, where[name]]))
            whole = table.column(name).combine_chunks()
            return whole.chunk(0) if isinstance(whole, pa.ChunkedArray) else whole

        def column(whole, kinds):
            kind = whole.type
            text, whole_numbers = pa.types.is_string(kind) or pa.types.is_large_string(kind), pa.types.is_integer(kind) or pa.types.is_date(kind) or pa.types.is_boolean(kind)
            there = np.ones(rows, bool) if not whole.null_count else whole.is_valid().to_numpy(zero_copy_only=False)
            at = np.flatnonzero(there)
            counts, low, high, some = spans(at)
            if not text:
                plain = whole.cast(pa.int32()) if pa.types.is_date(kind) else whole
                v = plain.drop_null().to_numpy(zero_copy_only=False)
                v = v.astype(np.int64) if whole_numbers else v.astype(np.float64)
            done = {}

            def as_own(values, there):
                """Values in the type of the column."""
                made = pa.array(values.astype(np.int64), pa.int64(), mask=~there) if whole_numbers else pa.array(values, pa.float64(), mask=~there)
                return made.cast(pa.int32()).cast(kind) if pa.types.is_date(kind) else made.cast(kind)

            def rows_at(index, there):
                return whole.take(pa.array(index, pa.int64(), mask=~there))

            def total(kind_of_number):
                return spread(some, np.add.reduceat(v.astype(kind_of_number), low[some]) if some.any() else np.zeros(0, kind_of_number))

            def spread_of(values, counts, low, sums):
                """Standard deviation of each group, from the distances to its mean."""
                enough = counts > 1
                far = values - np.repeat(sums / np.maximum(counts, 1), counts)
                squares = np.zeros(n)
                if (counts > 0).any():
                    squares[counts > 0] = np.add.reduceat(far * far, low[counts > 0])
                return pa.array(np.sqrt(squares / np.maximum(counts - 1, 1)), mask=~enough)

            def steps():
                """Steps from value to value within the groups."""
                if "steps" not in done:
                    inside = group[at][1:] == group[at][:-1]
                    step = (v[1:] - v[:-1])[inside]
                    number = np.maximum(counts - 1, 0)
                    begin = np.cumsum(number) - number
                    sums = np.zeros(n)
                    if len(step):
                        sums[number > 0] = np.add.reduceat(step.astype(np.float64), begin[number > 0])
                    done["steps"] = step, number, begin, sums
                return done["steps"]

            def last_values(back):
                """Each group's value so many before its last, and which groups have one."""
                has = counts > back
                return spread(has, v[high[has] - 1 - back]), has

            def in_order():
                """Rows of values by group and value."""
                if "sorted" not in done:
                    done["sorted"] = np.lexsort((v, group[at]))
                return done["sorted"]

            def result(what):
                if what == "count":
                    return pa.array(counts, pa.int64())
                if what == "count_if":
                    return pa.array(total(np.int64), pa.int64())
                if what == "sum":
                    return pa.array(total(np.int64 if whole_numbers else np.float64), mask=~some)
                if what == "mean":
                    return pa.array(total(np.float64) / np.maximum(counts, 1), mask=~some)
                if what == "std":
                    return spread_of(v.astype(np.float64), counts, low, total(np.float64))
                if what in ("min", "max"):
                    # Spark's NaN is above all numbers.
                    best = np.fmin if what == "min" else np.maximum
                    return as_own(spread(some, best.reduceat(v, low[some]) if some.any() else v[:0]), some)
                if what in ("first", "last"):
                    off = np.add.reduceat((~known).astype(np.int64), begins)
                    has = off < ends - begins
                    return rows_at(np.where(has, begins + off if what == "first" else ends - 1, 0), has)
                if what in ("first_nonnull", "last_nonnull"):
                    mine = at if all_known else at[known[at]]
                    _, lowest, highest, has = (counts, low, high, some) if all_known else spans(mine)
                    return rows_at(spread(has, mine[lowest[has] if what == "first_nonnull" else highest[has] - 1]), has)
                if what == "median":
                    ranked = v[in_order()].astype(np.float64)
                    a, b = ranked[low[some] + (counts[some] - 1) // 2], ranked[low[some] + counts[some] // 2]
                    return pa.array(spread(some, np.where(a == b, a, 0.5 * a + 0.5 * b)), mask=~some)
                if what == "mode":
                    by = in_order()
                    value, of_group = v[by], group[at][by]
                    if not len(by):
                        return rows_at(np.zeros(n, np.int64), some)
                    run = np.flatnonzero(np.append(True, (value[1:] != value[:-1]) | (of_group[1:] != of_group[:-1])))
                    length, owner = np.diff(np.append(run, len(by))), of_group[run]
                    begin = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                    most = np.maximum.reduceat(length, begin)
                    best = np.flatnonzero(length == np.repeat(most, np.diff(np.append(begin, len(run)))))
                    best = best[np.append(True, owner[best][1:] != owner[best][:-1])]
                    return rows_at(spread(some, at[by[run[best]]]), some)
                if what == "tail_mean":
                    sums = np.zeros(n)
                    for back in reversed(range(tail)):
                        values, has = last_values(back)
                        sums[has] += values[has]
                    return pa.array(sums / np.clip(counts, 1, tail), mask=~some)
                if what == "tail_max":
                    out, _ = last_values(0)
                    for back in range(1, tail):
                        values, has = last_values(back)
                        out[has] = np.maximum(out[has], values[has])
                    return as_own(out, some)
                if what == "maxidx":
                    above = np.flatnonzero(v > 0)
                    _, lowest, _, has = spans(at[above])
                    if not len(above):
                        return pa.array(np.zeros(n, np.int64), mask=~has)
                    top = spread(has, np.maximum.reduceat(v[above], lowest[has]))
                    owner = group[at][above]
                    best = np.flatnonzero(v[above] == top[owner])
                    best = best[np.append(True, owner[best][1:] != owner[best][:-1])]
                    return pa.array(spread(has, best - lowest[has]), pa.int64(), mask=~has)
                step, number, begin, sums = steps()
                if what == "diffmean":
                    return pa.array(sums / np.maximum(number, 1), mask=number == 0)
                if what == "diffstd":
                    return spread_of(step.astype(np.float64), number, begin, sums)
                has = number > 0
                return as_own(spread(has, step[(begin + number)[has] - 1]), has)

            return {name: result(what) for what, name in kinds.items()}

        first = pa.array(begins, pa.int64())
        out = {k: table.column(k).take(first).combine_chunks() for k in keys}
        with np.errstate(all="ignore"):
            for name, kinds in reductions.items():
                out |= column(values_of(name), kinds)
        return pa.RecordBatch.from_arrays([a.chunk(0) if isinstance(a, pa.ChunkedArray) else a for a in out.values()], names=list(out))

    return groups
