"""Features of the sequence of a group's values, in the order of an explicit key.

Sorted rows are reduced in batches (``batch_features``). Next to aggregates of other makes (``group_features``), and for hot groups, marks are
put on each row by windows, and one ``groupBy`` on the same key reduces them, so that both use one shuffle and one sort. All columns share three window frames: the rows before (last non-null value), the
rows so far (running counts) and the whole group (totals). Hot groups get the same marks piece by piece.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefeatures.functions.schema import quoted
from casefeatures.operators.batches import MAX_VALUES, collected, reduce_batches
from casefeatures.operators.hotgroups import (
    PIECE,
    Split,
    exact_medians,
    in_pieces,
    join_pieces,
    rows_per_task,
    split_hot,
)

TAIL = 3
KINDS = ("tail_mean", "diffmean", "diffstd", "difflast")


def _listed(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def _window(part: Sequence[str], order: Sequence[str], rows: str) -> str:
    return f"OVER (PARTITION BY {_listed(part)} ORDER BY {_listed(order)} ROWS BETWEEN UNBOUNDED PRECEDING AND {rows})"


def _marks(df: DataFrame, part: Sequence[str], order: Sequence[str], columns: Sequence[str], peaks: Sequence[str]) -> DataFrame:
    before, upto = _window(part, order, "1 PRECEDING"), _window(part, order, "CURRENT ROW")
    whole = _window(part, order, "UNBOUNDED FOLLOWING")
    return df.selectExpr(
        "*",
        *[f"last(`{c}`, true) {before} AS `_prev_{c}`" for c in columns],
        *[f"count(`{c}`) {whole} AS `_all_{c}`" for c in columns],
        *[f"count(`{c}`) {upto} AS `_upto_{c}`" for c in columns],
        *[f"count(CASE WHEN `{c}` > 0 THEN 1 END) {upto} AS `_place_{c}`" for c in peaks],
    )


def _carry(pieces: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], peaks: Sequence[str]) -> DataFrame:
    """Per piece: the last value before it, the values after it, the positive values before it."""
    place = f"struct({_listed(order)})"
    totals = pieces.groupBy(*[quoted(k) for k in keys], PIECE).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.expr(f"max_by(`{c}`, CASE WHEN `{c}` IS NOT NULL THEN {place} END) AS `_end_{c}`") for c in columns],
        *[F.expr(f"count(`{c}`) AS `_count_{c}`") for c in columns],
        *[F.expr(f"count(CASE WHEN `{c}` > 0 THEN 1 END) AS `_pos_{c}`") for c in peaks],
    )
    before, upto = _window(keys, [PIECE], "1 PRECEDING"), _window(keys, [PIECE], "CURRENT ROW")
    whole = _window(keys, [PIECE], "UNBOUNDED FOLLOWING")
    return totals.selectExpr(
        *[f"`{k}`" for k in (*keys, PIECE)],
        *[f"last(`_end_{c}`, true) {before} AS `_from_{c}`" for c in columns],
        *[f"sum(`_count_{c}`) {whole} - sum(`_count_{c}`) {upto} AS `_after_{c}`" for c in columns],
        *[f"coalesce(sum(`_pos_{c}`) {before}, 0) AS `_ahead_{c}`" for c in peaks],
    )


def with_marks(split: Split, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], peaks: Sequence[str] = ()) -> DataFrame:
    """Rows with, per column, ``_prev_`` (the last value before), ``_left_`` (how many values follow), ``_place_``."""
    keep = [f"`{c}`" for c in (split.cold if split.cold is not None else split.hot).columns]
    out = None
    if split.cold is not None:
        out = _marks(split.cold, keys, order, columns, peaks).selectExpr(
            *keep,
            *[f"`_prev_{c}`" for c in columns],
            *[f"`_all_{c}` - `_upto_{c}` AS `_left_{c}`" for c in columns],
            *[f"`_place_{c}`" for c in peaks],
        )
    if split.hot is not None:
        pieces = in_pieces(split, keys, order)
        rows = join_pieces(pieces, _carry(pieces, keys, order, columns, peaks), keys)
        hot = _marks(rows, [*keys, PIECE], order, columns, peaks).selectExpr(
            *keep,
            *[f"coalesce(`_prev_{c}`, `_from_{c}`) AS `_prev_{c}`" for c in columns],
            *[f"`_all_{c}` - `_upto_{c}` + `_after_{c}` AS `_left_{c}`" for c in columns],
            *[f"`_place_{c}` + `_ahead_{c}` AS `_place_{c}`" for c in peaks],
        )
        out = hot if out is None else out.unionByName(hot)
    return out


def sequence_aggs(columns: Sequence[str], kinds: Sequence[str] = KINDS, tail: int = TAIL) -> list[Column]:
    """Reduce marked rows: mean and maximum of the last values, mean, spread and last of the steps."""
    forms = {
        "tail_mean": "avg(CASE WHEN `_left_{c}` < {tail} THEN `{c}` END)",
        "tail_max": "max(CASE WHEN `_left_{c}` < {tail} THEN `{c}` END)",
        "diffmean": "avg(`{c}` - `_prev_{c}`)",
        "diffstd": "stddev_samp(`{c}` - `_prev_{c}`)",
        "difflast": "max(CASE WHEN `_left_{c}` = 0 THEN `{c}` - `_prev_{c}` END)",
    }
    return [F.expr(f"{forms[k].format(c=c, tail=tail)} AS `{c}_{k}`") for c in columns for k in kinds]


def peak_aggs(peaks: Sequence[str]) -> list[Column]:
    """0-based place, among the values above 0, of the first maximum."""
    best = "max(CASE WHEN `{c}` > 0 THEN struct(`{c}` AS v, -`_place_{c}` AS p) END)"
    return [F.expr(f"-{best.format(c=c)}.p - 1 AS `{c}_maxidx`") for c in peaks]


def group_features(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggs: Sequence[Column] = (),
    sequences: Sequence[str] = (),
    kinds: Sequence[str] = KINDS,
    peaks: Sequence[str] = (),
    medians: Sequence[tuple[Column, str]] = (),
    counted: DataFrame | None = None,
    limit: int | None = None,
    modes: bool = False,
    split: Split | None = None,
) -> DataFrame:
    """One row per key: plain aggregates, sequence features, places of peaks and medians together.

    ``modes`` tells that there are modes among ``aggs``; ``split`` gives the rows as parted before, of which ``df`` is all. The order key must be unique within a group. Medians of hot groups are taken from counts, not from the
    values of the group gathered in one task.
    """
    by = [quoted(k) for k in keys]
    if not keys:
        raise ValueError("name at least one key")
    if not (sequences or peaks or medians or modes):
        return df.groupBy(*by).agg(*aggs)
    # The windows leave the rows sorted by key. From now on the session aggregates such rows as they come: a hash table of modes and medians
    # sorts its rows, marks and all, a second time as soon as it holds a few groups.
    df.sparkSession.conf.set("spark.sql.execution.replaceHashWithSortAgg", "true")
    split = split_hot(df, keys, counted, limit) if split is None else split
    if not (sequences or peaks or medians):
        # Rows of cold keys are dealt and sorted once, before the aggregates; those of hot keys combine before the shuffle.
        cold = None if split.cold is None else split.cold.repartition(*by).sortWithinPartitions(*by).groupBy(*by).agg(*aggs)
        hot = None if split.hot is None else split.hot.groupBy(*by).agg(*aggs)
        return hot if cold is None else cold if hot is None else cold.unionByName(hot)
    marked = with_marks(split, keys, order, sequences, peaks) if sequences or peaks else df
    reduced = [*aggs, *sequence_aggs(sequences, kinds), *peak_aggs(peaks)]
    if split.hot is None:
        return marked.groupBy(*by).agg(*reduced, *[F.median(c).alias(n) for c, n in medians])
    out = marked.groupBy(*by).agg(*reduced) if reduced else df.select(*by).distinct()
    if medians:
        columns = [c.alias(f"_value{i}") for i, (c, _) in enumerate(medians)]
        values = Split(*[None if d is None else d.select(*by, *columns) for d in (split.cold, split.hot)], split.hot_rows, split.limit)
        part = exact_medians(df, keys, {f"_value{i}": n for i, (_, n) in enumerate(medians)}, values, limit)
        part = part.withColumnsRenamed({k: f"_of_{k}" for k in keys})
        on = reduce(lambda a, b: a & b, [quoted(k).eqNullSafe(quoted(f"_of_{k}")) for k in keys])
        out = out.join(part, on, "left").drop(*[f"_of_{k}" for k in keys])
    return out


def batch_features(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggs: Callable[[], Mapping[str, Column]],
    sequences: Sequence[str] = (),
    kinds: Sequence[str] = KINDS,
    peaks: Sequence[str] = (),
    medians: Sequence[tuple[Column, str]] = (),
    counted: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """What ``group_features`` gives with modes, for many columns: sorted rows are reduced in batches (``operators.batches``).

    ``aggs`` makes the plain aggregates of ``operators.aggregates`` by name. Groups too large for a batch are hot: these go to ``group_features``, as
    does a table with columns that batches do not take.
    """
    with collected() as noted:
        made = list(aggs().items())
        made += [(f"{c}_{k}", noted.add(k, quoted(c))) for c in sequences for k in kinds]
        made += [(f"{c}_maxidx", noted.add("maxidx", quoted(c))) for c in peaks]
        made += [(n, noted.add("median", c)) for c, n in medians]
    limit = min(limit or rows_per_task(df.sparkSession), max(1, MAX_VALUES // (len(noted.inputs) + 1)))
    split = split_hot(df, keys, counted, limit)
    cold = None if split.cold is None else reduce_batches(split.cold, keys, order, noted.inputs, noted.reductions, TAIL)
    if cold is not None:
        cold = cold.select(*[quoted(k) for k in keys], *[c.alias(n) for n, c in made])
        if split.hot is None:
            return cold
        df, split = split.hot, Split(None, split.hot, split.hot_rows, split.limit, split.hot_keys)
    plain = [c.alias(n) for n, c in aggs().items()]
    hot = group_features(df, keys, order, plain, sequences, kinds, peaks, medians, counted, limit, True, split)
    return hot if cold is None else cold.unionByName(hot)


def sequence_features(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], kinds: Sequence[str] = KINDS, limit: int | None = None) -> DataFrame:
    """The sequence features of the columns, one row per key."""
    slim = df.select(*[quoted(c) for c in dict.fromkeys([*keys, *order, *columns])])
    return batch_features(slim, keys, order, dict, sequences=columns, kinds=kinds, limit=limit)


def peak_places(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    slim = df.select(*[quoted(c) for c in dict.fromkeys([*keys, *order, *columns])])
    return group_features(slim, keys, order, peaks=columns)


def order_ties(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keys whose order is not unique, with ``tied_rows``: rows that share their order with another row of the key. Nulls are equal.

    First, last and step features of such a key depend on which of the tied rows comes first. Counts combine before the shuffle, and a
    key's rows are dealt by its order as well, so that a hot key is no single task; no rows where every order is unique.
    """
    by, along = [quoted(k) for k in keys], [quoted(o) for o in order]
    shared = df.groupBy(*by, *along).agg(F.count(F.lit(1)).alias("tied_rows")).where("tied_rows > 1")
    return shared.groupBy(*by).agg(F.sum("tied_rows").alias("tied_rows"))
