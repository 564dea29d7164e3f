"""The whole job: sixteen tables to one row per case, and what is dropped from it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefeatures.functions import rows as R
from casefeatures.functions.schema import cast_by_suffix, narrow_types, parse_date, quoted
from casefeatures.operators.encode import given_values, index_categories, lookup_sizes, with_ordinals
from casefeatures.operators.joins import join_base, not_taken
from casefeatures.operators.sequence import order_ties
from casefeatures.plans import tables as K
from casefeatures.plans.rollup import KEYS, ORDER, fit_table, rollup_depth1, rollup_depth2, static_table
from casefeatures.sources.files import bucketed, checkpointed, scan_parts, written

# Tables that are fitted or rolled up at a time.
AT_ONCE = 6
NO_FEATURES = ("target", "case_id", "WEEK_NUM", "MONTH", "date_decision")


def load_tables(spark, path: str, kind: str) -> dict[str, DataFrame]:
    """The base and the detail tables of ``path/kind``, named ``kind_table*.parquet``, all parts stacked."""
    names = ("base", *K.SPECS)
    return {n: scan_parts(spark, f"{path}/{kind}/{kind}_{n}{'' if n == 'base' else '*'}.parquet") for n in names}


def fit_lookups(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One long lookup table for all encoded columns: fitted, given and numbered ones.

    The result is pinned in the shared folder, for it is read once per encoded column. Without a fitted category it holds the others.
    """
    base, fit, more = tables["base"], None, None
    chosen = [name for name, spec in K.SPECS.items() if name in tables and spec.categories]

    def parts_of(name: str) -> tuple[DataFrame, list[DataFrame]]:
        return fit_table(tables[name], K.SPECS[name], base), [index_categories(tables[name], column) for column in K.INDEXED.get(name, ())]

    for part, numbers in _together(base.sparkSession, parts_of, chosen, AT_ONCE):
        fit = part if fit is None else fit.unionByName(part)
        for numbered in numbers:
            more = numbered if more is None else more.unionByName(numbered)
    if fit is None:
        fit = base.sparkSession.createDataFrame([], "column string, category string, mean_target double, frequency long")
    given = given_values(base.sparkSession, K.GIVEN)
    more = given if more is None else more.unionByName(given)
    return checkpointed(with_ordinals(checkpointed(fit)).join(more, ["column", "category"], "full"))


def roll_up_all(
    tables: Mapping[str, DataFrame],
    lookup: DataFrame,
    keep: Callable[[str, DataFrame], DataFrame] | None = None,
    at_once: int = AT_ONCE,
) -> dict[str, DataFrame]:
    """One table of one row per case for each name in JOIN_ORDER.

    ``keep(name, df)`` may store each roll-up and read it back (``stored_under``), which ends its plan. ``at_once`` roll-ups are planned
    and stored at a time, a child before its parent, so the cores do not wait while the plan of one is made or its last task runs.
    """
    keep = keep or (lambda _, df: df)
    sizes = lookup_sizes(lookup)

    def roll_up(name: str) -> DataFrame:
        spec, table = K.SPECS[name], tables[name]
        if spec.depth == 0:
            return keep(name, static_table(table, spec, lookup, sizes))
        child = None
        if spec.child:
            child = keep(spec.child, rollup_depth2(tables[spec.child], K.SPECS[spec.child], lookup, sizes))
        return keep(name, rollup_depth1(table, spec, lookup, child, sizes))

    return dict(zip(K.JOIN_ORDER, _together(lookup.sparkSession, roll_up, K.JOIN_ORDER, at_once), strict=True))


def _together(spark: SparkSession, work: Callable, items: Iterable, at_once: int) -> list:
    """The results of ``work`` on every item, in their order, ``at_once`` of them at a time."""
    with ThreadPoolExecutor(at_once) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(work), item) for item in items]]


def order_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table``, ``tied_keys``, ``tied_rows`` of every table that is rolled up: where its rows have no order of their own within a key.

    One row per table, zeros where the order is unique. Rolled-up features that follow the order are then the same on any partitioning.
    """
    out = None
    for name, spec in K.SPECS.items():
        if name in tables and spec.depth:
            ties = order_ties(tables[name], KEYS[spec.depth], ORDER[spec.depth])
            row = ties.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("tied_keys"), F.coalesce(F.sum("tied_rows"), F.lit(0)).alias("tied_rows"))
            out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError("no table is rolled up")
    return out


def stored_under(path: str) -> Callable[[str, DataFrame], DataFrame]:
    return lambda name, df: written(df, f"{path}/{name}")


def bucketed_as(prefix: str, buckets: int) -> Callable[[str, DataFrame], DataFrame]:
    """Store each roll-up bucketed by the case: joining them all then shuffles the base only. A second run replaces the first one's
    tables of the same prefix."""
    return lambda name, df: bucketed(df, f"{prefix}{name}", "case_id", buckets, "overwrite")


def join_all(base: DataFrame, rolled: Mapping[str, DataFrame], kind: str) -> DataFrame:
    """Join the roll-ups to the base: inner for "train", left for "test".

    Names and places of the columns follow JOIN_ORDER. The joins go from the narrowest roll-up to the widest, so that few of them carry
    the wide ones' columns; each has one row per case, so any order gives the same rows.
    """
    how = "left" if kind == "test" else "inner"
    out = cast_by_suffix(base)
    columns, sides = ["case_id", *[c for c in out.columns if c != "case_id"]], []
    for name in K.JOIN_ORDER:
        sides.append(not_taken(rolled[name], columns))
        columns += [c for c in sides[-1].columns if c != "case_id"]
    for side in sorted(sides, key=lambda side: len(side.columns)):
        out = join_base(out, side, how)
    return out.select(*[quoted(c) for c in columns])


def date_features(df: DataFrame, columns: Iterable[str], ref: str = "date_decision") -> DataFrame:
    """Dates become days before the decision; weekday, month, quarter and week of the decision are added."""
    df = df.withColumn(ref, parse_date(quoted(ref).cast("string")))
    df = df.select("*", *R.date_parts(quoted(ref), ref))
    return R.days_before_ref(df, ref, set(columns))


def prune_features(df: DataFrame, weak: Iterable[str] = (), listed: Iterable[str] = (), endings: tuple[str, ...] = K.DROPPED_ENDINGS) -> DataFrame:
    """Drop listed columns, weak ones and those with the given endings; names that are not there are ignored."""
    gone = {*listed, *weak, *[c for c in df.columns if endings and c.endswith(tuple(endings))]}
    return R.drop_columns(df, gone)


def assemble_features(
    tables: Mapping[str, DataFrame],
    kind: str = "train",
    lookup: DataFrame | None = None,
    weak: Iterable[str] = (),
    keep: Callable[[str, DataFrame], DataFrame] | None = None,
    narrow: bool = True,
) -> DataFrame:
    """One wide row per case.

    ``keep`` stores each roll-up and the wide table, so that no plan spans the whole job; ``narrow`` then takes a
    pass over the stored table to find the ranges. Without ``keep`` it pins the wide table first, so the job runs once.
    Within ``files.scratch_run`` lookups, checkpoints and roll-ups stored under its folder are removed once the result is written.
    """
    lookup = fit_lookups(tables) if lookup is None else lookup
    wide = join_all(tables["base"], roll_up_all(tables, lookup, keep), kind)
    dates = [f.name for f in wide.schema.fields if isinstance(f.dataType, T.DateType) and f.name != "date_decision"]
    features = [c for c in wide.columns if c not in NO_FEATURES]
    if kind == "train":
        wide = R.drop_all_null_rows(wide, features)
    wide = date_features(wide, dates)
    wide = R.all_nan_to_null(wide)
    wide = prune_features(wide, weak, (*K.PLACE_COLUMNS, *K.ONE_VALUE_COLUMNS))
    if keep:
        wide = keep("wide", wide)
    elif narrow:
        wide = checkpointed(wide)
    return narrow_types(wide) if narrow else wide


def category_columns(df: DataFrame) -> list[str]:
    """Columns that models take as categories."""
    return [c for c in df.columns if c.endswith(K.CATEGORY_ENDINGS)]


