"""Roll-ups driven by specs: rows of a table are typed, encoded and reduced to one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefeatures.functions import rows as R
from casefeatures.functions.schema import cast_by_suffix, lenient_cast, numeric_columns, pick_columns, quoted
from casefeatures.operators import aggregates as A
from casefeatures.operators.encode import encode, fit_encodings
from casefeatures.operators.joins import join_child_level, join_one
from casefeatures.operators.sequence import batch_features, group_features
from casefeatures.plans.spec import NO_SEQUENCE, TableSpec

KEYS = {1: ["case_id"], 2: ["case_id", "num_group1"]}
ORDER = {1: ["num_group1"], 2: ["num_group2"]}
# A case has at most one in so many rows of a table that is dealt by case.
EVEN = 1000
# Bytes of a method above which HotSpot interprets it, however often it runs.
HOTSPOT_LIMIT = 8000


def encode_table(df: DataFrame, spec: TableSpec, lookup: DataFrame | None, sizes: Mapping | None = None) -> DataFrame:
    """All row-level columns of a table: derived dates, flags, casts and encodings."""
    made: dict[str, Column] = {}
    for name, (year, month) in spec.month_dates.items():
        made[name] = R.make_month_date(quoted(year), quoted(month))
    for c in spec.split_first:
        made[c] = R.split_first(quoted(c))
    for name, of in spec.latest.items():
        made[name] = R.latest_of_columns(*[quoted(c) for c in of])
    for name, (c, value) in spec.flags.items():
        made[name] = R.value_flag(quoted(c).cast("string"), value)
    for c, values in spec.one_hot.items():
        word = quoted(c).cast("string")
        word = word if spec.one_hot_fill is None else R.fill_null(word, spec.one_hot_fill)
        made |= {f"{c}_{label}": R.value_flag(word, value) for value, label in values.items()}
    for c in spec.bools:
        made[c] = lenient_cast(quoted(c), "tinyint")
    if spec.lenient_endings:
        spoken = {*made, *spec.bools, *spec.drop, *[c.column for c in spec.categories], "case_id"}
        for c in df.columns:
            if c.endswith(spec.lenient_endings) and c not in spoken:
                made[c] = lenient_cast(quoted(c), "double")
    df = R.derive(df, made) if made else df
    if lookup is not None:
        df = encode(df, lookup, spec.categories, sizes)
    later: dict[str, Column] = {}
    for name, (a, b) in spec.mixed.items():
        later[name] = R.mean_of_encodings(quoted(a), quoted(b))
    for name, (a, b) in spec.days.items():
        later[name] = R.days_between(quoted(a), quoted(b))
    df = R.derive(df, later) if later else df
    for name, (a, b, bounds) in spec.ages.items():
        years = R.scale(R.days_between(quoted(a), quoted(b)), 1.0 / 365)
        df = df.select("*", *R.band_flags(years, bounds, name))
    return R.drop_columns(df, spec.drop) if spec.drop else df


def _number(df: DataFrame, spec: TableSpec, name: str) -> Column:
    """A column as a number: text is read leniently, a date counts its days since 1970."""
    kind = df.schema[name].dataType
    c = quoted(name)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    c = c if isinstance(kind, T.DoubleType) else lenient_cast(c, "double")
    c = R.nan_to_null(c)
    return F.nullif(c, F.lit(spec.null_values[name])) if name in spec.null_values else c


def aggregates_of(df: DataFrame, spec: TableSpec, order: str) -> dict[str, Column]:
    """The plain aggregates of a spec, by output name."""
    have, o, out = set(df.columns), quoted(order), {}

    def num(c: str) -> Column:
        return _number(df, spec, c)

    for c in spec.counts:
        out[f"num_{c}"] = A.count_nonnull(quoted(c))
    for c in spec.counts_known:
        out[f"num_{c}"] = A.count_nonmissing(quoted(c))
    for c in spec.counts_positive:
        out[f"num_{c}"] = A.count_where(num(c) > 0)
    for name, (c, bound) in spec.counts_above.items():
        out[name] = A.count_where(num(c) > bound)
    for c in spec.counts_zero:
        out[f"num_{c}_zero"] = A.count_where(num(c) == 0)
    for name, (a, b) in spec.counts_both.items():
        out[name] = A.count_where(quoted(a).isNotNull() & (num(b) > 0))
    for c, names in spec.counts_of.items():
        for value, name in names.items():
            out[name] = A.count_where(quoted(c).cast("string") == value)
    for c, name in spec.counts_null.items():
        out[name] = A.count_where(quoted(c).isNull())
    for kind, columns in spec.positive.items():
        for c in columns:
            out[f"{c}_{kind}"] = A.positive_stat(kind, num(c))
    for name, (kind, c) in spec.stats.items():
        out[name] = A.stat(kind, num(c))
    for name, (kind, c, known) in spec.where.items():
        cond = quoted(known).isNotNull()
        made = {"sum": A.sum_where, "min": A.min_where, "max": A.max_where}[kind]
        out[name] = made(cond, quoted(c))
    for c in spec.any_null:
        out[f"{c}_null"] = A.any_null(quoted(c))
    for name, (kind, a, b) in spec.ratios.items():
        out[name] = A.ratio_of(kind, num(a), num(b))
    for name, (kind, a, b) in spec.row_ratios.items():
        out[name] = A.of_ratio(kind, num(a), num(b))
    for name, (kind, a, b) in spec.row_ratios_zero.items():
        x, y = num(a), num(b)
        out[name] = A.stat(kind, F.when(x.isNull() | y.isNull(), F.lit(0.0)).otherwise(R.safe_ratio(x, y)))
    for name, (a, b) in spec.shares.items():
        out[name] = A.share(num(a), num(b))
    for name, (kind, a, b) in spec.diffs.items():
        out[name] = A.diff_of(kind, num(a), num(b))
    for name, (kind, a, b) in spec.row_diffs.items():
        out[name] = A.of_diff(kind, num(a), num(b))
    for name, (kind, a, b) in spec.row_gaps.items():
        out[name] = A.of_diff(kind, num(a), num(b), absolute=True)
    for name, (c, below) in spec.recent.items():
        out[name] = A.recent_flag(num(c), below)
    for name, (kind, a, b) in spec.row_days.items():
        out[name] = A.of_days(kind, quoted(a), quoted(b))
    for name, (a, b) in spec.group_days.items():
        out[name] = A.days_of(quoted(a), quoted(b))
    for name, (kind, a, b, c, d) in spec.days_norm.items():
        out[name] = A.days_norm(kind, quoted(a), quoted(b), quoted(c), quoted(d))
    for name, (kind, c) in spec.dates.items():
        out[name] = A.mean_date(quoted(c)) if kind == "mean" else A.stat(kind, quoted(c))
    for name, (part, kind, c) in spec.date_numbers.items():
        out[name] = {"year": F.year, "month": F.month}[part](A.stat(kind, quoted(c)))
    for name, c in spec.spans.items():
        out[name] = A.span(num(c))
    for name, c in spec.span_days.items():
        out[name] = A.span_days(quoted(c))
    for name, c in spec.span_years.items():
        out[name] = F.year(A.stat("max", quoted(c))) - F.year(A.stat("min", quoted(c)))
    for name, (a, b) in spec.gaps.items():
        out[name] = A.gap(num(a), num(b))
    for name, (a, b) in spec.wide_spans.items():
        out[name] = A.stat("max", quoted(a)) - A.stat("min", quoted(b))
    for name, c in spec.date_std.items():
        out[name] = A.date_std(quoted(c))
    for c in spec.first:
        out[c] = A.first_value(quoted(c), o)
    for c in spec.first_nonnull:
        out[c] = A.first_nonnull(quoted(c), o)
    for name, c in spec.last.items():
        out[name] = A.last_value(quoted(c), o)
    for name, c in spec.last_nonnull.items():
        out[name] = A.last_nonnull(quoted(c), o)
    for name, c in spec.last_positive.items():
        out[name] = A.last_positive(num(c), o)
    for c in spec.peak_drops:
        out[f"{c}_pos"] = A.peak_drop(num(c), o)
    for name, c in spec.rises.items():
        out[name] = A.rise_flag(num(c), o)
    for name, c in spec.first_last.items():
        out[name] = A.first_last_ratio(num(c), o)
    for name, by in spec.scaled.items():
        out[name] = R.scale(out[name], by)
    out |= agg_encodings(sorted(have), spec.average_endings, spec.order_endings, o)
    if spec.name_rules:
        out |= agg_by_name_rule(pick_columns(df, without=("num_group1", "num_group2")))
    return out


def agg_encodings(columns: list[str], average: tuple[str, ...], ordered: tuple[str, ...], o: Column) -> dict[str, Column]:
    """Mean of columns with these endings under the same name; last and mode of columns with those endings."""
    out = {c: A.stat("mean", quoted(c)) for c in columns if average and c.endswith(average)}
    for c in columns:
        if ordered and c.endswith(ordered):
            out[f"{c}_last"] = A.last_nonnull(quoted(c), o)
            out[f"{c}_mode"] = A.mode_of(quoted(c))
    return out


def agg_by_name_rule(columns: list[str]) -> dict[str, Column]:
    """Second-level rules: what a rolled-up column is called says how it is rolled up again."""
    out: dict[str, Column] = {}
    for c in columns:
        if c.startswith("num_"):
            out[c] = A.whole_total(quoted(c))
        if c.endswith(("_mean", "_duration", "_diff")):
            out[f"{c}_mean"] = A.stat("mean", quoted(c))
        if c.endswith("_first"):
            out[f"{c}_min"] = A.stat("min", quoted(c))
        if c.endswith("_last"):
            out[f"{c}_max"] = A.stat("max", quoted(c))
    return out


def reduce_table(df: DataFrame, spec: TableSpec, counted: DataFrame | None = None) -> DataFrame:
    """One row per key of the spec's depth, from encoded rows."""
    keys, order = KEYS[spec.depth], ORDER[spec.depth]
    plain = df
    sequences = numeric_columns(df, without_suffixes=NO_SEQUENCE[spec.depth]) if spec.sequences else []
    df = R.derive(df, {c: _number(df, spec, c) for c in spec.peaks}) if spec.peaks else df
    medians = [(A.positive(_number(df, spec, c)), f"{c}_median") for c in spec.medians]

    def aggs() -> dict[str, Column]:
        return aggregates_of(plain, spec, order[0])

    if sequences or spec.peaks or medians or spec.order_endings:
        out = batch_features(df, keys, order, aggs, sequences, spec.sequence_kinds, spec.peaks, medians, counted)
    else:
        out = group_features(df, keys, order, aggs=[c.alias(n) for n, c in aggs().items()])
    result = spec.result()
    out = R.derive(out, result) if result else out
    return R.drop_columns(out, spec.result_drop) if spec.result_drop else out


def rollup_depth2(df: DataFrame, spec: TableSpec, lookup: DataFrame | None = None, sizes: Mapping | None = None) -> DataFrame:
    """Cast, encode and reduce a depth-2 table to one row per (case, num_group1)."""
    typed = cast_by_suffix(df)
    return reduce_table(encode_table(typed, spec, lookup, sizes), spec, counted=df)


def rollup_depth1(df: DataFrame, spec: TableSpec, lookup: DataFrame | None = None, child: DataFrame | None = None, sizes: Mapping | None = None) -> DataFrame:
    """Cast and encode a depth-1 table, join the roll-up of its child, reduce to one row per case.

    Rows are dealt for the join before they are encoded: by case, so that they stay where they are until they are reduced, or by the whole key of the
    join where a case is large among them. Reading and casting a wide table and encoding it would otherwise be one generated
    method, too large for HotSpot to compile; from now on the session runs such methods operator by operator.
    """
    df.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", str(HOTSPOT_LIMIT))
    typed = cast_by_suffix(df)
    if child is not None:
        by = KEYS[1] if is_even(df, KEYS[1]) else KEYS[2]
        if by == KEYS[1]:
            # From now on the session joins rows that are dealt by some of the keys of a join where they are.
            df.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        typed = typed.repartition(*[quoted(k) for k in by])
    encoded = encode_table(typed, spec, lookup, sizes)
    if child is not None:
        encoded = join_child_level(encoded, child)
    return reduce_table(encoded, spec, counted=df)


def is_even(df: DataFrame, keys: Sequence[str], least: int = EVEN) -> bool:
    """Whether no key has more than one in ``least`` rows. Rows are counted per key; counts combine before the shuffle."""
    sizes = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("_rows"))
    row = sizes.agg(F.sum("_rows").alias("rows"), F.max("_rows").alias("largest")).first()
    return (row["largest"] or 0) * least <= (row["rows"] or 0)


def static_table(df: DataFrame, spec: TableSpec, lookup: DataFrame | None = None, sizes: Mapping | None = None) -> DataFrame:
    """A depth-0 table has one row per case already: cast and encode only."""
    return encode_table(cast_by_suffix(df), spec, lookup, sizes)


def fit_table(df: DataFrame, spec: TableSpec, base: DataFrame, target: str = "target") -> DataFrame:
    """Lookup rows of all fitted categories of a table, against the target of the case."""
    fitted = {c.lookup: c for c in spec.categories if any(k != "value" for k, _ in c.kinds) and not c.fitted_on}
    typed = cast_by_suffix(df)
    typed = R.derive(typed, {c: R.split_first(quoted(c)) for c in spec.split_first}) if spec.split_first else typed
    return fit_encodings(join_one(typed, base.select("case_id", target)), list(fitted.values()), target)
