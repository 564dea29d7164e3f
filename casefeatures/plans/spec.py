"""What a table contributes, as data: one ``TableSpec`` per table, read by ``plans.rollup``.

Columns are named, never indexed; ``kind`` is one of the statistics sum, mean, min, max, std.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column

from casefeatures.operators.encode import Category
from casefeatures.operators.sequence import KINDS

Names = tuple[str, ...]
Pair = tuple[str, str]
KindPair = tuple[str, str, str]

# Endings of columns that get no sequence features, per depth.
NO_SEQUENCE = {
    1: ("_mean_target", "_frequency", "_encoded", "_group1", "_id", "_encoded_last", "_encoded_mode"),
    2: ("_mean_target", "_frequency", "_encoded", "_group1", "_group2", "_id"),
}


@dataclass(frozen=True)
class TableSpec:
    name: str
    depth: int
    child: str | None = None

    # rows: before anything is summarised
    month_dates: Mapping[str, Pair] = field(default_factory=dict)  # new date: (year, month)
    split_first: Names = ()
    latest: Mapping[str, Names] = field(default_factory=dict)  # new column: greatest of these
    flags: Mapping[str, Pair] = field(default_factory=dict)  # new column: 1 where (column, value) agree
    one_hot: Mapping[str, Mapping[str, str]] = field(default_factory=dict)  # column: {value: label}
    one_hot_fill: str | None = None
    bools: Names = ()
    lenient_endings: Names = ()  # columns with these last letters that are not spoken for become doubles
    categories: tuple[Category, ...] = ()
    mixed: Mapping[str, Pair] = field(default_factory=dict)  # new column: mean of two encodings
    days: Mapping[str, Pair] = field(default_factory=dict)  # new column: days from the second date to the first
    ages: Mapping[str, tuple[str, str, tuple[float, ...]]] = field(default_factory=dict)
    drop: Names = ()

    # groups: counts
    counts: Names = ()  # num_c: rows where c is not null
    counts_known: Names = ()  # num_c: the same, the missing word as null
    counts_positive: Names = ()  # num_c: rows where c > 0
    counts_above: Mapping[str, tuple[str, float]] = field(default_factory=dict)
    counts_zero: Names = ()  # num_c_zero
    counts_both: Mapping[str, Pair] = field(default_factory=dict)  # first is not null and second > 0
    counts_of: Mapping[str, Mapping[str, str]] = field(default_factory=dict)  # column: {value: name}
    counts_null: Mapping[str, str] = field(default_factory=dict)  # column: name

    # groups: statistics
    positive: Mapping[str, Names] = field(default_factory=dict)  # kind: columns -> c_kind over values > 0
    medians: Names = ()  # c_median over values > 0
    stats: Mapping[str, Pair] = field(default_factory=dict)  # name: (kind, column)
    where: Mapping[str, KindPair] = field(default_factory=dict)  # name: (kind, column, column that must not be null)
    any_null: Names = ()
    ratios: Mapping[str, KindPair] = field(default_factory=dict)  # name: kind of a / kind of b
    row_ratios: Mapping[str, KindPair] = field(default_factory=dict)  # name: kind of a / b
    row_ratios_zero: Mapping[str, KindPair] = field(default_factory=dict)  # the same, 0 where a or b is null
    shares: Mapping[str, Pair] = field(default_factory=dict)
    diffs: Mapping[str, KindPair] = field(default_factory=dict)
    row_diffs: Mapping[str, KindPair] = field(default_factory=dict)
    row_gaps: Mapping[str, KindPair] = field(default_factory=dict)  # of absolute differences
    recent: Mapping[str, tuple[str, float]] = field(default_factory=dict)
    null_values: Mapping[str, float] = field(default_factory=dict)  # column: number that means nothing

    # groups: dates and spans
    row_days: Mapping[str, KindPair] = field(default_factory=dict)
    group_days: Mapping[str, Pair] = field(default_factory=dict)
    days_norm: Mapping[str, tuple[str, str, str, str, str]] = field(default_factory=dict)
    dates: Mapping[str, Pair] = field(default_factory=dict)  # name: (max, min or mean, date)
    date_numbers: Mapping[str, tuple[str, str, str]] = field(default_factory=dict)  # name: (year or month, max or min, date)
    spans: Mapping[str, str] = field(default_factory=dict)  # name: number column
    span_days: Mapping[str, str] = field(default_factory=dict)
    span_years: Mapping[str, str] = field(default_factory=dict)
    gaps: Mapping[str, Pair] = field(default_factory=dict)
    wide_spans: Mapping[str, Pair] = field(default_factory=dict)  # name: max of the first less min of the second
    date_std: Mapping[str, str] = field(default_factory=dict)
    scaled: Mapping[str, float] = field(default_factory=dict)  # factor on a named result

    # groups: order
    first: Names = ()
    first_nonnull: Names = ()
    last: Mapping[str, str] = field(default_factory=dict)  # name: column
    last_nonnull: Mapping[str, str] = field(default_factory=dict)
    last_positive: Mapping[str, str] = field(default_factory=dict)
    peaks: Names = ()
    peak_drops: Names = ()
    rises: Mapping[str, str] = field(default_factory=dict)
    first_last: Mapping[str, str] = field(default_factory=dict)

    # groups: rules by name
    average_endings: Names = ()  # mean under the same name
    order_endings: Names = ()  # last and mode
    name_rules: bool = False
    sequences: bool = False
    sequence_kinds: Names = KINDS

    # results
    result: Callable[[], dict[str, Column]] = dict
    result_drop: Names = ()
