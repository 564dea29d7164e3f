"""Aggregates over the rows of a group, as columns for ``groupBy(...).agg(...)``.

All of them combine before the shuffle to a small state, except two: ``mode_of`` keeps one count per distinct value (for encoded
categories: at most the size of the lookup), and the statistic "median" every distinct value of its group; where a group may be
hot, use ``hotgroups.exact_median``. Order is always given by a column ``o``. The basic ones can be collected in place of being made, see
``operators.batches``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from casefeatures.functions.rows import MISSING, days_between, safe_ratio, sentinel_to_null
from casefeatures.operators.batches import reduction


def count_nonnull(c: Column) -> Column:
    return reduction("count", c, lambda: F.count(c))


def count_nonmissing(c: Column, missing=MISSING) -> Column:
    return count_nonnull(sentinel_to_null(c, missing))


def count_where(cond: Column) -> Column:
    return reduction("count_if", cond, lambda: F.count_if(cond))


def _sum(c: Column) -> Column:
    return reduction("sum", c, lambda: F.sum(c))


def total(c: Column) -> Column:
    """Sum; of nothing it is 0."""
    return F.coalesce(_sum(c), F.lit(0).cast("double"))


def whole_total(c: Column) -> Column:
    """Sum of whole numbers; of nothing it is 0."""
    return F.coalesce(_sum(c), F.lit(0))


def positive(c: Column) -> Column:
    return F.when(c > 0, c)


STATS = {
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "median": F.median,
}


def stat(kind: str, c: Column) -> Column:
    return total(c) if kind == "sum" else reduction(kind, c, lambda: STATS[kind](c))


def positive_stat(kind: str, c: Column) -> Column:
    """A statistic over the values above 0 only."""
    return stat(kind, positive(c))


def sum_where(cond: Column, c: Column) -> Column:
    """Sum with 0 where the condition does not hold."""
    return total(F.when(cond, c).otherwise(F.lit(0)))


def min_where(cond: Column, c: Column) -> Column:
    return stat("min", F.when(cond, c))


def max_where(cond: Column, c: Column) -> Column:
    return stat("max", F.when(cond, c))


def first_value(c: Column, o: Column) -> Column:
    """Value of the first row, null or not."""
    return reduction("first", c, lambda: F.min_by(c, o))


def first_nonnull(c: Column, o: Column) -> Column:
    return reduction("first_nonnull", c, lambda: F.min_by(c, F.when(c.isNotNull(), o)))


def last_value(c: Column, o: Column) -> Column:
    """Value of the last row, null or not."""
    return reduction("last", c, lambda: F.max_by(c, o))


def last_nonnull(c: Column, o: Column) -> Column:
    return reduction("last_nonnull", c, lambda: F.max_by(c, F.when(c.isNotNull(), o)))


def last_positive(c: Column, o: Column) -> Column:
    return last_nonnull(positive(c), o)


def mode_of(c: Column) -> Column:
    """Most frequent value that is not null, the smallest on ties. For columns of few distinct values."""
    return reduction("mode", c, lambda: F.mode(c, True))


def peak_drop(c: Column, o: Column) -> Column:
    """(maximum - last) / maximum; 1 when both are 0."""
    top, last = stat("max", c), last_value(c, o)
    return F.when((top == 0) & (last == 0), F.lit(1.0)).otherwise(F.try_divide(top - last, top))


def span(c: Column) -> Column:
    """Maximum less minimum of numbers."""
    return stat("max", c) - stat("min", c)


def span_days(c: Column) -> Column:
    return days_between(stat("max", c), stat("min", c))


def gap(a: Column, b: Column) -> Column:
    """Minimum of one column less the maximum of another."""
    return stat("min", a) - stat("max", b)


def any_null(c: Column) -> Column:
    return stat("max", c.isNull()).cast("int")


def ratio_of(kind: str, a: Column, b: Column) -> Column:
    """Statistic of a / the same statistic of b."""
    return safe_ratio(stat(kind, a), stat(kind, b))


def of_ratio(kind: str, a: Column, b: Column) -> Column:
    """Statistic of the row ratios."""
    return stat(kind, safe_ratio(a, b))


def share(a: Column, b: Column) -> Column:
    """sum a / (sum a + sum b)"""
    return safe_ratio(total(a), total(a) + total(b))


def diff_of(kind: str, a: Column, b: Column) -> Column:
    """Statistic of a less the same statistic of b."""
    return stat(kind, a) - stat(kind, b)


def of_diff(kind: str, a: Column, b: Column, absolute: bool = False) -> Column:
    """Statistic of the row differences."""
    return stat(kind, F.abs(a - b) if absolute else a - b)


def of_days(kind: str, a: Column, b: Column) -> Column:
    """Statistic of the days from b to a in each row."""
    return stat(kind, days_between(a, b))


def days_of(a: Column, b: Column) -> Column:
    """Days between the latest a and the latest b."""
    return days_between(stat("max", a), stat("max", b))


def days_norm(kind: str, a: Column, b: Column, c: Column, d: Column) -> Column:
    """Statistic of the days from b to a / mean of the days from d to c."""
    return safe_ratio(of_days(kind, a, b), of_days("mean", c, d))


def mean_date(c: Column) -> Column:
    """Mean of dates, rounded down to a day."""
    return F.date_from_unix_date(F.floor(stat("mean", F.unix_date(c))).cast("int"))


def date_std(c: Column) -> Column:
    """Standard deviation of dates in whole days, rounded down.

    From whole sums: the variance is a ratio of two whole numbers, so a deviation of just so many days is not rounded down to one less.
    """
    day, exact = F.unix_date(c), "decimal(38,0)"
    square, part = day.cast("long") * day, F.lit(1 << 20)
    n, days = count_nonnull(day).cast(exact), _sum(day.cast("long")).cast(exact)
    squares = _sum(F.call_function("div", square, part)).cast(exact) * part + _sum(square % part)
    variance = F.call_function("div", n * squares - days * days, F.nullif(n * (n - 1), F.lit(0).cast(exact)))
    return F.floor(F.sqrt(variance.cast("double")))


def recent_flag(c: Column, below: float = 120.0) -> Column:
    """1 if the smallest value above 0 is below the bound; null if there is none."""
    return (stat("min", positive(c)) < below).cast("int")


def rise_flag(c: Column, o: Column) -> Column:
    """1 if the last value is above the first, else 0."""
    return F.when(last_value(c, o) - first_value(c, o) > 0, 1).otherwise(0)


def first_last_ratio(c: Column, o: Column) -> Column:
    return safe_ratio(first_value(c, o), last_value(c, o))


def one_hot_sums(c: Column, values: Iterable, name: str) -> list[Column]:
    """Rows per listed value."""
    return [whole_total((c == F.lit(v)).cast("int")).alias(f"{name}_{v}") for v in values]
