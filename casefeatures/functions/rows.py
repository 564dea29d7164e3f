"""Functions of one row: null handling, flags, strings, dates, ratios."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefeatures.functions.schema import FLOAT_TYPES, quoted

# Fixed value: the category that means "missing" in the case data.
MISSING = "a55475b1"


def derive(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or overwrite columns, all in one projection."""
    return df.withColumns(dict(columns))


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop by list; names that are not there are ignored."""
    names = set(names)
    return df.selectExpr(*[f"`{n}`" for n in df.columns if n not in names])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_all_null_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep rows with a value in at least one of the columns. NaN counts as a value."""
    known = ", ".join(f"CASE WHEN `{c}` IS NOT NULL THEN true END" for c in columns)
    return df.filter(f"coalesce({known}, false)") if known else df


def fill_null(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def all_nan_to_null(df: DataFrame) -> DataFrame:
    """NaN to null in every float column."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, FLOAT_TYPES)}
    return df.selectExpr(*[f"CASE WHEN NOT isnan(`{n}`) THEN `{n}` END AS `{n}`" if n in floats else f"`{n}`" for n in df.columns])


def sentinel_to_null(c: Column, value=MISSING) -> Column:
    return F.nullif(c, F.lit(value))


def remap_values(c: Column, values: Mapping, default=None) -> Column:
    """Value by map; anything else, null included, becomes the default."""
    out = F.lit(default)
    for old, new in values.items():
        out = F.when(c == F.lit(old), F.lit(new)).otherwise(out)
    return out


def value_flag(c: Column, value) -> Column:
    """1 where c is the value, 0 where it is another, null where c is null."""
    return (c == F.lit(value)).cast("int")


def one_hot(c: Column, values: Sequence, name: str, label=str) -> list[Column]:
    """One ``value_flag`` per listed value, named ``name_value``."""
    return [value_flag(c, v).alias(f"{name}_{label(v)}") for v in values]


def null_flag(c: Column) -> Column:
    return c.isNull().cast("int")


def in_list_flag(c: Column, values: Sequence) -> Column:
    return c.isin(*values).cast("int")


def mean_of_encodings(a: Column, b: Column) -> Column:
    """Half the sum, with null as 0."""
    return (F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0))) * 0.5


def split_first(c: Column, mark: str = "_", missing: str | None = MISSING) -> Column:
    """First part of a marked string, after the missing value became null."""
    c = c if missing is None else sentinel_to_null(c, missing)
    return F.substring_index(c, mark, 1)


def digits_to_int(c: Column) -> Column:
    """Take out the first character that is no digit, read the rest as a whole number, else null."""
    rest = F.regexp_replace(c, r"^([0-9]*)[^0-9]", "$1")
    return F.when(rest.rlike(r"^[+-]?[0-9]+$"), rest.try_cast("bigint"))


def days_between(a: Column, b: Column) -> Column:
    """Whole days from b to a, signed."""
    return F.datediff(a, b)


def days_before_ref(df: DataFrame, ref: str, columns: Iterable[str], drop_ref: bool = True) -> DataFrame:
    """Each listed date column becomes the days from it to the reference date."""
    columns = set(columns)
    names = [n for n in df.columns if not (drop_ref and n == ref)]
    return df.selectExpr(*[f"datediff(`{ref}`, `{n}`) AS `{n}`" if n in columns else f"`{n}`" for n in names])


def date_parts(c: Column, name: str) -> list[Column]:
    """ISO weekday (Monday is 1), month, quarter and ISO week."""
    return [
        (F.weekday(c) + 1).alias(f"{name}_weekday"),
        F.month(c).alias(f"{name}_month"),
        F.quarter(c).alias(f"{name}_quarter"),
        F.weekofyear(c).alias(f"{name}_week"),
    ]


def make_month_date(year: Column, month: Column) -> Column:
    """First day of a month given as text or numbers; null where there is no such month."""
    y, m = (x.try_cast("double").try_cast("int") for x in (year, month))
    return F.when(m.between(1, 12) & y.between(1, 9999), F.make_date(y, m, F.lit(1)))


def latest_of_columns(*columns: Column) -> Column:
    """Greatest value that is not null."""
    return F.greatest(*columns) if len(columns) > 1 else columns[0]


def band_flags(years: Column, bounds: Sequence[float], name: str) -> list[Column]:
    """0/1 per band, upper bound included; an unknown value is 0 in all. Needs two bounds or more."""
    def flag(cond: Column, label: str) -> Column:
        return F.when(cond, 1).otherwise(0).alias(f"{name}_{label}")

    out = [flag(years <= bounds[0], f"{bounds[0]:g}")]
    for low, high in zip(bounds, bounds[1:]):
        out.append(flag((years > low) & (years <= high), f"{low:g}_{high:g}"))
    return out + [flag(years > bounds[-1], f"{bounds[-1]:g}")]


def scale(c: Column, by: float) -> Column:
    return c * F.lit(by)


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is 0, or where either is null or NaN."""
    return F.try_divide(nan_to_null(a.cast("double")), nan_to_null(b.cast("double")))
