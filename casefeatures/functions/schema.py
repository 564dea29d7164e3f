"""Types by column-name rule, lenient and strict casts, narrowing, column picking."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_COLUMNS = ("case_id", "WEEK_NUM", "num_group1", "num_group2")

# Last letter of a column name -> type.
SUFFIX_TYPES = {"A": "double", "P": "double", "D": "date", "M": "string", "T": "string"}

INTEGER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)
NUMERIC_TYPES = (*INTEGER_TYPES, *FLOAT_TYPES, T.DecimalType)

_INTEGER_RANGES = (
    ("tinyint", 2**7),
    ("smallint", 2**15),
    ("int", 2**31),
    ("bigint", 2**63),
)
_FLOAT_MAX = 3.4028234663852886e38


def quoted(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col(f"`{name}`")


def type_by_name(name: str) -> str | None:
    """The type a column name asks for, or None to leave it as stored."""
    if name in KEY_COLUMNS:
        return "bigint"
    return SUFFIX_TYPES.get(name[-1:])


def cast_by_suffix(df: DataFrame) -> DataFrame:
    """Keys to long, other columns by their last letter, in one projection."""
    out = []
    for field in df.schema.fields:
        wanted = type_by_name(field.name)
        same = wanted is None or field.dataType.simpleString() == wanted
        out.append(quoted(field.name) if same else quoted(field.name).cast(wanted).alias(field.name))
    return df.select(*out)


def lenient_cast(c: Column, to: str) -> Column:
    """A value that does not fit becomes null."""
    return c.try_cast(to)


def strict_cast(c: Column, to: str) -> Column:
    """A value that does not fit is an error (ANSI mode)."""
    return c.cast(to)


def bool_to_int(c: Column, missing: int | None = None) -> Column:
    """A flag as 0/1; null stays null unless ``missing`` is given."""
    out = c.try_cast("tinyint")
    return out if missing is None else F.coalesce(out, F.lit(missing).cast("tinyint"))


def parse_date(c: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.to_date(c, pattern)


def pick_columns(
    df: DataFrame,
    types: Sequence[type] | None = None,
    prefix: str = "",
    suffixes: Iterable[str] = ("",),
    without: Iterable[str] = (),
    without_suffixes: Iterable[str] = (),
) -> list[str]:
    """Column names by type, prefix and suffix, less the excluded ones."""
    suffixes, without_suffixes, without = tuple(suffixes), tuple(without_suffixes), set(without)
    return [
        f.name
        for f in df.schema.fields
        if (types is None or isinstance(f.dataType, tuple(types)))
        and f.name.startswith(prefix)
        and f.name.endswith(suffixes)
        and f.name not in without
        and not (without_suffixes and f.name.endswith(without_suffixes))
    ]


def numeric_columns(df: DataFrame, without_suffixes: Iterable[str] = ()) -> list[str]:
    return pick_columns(df, types=NUMERIC_TYPES, without_suffixes=without_suffixes)


def _narrowest(field: T.StructField, low, high) -> str | None:
    if low is None:
        return None
    if isinstance(field.dataType, INTEGER_TYPES):
        return next(t for t, top in _INTEGER_RANGES if t == "bigint" or (low > -top and high < top - 1))
    if isinstance(field.dataType, FLOAT_TYPES) and -_FLOAT_MAX < low and high < _FLOAT_MAX:
        return "float"
    return None


def column_ranges(df: DataFrame, fields: Sequence[T.StructField], at_once: int = 100) -> dict[str, tuple]:
    """Least and greatest value per column, NaN aside, by one job; one row per ``at_once`` columns reaches the driver.

    The aggregations of a wide table, each over its own columns, are the branches of one union: a columnar file is read once
    in all, the generated code of each branch stays small, and the number of jobs does not grow with the columns.
    """
    parts = [fields[start : start + at_once] for start in range(0, len(fields), at_once)]
    branches = []
    for number, part in enumerate(parts):
        ranges = {}
        for kind, types, held in (("whole", INTEGER_TYPES, "bigint"), ("real", FLOAT_TYPES, "double")):
            own = [f for f in part if isinstance(f.dataType, types)]
            values = [f"CASE WHEN NOT isnan(`{f.name}`) THEN `{f.name}` END" if kind == "real" else f"`{f.name}`" for f in own]
            pairs = [f"array(CAST(min({v}) AS {held}), CAST(max({v}) AS {held}))" for v in values]
            ranges[kind] = F.expr(f"CAST(array({', '.join(pairs)}) AS array<array<{held}>>)").alias(kind)
        branches.append(df.agg(*ranges.values()).select(F.lit(number).alias("part"), *ranges))
    out = {}
    for row in reduce(DataFrame.unionByName, branches).collect() if branches else ():
        for kind, types in (("whole", INTEGER_TYPES), ("real", FLOAT_TYPES)):
            own = [f for f in parts[row["part"]] if isinstance(f.dataType, types)]
            out |= {f.name: tuple(r) for f, r in zip(own, row[kind], strict=True)}
    return out


def narrow_types(df: DataFrame, keep: Iterable[str] = KEY_COLUMNS) -> DataFrame:
    """Each numeric column in the smallest type that strictly holds its range, in one projection.

    Needs the ranges of the columns, so ``df`` should be a stored table. Columns of nulls only, and the ``keep``
    columns, stay as they are.
    """
    keep = set(keep)
    fields = [f for f in df.schema.fields if isinstance(f.dataType, INTEGER_TYPES + FLOAT_TYPES) and f.name not in keep]
    ranges = column_ranges(df, fields)
    to = {f.name: _narrowest(f, *ranges[f.name]) for f in fields}
    return df.selectExpr(*[f"CAST(`{n}` AS {to[n]}) AS `{n}`" if to.get(n) else f"`{n}`" for n in df.columns])
