"""Category encodings: fitted from labelled data into one long lookup table, applied by joins.

Lookup columns: ``column, category, mean_target, frequency, ordinal``, and ``value`` for given values.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casefeatures.functions.schema import quoted
from casefeatures.operators.hotgroups import row_numbers
from casefeatures.sources.files import checkpointed

NO_CATEGORY = "None"
MAX_BROADCAST_CATEGORIES = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
# All lookups one call of ``encode`` broadcasts, together.
MAX_BROADCAST_TOTAL = 256 * 1024 * 1024
HOT_SHARE = 1000
# Items the summary of frequent categories keeps: an estimate is off by less than 1/4,000 of the rows.
TRACKED = 10_000
SALTS = 1024


@dataclass(frozen=True)
class Category:
    """How one column is encoded.

    ``kinds`` maps the lookup column to the output name; ``fill`` puts a word in place of null first;
    ``fitted_on`` names another column whose lookup is used; ``default`` replaces unknown results.
    """

    column: str
    kinds: tuple[tuple[str, str], ...]
    fill: str | None = None
    fitted_on: str | None = None
    default: int | None = None

    @property
    def lookup(self) -> str:
        return self.fitted_on or self.column

    def value(self) -> Column:
        c = quoted(self.column).cast("string")
        return c if self.fill is None else F.coalesce(c, F.lit(self.fill))


def fit_encodings(df: DataFrame, columns: Iterable[str | Category], target: str) -> DataFrame:
    """Per column and category the mean target and the row count, in one pass over the table.

    The columns are turned into rows with a generator; counts and sums combine before the shuffle, so a
    frequent category costs nothing extra.
    """
    columns = [c if isinstance(c, Category) else Category(c, ()) for c in columns]
    pairs = F.array(*[F.struct(F.lit(c.lookup).alias("column"), c.value().alias("category")) for c in columns])
    return (
        df.select(F.inline(pairs), quoted(target).alias("_target"))
        .filter(F.col("category").isNotNull())
        .groupBy("column", "category")
        .agg(F.avg("_target").alias("mean_target"), F.count(F.lit(1)).alias("frequency"))
    )


def with_ordinals(lookup: DataFrame) -> DataFrame:
    """0-based rank per column by rising mean target, null last, ties by category."""
    ranked = row_numbers(
        lookup.withColumns({"_unknown": F.col("mean_target").isNull()}),
        ["column"],
        ["_unknown", "mean_target", "category"],
        "_rank",
    )
    return ranked.withColumn("ordinal", (F.col("_rank") - 1).cast("int")).drop("_unknown", "_rank")


def frequency_share(lookup: DataFrame) -> DataFrame:
    """Row count / all rows of the column. Totals are one row per column, joined back."""
    totals = lookup.groupBy("column").agg(F.sum("frequency").alias("_total"))
    return lookup.join(F.broadcast(totals), "column").withColumn(
        "share", F.try_divide(F.col("frequency").cast("double"), F.col("_total"))
    ).drop("_total")


def given_values(spark: SparkSession, values: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """A lookup of given values: ranks set by hand, days of a period, middle of a band."""
    rows = [(column, category, float(v)) for column, given in values.items() for category, v in given.items()]
    return spark.createDataFrame(rows, "column string, category string, value double")


def index_categories(df: DataFrame, column: str) -> DataFrame:
    """A lookup that numbers the categories of a column from 1, in order."""
    known = df.select(F.lit(column).alias("column"), quoted(column).cast("string").alias("category"))
    distinct = known.filter(F.col("category").isNotNull()).distinct()
    return row_numbers(distinct, ["column"], ["category"], "_n").select(
        "column", "category", F.col("_n").cast("double").alias("value")
    )


def lookup_sizes(lookup: DataFrame) -> dict[str, tuple[int, int]]:
    """Categories and bytes per column; one row per encoded column reaches the driver."""
    rows = lookup.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("category") + 40).alias("bytes")
    ).collect()
    return {r["column"]: (r["n"], r["bytes"]) for r in rows}


def encode(df: DataFrame, lookup: DataFrame, categories: Sequence[Category], sizes: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """Add the encodings of all categories. Unknown and null categories give null, or the default.

    Each column needs one join, which brings all its encodings. Lookups of checked size are broadcast, the smallest first, as far as
    they fit MAX_BROADCAST_TOTAL together, so the rows are not shuffled; the others are joined by ``_encode_large``.
    """
    if not categories:
        return df
    sizes = lookup_sizes(lookup) if sizes is None else sizes
    small = _broadcast_lookups({cat.lookup: sizes.get(cat.lookup, (0, 0)) for cat in categories}, [cat.lookup for cat in categories])
    large = {i: cat for i, cat in enumerate(categories) if i not in small}
    frequent = frequent_categories(df, large) if large else None
    for i, cat in enumerate(categories):
        wanted = dict.fromkeys(kind for kind, _ in cat.kinds)
        part = lookup.filter(F.col("column") == cat.lookup).select(
            F.col("category").alias(f"_category{i}"), *[F.col(k).alias(f"_{k}{i}") for k in wanted]
        )
        if i in small:
            df = df.join(F.broadcast(part), cat.value() == F.col(f"_category{i}"), "left")
        else:
            df = _encode_large(df, part, cat, i, list(wanted), frequent)
    out = {}
    for i, cat in enumerate(categories):
        for kind, name in cat.kinds:
            c = F.col(f"_{kind}{i}")
            out[name] = c if cat.default is None else F.coalesce(c, F.lit(cat.default))
    helpers = {f"_category{i}" for i in range(len(categories))} | {
        f"_{kind}{i}" for i, cat in enumerate(categories) for kind, _ in cat.kinds
    }
    keep = [quoted(c) for c in df.columns if c not in helpers and c not in out]
    return df.select(*keep, *[c.alias(n) for n, c in out.items()])


def _broadcast_lookups(sizes: Mapping[str, tuple[int, int]], wanted: Sequence[str]) -> set[int]:
    """Places in ``wanted`` whose lookups are broadcast: each within its bounds, all within the total."""
    spent, chosen = 0, set()
    for i in sorted(range(len(wanted)), key=lambda i: (sizes[wanted[i]][1], i)):
        n, size = sizes[wanted[i]]
        if n <= MAX_BROADCAST_CATEGORIES and size <= MAX_BROADCAST_BYTES and spent + size <= MAX_BROADCAST_TOTAL:
            spent += size
            chosen.add(i)
    return chosen


def frequent_categories(df: DataFrame, categories: Mapping[int, Category]) -> DataFrame:
    """One row with, per category column i, ``_frequent<i>``: all values that make up more than 1/HOT_SHARE of the rows, and a few more.

    A summary of frequent items is kept per task and merged, for all columns in one pass over the rows being encoded: what was
    frequent when the lookup was fitted need not be so now, and a frequent value may be in no lookup. At most 2 * HOT_SHARE values each.
    """
    values = df.select(*[c.value().alias(f"_value{i}") for i, c in categories.items()])
    tops = [F.expr(f"approx_top_k(`_value{i}`, {2 * HOT_SHARE}, {max(TRACKED, 2 * HOT_SHARE)})").alias(f"_frequent{i}") for i in categories]
    return checkpointed(values.agg(*tops))


def _encode_large(df: DataFrame, part: DataFrame, cat: Category, i: int, kinds: list[str], frequent: DataFrame) -> DataFrame:
    """Join a lookup too large to broadcast.

    The frequent values of the rows, at most 2 * HOT_SHARE, are broadcast with their encodings, or with none if the lookup does not hold
    them. The rest is shuffled, and rows that need no partner (null, or found already) are spread over salts instead of
    meeting in one task.
    """
    key, rows = cat.value(), list(df.columns)
    hot_key, cold_key = f"_hot{i}", f"_cold{i}"
    hot = F.broadcast(frequent.select(F.explode(f"_frequent{i}.item").alias(hot_key)).filter(F.col(hot_key).isNotNull()))
    found = part.join(hot, F.col(f"_category{i}") == F.col(hot_key), "left_semi")
    hot = hot.join(F.broadcast(found), F.col(f"_category{i}") == F.col(hot_key), "left")
    df = df.join(F.broadcast(hot.select(hot_key, *[F.col(f"_{k}{i}").alias(f"_hot_{k}{i}") for k in kinds])), key == F.col(hot_key), "left")
    df = df.withColumn(cold_key, F.when(F.col(hot_key).isNull(), key))
    salt = F.when(F.col(cold_key).isNull(), 1 + F.pmod(F.xxhash64(*[quoted(c) for c in rows]), F.lit(SALTS))).otherwise(0)
    # One key of two fields: a constant second key would be taken out of the join, and with it the salt out of the shuffle.
    mine = F.struct(F.col(cold_key).alias("category"), salt.cast("int").alias("salt"))
    joined = df.join(part, mine == F.struct(F.col(f"_category{i}").alias("category"), F.lit(0).alias("salt")), "left")
    return joined.select(
        *[quoted(c) for c in rows],
        F.coalesce(F.col(hot_key), F.col(f"_category{i}")).alias(f"_category{i}"),
        *[F.coalesce(F.col(f"_hot_{k}{i}"), F.col(f"_{k}{i}")).alias(f"_{k}{i}") for k in kinds],
    )


def fitted(column: str, name: str | None = None, kinds: str = "mfo", fill: str | None = None, fitted_on: str | None = None) -> Category:
    """The three fitted encodings of a column under their usual names: m(ean), f(requency), o(rdinal)."""
    short = name or column
    names = {"m": ("mean_target", f"{short}_mean_target"), "f": ("frequency", f"{short}_frequency"), "o": ("ordinal", f"{column}_encoded")}
    return Category(column, tuple(names[k] for k in kinds), fill, fitted_on)


def valued(column: str, name: str, fill: str | None = None, fitted_on: str | None = None, default: int | None = None) -> Category:
    """A column encoded by given values."""
    return Category(column, (("value", name),), fill, fitted_on, default)
