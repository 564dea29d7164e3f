"""Groups too large for one task.

Sums, counts, extremes and the like combine before the shuffle, so a hot key does not hurt them.
What depends on the order of a group's rows (steps, running counts, places) does not combine that
way. Such operators ask ``split_hot`` which keys are hot. Their rows are cut into contiguous
pieces along the order key, each small enough for a task, and what a piece must know of the pieces
before or after it is carried over from one summary row per piece. No row is dropped.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casefeatures.functions.schema import quoted
from casefeatures.sources.files import checkpointed

ROWS_PER_TASK = "spark.casefeatures.rowsPerTask"
DEFAULT_ROWS_PER_TASK = 1_000_000
MAX_HOT_KEYS = 100_000
# Pieces of one table, at most: the sample behind their cut points and the reports of their tasks go to the driver. Pieces are sorted on disk where they are large.
MAX_PIECES = 2_000
PIECE = "_piece"


def rows_per_task(spark: SparkSession) -> int:
    return int(spark.conf.get(ROWS_PER_TASK, str(DEFAULT_ROWS_PER_TASK)))


@dataclass(frozen=True)
class Split:
    """Rows of ordinary keys, and rows of hot keys if there are any."""

    cold: DataFrame | None
    hot: DataFrame | None = None
    hot_rows: int = 0
    limit: int = 0
    hot_keys: DataFrame | None = None


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[f"`{k}`"].eqNullSafe(right[f"`{k}`"]) for k in keys])


def split_hot(df: DataFrame, keys: Sequence[str], counted: DataFrame | None = None, limit: int | None = None) -> Split:
    """Count rows per key (columns pruned to the key, combined before the shuffle) and part the table.

    ``counted`` may name a cheaper table with the same keys and at least as many rows per key; ``limit`` sets
    the rows a task takes, in place of the session's setting.
    The hot keys that are broadcast are at most MAX_HOT_KEYS: a key is hot only above
    1/MAX_HOT_KEYS of all rows.
    """
    counted = df if counted is None else counted
    limit = limit or rows_per_task(df.sparkSession)
    if not keys:
        rows = counted.count()
        return Split(df, limit=limit) if rows <= limit else Split(None, df, rows, limit)
    sizes = counted.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("_rows"))
    row = sizes.agg(
        F.sum("_rows").alias("rows"),
        F.max("_rows").alias("largest"),
        F.sum(F.when(F.col("_rows") > limit, F.col("_rows"))).alias("hot_rows"),
    ).first()
    least = (row["rows"] or 0) // MAX_HOT_KEYS
    if least > limit:
        warnings.warn(f"{limit} rows per task would leave more than {MAX_HOT_KEYS} hot keys to broadcast; {least} are taken", stacklevel=2)
        limit = least
    if (row["largest"] or 0) <= limit:
        return Split(df, limit=limit)
    hot_keys = F.broadcast(sizes.filter(F.col("_rows") > limit).drop("_rows"))
    on = same_keys(df, hot_keys, keys)
    return Split(df.join(hot_keys, on, "left_anti"), df.join(hot_keys, on, "left_semi"), row["hot_rows"], limit, hot_keys)


def in_pieces(split: Split, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Hot rows with the number of their piece: pieces follow (keys, order) and are even in size, at most MAX_PIECES of them.

    The cut points come from Spark's own range partitioning, which samples. The checkpoint pins
    them, for the pieces are read twice: once to summarise, once to work on.
    """
    n = min(MAX_PIECES, max(2, 2 * -(-split.hot_rows // split.limit)))
    by = [quoted(c) for c in (*keys, *order)]
    return checkpointed(split.hot.repartitionByRange(n, *by).withColumn(PIECE, F.spark_partition_id()))


def piece_window(keys: Sequence[str]) -> W:
    """Over the summary rows of one key: as many as it has pieces, never as many as rows."""
    return W.partitionBy(*[quoted(k) for k in keys]).orderBy(PIECE)


def join_pieces(pieces: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring the carried columns to the rows: one row per (key, piece), which is broadcast where it is small.

    Otherwise both sides are shuffled by key and piece, so no task gets more than a piece.
    """
    on = same_keys(pieces, carried, [*keys, PIECE])
    return pieces.join(carried, on).drop(*[carried[f"`{c}`"] for c in (*keys, PIECE)])


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, Column], limit: int | None = None) -> DataFrame:
    """Add per name the sum of a column over the rows of the group up to this one.

    Without keys the whole table is one group; it is then cut like any other hot group.
    """
    split = split_hot(df, keys, limit=limit)
    out = None
    if split.cold is not None:
        w = W.partitionBy(*[quoted(k) for k in keys]).orderBy(*[quoted(o) for o in order])
        upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
        out = split.cold.select("*", *[F.sum(c).over(upto).alias(n) for n, c in sums.items()])
    if split.hot is not None:
        pieces = in_pieces(split, keys, order)
        totals = pieces.groupBy(*[quoted(k) for k in keys], PIECE).agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()])
        before = piece_window(keys).rowsBetween(W.unboundedPreceding, -1)
        carried = totals.select(
            *[quoted(k) for k in keys], PIECE, *[F.sum(f"_sum_{n}").over(before).alias(f"_before_{n}") for n in sums]
        )
        w = W.partitionBy(*[quoted(k) for k in keys], PIECE).orderBy(*[quoted(o) for o in order])
        upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
        zero = {n: F.coalesce(F.col(f"_before_{n}"), F.lit(0)) for n in sums}
        hot = join_pieces(pieces, carried, keys).select(
            *[quoted(c) for c in df.columns],
            *[(F.coalesce(F.sum(c).over(upto), F.lit(0)) + zero[n]).alias(n) for n, c in sums.items()],
        )
        out = hot if out is None else out.unionByName(hot)
    return out


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, limit: int | None = None) -> DataFrame:
    """Add the 1-based place of each row in its group."""
    return running_sums(df, keys, order, {name: F.lit(1)}, limit)


def exact_medians(df: DataFrame, keys: Sequence[str], names: Mapping[str, str], split: Split | None = None, limit: int | None = None) -> DataFrame:
    """Medians of several columns per key; ``names`` maps a column to the name of its median.

    Those of hot keys come from counts per column and distinct value; no hot group is gathered. The columns are turned into rows,
    so one count, one running sum (with one checkpoint) and one reduction serve them all. Counts combine before the
    shuffle; the totals that are broadcast are one row per hot key (at most MAX_HOT_KEYS) and column.
    """
    by = [quoted(k) for k in keys]
    split = split_hot(df, keys, limit=limit) if split is None else split
    out = None
    if split.cold is not None:
        out = split.cold.groupBy(*by).agg(*[F.median(quoted(c)).alias(n) for c, n in names.items()])
    if split.hot is not None:
        pairs = F.array(*[F.struct(F.lit(i).alias("_column"), quoted(c).cast("double").alias("_value")) for i, c in enumerate(names)])
        both = [*keys, "_column"]
        counts = split.hot.select(*by, F.inline(pairs)).groupBy(*by, "_column", "_value").agg(F.count("_value").alias("_n"))
        places = running_sums(counts, both, ["_value"], {"_upto": F.col("_n")}, limit)
        totals = F.broadcast(counts.groupBy(*by, "_column").agg(F.sum("_n").alias("_total")))
        found = places.join(totals, same_keys(places, totals, both)).drop(*[totals[f"`{k}`"] for k in both])
        reduced = []
        for i in range(len(names)):
            own = F.col("_column") == i
            reduced.append(F.min(F.when(own & (F.col("_upto") >= F.floor((F.col("_total") + 1) / 2)), F.col("_value"))).alias(f"_low{i}"))
            reduced.append(F.min(F.when(own & (F.col("_upto") >= F.floor(F.col("_total") / 2) + 1), F.col("_value"))).alias(f"_high{i}"))
        # The formula of Spark's own median, so that a group's size does not show in the last digit.
        middle = [F.when(F.col(f"_low{i}") == F.col(f"_high{i}"), F.col(f"_low{i}")).otherwise(0.5 * F.col(f"_low{i}") + 0.5 * F.col(f"_high{i}")) for i in range(len(names))]
        hot = found.groupBy(*by).agg(*reduced).select(*by, *[m.alias(n) for m, n in zip(middle, names.values(), strict=True)])
        out = hot if out is None else out.unionByName(hot)
    return out


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str, split: Split | None = None, limit: int | None = None) -> DataFrame:
    """Median of one column per key, see ``exact_medians``."""
    return exact_medians(df, keys, {value: name}, split, limit)


def exact_mode(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Most frequent non-null value per key, the smallest on ties, from counts per distinct value."""
    by = [quoted(k) for k in keys]
    counts = df.groupBy(*by, quoted(value)).agg(F.count(quoted(value)).alias("_n"))
    best = F.min(F.when(quoted(value).isNotNull(), F.struct((-F.col("_n")).alias("n"), quoted(value).alias("v"))))
    return counts.groupBy(*by).agg(best["v"].alias(name))
