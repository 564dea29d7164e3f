"""Joins between the levels. All are equi-joins on keys that are unique on both sides after a roll-up."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefeatures.operators.hotgroups import same_keys, split_hot

CASE = "case_id"
CHILD_KEYS = ("case_id", "num_group1")


def join_one(rows: DataFrame, side: DataFrame, key: str = CASE, how: str = "inner") -> DataFrame:
    """Join of many rows per key with a table of one row per key, "inner" or "left".

    Rows of hot keys meet the few side rows of those keys by broadcast (at most MAX_HOT_KEYS rows), so that
    no task gets all rows of a key; the others are joined as usual.
    """
    split = split_hot(rows, [key])
    if split.hot is None:
        return rows.join(side, key, how)
    few = side.join(split.hot_keys, same_keys(side, split.hot_keys, [key]), "left_semi")
    return split.cold.join(side, key, how).unionByName(split.hot.join(F.broadcast(few), key, how))


def join_child_level(depth1: DataFrame, rolled: DataFrame, keys: Sequence[str] = CHILD_KEYS) -> DataFrame:
    """Bring rolled-up depth-2 rows to their depth-1 row. The full key is unique, so no key is hot."""
    return depth1.join(rolled, list(keys), "left")


def join_base(base: DataFrame, rolled: DataFrame, how: str, key: str = CASE, suffix: str = "_right") -> DataFrame:
    """Join a roll-up to the base: "inner" for training data, "left" for test data. A name that is taken gets a suffix."""
    if how not in ("inner", "left"):
        raise ValueError(f"how is {how!r}")
    return base.join(not_taken(rolled, base.columns, key, suffix), key, how)


def not_taken(rolled: DataFrame, columns: Iterable[str], key: str = CASE, suffix: str = "_right") -> DataFrame:
    """The roll-up with a suffix on those of its names that are among the columns; the key keeps its name."""
    taken = set(columns)
    return rolled.withColumnsRenamed({c: c + suffix for c in rolled.columns if c != key and c in taken})


def join_target(features: DataFrame, base: DataFrame, key: str = CASE, columns: Sequence[str] = ("WEEK_NUM", "target"), suffix: str = "_right") -> DataFrame:
    """Bring week and target to the features; a name that is taken gets a suffix."""
    taken = set(features.columns)
    side = base.select(key, *[F.col(c).alias(c + suffix if c in taken else c) for c in columns])
    return features.join(side, key, "left")


def join_weights(data: DataFrame, weights: DataFrame, key: str = CASE) -> DataFrame:
    return data.join(weights, key, "left")


def cases_left(base: DataFrame, rolled: Mapping[str, DataFrame], key: str = CASE) -> DataFrame:
    """Cases that remain after each inner join in turn, one row per step, from one pass over the keys."""
    df = base.select(key)
    for name, table in rolled.items():
        df = df.join(table.select(key, F.lit(True).alias(f"_in_{name}")), key, "left")
    present = [F.col(f"_in_{name}").isNotNull() for name in rolled]
    steps = [F.count_if(reduce(lambda a, b: a & b, present[: i + 1])).alias(str(i)) for i in range(len(present))]
    counts = df.agg(F.count(F.lit(1)).alias("base"), *steps)
    rows = [F.struct(F.lit(0).alias("step"), F.lit("base").alias("table"), F.col("base").alias("cases"))]
    rows += [F.struct(F.lit(i + 1).alias("step"), F.lit(n).alias("table"), F.col(str(i)).alias("cases")) for i, n in enumerate(rolled)]
    return counts.select(F.inline(F.array(*rows)))
