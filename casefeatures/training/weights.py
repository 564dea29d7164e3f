"""Row weights, column roles and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefeatures.functions.schema import quoted
from casefeatures.operators.hotgroups import row_numbers
from casefeatures.operators.joins import join_one
from casefeatures.sources.files import checkpointed

# Columns that are no features.
ROLE_COLUMNS = ("target", "case_id", "WEEK_NUM", "MONTH", "date_decision", "weights")
MAX_BROADCAST_GROUPS = 100_000
# Strata of groups by their share of positives, each a twentieth wide.
STRATA = 20


def _counts(data: DataFrame, group: str, target: str) -> DataFrame:
    """Rows of each class per group, computed once: what reads them again reads the few counted rows."""
    return checkpointed(data.groupBy(group).agg(F.count_if(F.col(target) == 1).alias("_pos"), F.count_if(F.col(target) == 0).alias("_neg")))


def _weights_of(counts: DataFrame, group: str) -> DataFrame:
    """One row per group with the weight of either class."""
    pos, neg = F.nullif(F.col("_pos"), F.lit(0)).cast("double"), F.nullif(F.col("_neg"), F.lit(0)).cast("double")
    return counts.select(quoted(group), (pos / pos).alias("_weight_1"), (pos / neg).alias("_weight_0"))


def class_weights(data: DataFrame, group: str = "WEEK_NUM", target: str = "target") -> DataFrame:
    """Per group and class: positives of the group / rows of the class. A group without positives gives null."""
    rows = [F.struct(F.lit(y).alias(target), F.col(f"_weight_{y}").alias("weights")) for y in (1, 0)]
    return _weights_of(_counts(data, group, target), group).select(quoted(group), F.inline(F.array(*rows)))


def _with_groups(data: DataFrame, side: DataFrame, group: str) -> DataFrame:
    """Join rows with one row per group: broadcast where there are few groups, else hot groups apart from the others."""
    if side.count() <= MAX_BROADCAST_GROUPS:
        return data.join(F.broadcast(side), group, "left")
    return join_one(data, side, group, "left")


def class_weight_by_group(data: DataFrame, group: str = "WEEK_NUM", target: str = "target") -> DataFrame:
    """Add ``weights``. Counts combine before the shuffle, so a group with most of the rows is no hot spot, nor is it in the join."""
    joined = _with_groups(data, _weights_of(_counts(data, group, target), group), group)
    weight = F.when(quoted(target) == 1, F.col("_weight_1")).when(quoted(target) == 0, F.col("_weight_0"))
    return joined.withColumn("weights", weight).drop("_weight_1", "_weight_0")


def split_roles(columns: Sequence[str], roles: Sequence[str] = ROLE_COLUMNS) -> tuple[list[str], list[str]]:
    """Feature names and the rest."""
    roles = set(roles)
    return [c for c in columns if c not in roles], [c for c in columns if c in roles]


def fold_of_groups(data: DataFrame, group: str = "WEEK_NUM", target: str = "target", folds: int = 5) -> DataFrame:
    """One row per group with its fold, by one rule for any number of groups, without the driver.

    Groups are put in strata by their share of positives, and dealt to and fro over the folds from the largest to the smallest of
    each stratum; the dealing goes on from one stratum to the next. Within a stratum both classes follow the size, so the
    folds' counts of either class differ by no more than a largest group per stratum.
    """
    counts = _counts(data, group, target)
    rows = F.col("_pos") + F.col("_neg")
    sized = counts.select(group, F.floor(STRATA * F.col("_pos") / F.nullif(rows, F.lit(0))).alias("_stratum"), (-rows).alias("_size"))
    place = (F.col("_n") - 1) % (2 * folds)
    return row_numbers(sized, [], ["_stratum", "_size", group], "_n").select(
        group, F.when(place < folds, place).otherwise(2 * folds - 1 - place).cast("int").alias("fold")
    )


def stratified_group_folds(data: DataFrame, group: str = "WEEK_NUM", target: str = "target", folds: int = 5) -> DataFrame:
    """Add ``fold``: a group is never split and the class shares of the folds stay near even (see ``fold_of_groups``)."""
    return _with_groups(data, checkpointed(fold_of_groups(data, group, target, folds)), group)
