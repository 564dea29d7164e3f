"""Area under the ROC curve, with or without row weights, and the summary over folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefeatures.functions.schema import quoted
from casefeatures.operators.hotgroups import running_sums


def weighted_auc(df: DataFrame, score: str, target: str, weight: str | None = None, keys: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """Area per key (or of the whole table). Tied scores share; null if a class has no weight.

    Weights are summed per distinct score first. The area is the sum, over scores, of the positive weight times
    the negative weight below it (half of what ties). The running sum is cut into pieces where it is long.
    """
    w = F.lit(1.0) if weight is None else quoted(weight).cast("double")
    by = [quoted(k) for k in keys]
    per_score = (
        df.filter(quoted(score).isNotNull())
        .groupBy(*by, quoted(score).alias("_score"))
        .agg(
            F.sum(F.when(quoted(target) == 1, w).otherwise(0.0)).alias("_pos"),
            F.sum(F.when(quoted(target) == 0, w).otherwise(0.0)).alias("_neg"),
        )
    )
    run = running_sums(per_score, keys, ["_score"], {"_neg_upto": F.col("_neg")}, limit)
    pairs = F.sum(F.col("_pos") * (F.col("_neg_upto") - F.col("_neg") / 2))
    return run.groupBy(*by).agg(F.try_divide(pairs, F.sum("_pos") * F.sum("_neg")).alias("auc"))


def auc(df: DataFrame, score: str, target: str, keys: Sequence[str] = ()) -> DataFrame:
    return weighted_auc(df, score, target, None, keys)


def cv_summary(scores: DataFrame, score: str = "auc", fold: str = "fold") -> DataFrame:
    """The fold scores in order of fold, their mean and their maximum."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(quoted(fold).alias("f"), quoted(score).alias("s")))), lambda x: x["s"])
    return scores.agg(listed.alias("scores"), F.avg(quoted(score)).alias("mean_score"), F.max(quoted(score)).alias("max_score"))
