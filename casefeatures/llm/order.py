"""Places of rows in an order that no single task sees whole."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casefeatures.sources.files import scratch_path, written


def in_pieces(df: DataFrame, by: list[str], name: str = "ordered") -> DataFrame:
    """``df`` sorted and written in range pieces: ``piece`` and ``at`` ascend in the order of ``by`` (nulls first), ``at`` by one within a piece.

    ``df`` has none of these columns. Equal rows come in any order.
    """
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    return written(rows.withColumn("piece", F.shiftright("at", 33)), scratch_path(df.sparkSession, name))


def placed(df: DataFrame, group: list[str], by: list[str]) -> DataFrame:
    """``df`` with ``place`` (from 0, in the order of ``by``) and ``n`` (rows of the group); nulls are values and come first.

    A group may run over many pieces: each piece counts its own rows, and a running sum over the counts of one group, as many
    as it has pieces, says where a piece begins. Written, so that equal rows keep their places.
    """
    rows = in_pieces(df, [*group, *by])
    counts = rows.groupBy(*group, "piece").agg(F.min("at").alias("_first"), F.count("*").alias("_rows"))
    own = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = F.sum("_rows").over(own.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(
        *[F.col(g).alias(f"_{g}") for g in group], F.col("piece").alias("_piece"), "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_rows").over(own).alias("n")
    )
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group], F.col("piece") == F.col("_piece"))
    return rows.join(counts, same).select(*df.columns, (F.col("at") - F.col("_first") + F.col("_before")).alias("place"), "n")
