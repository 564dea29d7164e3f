"""Aggregates on rows made for them."""

import datetime

from pyspark.sql import functions as F

from casefeatures.operators import aggregates as A
from casefeatures.operators.sequence import group_features


# Days since 1970 that deviate by just so many days.
WHOLE = [
    ([9503, 8779, 8711, 8777], 375), ([9449, 9933, 9999, 9669], 253), ([9617, 10294, 9212, 9020, 9303, 9672, 9921], 440),
    ([8359, 8937, 8397, 8745], 279), ([8531, 8195, 8367, 8741], 233), ([8672, 8427, 8666, 9646, 9484], 547),
]


def test_deviation_of_whole_days_is_not_rounded_below_it(spark):
    first = datetime.date(1970, 1, 1)
    rows = [(i, first + datetime.timedelta(d)) for i, (days, _) in enumerate(WHOLE) for d in days]
    df = spark.createDataFrame(rows, "k int, day date").coalesce(1)
    found = {r["k"]: r["std"] for r in df.groupBy("k").agg(A.date_std(F.col("day")).alias("std")).collect()}
    assert found == {i: std for i, (_, std) in enumerate(WHOLE)}


def test_deviation_of_few_and_far_dates(spark):
    rows = [(1, "2001-01-01"), (2, None), (3, "0001-01-01"), (3, "9999-12-31"), (4, "1969-12-30"), (4, "1969-12-31"), (4, "2020-02-29"), (4, None)]
    df = spark.createDataFrame(rows, "k int, day string").select("k", F.col("day").cast("date").alias("day"))
    found = {r["k"]: (r["std"], r["plain"]) for r in df.groupBy("k").agg(A.date_std(F.col("day")).alias("std"), F.floor(F.stddev_samp(F.unix_date("day"))).alias("plain")).collect()}
    assert found[1] == found[2] == (None, None)
    assert all(std == plain for std, plain in found.values())


def test_marked_rows_are_not_sorted_again(spark):
    """Modes next to sequence features are taken from the rows in the order the windows leave them in."""
    df = spark.range(100).select((F.col("id") % 9).alias("k"), F.col("id").alias("o"), (F.col("id") % 4 * 1.0).alias("v"))
    out = group_features(df, ["k"], ["o"], [A.mode_of(F.col("v")).alias("v_mode")], ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan and "ObjectHashAggregate" not in plan and plan.count("- Sort [") == 1
    assert out.count() == 9
