"""Row functions, types and ranges on values the test tables lack."""

import datetime

import pytest
from pyspark.sql import functions as F

from casefeatures.functions import rows as R
from casefeatures.functions import schema as S
from casefeatures.operators import aggregates as A


def one(spark, schema, rows, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_ratio(spark):
    nan = float("nan")
    rows = [(1.0, 2.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0), (1.0, None), (nan, 1.0)]
    got = one(spark, "a double, b double", rows, R.safe_ratio(F.col("a"), F.col("b")))
    assert got == [(0.5,), (None,), (None,), (None,), (None,), (None,), (None,)]


def test_peak_drop_and_flags(spark):
    df = spark.createDataFrame([(1, 0, 4.0), (1, 1, 1.0), (2, 0, 0.0), (3, 0, None), (4, 0, -2.0), (4, 1, -1.0)], "k int, o int, v double")
    v, o = F.col("v"), F.col("o")
    got = {r["k"]: list(r)[1:] for r in df.groupBy("k").agg(A.peak_drop(v, o), A.recent_flag(v, 2.0), A.rise_flag(v, o), A.total(v)).collect()}
    assert got[1] == [0.75, 1, 0, 5.0]
    assert got[2] == [1.0, None, 0, 0.0]
    assert got[3] == [None, None, 0, 0.0]
    assert got[4] == [0.0, None, 1, -3.0]


def test_month_dates_and_parts(spark):
    d = datetime.date
    rows = [("2020", "2"), ("2020.0", "13.0"), ("2020", "0"), (None, "1"), ("x", "1")]
    got = one(spark, "y string, m string", rows, R.make_month_date(F.col("y"), F.col("m")))
    assert got == [(d(2020, 2, 1),), (None,), (None,), (None,), (None,)]
    got = one(spark, "a date", [(d(2021, 1, 1),), (d(2023, 1, 1),)], *R.date_parts(F.col("a"), "a"))
    assert got == [(5, 1, 1, 53), (7, 1, 1, 52)]


def test_digits_and_first_part(spark):
    rows = [("P114",), ("1x2y",), ("12",), ("",), (None,), ("P1P2",), ("-5",), ("a55475b1",)]
    got = [r[0] for r in one(spark, "c string", rows, R.digits_to_int(F.col("c")))]
    assert got == [114, None, 12, None, None, None, 5, None]
    got = [r[0] for r in one(spark, "c string", [("P1_2_3",), ("a55475b1",), (None,), ("x",)], R.split_first(F.col("c")))]
    assert got == ["P1", None, None, "x"]


def test_null_handling(spark):
    df = spark.createDataFrame([(1, None, float("nan")), (2, None, None), (3, "x", 1.0)], "k int, c string, v double")
    assert [r["k"] for r in R.drop_all_null_rows(df, ["c", "v"]).orderBy("k").collect()] == [1, 3]
    assert [r["v"] for r in R.all_nan_to_null(df).orderBy("k").collect()] == [None, None, 1.0]
    assert R.drop_all_null_rows(df, []).count() == 3
    flags = [tuple(r) for r in df.orderBy("k").select(*R.one_hot(F.col("c"), ["x", "y"], "c"), R.null_flag(F.col("c"))).collect()]
    assert flags == [(None, None, 1), (None, None, 1), (1, 0, 0)]
    assert [r[0] for r in df.orderBy("k").select(R.remap_values(F.col("c"), {"x": 1}, -1)).collect()] == [-1, -1, 1]


def test_bands(spark):
    got = one(spark, "y double", [(25.0,), (25.1,), (60.0,), (60.1,), (None,)], *R.band_flags(F.col("y"), [25, 35, 45, 60], "age"))
    assert got == [(1, 0, 0, 0, 0), (0, 1, 0, 0, 0), (0, 0, 0, 1, 0), (0, 0, 0, 0, 1), (0, 0, 0, 0, 0)]


def test_cast_by_suffix(spark):
    df = spark.createDataFrame([(1, "2.5", "2020-01-02", 7, True)], "case_id int, a_1A string, b_2D string, c_3M int, d_4L boolean")
    out = S.cast_by_suffix(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "double", "date", "string", "boolean"]


def test_strict_cast_fails_and_lenient_does_not(spark):
    df = spark.createDataFrame([(70000,)], "n int")
    assert df.select(S.lenient_cast(F.col("n"), "smallint")).first()[0] is None
    with pytest.raises(Exception, match="OVERFLOW"):
        df.select(S.strict_cast(F.col("n"), "smallint")).collect()


def test_narrow_types(spark):
    rows = [(0, 0, -(2**31) + 1, 0.0, None, 1, 1e39), (0, 126, 2**31 - 2, float("nan"), None, 127, 1.0)]
    df = spark.createDataFrame(rows, "case_id long, a long, b long, d double, e long, f long, g double")
    types = {f.name: f.dataType.simpleString() for f in S.narrow_types(df).schema.fields}
    assert types == {"case_id": "bigint", "a": "tinyint", "b": "int", "d": "float", "e": "bigint", "f": "smallint", "g": "double"}
    got = [tuple(r)[:3] for r in S.narrow_types(df).collect()]
    assert got == [r[:3] for r in rows]


def test_pick_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "x", True)], "num_a long, b_mean double, num_c string, num_d_id boolean")
    assert S.pick_columns(df, S.NUMERIC_TYPES, prefix="num_") == ["num_a"]
    assert S.pick_columns(df, suffixes=("_mean",)) == ["b_mean"]
    assert S.pick_columns(df, without=("num_a",), without_suffixes=("_id",)) == ["b_mean", "num_c"]
