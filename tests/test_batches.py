"""Groups reduced in batches give what Spark's own aggregates and windows give."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F
from test_plans import initial, plan_of

from casefeatures.operators import aggregates as A
from casefeatures.operators import batches as B
from casefeatures.operators.sequence import batch_features, group_features
from casefeatures.plans import rollup as P
from casefeatures.plans.spec import TableSpec

SEQUENCES = ["tail_mean", "tail_max", "diffmean", "diffstd", "difflast"]
SCHEMA = "k long, o long, d double, i int, s short, word string, day date, flag boolean, empty double"


@pytest.fixture(scope="module")
def rows(spark):
    """Keys of one to 700 rows, one of them null; nulls everywhere, also in the order; a column of nulls only."""
    rnd, out = random.Random(5), []
    for k, n in [(None, 40), (1, 1), (2, 2), (3, 700), (4, 5), *[(10 + i, rnd.randint(1, 9)) for i in range(200)]]:
        for o in range(n):
            def maybe(x):
                return None if rnd.random() < 0.3 else x

            day = datetime.date(1970, 1, 1) + datetime.timedelta(rnd.randint(-400, 9000))
            out.append(
                (k, None if o == 0 and n > 3 else o, maybe(rnd.choice([0.0, -1.5, 2.25, 7.0, rnd.random() * 100])), maybe(rnd.randint(-5, 5)), maybe(rnd.randint(0, 3)),
                 maybe(rnd.choice("abc")), maybe(day), maybe(rnd.random() < 0.5), None)
            )
    rnd.shuffle(out)
    return spark.createDataFrame(out, SCHEMA).repartition(3).persist()


def aggs():
    d, i, o = F.col("d"), F.col("i"), F.col("o")
    return {
        "n_d": A.count_nonnull(d), "n_word": A.count_nonmissing(F.col("word"), "b"), "n_up": A.count_where(d > 1), "n_empty": A.count_nonnull(F.col("empty")),
        **{f"d_{k}": A.positive_stat(k, d) for k in ("sum", "mean", "min", "max", "std", "median")},
        **{f"i_{k}": A.stat(k, i) for k in ("mean", "min", "max", "std")},
        "i_total": A.whole_total(i), "empty_sum": A.total(F.col("empty")), "empty_max": A.stat("max", F.col("empty")), "any": A.any_null(F.col("flag")),
        "day_max": A.stat("max", F.col("day")), "day_mean": A.mean_date(F.col("day")), "day_std": A.date_std(F.col("day")), "day_span": A.span_days(F.col("day")),
        "first": A.first_value(F.col("word"), o), "first_known": A.first_nonnull(F.col("word"), o), "last": A.last_value(d, o), "last_known": A.last_nonnull(F.col("day"), o),
        "last_up": A.last_positive(d, o), "drop": A.peak_drop(d, o), "rise": A.rise_flag(d, o), "ends": A.first_last_ratio(d, o),
        "i_mode": A.mode_of(i), "d_mode": A.mode_of(d), "empty_mode": A.mode_of(F.col("empty")), "ratio": A.ratio_of("sum", d, i), "recent": A.recent_flag(d, 2.0),
    }


def same(a, b):
    return a == b or isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("limit, at_once", [(1_000_000, 10_000), (1_000_000, 3), (30, 10_000)])
def test_batches_give_what_columns_give(spark, rows, rows_per_task, monkeypatch, limit, at_once):
    more = (SEQUENCES, ["d"], [(F.col("d"), "d_middle")])
    want = group_features(rows, ["k"], ["o"], [c.alias(n) for n, c in aggs().items()], ["d", "i", "s", "empty"], *more, modes=True)
    rows_per_task(limit)
    monkeypatch.setattr(B, "ROWS_AT_ONCE", at_once)
    got = batch_features(rows, ["k"], ["o"], aggs, ["d", "i", "s", "empty"], *more)
    assert "MapInArrow" in plan_of(got) and [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
    one, two = ({r["k"]: r for r in df.collect()} for df in (want, got))
    assert set(one) == set(two) and len(one) == 205
    for k, r in one.items():
        for c, x in r.asDict().items():
            assert same(x, two[k][c]), (k, c, x, two[k][c])


def test_a_type_that_batches_do_not_take_is_reduced_by_columns(spark):
    df = spark.range(20).selectExpr("id % 3 AS k", "id AS o", "CAST(id AS DECIMAL(9,2)) AS v")
    out = batch_features(df, ["k"], ["o"], lambda: {"m": A.stat("max", F.col("v"))}, ["v"])
    assert "MapInArrow" not in initial(out) and {r["k"]: int(r["m"]) for r in out.collect()} == {0: 18, 1: 19, 2: 17}


def test_wide_roll_ups_run_no_windows_over_their_columns(spark):
    """Failed before: every numeric column had three windows and every result an aggregate of its own, each a call or two a row."""
    df = spark.range(400).selectExpr("id % 40 AS case_id", "id AS num_group1", *[f"CAST(id % {i + 2} AS DOUBLE) AS c{i}_1A" for i in range(30)])
    plan = initial(P.reduce_table(df, TableSpec(name="t", depth=1, sequences=True, stats={f"c{i}_sum": ("sum", f"c{i}_1A") for i in range(30)})))
    assert plan.count("windowspecdefinition") <= 1 and "Aggregate" not in plan and "MapInArrow" in plan


def test_rows_of_an_even_table_are_dealt_once(spark):
    """Failed before: rows were dealt by case and number for the join with their child, and once more, encoded and joined, by case."""
    spec = TableSpec(name="t", depth=1, child="c", stats={"x_sum": ("sum", "x_1A")}, sequences=True)
    rows = spark.range(6000).selectExpr("id % 2000 AS case_id", "id AS num_group1", "CAST(id AS DOUBLE) AS x_1A")
    child = spark.range(0, 6000, 2).selectExpr("id % 2000 AS case_id", "id AS num_group1", "1 AS n").groupBy("case_id", "num_group1").agg(F.sum("n").cast("double").alias("y_2A"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = P.rollup_depth1(rows, spec, None, child)
        plan = initial(out)
        got = {r["case_id"]: (r["x_sum"], r["y_2A_difflast"]) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("REPARTITION_BY_COL" in line for line in dealt) == 1
    assert len(dealt) <= 3 and all("case_id" in line for line in dealt)  # the rows, the child's own roll-up, and that to the rows
    assert got == {k: (float(3 * k + 6000), 0.0 if k % 2 == 0 else None) for k in range(2000)}
