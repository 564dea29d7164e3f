"""Groups cut into pieces give what whole groups give, and what plain Python gives."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from casefeatures.operators import hotgroups as H
from casefeatures.operators.sequence import group_features, order_ties, peak_places, sequence_features

KINDS = ("tail_mean", "tail_max", "diffmean", "diffstd", "difflast")


def brute(values):
    v = [x for x in values if x is not None]
    steps = [b - a for a, b in zip(v, v[1:])]
    positive = [x for x in v if x > 0]
    return {
        "tail_mean": statistics.fmean(v[-3:]) if v else None,
        "tail_max": max(v[-3:]) if v else None,
        "diffmean": statistics.fmean(steps) if steps else None,
        "diffstd": statistics.stdev(steps) if len(steps) > 1 else None,
        "difflast": steps[-1] if steps else None,
        "maxidx": positive.index(max(positive)) if positive else None,
        "median": statistics.median(v) if v else None,
    }


def close(a, b):
    return a is None and b is None or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(5)
    made = {k: [rng.choice([None, -2.0, 0.0, 1.5, float(rng.randint(-50, 50))]) for _ in range(n)] for k, n in enumerate([1, 2, 3, 5, 8, 40, 700, 0])}
    made[8] = [None] * 9  # nothing known
    made[9] = [None] * 120 + [4.0] + [None] * 200 + [7.0, 7.0] + [None] * 150  # gaps longer than a piece
    made[10] = [1.0, None, 2.0]
    return {k: v for k, v in made.items() if v}


@pytest.fixture(scope="module")
def frame(spark, groups):
    rows = [(k, o, v) for k, values in groups.items() for o, v in enumerate(values)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "k long, o int, v double").repartition(5)


@pytest.mark.parametrize("limit", [1_000_000, 60, 4])
def test_features_of_hot_and_cold_groups(spark, frame, groups, rows_per_task, limit):
    rows_per_task(limit)
    out = group_features(
        frame, ["k"], ["o"], [F.count(F.lit(1)).alias("n")], ["v"], KINDS, ["v"], [(F.col("v"), "v_median")]
    )
    got = {r["k"]: r for r in out.collect()}
    assert set(got) == set(groups)
    for k, values in groups.items():
        want = brute(values)
        assert got[k]["n"] == len(values)
        for kind, x in want.items():
            assert close(got[k][f"v_{kind}"], x), (k, kind, got[k][f"v_{kind}"], x)


def test_a_third_of_all_rows_in_one_key(spark, rows_per_task):
    rows_per_task(500)
    df = spark.range(12_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 400 + 1).alias("k"), "id", (F.pmod(F.xxhash64("id"), F.lit(1000)) / 7).alias("v")
    )
    split = H.split_hot(df, ["k"])
    assert [r["k"] for r in split.hot.select("k").distinct().collect()] == [0]
    assert split.cold.count() + split.hot.count() == 12_000
    sizes = [r["count"] for r in H.in_pieces(split, ["k"], ["id"]).groupBy(H.PIECE).count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 1000
    cut = {r["k"]: list(r)[1:] for r in sequence_features(df, ["k"], ["id"], ["v"], KINDS).collect()}
    rows_per_task(1_000_000)
    whole = {r["k"]: list(r)[1:] for r in sequence_features(df, ["k"], ["id"], ["v"], KINDS).collect()}
    assert set(cut) == set(whole)
    for k in whole:
        assert all(close(a, b) for a, b in zip(cut[k], whole[k]))


@pytest.mark.parametrize("limit", [1_000_000, 50])
def test_row_numbers_without_and_with_keys(spark, rows_per_task, limit):
    rows_per_task(limit)
    df = spark.range(500).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 500).alias("o")).repartition(6)
    whole = H.row_numbers(df, [], ["o"], "n").orderBy("o").collect()
    assert [r["n"] for r in whole] == list(range(1, 501))
    per_key = H.row_numbers(df, ["k"], ["o"], "n").orderBy("k", "o").collect()
    seen = {}
    for r in per_key:
        seen[r["k"]] = seen.get(r["k"], 0) + 1
        assert r["n"] == seen[r["k"]]


@pytest.mark.parametrize("limit", [1_000_000, 20])
def test_median_and_mode(spark, frame, groups, rows_per_task, limit):
    rows_per_task(limit)
    medians = {r["k"]: r["m"] for r in H.exact_median(frame, ["k"], "v", "m").collect()}
    modes = {r["k"]: r["m"] for r in H.exact_mode(frame, ["k"], "v", "m").collect()}
    for k, values in groups.items():
        v = [x for x in values if x is not None]
        assert close(medians[k], statistics.median(v) if v else None)
        assert modes[k] == (min(v, key=lambda x: (-v.count(x), x)) if v else None)


def test_null_key_is_a_group(spark, rows_per_task):
    df = spark.createDataFrame([(None, i, float(i * i)) for i in range(30)] + [(1, i, float(i)) for i in range(3)], "k long, o int, v double")
    want = {r["k"]: list(r)[1:] for r in sequence_features(df, ["k"], ["o"], ["v"]).collect()}
    rows_per_task(5)
    got = {r["k"]: list(r)[1:] for r in sequence_features(df, ["k"], ["o"], ["v"]).collect()}
    assert set(got) == {None, 1}
    for k in want:
        assert all(close(a, b) for a, b in zip(got[k], want[k]))


def test_peak_places_of_ties(spark):
    df = spark.createDataFrame([(1, 0, -1.0), (1, 1, 5.0), (1, 2, 5.0), (2, 0, 0.0), (3, 0, None)], "k long, o int, v double")
    assert {r["k"]: r["v_maxidx"] for r in peak_places(df, ["k"], ["o"], ["v"]).collect()} == {1: 0, 2: None, 3: None}


def test_medians_of_many_columns_at_once(spark, rows_per_task, monkeypatch):
    """Counts, places and medians of all columns come from one table: one checkpoint, whatever the number of columns."""
    rows = [(k, i, float((i * 37) % 11), (i * 5) % 7 if i % 4 else None, None if k else i) for k, n in ((0, 90), (1, 61), (2, 4)) for i in range(n)]
    df = spark.createDataFrame(rows, "k long, o int, a double, b int, c long")
    medians = [(F.col("a"), "ma"), (F.when(F.col("b") > 2, F.col("b")), "mb"), (F.col("c"), "mc")]
    want = {r["k"]: list(r) for r in group_features(df, ["k"], ["o"], [F.count("*").alias("n")], medians=medians).collect()}
    rows_per_task(20)
    made = []
    monkeypatch.setattr(H, "checkpointed", lambda d, f=H.checkpointed: made.append(1) or f(d))
    got = group_features(df, ["k"], ["o"], [F.count("*").alias("n")], medians=medians)
    assert {r["k"]: list(r) for r in got.collect()} == want
    assert len(made) <= 1
    assert want[1][4] is None and want[0][4] == 44.5


def test_order_ties(spark):
    rows = [(1, 1, "a"), (1, 1, "b"), (1, 2, "c"), (2, 1, "d"), (None, None, "e"), (None, None, "f"), (3, None, "g"), (3, None, "h"), (3, 5, "i"), (3, 5, "j")]
    df = spark.createDataFrame(rows, "case_id long, num_group1 long, tied_rows string")  # a column of the result's name
    out = {r["case_id"]: r["tied_rows"] for r in order_ties(df, ["case_id"], ["num_group1"]).collect()}
    assert out == {1: 2, None: 2, 3: 4}
    assert order_ties(df.limit(0), ["case_id"], ["num_group1"]).collect() == []


def test_pieces_are_bounded(spark, monkeypatch):
    """Many rows for the limit do not make more pieces than the bound; the places stay."""
    made, plain = [], H.in_pieces
    monkeypatch.setattr(H, "MAX_PIECES", 3)
    monkeypatch.setattr(H, "in_pieces", lambda *a: made.append(plain(*a)) or made[-1])
    df = spark.range(2000).select((F.col("id") % 2).alias("k"), (F.col("id") * 7919 % 2000).alias("o"))
    out = H.row_numbers(df, ["k"], ["o"], "place", limit=10)
    assert out.where(F.col("place") != F.expr("(o div 2) + 1")).count() == 0 and out.count() == 2000
    assert made[0].rdd.getNumPartitions() <= 3
