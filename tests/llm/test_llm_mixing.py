"""Targets, flights and mixes."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import DOCS, corpus, frame, words
from pyspark.sql import functions as F

from casefeatures.llm import mixing


def test_targets():
    assert mixing.targets([("b", 100), ("a", 100), (None, 100)]) == {"a": 50.0, "b": 100.0, None: 150.0}
    got = mixing.targets([("a", 1000), ("b", 10), ("c", 10)])  # b and c stop at 3 times their size
    assert got == {"a": 960.0, "b": 30.0, "c": 30.0}
    assert mixing.targets([]) == {} and mixing.targets([("a", 0)]) == {"a": 0.0}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 3000])
def test_flight_keeps_both_sums(n):
    rng = np.random.default_rng(n)
    x = rng.integers(1, 500, n).astype(float)
    p = rng.random(n) if n % 2 else np.full(n, 0.37)
    out = mixing.flight(p, x, rng) if n else p
    assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2
    assert out.sum() == pytest.approx(p.sum(), abs=1e-5) and (out * x).sum() == pytest.approx((p * x).sum(), abs=1e-2)


def test_flight_is_fair():
    """Every document is drawn as often as its probability says."""
    x = np.array([5.0, 9, 1, 7, 7, 3, 30, 2])
    drawn = sum(mixing.flight(np.full(8, 0.4), x, np.random.default_rng(i)) for i in range(3000)) / 3000
    assert np.abs(drawn - 0.4).max() < 0.04


def big(seed=1):
    rng = random.Random(seed)
    return [(i, "w " * rng.randrange(1, 300), "en", rng.choice(["a", "a", "a", "b", "c", "d", None]), 0) for i in range(3000)]


def test_mix_meets_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 100)
    rows = big()
    out = [tuple(r) for r in mixing.mixed(frame(spark, rows)).collect()]
    size = {i: len(words(t)) for i, t, *_ in rows}
    of = {i: s for i, _, _, s, _ in rows}
    sums = Counter()
    for i in size:
        sums[of[i]] += size[i]
    goal = mixing.targets(list(sums.items()))
    taken = defaultdict(int)
    for i, n, whole, target, t in out:
        assert n == size[i] and whole == sums[of[i]] and target == pytest.approx(goal[of[i]]) and 0 <= t <= 3 * n and t % n == 0
        taken[of[i]] += t
    for s, t in goal.items():
        assert abs(taken[s] - t) <= 300, (s, taken[s], t)
    again = [tuple(r) for r in mixing.mixed(frame(spark, rows[::-1])).collect()]
    assert sorted(again) == sorted(out)


def test_odd_rows(spark):
    rows = corpus()
    rows += [rows[0], (None, "a b c", None, None, 0), (None, "a b c", None, "s1", 0), (900, None, None, "void", None)]
    df = frame(spark, rows).withColumns({"row": F.lit("x"), "_row": F.lit("y"), "size": F.lit(0)})
    out = mixing.mixed(df).collect()
    assert len(out) == len(rows) and all(r["taken"] == 0 for r in out if not r["size"])
    copies = mixing.taken_rows(df)
    assert copies.columns == df.columns
    assert sum(len(words(r["text"])) for r in copies.collect()) == sum(r["taken"] for r in out)


def test_empty(spark):
    assert mixing.mixed(spark.createDataFrame([], DOCS)).collect() == []
    assert mixing.taken_rows(spark.createDataFrame([], DOCS)).collect() == []
    assert [r["taken"] for r in mixing.mixed(frame(spark, [(1, None, None, "a", 0)])).collect()] == [0]
