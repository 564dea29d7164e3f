"""Top k against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from casefeatures.llm import mtree

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, every=50):
    sound = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(sound):
        if i % every == 0:
            best = sorted((-sum(x * y for x, y in zip(q, v, strict=False)), j) for b, (j, v) in enumerate(sound) if b != a)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def rows(n, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    out = [(i, (rng.normal(size=dim) * 0.2 + (i % 3)).astype(np.float32).tolist(), 0) for i in range(n)]
    same = [0.25] * dim
    out += [(n + i, same, 0) for i in range(150)]
    return [*out, (9001, None, 0), (9050, None, 0), (9002, [1.0, None], 0), (9003, [float("nan")] * dim, 0), (9004, [float("inf")] * dim, 0), (None, same, 0), (9100, [], 0), (9150, [2.0], 0), (50, same, 0), (50, same, 0)]


@pytest.mark.parametrize(("block", "leaf", "fan"), [(8192, 64, 16), (60, 4, 3)])
def test_like_brute_force(spark, monkeypatch, block, leaf, fan):
    for name, value in (("BLOCK", block), ("LEAF", leaf), ("FAN", fan)):
        monkeypatch.setattr(mtree, name, value)
    data = rows(600)
    df = spark.createDataFrame(data, VECTORS).repartition(3).withColumns({"row": F.lit(0), "v": F.lit("x"), "id": F.lit(1)})
    assert sorted(tuple(r) for r in mtree.top_k(df, "vec_id", "embedding").collect()) == brute(data)


def test_queries_in_lots(spark):
    data = rows(300, seed=2)
    v = mtree.written(mtree.integers(spark.createDataFrame(data, VECTORS), "vec_id", "embedding"), mtree.scratch_path(spark, "v"))
    out = mtree.nearest(v, v.where("id % 50 = 0"), lot=3)
    assert sorted(tuple(r) for r in out.collect()) == brute(data)


def test_few_and_none(spark):
    for data in ([], [(50, [1.0], 0)], [(1, [1.0], 0)], [(0, [1.0], 0), (1, [0.5], 0)], [(0, [], 0), (100, [], 0)]):
        out = mtree.top_k(spark.createDataFrame(data, VECTORS), "vec_id", "embedding")
        assert sorted(tuple(r) for r in out.collect()) == brute(data)


def test_one_long_vector(spark):
    data = [*rows(120, seed=4), (8888, [0.5] * 40, 0)]
    out = mtree.top_k(spark.createDataFrame(data, VECTORS), "vec_id", "embedding")
    assert sorted(tuple(r) for r in out.collect()) == brute(data)


def test_large_numbers(spark):
    data = [(i, [float(2**21 + i * 7 % 13), float(i - 60)], 0) for i in range(120)]
    out = mtree.top_k(spark.createDataFrame(data, VECTORS), "vec_id", "embedding")
    assert sorted(tuple(r) for r in out.collect()) == brute(data)


def test_search_computes_few_products():
    """Clustered vectors: a search reads few of the leaves."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 2, (500, 4)) for c in (-400, -100, 100, 400)]).astype(np.int64)
    import pandas as pd

    tree = mtree.Tree(pd.DataFrame(mtree.build(np.arange(2000), np.arange(2000), x, 1)), 4)
    read = []
    entries = tree.entries
    tree.entries = type("L", (), {"__getitem__": lambda _, i: read.append(i) or entries[i]})()
    got = tree.search(x[1999:], np.array([1999]), 5, np.array([-np.inf]))[0]
    want = sorted(((-int(x[1999] @ x[j]), j) for j in range(1999)))[:5]
    assert sorted((-s, -i) for s, i, _ in got) == want and len(read) < sum(tree.leaf) / 2
