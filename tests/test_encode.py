"""Encodings: unknown, null and tied categories, and lookups too large to broadcast."""

import pytest
from pyspark.sql import functions as F

from casefeatures.operators import encode as E


@pytest.fixture(scope="module")
def train(spark):
    rows = [("a", 1), ("a", 0), ("b", 1), ("b", 0), ("c", 1), ("d", None), (None, 1), (None, 0), ("a55475b1", 0)]
    return spark.createDataFrame(rows, "c string, y int")


@pytest.fixture(scope="module")
def lookup(train):
    return E.with_ordinals(E.fit_encodings(train, ["c"], "y"))


def test_fit_and_rank(lookup):
    got = {r["category"]: (r["mean_target"], r["frequency"], r["ordinal"]) for r in lookup.collect()}
    assert got == {"a55475b1": (0.0, 1, 0), "a": (0.5, 2, 1), "b": (0.5, 2, 2), "c": (1.0, 1, 3), "d": (None, 1, 4)}


def test_filled_null_is_a_category(train):
    got = {r["category"]: r["frequency"] for r in E.fit_encodings(train, [E.fitted("c", fill="None")], "y").collect()}
    assert got["None"] == 2


def encoded(df, lookup, **kw):
    out = E.encode(df, lookup, [E.fitted("c", **kw)])
    return {r["k"]: (r["c_mean_target"], r["c_frequency"], r["c_encoded"]) for r in out.collect()}


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(1, "a"), (2, "zzz"), (3, None), (4, "d"), (5, "c")], "k int, c string")


WANT = {1: (0.5, 2, 1), 2: (None, None, None), 3: (None, None, None), 4: (None, 1, 4), 5: (1.0, 1, 3)}


def test_encode(rows, lookup):
    assert encoded(rows, lookup) == WANT


def test_a_large_lookup_is_joined_without_broadcasting_it(spark, rows, lookup, monkeypatch):
    monkeypatch.setattr(E, "MAX_BROADCAST_CATEGORIES", 1)
    monkeypatch.setattr(E, "HOT_SHARE", 5)  # categories above a fifth of the rows are hot
    assert encoded(rows, lookup) == WANT
    many = rows.crossJoin(spark.range(50)).select((F.col("k") * 100 + F.col("id")).alias("k"), "c")
    assert encoded(many, lookup) == {k * 100 + i: v for k, v in WANT.items() for i in range(50)}


def test_given_values_without_frequencies(spark, rows, monkeypatch):
    given = E.given_values(spark, {"c": {"a": 3, "c": 7.5}})
    want = {1: 3.0, 2: 0.0, 3: 0.0, 4: 0.0, 5: 7.5}
    cat = [E.valued("c", "v", default=0)]
    assert {r["k"]: r["v"] for r in E.encode(rows, given, cat).collect()} == want
    monkeypatch.setattr(E, "MAX_BROADCAST_BYTES", 1)
    assert {r["k"]: r["v"] for r in E.encode(rows, given, cat).collect()} == want


def test_index(spark, train, rows):
    lookup = E.index_categories(train, "c")
    out = E.encode(rows, lookup, [E.valued("c", "c", default=0)])
    assert {r["k"]: r["c"] for r in out.collect()} == {1: 1.0, 2: 0.0, 3: 0.0, 4: 5.0, 5: 4.0}


def test_share(lookup):
    got = {r["category"]: r["share"] for r in E.frequency_share(lookup).collect()}
    assert got["a"] == pytest.approx(2 / 7) and sum(got.values()) == pytest.approx(1)


def spread(df):
    """Rows per task of the last shuffle, largest first; tasks without rows count."""
    spark = df.sparkSession
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    return sorted(sizes, reverse=True)


@pytest.mark.parametrize("known", [True, False])
def test_a_hot_category_of_a_large_lookup_is_spread(spark, monkeypatch, known):
    """A third of all rows hold one category, which the lookup may not even know; nothing says that it is frequent."""
    monkeypatch.setattr(E, "MAX_BROADCAST_CATEGORIES", 1)
    lookup = spark.range(20_000).select(F.lit("c").alias("column"), F.concat(F.lit("v"), "id").alias("category"), F.col("id").cast("double").alias("value"))
    hot = "v7" if known else "elsewhere"
    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, hot).otherwise(F.concat(F.lit("v"), F.col("id") % 19_000)).alias("c"))
    out = E.encode(df, lookup, [E.valued("c", "number", default=-1)])
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = spread(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    assert sum(sizes) == 30_000 and len(sizes) == 8 and sizes[0] <= 2 * sizes[4]
    want = {r["id"]: -1.0 if r["c"] == "elsewhere" else float(r["c"][1:]) for r in df.collect()}
    assert {r["id"]: r["number"] for r in out.collect()} == want


def test_frequent_values_are_found_whatever_was_fitted(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 500 == 0, "often").when(F.col("id") % 4 == 0, None).otherwise(F.col("id").cast("string")).alias("c"))
    found = {r["item"] for r in E.frequent_categories(df, {0: E.valued("c", "n")}).select(F.inline("_frequent0")).collect()}
    assert "often" in found and len(found) <= 2 * E.HOT_SHARE


def test_lookups_share_one_budget_of_broadcasts():
    mb = 1024 * 1024
    sizes = {f"c{i}": (1000, 60 * mb) for i in range(18)} | {"few": (5, 300), "wide": (5, 65 * mb), "many": (500_001, mb)}
    wanted = [*sizes]
    chosen = [wanted[i] for i in sorted(E._broadcast_lookups(sizes, wanted))]
    assert "few" in chosen and "wide" not in chosen and "many" not in chosen
    assert len(chosen) == 5 and sum(sizes[c][1] for c in chosen) <= E.MAX_BROADCAST_TOTAL


def test_lookups_beyond_the_budget_are_joined_all_the_same(spark, rows, lookup, monkeypatch):
    both = lookup.unionByName(lookup.withColumn("column", F.lit("d")))
    df = rows.withColumn("d", F.col("c"))
    cats = [E.fitted("c"), E.fitted("d")]
    want = {r["k"]: list(r) for r in E.encode(df, both, cats).collect()}
    monkeypatch.setattr(E, "MAX_BROADCAST_TOTAL", sum(s for _, s in E.lookup_sizes(lookup).values()))
    got = E.encode(df, both, cats)
    assert {r["k"]: list(r) for r in got.collect()} == want


def test_large_lookups_of_no_rows(spark, lookup, monkeypatch):
    monkeypatch.setattr(E, "MAX_BROADCAST_CATEGORIES", 0)
    empty = spark.createDataFrame([], "k int, c string")
    assert E.encode(empty, lookup, [E.fitted("c")]).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, None)], "k int, c string")
    assert {r["k"]: r["c_encoded"] for r in E.encode(nulls, lookup, [E.fitted("c")]).collect()} == {1: None, 2: None}
