"""Weights, folds, areas, and small models end to end."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from casefeatures.training import scores, trees, weights


@pytest.fixture(scope="module")
def weeks(spark):
    sizes = {1: (3, 9), 2: (0, 4), 3: (5, 0), 4: (1, 30), 5: (2, 2), 6: (4, 11), 7: (6, 20), 8: (2, 7)}
    rows, case = [], itertools.count()
    for week, (pos, neg) in sizes.items():
        rows += [(next(case), week, 1) for _ in range(pos)] + [(next(case), week, 0) for _ in range(neg)]
    return spark.createDataFrame(rows, "case_id long, WEEK_NUM long, target int")


def test_class_weights(weeks):
    got = {(r["WEEK_NUM"], r["target"]): r["weights"] for r in weights.class_weight_by_group(weeks).collect()}
    assert got[1, 1] == 1.0 and got[1, 0] == pytest.approx(1 / 3)
    assert got[2, 0] is None  # no positive in the week
    assert got[3, 1] == 1.0 and (3, 0) not in got
    assert got[4, 0] == pytest.approx(1 / 30)
    assert weights.class_weight_by_group(weeks).count() == weeks.count()


def test_class_weights_of_many_groups(spark, rows_per_task, monkeypatch):
    """Too many groups to broadcast and one that holds a third of the rows: the same weights, with the hot group joined apart."""
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("WEEK_NUM"), (F.pmod(F.xxhash64("id"), F.lit(5)) == 0).cast("int").alias("target"))
    df = df.withColumn("target", F.when(F.rand(1) > 2, None).otherwise(F.col("target")))
    want = sorted(map(tuple, weights.class_weight_by_group(df).collect()))
    monkeypatch.setattr(weights, "MAX_BROADCAST_GROUPS", 3)
    rows_per_task(500)
    out = weights.class_weight_by_group(df)
    assert sorted(map(tuple, out.select("WEEK_NUM", "target", "weights").collect())) == want
    assert "Union" in out._jdf.queryExecution().executedPlan().toString()


def check_folds(out, n, folds, largest):
    assert out.filter(F.col("fold").isNull()).count() == 0 and out.count() == n
    assert out.groupBy("WEEK_NUM").agg(F.countDistinct("fold").alias("n")).filter("n <> 1").count() == 0
    got = {r["fold"]: r for r in out.groupBy("fold").agg(F.sum("target").alias("pos"), F.sum(1 - F.col("target")).alias("neg")).collect()}
    assert set(got) == set(range(folds))
    for kind in ("pos", "neg"):
        counts = [r[kind] for r in got.values()]
        assert max(counts) - min(counts) <= largest[kind], (kind, counts)


def test_folds(weeks):
    check_folds(weights.stratified_group_folds(weeks, folds=3), weeks.count(), 3, {"pos": 8, "neg": 38})


@pytest.mark.parametrize("groups", [40, 2000, 200_000])
def test_folds_of_many_groups(spark, groups):
    """All positives in a tenth of the groups: the shares stay even by the same rule at every size."""
    df = spark.range(groups * 4).select((F.col("id") % groups).alias("WEEK_NUM"), (F.col("id") % groups % 10 == 0).cast("int").alias("target"))
    pos = groups // 10 * 4
    check_folds(weights.stratified_group_folds(df, folds=5), groups * 4, 5, {"pos": 8 if groups > 40 else pos, "neg": 8})


def area(rows):
    pairs = wins = 0.0
    for s, y, w in rows:
        for s2, y2, w2 in rows:
            if y == 1 and y2 == 0:
                pairs += w * w2
                wins += w * w2 * (1.0 if s > s2 else 0.5 if s == s2 else 0.0)
    return wins / pairs if pairs else None


@pytest.mark.parametrize("limit", [1_000_000, 10])
def test_area(spark, rows_per_task, limit):
    rows_per_task(limit)
    rows = [((i * 7 % 50) / 50, int(i * 13 % 10 < 3), float(i % 4)) for i in range(200)]
    df = spark.createDataFrame([(i % 3, *r) for i, r in enumerate(rows)], "k int, s double, y int, w double")
    assert scores.weighted_auc(df, "s", "y", "w").first()[0] == pytest.approx(area(rows))
    assert scores.auc(df, "s", "y").first()[0] == pytest.approx(area([(s, y, 1.0) for s, y, _ in rows]))
    per_key = {r["k"]: r["auc"] for r in scores.weighted_auc(df, "s", "y", "w", ["k"]).collect()}
    for k in range(3):
        assert per_key[k] == pytest.approx(area([r for i, r in enumerate(rows) if i % 3 == k]))


def test_area_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.4, 1)], "s double, y int")
    assert scores.auc(df, "s", "y").first()[0] is None


def test_summary(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.75)], "fold int, auc double")
    r = scores.cv_summary(df).first()
    assert (r["scores"], r["mean_score"], r["max_score"]) == ([0.75, 0.5], 0.625, 0.75)


def test_split_roles():
    assert weights.split_roles(["case_id", "x", "weights", "target", "y"]) == (["x", "y"], ["case_id", "weights", "target"])


def test_draws_are_seeded():
    a, b = trees.draw_params(4), trees.draw_params(4)
    assert a == b and len({d["maxDepth"] for d in a}) > 1
    assert all(3 <= d["maxDepth"] <= 20 and d["maxIter"] == 2500 for d in a)


def test_models(spark, tmp_path):
    df = spark.range(600).select(
        F.col("id").alias("case_id"), (F.col("id") % 6).alias("WEEK_NUM"), (F.pmod(F.xxhash64("id"), F.lit(100)) / 10).alias("x.1"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 5).cast("double").alias("gap"), (F.col("id") % 7).cast("int").alias("c_encoded"),
    )
    df = df.withColumn("target", ((F.col("`x.1`") > 6) | (F.col("c_encoded") == 3)).cast("int"))
    data = weights.stratified_group_folds(weights.class_weight_by_group(df), folds=2).cache()
    features = trees.Features(["x.1", "gap"], trees.code_sizes(data, ["c_encoded"]))
    assert features.codes == {"c_encoded": 7}
    models = trees.train_boosted_trees(data, features, {"maxDepth": 3, "maxIter": 4, "stepSize": 0.5}, folds=2)
    scored = trees.predict_held_out(models, data, features)
    assert scored.count() == 600 and scored.filter("score < 0 or score > 1 or score is null").count() == 0
    assert all(r["auc"] > 0.9 for r in trees.fold_scores(scored).collect())
    importance = trees.feature_importance(spark, models, features)
    splits = {r["feature_name"]: r["importance_split"] for r in importance.collect()}
    assert splits["x.1"] > 0 and set(splits) == {"c_encoded", "x.1", "gap", "x.1_null", "gap_null"}
    weak = {r[0] for r in trees.select_weak_features(importance, 1).collect()}
    assert weak == {n for n, s in splits.items() if s == 0}
    trees.save_models(models, str(tmp_path / "m"))
    again = trees.predict_held_out(trees.load_models(str(tmp_path / "m"), 2), data, features)
    both = scored.select("case_id", "score").join(again.select("case_id", F.col("score").alias("s2")), "case_id")
    assert both.filter("score <> s2").count() == 0
    trees.save_names(spark, features.names, str(tmp_path / "n"))
    assert trees.load_names(spark, str(tmp_path / "n")) == features.names


def test_category_code_out_of_range_is_its_own_code(spark):
    df = spark.createDataFrame([(0,), (5,), (None,)], "c int")
    out = trees.model_input(df, trees.Features([], {"c": 3}))
    assert [float(r["features"][0]) for r in out.collect()] == [0.0, 3.0, 3.0]


def test_boosting_keeps_many_trees_and_trains_without_weights(spark):
    """At the job's rate one tree is not enough; a week without positives, whose weights are null, does not stop training."""
    df = spark.range(1200).select(
        F.col("id").alias("case_id"), (F.col("id") % 6).alias("WEEK_NUM"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10).alias("x"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 10).alias("y")
    )
    df = df.withColumn("target", ((F.col("x") + F.col("y") > 100) & (F.col("WEEK_NUM") != 3)).cast("int"))
    data = weights.stratified_group_folds(weights.class_weight_by_group(df), folds=2).cache()
    assert data.filter("weights IS NULL").count() == 200
    features = trees.Features(["x", "y"], flag_nulls=False)
    params = {"maxDepth": 2, "maxIter": 40, "stepSize": trees.TRAIN_PARAMS["stepSize"]}
    models = trees.train_boosted_trees(data, features, params, folds=2)
    assert all(n > 20 for n in trees.tree_counts(models).values())
    one = trees.train_boosted_trees(data, features, {**params, "maxIter": 1}, folds=2)
    many, few = ({r["fold"]: r["auc"] for r in trees.fold_scores(trees.predict_held_out(m, data, features), weight=None).collect()} for m in (models, one))
    assert all(many[k] > few[k] for k in many)
    scored = trees.predict_held_out(models, data, features)
    assert scored.count() == 1200


def test_patience_stops(spark, monkeypatch):
    """A column of noise: the held-out loss soon rises, and training stops long before the most trees."""
    monkeypatch.setattr(trees, "FIRST_FIT", 10)
    df = spark.range(400).select((F.pmod(F.xxhash64("id"), F.lit(997)) / 10).alias("x"), (F.pmod(F.xxhash64("id", F.lit(5)), F.lit(2))).cast("double").alias("target"), (F.col("id") % 2).alias("fold"))
    features = trees.Features(["x"], flag_nulls=False)
    models = trees.train_boosted_trees(df, features, {"maxDepth": 4, "maxIter": 400, "stepSize": 0.3}, folds=2, weight=None, patience=3)
    assert all(n < 50 for n in trees.tree_counts(models).values())


def test_large_categories_are_numbers(spark):
    df = spark.createDataFrame([(0,), (5,), (None,)], "c int")
    features = trees.Features([], {"c": 6}, max_codes=3)
    assert [float(r["features"][0]) for r in trees.model_input(df, features).collect()] == [0.0, 5.0, trees.FILL]
    assert trees.classifier(features, {}, "t", None, 1).getMaxBins() == 32


def test_first_trees_are_a_smaller_fit(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.linalg import Vectors

    rng = random.Random(9)
    rows = [(Vectors.dense([rng.random(), rng.random()]),) for _ in range(300)]
    df = spark.createDataFrame([(x, float(x[0] + 0.3 * rng.random() > 0.6)) for (x,) in rows], ["features", "label"])
    gbt = GBTClassifier(maxIter=12, maxDepth=2, seed=3, subsamplingRate=0.7)
    cut, small = trees.first_trees(gbt.fit(df), 5), gbt.copy({gbt.maxIter: 5}).fit(df)
    assert cut.getNumTrees == 5 and cut.toDebugString.split("\n", 1)[1] == small.toDebugString.split("\n", 1)[1]
    a, b = ([r["probability"] for r in m.transform(df).select("probability").collect()] for m in (cut, small))
    assert a == b and cut.featureImportances == small.featureImportances


@pytest.fixture(scope="module")
def searched(spark):
    df = spark.range(600).select(F.col("id").alias("case_id"), (F.col("id") % 2).cast("int").alias("fold"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10).alias("x"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 10).alias("y"))
    data = df.withColumn("target", (F.col("x") + F.col("y") > 100).cast("int")).cache()
    draws = [{"maxDepth": d, "maxIter": 3, "stepSize": 0.3} for d in (1, 3, 2)]
    return data, trees.Features(["x", "y"], flag_nulls=False), draws


def ranked(found):
    return [(r["trial"], r["mean_score"]) for r in found.collect()]


def test_trials_at_a_time_give_what_one_after_the_other_gives(searched):
    data, features, draws = searched
    one = ranked(trees.param_search(data, features, draws, folds=2, weight=None, at_once=1))
    assert len({s for _, s in one}) > 1 and one == ranked(trees.param_search(data, features, draws, folds=2, weight=None, at_once=3))


def test_a_search_goes_on_where_it_stopped(spark, searched, tmp_path, monkeypatch):
    data, features, draws = searched
    folder, fitted = str(tmp_path / "search"), []
    real = trees._fitted

    def fit(ready, features, params, fold, wanted, *rest):
        if len(fitted) == 1:
            raise RuntimeError("driver lost")
        fitted.append((params["maxDepth"], tuple(wanted)))
        return real(ready, features, params, fold, wanted, *rest)

    monkeypatch.setattr(trees, "_fitted", fit)
    with pytest.raises(RuntimeError, match="driver lost"):
        trees.param_search(data, features, draws, folds=2, weight=None, at_once=1, folder=folder)
    monkeypatch.setattr(trees, "_fitted", lambda *a: fitted.append((a[2]["maxDepth"], tuple(a[4]))) or real(*a))
    got = ranked(trees.param_search(data, features, draws, folds=2, weight=None, folder=folder))
    assert sorted(d for d, _ in fitted) == [1, 2, 3]  # the finished trial is not fitted again
    assert got == ranked(trees.param_search(data, features, draws, folds=2, weight=None))
    fitted.clear()
    other = [{**draws[0], "maxDepth": 4}, *draws[1:]]
    trees.param_search(data, features, other, folds=2, weight=None, folder=folder)
    assert [d for d, _ in fitted] == [4]  # other parameters are another trial


def test_losers_of_the_first_fold_are_left(searched):
    data, features, draws = searched
    whole = dict(ranked(trees.param_search(data, features, draws, folds=2, weight=None)))
    got = ranked(trees.param_search(data, features, draws, folds=2, weight=None, keep=0.5))
    first = {i: trees.fold_scores(trees.predict_held_out(trees.train_boosted_trees(data, features, p, folds=1, weight=None), data, features), weight=None).first()["auc"] for i, p in enumerate(draws)}
    worst = min(first, key=lambda i: (first[i], -i))
    assert got[2] == (worst, None) and dict(got[:2]) == {i: s for i, s in whole.items() if i != worst}


@pytest.mark.parametrize("weight", ["weights", None])
def test_equal_rows_are_merged_to_the_same_trees(spark, monkeypatch, weight):
    """Few different rows, each many times: the fit takes one of each, and every tree and the stopping place stay."""
    rows = [(i % 3, float(i % 7), float(i % 11) if i % 11 else None, int((i * 7919) % 100 < 10 * (i % 7) + 3 * (i % 11)), 0.5 + i % 2) for i in range(5000)]
    data = spark.createDataFrame(rows, "fold int, a double, b double, target int, weights double")
    features, params = trees.Features(["a", "b"]), {"maxDepth": 2, "maxIter": 12, "stepSize": 0.2}
    sizes, plain = [], trees._fitted
    monkeypatch.setattr(trees, "_fitted", lambda ready, *a: sizes.append(ready.count()) or plain(ready, *a))
    few = trees.train_boosted_trees(data, features, params, folds=3, weight=weight, patience=4)
    monkeypatch.setattr(trees, "merged_rows", lambda ready, weight: (ready, weight))
    all_ = trees.train_boosted_trees(data, features, params, folds=3, weight=weight, patience=4)
    assert sizes[0] <= 3 * 7 * 11 * 2 * 2 < sizes[1] == 5000
    assert trees.tree_counts(few) == trees.tree_counts(all_)
    a, b = (trees.predict_held_out(m, data, features).groupBy("fold", "a", "b").agg(F.max("score").alias("s")).orderBy("fold", "a", "b").collect() for m in (few, all_))
    assert [r["s"] for r in a] == pytest.approx([r["s"] for r in b], abs=1e-9)


def test_a_search_scores_equal_rows_once(spark, monkeypatch):
    """Few different rows, each many times: one of each is scored and counts as many, and the scores stay. The rows scored are computed once."""
    rows = [(i % 2, float(i % 7), float(i % 11) if i % 11 else None, int((i * 7919) % 100 < 10 * (i % 7) + 3 * (i % 11))) for i in range(4000)]
    data = spark.createDataFrame(rows, "fold int, a double, b double, target int")
    features, draws = trees.Features(["a", "b"]), [{"maxDepth": 2, "maxIter": 3, "stepSize": 0.3, "subsamplingRate": 0.7}]
    scored, plain = [], trees.predict_held_out
    monkeypatch.setattr(trees, "predict_held_out", lambda models, rows, *a: scored.append(rows.count()) or plain(models, rows, *a))
    few = ranked(trees.param_search(data, features, draws, folds=2, weight=None))
    monkeypatch.setattr(trees, "merged_rows", lambda ready, weight: (ready, weight))
    assert few == ranked(trees.param_search(data, features, draws, folds=2, weight=None))
    assert scored[0] <= 2 * 7 * 11 * 2 < scored[1] == 4000


def test_rows_of_the_model_queries_are_computed_once(spark, small):
    from casefeatures.checks.queries import _model_rows

    plan = _model_rows(spark, small)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan and "RDD" in plan
