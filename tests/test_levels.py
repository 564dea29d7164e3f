"""Roll-ups, joins of the levels and the whole job on a few tables."""

import threading

import pytest
from pyspark.sql import functions as F

from casefeatures.checks import casetables
from casefeatures.operators import joins as J
from casefeatures.plans import assemble
from casefeatures.plans import tables as K
from casefeatures.plans.rollup import agg_by_name_rule, rollup_depth1, rollup_depth2


@pytest.fixture(scope="module")
def levels(spark):
    base = spark.createDataFrame([(1, 5, 201901, 0, "2019-05-01"), (2, 5, 201901, 1, "2019-05-02"), (3, 6, 201902, 0, "2019-06-01")], "case_id long, WEEK_NUM long, MONTH long, target int, date_decision string")
    one = spark.createDataFrame([(1, 0, 10.0), (1, 1, None), (2, 0, 4.0)], "case_id long, num_group1 long, amount_416A double")
    two = spark.createDataFrame([(1, 0, 0, 3.0, 1.0), (1, 0, 1, 0.0, 2.0), (1, 0, 2, 9.0, None)], "case_id long, num_group1 long, num_group2 long, pmts_dpdvalue_108P double, pmts_pmtsoverdue_635A double")
    return base, one, two.withColumn("pmts_date_1107D", F.date_add(F.lit("2018-12-30").cast("date"), F.col("num_group2").cast("int")))


def test_depth2(levels):
    r = rollup_depth2(levels[2], K.CREDIT_BUREAU_B_2).first().asDict()
    assert r["num_pmts_date_1107D"] == 3 and r["pmts_date_1107D_first"] == 2018 and r["pmts_date_1107D_last"] == 2019
    assert r["pmts_date_1107D_duration"] == 1 and r["pmts_date_1107D_duration_days"] == 2
    assert r["num_pmts_dpdvalue_108P"] == 2 and r["pmts_dpdvalue_108P_maxidx"] == 1 and r["pmts_dpdvalue_108P_pos"] == 0.0
    assert r["pmts_pmtsoverdue_635A_last"] is None and r["pmts_pmtsoverdue_635A_pos"] is None
    assert r["pmts_dpdvalue_108P_tail_mean"] == 4.0 and r["pmts_dpdvalue_108P_diffmean"] == 3.0 and r["pmts_dpdvalue_108P_difflast"] == 9.0


def test_child_join_keeps_rows_without_children(levels):
    _, one, two = levels
    out = J.join_child_level(one, rollup_depth2(two, K.CREDIT_BUREAU_B_2))
    assert out.count() == 3 and out.filter("pmts_dpdvalue_108P_max is null").count() == 2


def test_inner_drops_and_left_keeps_cases(levels):
    base, one, _ = levels
    rolled = one.groupBy("case_id").agg(F.count("amount_416A").alias("n"))
    assert J.join_base(base, rolled, "inner").count() == 2
    assert J.join_base(base, rolled, "left").count() == 3
    with pytest.raises(ValueError):
        J.join_base(base, rolled, "outer")
    left = {r["table"]: r["cases"] for r in J.cases_left(base, {"one": rolled, "two": rolled.filter("case_id = 2")}).collect()}
    assert left == {"base": 3, "one": 2, "two": 1}


def test_target_name_clash(levels):
    base = levels[0]
    out = J.join_target(base.select("case_id", F.lit(9).alias("target")), base)
    assert out.columns == ["case_id", "target", "WEEK_NUM", "target_right"]


def test_name_rules():
    made = set(agg_by_name_rule(["case_id", "num_x", "y_mean", "y_tail_mean", "z_first", "z_last", "z_difflast", "w_duration", "w_diff"]))
    assert made == {"num_x", "y_mean_mean", "y_tail_mean_mean", "z_first_min", "z_last_max", "w_duration_mean", "w_diff_mean"}


def test_hot_case_gives_the_same_roll_up(spark, small, rows_per_task):
    df, spec = casetables.case_table(spark, small, "deposit_1"), K.DEPOSIT_1
    df = df.withColumn("case_id", F.when(F.col("case_id") % 3 == 0, 0).otherwise(F.col("case_id")))
    want = {r["case_id"]: r for r in rollup_depth1(df, spec).collect()}
    rows_per_task(100)
    got = {r["case_id"]: r for r in rollup_depth1(df, spec).collect()}
    assert set(got) == set(want)
    for k, r in want.items():
        for c, x in r.asDict().items():
            assert got[k][c] == x or got[k][c] == pytest.approx(x, rel=1e-9, abs=1e-9), (k, c)


@pytest.mark.parametrize("kind", ["train", "test"])
def test_whole_job(spark, small, tmp_path, monkeypatch, kind):
    chosen = ("debitcard_1", "tax_registry_a_1", "static_cb_0")
    monkeypatch.setattr(K, "JOIN_ORDER", chosen)
    tables = {n: casetables.case_table(spark, small, n) for n in ("base", *chosen)}
    tables["debitcard_1"] = tables["debitcard_1"].filter("case_id % 10 <> 0")
    for n, df in tables.items():
        df.write.parquet(str(tmp_path / f"in/{kind}/{kind}_{n}{'' if n == 'base' else '_0'}.parquet"))
    monkeypatch.setattr(K, "SPECS", {n: K.SPECS[n] for n in chosen})
    loaded = assemble.load_tables(spark, str(tmp_path / "in"), kind)
    wide = assemble.assemble_features(loaded, kind, weak=["age_60"], keep=assemble.stored_under(str(tmp_path / "kept")))
    cases = tables["base"].count()
    with_cards = tables["debitcard_1"].select("case_id").distinct().count()
    assert wide.count() == (with_cards if kind == "train" else cases)
    names = set(wide.columns)
    assert {"date_decision_weekday", "date_decision_quarter", "openingdate_857D_last", "riskassesment_302T_0", "education_88M_encoded"} <= names
    assert not names & {"date_decision", "age_60"} and not [c for c in names if c.endswith("_mean_target")]
    types = {f.name: f.dataType.simpleString() for f in wide.schema.fields}
    assert types["case_id"] == "bigint" and types["age_25"] == "tinyint" and "date" not in types.values()
    assert "education_88M_encoded" in assemble.category_columns(wide)


def test_raw_columns_follow_the_name_rule():
    for spec in K.SPECS.values():
        columns = casetables.raw_columns(spec)
        assert columns and all(casetables.COLUMN.fullmatch(c) for c in columns)


def test_hot_cases_in_fitting(spark, small, rows_per_task):
    rows = casetables.case_table(spark, small, "deposit_1").select(F.when(F.col("case_id") % 2 == 0, 0).otherwise(F.col("case_id")).alias("case_id"), "amount_416A")
    base = casetables.case_table(spark, small, "base").select("case_id", "target")
    want = sorted(map(tuple, J.join_one(rows, base).collect()), key=str)
    rows_per_task(200)
    out = J.join_one(rows, base)
    assert sorted(map(tuple, out.collect()), key=str) == want and len(want) > 500


def test_bucketed_roll_ups_are_joined_without_shuffling_them(spark, small, monkeypatch):
    chosen = ("deposit_1", "tax_registry_a_1", "tax_registry_b_1")
    monkeypatch.setattr(K, "JOIN_ORDER", chosen)
    keep = assemble.bucketed_as("rolled_", 8)
    base = casetables.case_table(spark, small, "base")
    rolled = {n: keep(n, rollup_depth1(casetables.case_table(spark, small, n), K.SPECS[n])) for n in chosen}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = assemble.join_all(base, rolled, "test")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("SortMergeJoin") == 3
        assert out.count() == base.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for n in chosen:
            spark.sql(f"drop table rolled_{n}")


def test_roll_ups_are_stored_side_by_side(spark, small, monkeypatch):
    chosen = ("deposit_1", "debitcard_1")
    monkeypatch.setattr(K, "JOIN_ORDER", chosen)
    tables = {n: casetables.case_table(spark, small, n) for n in ("base", *chosen)}
    lookup, met = assemble.fit_lookups(tables), threading.Barrier(len(chosen))

    def keep(name, df):
        met.wait(60)
        return df.withColumn("of", F.lit(name))

    rolled = assemble.roll_up_all(tables, lookup, keep)
    assert tuple(rolled) == chosen and all(df.select("of").distinct().collect() == [(n,)] for n, df in rolled.items())


def test_wide_roll_ups_are_joined_last_and_columns_keep_their_order(spark, monkeypatch):
    monkeypatch.setattr(K, "JOIN_ORDER", ("wide", "slim"))
    base = spark.createDataFrame([(5, 1), (5, 2), (6, 3)], "WEEK_NUM long, case_id long")
    wide = spark.createDataFrame([(1, 1.0, 2.0, 3.0), (2, 4.0, 5.0, 6.0)], "case_id long, a double, b double, WEEK_NUM double")
    slim = spark.createDataFrame([(1, 7.0), (3, 8.0)], "case_id long, a double")
    widths = []
    monkeypatch.setattr(assemble, "join_base", lambda left, side, how: widths.append(len(side.columns)) or J.join_base(left, side, how))
    for kind, rows in (("train", {(1, 5, 1.0, 2.0, 3.0, 7.0)}), ("test", {(1, 5, 1.0, 2.0, 3.0, 7.0), (2, 5, 4.0, 5.0, 6.0, None), (3, 6, None, None, None, 8.0)})):
        out = assemble.join_all(base, {"wide": wide, "slim": slim}, kind)
        assert out.columns == ["case_id", "WEEK_NUM", "a", "b", "WEEK_NUM_right", "a_right"]
        assert set(map(tuple, out.collect())) == rows
    assert widths == [2, 4, 2, 4]
