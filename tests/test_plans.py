"""What the plans look like: shuffles, joins, what reaches the scan."""

import re

from pyspark.sql import functions as F

from casefeatures.checks import queries as Q
from casefeatures.checks.queries import QUERIES
from casefeatures.operators import encode as E
from casefeatures.plans import rollup as P
from casefeatures.plans.spec import TableSpec


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def initial(df) -> str:
    text = plan_of(df)
    return text.split("== Initial Plan ==")[-1]


def test_sequence_features_take_one_shuffle(spark, small):
    plan = initial(QUERIES["seq_lines"](spark, small))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("+- Sort") == 1


def test_aggregates_combine_before_the_shuffle(spark, small):
    for name in ("agg_basic", "agg_date", "agg_last_nonnull", "fit_encodings", "agg_mode"):
        plan = initial(QUERIES[name](spark, small))
        assert "partial_" in plan and "Window" not in plan, name


def test_encoding_does_not_shuffle_the_rows(spark, small):
    lookup = Q.files.written(Q.category_lookup(spark, small), Q.files.scratch_path(spark, "lookup"))
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang", "source")
    plan = initial(Q.E.encode(docs, lookup, [Q.E.fitted("lang"), Q.E.fitted("source")]))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan


def test_scans_read_only_what_is_used(spark, small):
    plan = plan_of(QUERIES["agg_median"](spark, small))
    assert re.search(r"ReadSchema: struct<l_extendedprice:double,l_returnflag:string,l_linestatus:string>", plan)


def test_filters_reach_the_scan(spark, small):
    lines = spark.read.parquet(f"{small}/lineitem.parquet").filter(F.col("l_quantity") > 40).groupBy("l_returnflag").agg(Q.A.total(F.col("l_tax")))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity" in plan_of(lines)


def test_no_query_pairs_rows_without_keys_or_runs_python_per_row(spark, small):
    for name in ("rollup_depth1", "rollup_depth2", "join_base", "encode_ordinal", "weighted_auc", "agg_argmax_pos", "class_weight_by_group"):
        plan = plan_of(QUERIES[name](spark, small))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Python" not in plan, name


def test_modes_come_from_rows_sorted_once(spark, rows_per_task):
    """A roll-up with modes and no sequence features sorts its cold rows once, hot keys combine early; both give what one plain aggregate gives."""
    from casefeatures.operators import aggregates as A
    from casefeatures.operators.sequence import group_features

    rows = [(i % 50 if i < 2000 else 7 if i % 3 else None, i, float(i * 7919 % 5)) for i in range(3000)]
    df = spark.createDataFrame(rows, "case_id long, num_group1 long, kind double").repartition(5)
    aggs = [A.mode_of(F.col("kind")).alias("m"), A.last_nonnull(F.col("kind"), F.col("num_group1")).alias("l"), F.avg("kind").alias("a")]
    want = sorted(map(tuple, df.groupBy("case_id").agg(*aggs).collect()), key=str)
    cold = group_features(df, ["case_id"], ["num_group1"], aggs=aggs, modes=True)
    assert sorted(map(tuple, cold.collect()), key=str) == want
    plan = plan_of(cold).split("Initial Plan")[0]
    assert "ObjectHashAggregate" not in plan and plan.count("SortAggregate") == 1
    rows_per_task(100)
    assert sorted(map(tuple, group_features(df, ["case_id"], ["num_group1"], aggs=aggs, modes=True).collect()), key=str) == want


def test_roll_up_with_modes_sorts_its_rows(spark):
    from casefeatures.plans.rollup import reduce_table
    from casefeatures.plans.spec import TableSpec

    df = spark.range(2000).select((F.col("id") % 300).alias("case_id"), F.col("id").alias("num_group1"), (F.col("id") % 3).cast("double").alias("x_1M_encoded"))
    out = reduce_table(df, TableSpec(name="t", depth=1, order_endings=("_encoded",)))
    assert "ObjectHashAggregate" not in plan_of(out)


def test_rows_are_dealt_for_the_join_with_their_child_before_they_are_encoded(spark):
    """Reading and encoding are two generated methods, neither too large to be compiled, and the rows are still dealt once for the join."""
    spec = TableSpec(name="t", depth=1, child="c", categories=(E.valued("flag_4M", "flag_4M_encoded"),), stats={"x_sum": ("sum", "x_1A")}, order_endings=("_encoded",), sequences=True)
    rows = spark.range(60).selectExpr("id % 7 AS case_id", "id AS num_group1", "CAST(id AS DOUBLE) AS x_1A", "CASE WHEN id % 2 = 0 THEN 'a' END AS flag_4M")
    child = spark.range(0, 60, 2).selectExpr("id % 7 AS case_id", "id AS num_group1", "1 AS n").groupBy("case_id", "num_group1").agg(F.sum("n").cast("double").alias("y_2A"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = P.rollup_depth1(rows, spec, E.given_values(spark, {"flag_4M": {"a": 1.0}}), child)
        plan = initial(out)
        got = {r["case_id"]: (r["x_sum"], r["flag_4M_encoded_mode"]) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = re.search(r"Exchange hashpartitioning\(case_id#\d+L, num_group1#\d+L, \d+\), REPARTITION_BY_COL", plan)
    assert dealt and plan.index("BroadcastHashJoin") < dealt.start()
    assert len(re.findall(r"Exchange hashpartitioning\(case_id#\d+L, num_group1#", plan)) == 2  # the rows, and the child's own roll-up
    assert got == {k: (float(sum(i for i in range(60) if i % 7 == k)), 1.0) for k in range(7)}
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
