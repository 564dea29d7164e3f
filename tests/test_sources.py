"""Part files of unequal type, CSV, stored tables, the shared folder."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefeatures.checks import casetables
from casefeatures.plans import assemble
from casefeatures.plans import tables as K
from casefeatures.sources import files


def test_parts_of_unequal_type(spark, tmp_path):
    spark.createDataFrame([(1, 1, "x")], "k int, v int, c string").write.parquet(str(tmp_path / "t_1.parquet"))
    spark.createDataFrame([(2, 2.5, None)], "k long, v double, c void").select("k", "v", F.col("c").cast("string")).write.parquet(str(tmp_path / "t_2.parquet"))
    spark.createDataFrame([(3, 7)], "k int, v long").write.parquet(str(tmp_path / "t_3.parquet"))
    spark.createDataFrame([(4, 8, "y")], "k int, v int, c string").write.parquet(str(tmp_path / "t_4.parquet"))
    out = files.scan_parts(spark, str(tmp_path / "t_*.parquet"))
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "double", "string"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1.0, "x"), (2, 2.5, None), (3, 7.0, None), (4, 8.0, "y")]
    with pytest.raises(FileNotFoundError):
        files.scan_parts(spark, str(tmp_path / "none_*.parquet"))


def test_a_case_in_two_parts_is_one_case(spark, tmp_path):
    for i in (1, 2):
        spark.createDataFrame([(1, i, 2.0)], "case_id long, num_group1 long, v double").write.parquet(str(tmp_path / f"p_{i}.parquet"))
    parts = files.scan_parts(spark, str(tmp_path / "p_*.parquet"))
    assert [tuple(r) for r in parts.groupBy("case_id").agg(F.sum("v")).collect()] == [(1, 4.0)]


def test_common_type():
    assert files.common_type(T.IntegerType(), T.LongType()) == T.LongType()
    assert files.common_type(T.LongType(), T.FloatType()) == T.DoubleType()
    assert files.common_type(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert files.common_type(T.NullType(), T.DateType()) == T.DateType()
    assert files.common_type(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert files.common_type(T.StringType(), T.LongType()) == T.StringType()


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert files.shared_folder(spark) == named
    assert files.scratch_path(spark, "a").startswith(named) and files.scratch_path(spark, "a") != files.scratch_path(spark, "a")
    assert files.checkpointed(spark.range(5)).count() == 5


def test_csv_and_written(spark, tmp_path):
    path = tmp_path / "i.csv"
    path.write_text("feature_name,importance_split\na,3\nb,12\n")
    df = files.scan_csv(spark, str(path), "feature_name string, importance_split double")
    assert files.written(df, str(tmp_path / "out")).count() == 2
    with pytest.raises(Exception, match="already exists"):
        files.sink_parquet(df, str(tmp_path / "out"))


def test_bucketed_tables_join_without_shuffle(spark):
    for name in ("left_t", "right_t"):
        files.sink_bucketed(spark.range(1000).select(F.col("id").alias("case_id"), (F.col("id") * 2).alias(name + "_v")), name, "case_id", 4)
    plan = spark.table("left_t").hint("merge").join(spark.table("right_t"), "case_id")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    for name in ("left_t", "right_t"):
        spark.sql(f"drop table {name}")
    assert os.path.isdir(files.shared_folder(spark))


def test_numbers_of_unequal_type_stay_numbers():
    d, wide = T.DecimalType(10, 2), T.DecimalType(12, 4)
    assert files.common_type(d, T.DoubleType()) == T.DoubleType() and files.common_type(T.LongType(), d) == T.DoubleType()
    assert files.common_type(d, wide) == wide and files.common_type(T.DecimalType(38, 0), T.DecimalType(38, 20)) == T.DoubleType()
    assert files.common_type(T.BooleanType(), T.IntegerType()) == T.IntegerType() and files.common_type(d, T.BooleanType()) == d
    assert files.common_type(T.BooleanType(), T.StringType()) == T.StringType()


def write_parts(folder, n, schemas=2):
    folder.mkdir()
    for i in range(n):
        odd = i % schemas == 1
        pq.write_table(pa.table({"k": pa.array([i], pa.int64()), "v": pa.array([i / 2 if odd else i], pa.float64() if odd else pa.int32())}), folder / f"t_{i:05d}.parquet")
    return str(folder / "t_*.parquet")


def jobs(spark, name, work):
    spark.sparkContext.setJobGroup(name, name)
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_jobs_do_not_grow_with_parts(spark, tmp_path):
    few, many = write_parts(tmp_path / "few", 100), write_parts(tmp_path / "many", 2000)
    _, least = jobs(spark, "few parts", lambda: files.scan_parts(spark, few))
    out, most = jobs(spark, "many parts", lambda: files.scan_parts(spark, many))
    assert most == least <= 8
    row = out.agg(F.count("*"), F.sum("k"), F.sum("v")).first()
    assert out.schema["v"].dataType == T.DoubleType()
    assert list(row) == [2000, 1999 * 1000, sum(i / 2 if i % 2 else i for i in range(2000))]


def test_folders_are_parts(spark, tmp_path):
    spark.createDataFrame([(1, 1), (2, 2)], "k int, v int").repartition(2).write.parquet(str(tmp_path / "f_1.parquet"))
    spark.createDataFrame([(3, 2.5)], "k int, v double").write.parquet(str(tmp_path / "f_2.parquet"))
    spark.createDataFrame([(4, 4, "x")], "k int, v int, week string").write.partitionBy("week").parquet(str(tmp_path / "f_3.parquet"))
    out = files.scan_parts(spark, str(tmp_path / "f_*.parquet"))
    assert sorted(tuple(r) for r in out.select("k", "v", "week").collect()) == [(1, 1.0, None), (2, 2.0, None), (3, 2.5, None), (4, 4.0, "x")]
    spaced = tmp_path / "with space"
    spark.createDataFrame([(5,)], "k int").write.parquet(str(spaced / "a.parquet"))
    spark.createDataFrame([(6,)], "k int").write.parquet(str(spaced / "b.parquet"))
    paths = files.expand(spark, str(spaced / "*.parquet"))
    assert len(files.part_groups(spark, paths)) == 1 and files.scan_parts(spark, paths).count() == 2


def test_a_damaged_part_is_named_by_the_reader(spark, tmp_path):
    (tmp_path / "d_1.parquet").write_bytes(b"no parquet at all")
    spark.createDataFrame([(1,)], "k int").write.parquet(str(tmp_path / "d_2.parquet"))
    with pytest.raises(Exception, match="d_1.parquet"):
        files.scan_parts(spark, str(tmp_path / "d_*.parquet")).collect()


def files_below(folder):
    return sorted(os.path.join(at, name) for at, _, names in os.walk(folder) for name in names)


def test_a_run_leaves_nothing_in_the_shared_folder(spark, small, tmp_path, monkeypatch):
    chosen = ("debitcard_1", "tax_registry_a_1")
    monkeypatch.setattr(K, "JOIN_ORDER", chosen)
    tables = {n: casetables.case_table(spark, small, n) for n in ("base", *chosen)}
    shared = files.shared_folder(spark)
    before = files_below(shared)
    with files.scratch_run(spark, "job") as folder:
        assert os.path.dirname(folder) == shared
        wide = assemble.assemble_features(tables, keep=assemble.stored_under(files.scratch_path(spark, "rollups")))
        files.sink_parquet(wide, str(tmp_path / "wide"))
        assert files_below(folder) and files.checkpointed(spark.range(3)).count() == 3
    assert files_below(shared) == before and not os.path.exists(folder)
    assert spark.read.parquet(str(tmp_path / "wide")).count() == tables["base"].count()
    assert files.checkpointed(spark.range(3)).count() == 3  # in the shared folder again


def test_a_run_that_fails_is_removed_and_runs_nest(spark):
    with pytest.raises(ZeroDivisionError), files.scratch_run(spark) as outer:
        with files.scratch_run(spark) as inner:
            assert os.path.dirname(inner) == outer
            kept = files.written(spark.range(5), files.scratch_path(spark, "rows"))
            assert kept.count() == 5
        assert os.path.dirname(files.scratch_path(spark, "rows")) == outer and not os.path.exists(inner)
        files.written(spark.range(5), files.scratch_path(spark, "rows"))
        1 / 0
    assert not os.path.exists(outer)
    assert os.path.dirname(files.scratch_path(spark, "rows")) == files.shared_folder(spark)
