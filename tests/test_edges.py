"""Edge cases of operator paths not covered elsewhere."""

import pytest
from pyspark.sql import functions as F

from cataloom.operators import aggregate as A
from cataloom.operators import join as J
from cataloom.operators import project as P
from cataloom.operators.tracked import Tracked, unwrap


def test_join_with_column_condition_and_anti(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "ak int")
    b = spark.createDataFrame([(2,)], "bk int")
    assert J.join_tables(a, b, F.col("ak") == F.col("bk")).count() == 1
    anti = sorted((r.ak for r in J.join_tables(a, b, "ak = bk", "anti").collect()), key=repr)
    assert anti == [1, None]  # NULL keys never match, so the anti join keeps them


def test_group_by_sql_with_expression_keys(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "x int, v int")
    out = A.group_by_sql(df, "x % 2 AS parity", "sum(v) AS s")
    assert sorted(tuple(r) for r in out.collect()) == [(0, 20), (1, 40)]
    with pytest.raises(ValueError):
        A.group_by_sql(df, "x")


def test_range_join_nulls_and_left(spark):
    p = spark.createDataFrame([(1, 5.0), (2, None), (3, 100.0)], "pid int, v double")
    r = spark.createDataFrame([(0, 0.0, 10.0), (1, None, 10.0)], "rid int, lo double, hi double")
    inner = [tuple(x) for x in J.range_join(p, r, "v", "lo", "hi", bin_width=5.0).select("pid", "rid").collect()]
    assert inner == [(1, 0)]
    left = sorted((tuple(x) for x in J.range_join(p, r, "v", "lo", "hi", bin_width=5.0, how="left")
                   .select("pid", "rid").collect()), key=repr)
    assert left == [(1, 0), (2, None), (3, None)]


def test_tracked_lineage_survives_prefix_filter_preview(spark):
    t = Tracked(spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string"), ("src.t",))
    out = P.preview(P.filter_rows(P.prefix_columns(t, "x", uppercase=True), "X_ID > 1"), 5)
    df, tables = unwrap(out)
    assert tables == ("src.t",) and df.columns == ["X_ID", "X_S"] and df.count() == 1


def test_latest_with_single_order_column(spark):
    df = spark.createDataFrame([(1, 3, "a"), (1, 3, "b"), (1, 2, "c"), (2, None, "d")], "k int, o int, tag string")
    for method in ["join_back", "struct_max", "window"]:
        got = sorted(r.tag for r in A.latest_per_group(df, ["k"], ["o"], method=method).collect())
        assert got == ["a", "b"], method
    with pytest.raises(ValueError):
        A.latest_per_group(df, ["k"], ["o"], method="nope")


def test_aggregate_duplicate_names_raise(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError):
        A.aggregate(df, "k", k=("sum", "v"))


def test_checkpoint_dir_is_read_not_overridden(spark):
    from cataloom.session import checkpoint_dir, ensure_checkpoint_dir, shared_path

    before = checkpoint_dir(spark)
    assert before  # set by the test session
    assert ensure_checkpoint_dir(spark, default="/tmp/should-not-be-used") == before
    path = shared_path(spark, "x")
    assert path.startswith(before) and "/tables/x/" in path
