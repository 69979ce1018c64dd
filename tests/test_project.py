import pytest
from pyspark.sql import functions as F

from cataloom.operators import project as P
from cataloom.operators.tracked import Tracked


@pytest.fixture()
def df(spark):
    return spark.createDataFrame([(1, "a", 2.0), (2, None, 3.0)], "id int, name string, x double")


def test_select_keep_and_drop(df):
    kept = P.select(df, "x * 2 AS x2")
    assert kept.columns == ["id", "name", "x", "x2"]
    only = P.select(df, "id", "x * 2 AS x2", keep_original=False)
    assert only.columns == ["id", "x2"]
    assert [r.x2 for r in only.orderBy("id").collect()] == [4.0, 6.0]


def test_select_without_expressions_is_identity(df):
    assert P.select(df, keep_original=False) is df


def test_select_duplicate_output_raises(df):
    with pytest.raises(ValueError):
        P.select(df, "id")


def test_select_keeps_lineage(df):
    t = Tracked(df, ("s.t",))
    out = P.select(t, "x + 1 AS y")
    assert isinstance(out, Tracked) and out.tables == ("s.t",)


def test_concat_ws_skips_nulls(df):
    out = P.select(df, "concat_ws('::', name, CAST(id AS STRING)) AS loc", keep_original=False)
    assert sorted(r.loc for r in out.collect()) == ["2", "a::1"]


def test_prefix_columns_upper(df):
    out = P.prefix_columns(df, "phmcy", uppercase=True)
    assert out.columns == ["PHMCY_ID", "PHMCY_NAME", "PHMCY_X"]


def test_prefix_collision_raises(spark):
    # MBR_ACC + CVRG_X and MBR_ACC_CVRG + X give the same name
    left = P.prefix_columns(spark.createDataFrame([(1,)], "CVRG_X int"), "MBR_ACC", uppercase=True)
    right = P.prefix_columns(spark.createDataFrame([(1,)], "X int"), "MBR_ACC_CVRG", uppercase=True)
    with pytest.raises(ValueError):
        P.check_unique(left.columns + right.columns)
    with pytest.raises(ValueError):
        P.prefix_columns(spark.createDataFrame([(1, 2)], "a int, b int").toDF("x", "X"), "p", uppercase=True)


def test_prefix_is_one_project(df):
    out = P.prefix_columns(P.prefix_columns(df, "a"), "b")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 1


def test_qualify_and_subset(df):
    q = P.qualify_columns(df, "tbl")
    assert q.columns == ["tbl__id", "tbl__name", "tbl__x"]
    assert P.qualified_name("tbl", "tbl__id") == "tbl__id"
    assert P.subset(q, ["tbl__x"]).columns == ["tbl__x"]


def test_filter_and_mapping_and_preview(df):
    f = P.filter_rows(df, "x > 2.5")
    assert f.count() == 1
    f2 = P.filter_rows(df, F.col("x") > 2.5)
    assert f2.count() == 1
    m = P.project_mapping(df, [("id", "ID"), ("x * 10", "X10")])
    assert m.columns == ["ID", "X10"]
    assert P.preview(df, 1).count() == 1
