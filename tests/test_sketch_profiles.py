import datetime as dt
import math
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from cataloom.operators import learn
from cataloom.operators import profile as P


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_levels_of_every_type_without_a_row_per_column(spark):
    rows = [(i, f"c{i % 3}", float(i % 25), i % 20, None if i % 4 else i % 7, b"xy"[: i % 2 + 1], [i % 2], {"k": i % 4}, dt.date(2001, 1, 1 + i % 5), Decimal(i % 21), None) for i in range(3000)]
    schema = "id int, cat string, v double, twenty int, nulls int, b binary, a array<int>, m map<string,int>, d date, dec decimal(9,2), none string"
    df = spark.createDataFrame(rows, schema)
    got = {r.column_name: (r.non_null, r.distinct_levels, r.is_categorical) for r in P.column_levels(df).collect()}
    assert got == {
        "id": (3000, None, False), "cat": (3000, 3, True), "v": (3000, None, False), "twenty": (3000, 20, True), "nulls": (750, 7, True),
        "b": (3000, 2, True), "a": (3000, 2, True), "m": (3000, 4, True), "d": (3000, 5, True), "dec": (3000, None, False), "none": (0, 0, True),
    }
    old = {r.column_name: r.is_categorical for r in P.categorical_columns(df, exact=df.columns).collect()}
    assert old == {c: flag for c, (_, _, flag) in got.items()}
    assert "Generate" not in plan(P.column_levels(df))


def test_levels_that_a_full_sketch_drops(spark, monkeypatch):
    """One value in almost every row, beside rare ones: the sketch may keep too few."""
    monkeypatch.setattr(P, "TRACKED_LEVELS", 4)
    df = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")).alias("x"), (F.col("id") % 9).alias("nine"))
    got = {r.column_name: (r.distinct_levels, r.is_categorical) for r in P.column_levels(df, max_levels=9).collect()}
    assert got == {"x": (None, False), "nine": (9, True)}


def test_duplicates_shuffle_a_hash_per_unique_row(spark):
    df = spark.range(5000).select("id", F.concat(F.lit("long text " * 20), F.col("id")).alias("s"))
    assert tuple(P.find_duplicates(df).first()) == (0, 0)
    some = df.union(df.where("id < 10")).union(df.where("id < 3"))
    assert tuple(P.find_duplicates(some).first()) == (10, 23)
    assert tuple(P.find_duplicates(some, ["s"]).first()) == (10, 23)
    assert tuple(P.find_duplicates(df.limit(0)).first()) == (0, 0)


def test_duplicates_by_group_by_equality(spark):
    rows = [(0.0, [1.0]), (-0.0, [1.0]), (math.nan, [math.nan]), (math.nan, [math.nan]), (None, None), (None, None), (1.0, None), (None, [1.0])]
    df = spark.createDataFrame(rows, "x double, a array<double>")
    groups = df.groupBy("x", "a").count().where("count > 1").count()
    assert P.find_duplicates(df).first().duplicate_groups == groups == 3


@pytest.mark.parametrize("count", [0, 1, 100, 5000])
def test_samples_are_exact_and_do_not_depend_on_partitions(spark, count):
    df = spark.range(2000).select("id", (F.col("id") * 7 % 13).alias("g"), F.lit(None).cast("string").alias("n"))
    picked = [sorted(r.id for r in P.sample_rows(df.repartition(n), count, seed=3).collect()) for n in (1, 4, 16)]
    assert picked[0] == picked[1] == picked[2] and len(picked[0]) == min(count, 2000) == len(set(picked[0]))
    if count == 100:
        assert picked[0] != sorted(r.id for r in P.sample_rows(df, count, seed=4).collect())
        assert "TakeOrderedAndProject" in plan(P.sample_rows(df, count))


def test_samples_per_stratum(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 9, "b").alias("g"))
    got = [P.sample_rows(df.repartition(n), 30, seed=1, strata=["g"]) for n in (3, 8)]
    assert "WindowGroupLimit" in plan(got[0])
    rows = [sorted(map(tuple, d.collect()), key=repr) for d in got]
    assert rows[0] == rows[1] and sorted(sum(1 for r in rows[0] if r[1] == g) for g in ("a", "b", None)) == [30, 30, 30]
    small = P.sample_rows(df.where("id < 20"), 30, strata=["g"])
    assert small.count() == 20


def test_samples_are_even(spark):
    """Every tenth of the ids gets about a tenth of the sample, over many seeds."""
    df = spark.range(1000)
    hits = np.zeros(10)
    for seed in range(30):
        for r in P.sample_rows(df, 50, seed=seed).collect():
            hits[r.id // 100] += 1
    assert hits.sum() == 1500 and (abs(hits - 150) < 5 * math.sqrt(150 * 0.9)).all()


def direct(values, points, h):
    return [sum(math.exp(-0.5 * ((p - v) / h) ** 2) for v in values) / (len(values) * h * math.sqrt(2 * math.pi)) for p in points]


def test_grid_density_within_its_bound(spark):
    values = np.random.default_rng(5).normal(50, 20, 3000).tolist()
    points = [-200.0, 0.0, 37.7, 50.0, 81.3, 400.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,), (math.inf,)], "x double").repartition(5)
    for h, cells in ((4.0, 512), (4.0, 16), (30.0, 64)):
        got = {r.x: r.density for r in P.kernel_density_grid(df, "x", points, h, digits=15, cells=cells).collect()}
        for p, want in zip(points, direct(values, points, h)):
            assert abs(got[p] - want) <= P.grid_error(h, cells), (h, cells, p)
    default = {r.x: r.density for r in P.kernel_density_grid(df, "x", points, digits=12).collect()}
    h = 0.9 * min(np.std(values, ddof=1), np.subtract(*np.quantile(values, [0.75, 0.25])) / 1.34) * len(values) ** -0.2
    for p, want in zip(points, direct(values, points, h)):
        assert default[p] == pytest.approx(want, rel=5e-3, abs=1e-9)


def test_grid_density_of_constant_and_empty_columns(spark):
    flat = spark.createDataFrame([(4.0,)] * 5, "x double")
    (r,) = P.kernel_density_grid(flat, "x", [4.0], 0.5, digits=12).collect()
    assert r.density == pytest.approx(1 / (0.5 * math.sqrt(2 * math.pi)), rel=1e-9)
    assert [tuple(r) for r in P.kernel_density_grid(flat.limit(0), "x", [1.0]).collect()] == [(1.0, None)]


# ---------------------------------------------------------------- models
def blobs(spark, n=1200):
    rng = np.random.default_rng(2)
    rows = [(i, *(rng.normal(0, 1, 2) + (i % 4) * np.array([20.0, -15.0])).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "id int, a double, b double")


def test_centres_do_not_depend_on_partitions(spark):
    df = blobs(spark)
    fits = [learn.kmeans(df.repartition(n), ["a", "b"], k=4, max_iter=20, id_cols=["id"])[0] for n in (4, 16, 64)]
    for other in fits[1:]:
        for c, d in zip(fits[0].clusterCenters(), other.clusterCenters()):
            assert c == pytest.approx(d, rel=1e-9, abs=1e-9)
    found = sorted(round(c[0] / 20) for c in fits[0].clusterCenters())
    assert found == [0, 1, 2, 3]  # the seeding found all four groups


def test_clusters_of_few_and_odd_points(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, None), (4, math.nan), (5, 9.0)], "id int, x double")
    model, assigned = learn.kmeans(df, ["x"], k=3, max_iter=5, id_cols=["id"])
    assert sorted(c[0] for c in model.clusterCenters()) == [1.0, 9.0]  # two different points: two centres
    assert sorted(r.id for r in assigned.collect()) == [1, 2, 5]
    none, empty = learn.kmeans(df.where("false"), ["x"], k=3, max_iter=5, id_cols=["id"])
    assert none.clusterCenters() == [] and empty.count() == 0


def test_factor_of_ten_thousand_levels(spark):
    rng = np.random.default_rng(7)
    level = np.r_[np.arange(10_000), rng.integers(0, 10_000, 30_000)]
    y = level % 97 + rng.normal(0, 1, len(level))
    df = spark.createDataFrame([(f"g{a:05d}", float(b)) for a, b in zip(level, y)] + [(None, 1.0), ("g00001", None)], "g string, y double")
    got = {r.term: r for r in learn.group_coefficients(df, "y", "g", digits=12).collect()}
    assert len(got) == 10_000 and "(Intercept)" in got and "g00000" not in got
    mean = np.bincount(level, y) / np.bincount(level)
    n = np.bincount(level)
    sigma2 = ((y - mean[level]) ** 2).sum() / (len(y) - 10_000)
    assert got["(Intercept)"].estimate == pytest.approx(mean[0], rel=1e-9)
    for i in (1, 4321, 9999):
        r = got[f"g{i:05d}"]
        assert r.estimate == pytest.approx(mean[i] - mean[0], rel=1e-8) and r.n == n[i]
        assert r.std_error == pytest.approx(math.sqrt(sigma2 * (1 / n[i] + 1 / n[0])), rel=1e-9)
        assert r.t_value == pytest.approx(r.estimate / r.std_error, rel=1e-9)


def test_closed_form_equals_the_fitted_model(spark):
    rows = [("Ctl", 4.17), ("Ctl", 5.58), ("Ctl", 5.18), ("Trt", 4.81), ("Trt", 4.17), ("Trt", 4.41), ("Xyz", 7.0), ("Xyz", 6.2)]
    df = spark.createDataFrame(rows, "grp string, weight double")
    for intercept in (True, False):
        fit = learn.fit_group_model(df, "weight", "grp", intercept)
        want = {r[0]: r[1:4] for r in learn.coefficient_table(fit, learn.feature_levels(fit.model, df, "grp"))}
        got = {r.term: (r.estimate, r.std_error, r.t_value) for r in learn.group_coefficients(df, "weight", "grp", intercept).collect()}
        assert set(got) == set(want)
        for term in got:
            assert got[term] == pytest.approx(want[term], rel=1e-6)
    one_each = learn.group_coefficients(df.limit(1), "weight", "grp").collect()
    assert [(r.term, r.std_error, r.t_value) for r in one_each] == [("(Intercept)", None, None)]
    assert learn.group_coefficients(df.limit(0), "weight", "grp").count() == 0


def test_many_rare_values_are_not_counted_one_by_one(spark, monkeypatch):
    """Values that are all rare leave an empty sketch: hashes tell that they are many."""
    monkeypatch.setattr(P, "categorical_columns", lambda *a, **k: pytest.fail("a row per row and column"))
    df = spark.range(0, 60_000, 1, 3).select("id", F.col("id").cast("string").alias("s"), (F.col("id") * 0.5).alias("x"), (F.col("id") % 20).alias("twenty"), F.lit(None).cast("int").alias("none"))
    got = {r.column_name: (r.distinct_levels, r.is_categorical) for r in P.column_levels(df).collect()}
    assert got == {"id": (None, False), "s": (None, False), "x": (None, False), "twenty": (20, True), "none": (0, True)}
    assert {r.is_categorical for r in P.column_levels(df.limit(0)).collect()} == {True}
