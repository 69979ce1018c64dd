import math

import numpy as np
import pytest

from cataloom.operators import profile as P


def test_find_duplicates_nulls_equal(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, None), (2, None), (2, None), (3, "b"), (None, None)], "x int, y string"
    )
    r = P.find_duplicates(df).first()
    assert (r.duplicate_groups, r.duplicate_rows) == (2, 5)
    groups = sorted(r.occurrences for r in P.duplicate_groups(df).collect())
    assert groups == [2, 3]
    assert P.find_duplicates(df, ["y"]).first().duplicate_groups == 2  # 'a' twice, NULL four times


def test_find_duplicates_none(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    r = P.find_duplicates(df).first()
    assert r.duplicate_groups == 0 and r.duplicate_rows == 0


def test_row_count(spark):
    assert P.row_count(spark.range(17)).first().rowcount == 17


def test_sample_fraction_rules(spark):
    df = spark.range(1000)
    assert P.sample(df, percent=100, seed=1).count() == 1000
    n = P.sample(df, count=5000, seed=1).count()  # capped at 1000 rows -> fraction 1.0
    assert n == 1000
    small = P.sample(df, count=100, seed=3).count()
    assert 50 < small < 160


def test_categorical_columns(spark):
    rows = [(i, f"c{i % 3}", float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, cat string, v double")
    got = {r.column_name: (r.non_null, r.distinct_levels, r.distinct_ratio, r.is_categorical)
           for r in P.categorical_columns(df, max_levels=10).collect()}
    assert got == {"id": (500, 500, 1.0, False), "cat": (500, 3, 3 / 500, True), "v": (500, 500, 1.0, False)}


def test_histogram_matches_numpy(spark):
    vals = [float(x) for x in np.random.default_rng(1).normal(10, 3, 2000)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    got = sorted((r.bin, r.n) for r in P.histogram(df, "x", 8).collect())
    counts, _ = np.histogram(vals, bins=8)
    assert [n for _, n in got] == list(counts)
    assert sum(n for _, n in got) == len(vals)


def test_kernel_density_matches_direct_sum(spark):
    vals = [1.0, 2.0, 2.0, 3.5, 7.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = 0.8
    got = {r.x: r.density for r in P.kernel_density(df, "x", [0.0, 2.0, 5.0], bandwidth=h, digits=12).collect()}
    for p, dens in got.items():
        want = sum(math.exp(-0.5 * ((p - v) / h) ** 2) for v in vals) / (len(vals) * h * math.sqrt(2 * math.pi))
        assert dens == pytest.approx(want, rel=1e-9)


def test_duplicates_count_identity(spark):
    """rows - distinct rows == duplicate_rows - duplicate_groups."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", "b", None])), max_size=40))
    def check(rows):
        df = spark.createDataFrame(rows, "x int, y string")
        r = P.find_duplicates(df).first()
        total, distinct = len(rows), len(set(rows))
        assert (r.duplicate_rows or 0) - r.duplicate_groups == total - distinct

    check()


def test_profiles_accept_catalogued_names(spark):
    from cataloom.operators.project import select
    from cataloom.operators.tracked import Tracked
    from cataloom.plans import tpch

    cat = tpch.catalog(spark, "/root/testdata/sf0.001", ["nation", "region"])
    assert P.row_count("tpch.nation", catalog=cat).first().rowcount == 25
    assert P.find_duplicates("tpch.region", catalog=cat).first().duplicate_groups == 0
    assert P.sample("tpch.nation", percent=100, catalog=cat).count() == 25
    names = {r.column_name for r in P.categorical_columns("tpch.region", catalog=cat).collect()}
    assert names == {"r_regionkey", "r_name"}
    out = select("tpch.nation", "upper(n_name) AS up", catalog=cat)
    assert isinstance(out, Tracked) and out.tables == ("tpch.nation",) and "up" in out.df.columns
    with pytest.raises(TypeError):
        P.row_count("tpch.nation")


def test_duplicates_keep_microseconds_and_complex_columns(spark):
    import datetime as dt

    a = dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    rows = [(a, [1], {"k": 1}, b"x", "t"), (a.replace(microsecond=2), [1], {"k": 1}, b"x", "t"), (a, [1], {"k": 1}, b"x", "t")]
    df = spark.createDataFrame(rows, "ts timestamp, a array<int>, m map<string,int>, b binary, s string")
    r = P.find_duplicates(df).first()
    assert (r.duplicate_groups, r.duplicate_rows) == (1, 2)
    assert P.find_duplicates(df.limit(2)).first().duplicate_rows == 0
    got = {r.column_name: (r.non_null, r.distinct_levels, r.is_categorical) for r in P.categorical_columns(df, max_levels=1).collect()}
    assert got == {"ts": (3, 2, False), "a": (3, 1, True), "m": (3, 1, True), "b": (3, 1, True), "s": (3, 1, True)}
    some = {r.column_name: (r.approx_levels, r.distinct_levels) for r in P.categorical_columns(df, exact=["s"]).collect()}
    assert some["ts"] == (2, None) and some["s"] == (1, 1)


def test_sample_has_no_cap(spark):
    n = P.sample(spark.range(100_000), count=50_000, seed=3).count()
    assert 49_000 < n < 51_000


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    for vals in (rng.normal(0, 1e6, 501), rng.integers(-3, 4, 400).astype(float), np.array([5.0]), np.r_[rng.normal(0, 1, 50), 1e12]):
        counted = spark.createDataFrame([(float(v),) for v in vals], "v double").groupBy("v").count().checkpoint()
        for p in (0.0, 0.25, 0.5, 0.75, 1.0):
            assert P.exact_quantile(counted, len(vals), p) == pytest.approx(np.quantile(vals, p), rel=1e-12)


def test_density_of_constant_and_empty_columns(spark):
    flat = spark.createDataFrame([(4.0,)] * 5, "x double")
    h = 0.9 * 4.0 * 5 ** -0.2
    (r,) = P.kernel_density(flat, "x", [4.0], digits=12).collect()
    assert r.density == pytest.approx(1 / (h * math.sqrt(2 * math.pi)), rel=1e-9)
    assert [tuple(r) for r in P.kernel_density(flat.limit(0), "x", [1.0, 2.0]).collect()] == [(1.0, None), (2.0, None)]
    assert sorted((r.bin, r.n) for r in P.histogram(flat, "x", 3).collect()) == [(0, 5), (1, 0), (2, 0)]
    assert P.histogram(flat.limit(0), "x").count() == 0
