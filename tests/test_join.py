import os
import random

import pytest
from pyspark.sql import functions as F

from cataloom.operators import join as J
from cataloom.sources.catalog import TABLE_SCHEMA, SOURCE_SCHEMA, Catalog


@pytest.fixture(scope="module")
def cat(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("joincat"))
    data = {
        "a": ([(1, 10, 1, 1, 2), (2, 20, 1, 2, 1), (3, 30, 2, 2, 2), (4, None, 1, 1, 1)],
              "id int, b_id int, c_id1 int, c_id2 int, c2_id int"),
        "b": ([(10, "x"), (20, "y"), (99, "z")], "id int, name string"),
        "c": ([(1, 1, "p"), (1, 2, "q"), (2, 2, "r"), (2, 1, "s")], "k1 int, k2 int, v string"),
        "d": ([(1,)], "id int"),
        "tree": ([(1, None), (2, 1)], "id int, parent_id int"),
        "agg": ([(10, 5)], "b_id int, total int"),
    }
    rows = []
    for name, (values, schema) in data.items():
        path = os.path.join(root, name)
        spark.createDataFrame(values, schema).write.parquet(path)
        cols = [(f.split()[0], i + 1) for i, f in enumerate(schema.split(", "))]
        rows.append(["s", name, name, "original", "parquet", path, cols, []])
    fk = {
        "a": [
            ([("s.b", "s.a", "s.a.b_id", "s.b.id")],),
            ([("s.c", "s.a", "s.a.c_id1", "s.c.k1"), ("s.c", "s.a", "s.a.c_id2", "s.c.k2")],),
            ([("s.c", "s.a", "s.a.c2_id", "s.c.k1")],),
        ],
        "tree": [([("s.tree", "s.tree", "s.tree.parent_id", "s.tree.id")],)],
        "agg": [([("s.b", "s.agg", "s.agg.b_id", "s.b.id")],)],
    }
    for r in rows:
        r[7] = fk.get(r[1], [])
        if r[1] == "agg":
            r[3] = "derived"
    tables = spark.createDataFrame([tuple(r) for r in rows], TABLE_SCHEMA)
    sources = spark.createDataFrame([("s", "s", root, None, "source")], SOURCE_SCHEMA)
    return Catalog(spark, sources, tables)


def test_discover_first_fk_composite(cat):
    edges = J.discover_join_keys(cat, ["s.a", "s.b", "s.c"])
    assert [(e.child, e.parent) for e in edges] == [("s.a", "s.b"), ("s.a", "s.c")]
    assert edges[1].pairs == (("s.a.c_id1", "s.c.k1"), ("s.a.c_id2", "s.c.k2"))


def test_auto_join_rows_and_names(cat):
    out = J.auto_join(cat, "s.a", "s.b", "s.c")
    df = out.df
    assert out.tables == ("s.a", "s.b", "s.c")
    assert "a__id" in df.columns and "b__name" in df.columns and "c__v" in df.columns
    got = sorted((r.a__id, r.b__name, r.c__v) for r in df.collect())
    # row 3 has no parent in b; row 4 has a NULL b_id: both are dropped
    assert got == [(1, "x", "p"), (2, "y", "q")]


def test_auto_join_any_order(cat):
    a = sorted(tuple(r) for r in J.auto_join(cat, "s.b", "s.c", "s.a").df.select("a__id", "b__id", "c__v").collect())
    b = sorted(tuple(r) for r in J.auto_join(cat, "s.a", "s.b", "s.c").df.select("a__id", "b__id", "c__v").collect())
    assert a == b


def test_auto_join_without_link_raises(cat):
    with pytest.raises(ValueError, match="no foreign key"):
        J.auto_join(cat, "s.a", "s.d")


def test_self_reference_is_not_an_edge(cat):
    assert J.discover_join_keys(cat, ["s.tree", "s.a"]) == []


def test_derived_table_keeps_names(cat):
    df = J.auto_join(cat, "s.agg", "s.b").df
    assert "total" in df.columns and "b__name" in df.columns
    assert [(r.total, r.b__name) for r in df.collect()] == [(5, "x")]


def test_join_types(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "ak int, av string")
    b = spark.createDataFrame([(2, "x"), (4, "y")], "bk int, bv string")
    n = {t: J.join_tables(a, b, "ak = bk", t).count() for t in ["inner", "outer", "left_outer", "right_outer", "semijoin"]}
    assert n == {"inner": 1, "outer": 4, "left_outer": 3, "right_outer": 2, "semijoin": 1}
    lo = J.left_outer_join_tables(a, b, "ak = bk", filter_condition="ak < 3", select_cols=["ak", "bv"], out_col_prefix="z")
    assert lo.columns == ["Z_AK", "Z_BV"] and lo.count() == 2
    with pytest.raises(ValueError):
        J.join_type("sideways")


def test_join_filter_select_prefix_order(spark):
    a = spark.createDataFrame([(1, 5), (2, 6)], "ak int, x int")
    b = spark.createDataFrame([(1, 7), (2, 8)], "bk int, y int")
    out = J.join_tables(a, b, "ak = bk", filter_condition="y > 7", select_cols=["ak", "y"], out_col_prefix="p")
    assert [tuple(r) for r in out.collect()] == [(2, 8)] and out.columns == ["P_AK", "P_Y"]


def test_theta_join_condition(spark):
    a = spark.createDataFrame([(1,), (5,), (9,)], "v int")
    b = spark.createDataFrame([(0, 4), (4, 8)], "lo int, hi int")
    out = J.join_tables(a, b, "v BETWEEN lo AND hi")
    assert sorted(tuple(r) for r in out.collect()) == [(1, 0, 4), (5, 4, 8)]


def test_range_join_matches_brute_force(spark):
    rng = random.Random(3)
    pts = [(i, rng.uniform(-50, 150)) for i in range(400)] + [(400, None)]
    ivs = [(j, lo, lo + rng.uniform(0, 40)) for j, lo in enumerate(rng.uniform(-60, 140) for _ in range(60))]
    p = spark.createDataFrame(pts, "pid int, v double")
    r = spark.createDataFrame(ivs, "rid int, lo double, hi double")
    fast = J.range_join(p, r, "v", "lo", "hi", bin_width=10.0).select("pid", "rid")
    brute = {(i, j) for i, v in pts if v is not None for j, lo, hi in ivs if lo <= v <= hi}
    got = [tuple(x) for x in fast.collect()]
    assert len(got) == len(set(got)) and set(got) == brute
    left = J.range_join(p, r, "v", "lo", "hi", bin_width=10.0, how="left")
    unmatched = {i for i, v in pts} - {i for i, _ in brute}
    assert left.count() == len(brute) + len(unmatched)


def test_equi_join_composite(spark):
    a = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "x int, y int, v string")
    b = spark.createDataFrame([(1, 2, "B")], "x2 int, y2 int, w string")
    out = J.equi_join(a, b, [("x", "x2"), ("y", "y2")])
    assert [tuple(r) for r in out.select("v", "w").collect()] == [("b", "B")]
    with pytest.raises(ValueError):
        J.equi_join(a, b, [])


def test_join_back_aggregate(spark):
    df = spark.createDataFrame([(1, "M"), (1, "R"), (1, "M"), (2, "R"), (None, "M")], "k int, d string")
    out = J.join_back_aggregate(df, ["k"], [F.count_if(F.col("d") == "M").alias("m")])
    assert sorted((r.k, r.m) for r in out.collect()) == [(1, 2), (1, 2), (1, 2), (2, 0)]


def test_salted_join_back_equals_plain(spark):
    rows = [(1, "M")] * 300 + [(1, "R")] * 50 + [(2, "M"), (3, "R"), (None, "M")]
    df = spark.createDataFrame(rows, "k int, d string")
    aggs = [F.count_if(F.col("d") == "M").alias("m")]
    plain = sorted(tuple(r) for r in J.join_back_aggregate(df, ["k"], aggs).collect())
    salty = J.join_back_aggregate(df, ["k"], aggs, salt_buckets=8)
    assert salty.columns == ["k", "d", "m"]
    assert sorted(tuple(r) for r in salty.collect()) == plain
    # salts are deterministic: the same rows land on the same salt every time
    left, _ = J.salted(df, df, 8)
    a = sorted((tuple(r) for r in left.collect()), key=repr)
    b = sorted((tuple(r) for r in left.collect()), key=repr)
    assert a == b and len({r[-1] for r in a if r[0] == 1}) > 1


def test_salted_equi_join(spark):
    left = spark.createDataFrame([(1, i) for i in range(200)] + [(2, 0), (5, 0)], "k int, i int")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "rk int, v string")
    plain = sorted(tuple(r) for r in J.equi_join(left, right, [("k", "rk")], "left").collect())
    salty = J.equi_join(left, right, [("k", "rk")], "left", salt_buckets=4)
    assert salty.columns == ["k", "i", "rk", "v"]
    assert sorted(tuple(r) for r in salty.collect()) == plain
    with pytest.raises(ValueError):
        J.equi_join(left, right, [("k", "rk")], "full", salt_buckets=4)


def test_auto_join_reports_edges_and_accepts_override(cat):
    out, steps = J.auto_join(cat, "s.a", "s.b", "s.c", return_edges=True)
    assert [(t, [(e.child, e.parent) for e in es]) for t, es in steps] == [
        ("s.b", [("s.a", "s.b")]), ("s.c", [("s.a", "s.c")])]
    # override: join a to c on the second FK (c2_id -> k1) instead of the composite one
    override = [J.JoinEdge("s.a", "s.c", (("s.a.c2_id", "s.c.k1"),))]
    df = J.auto_join(cat, "s.a", "s.c", on=override).df
    want = sorted((a, k1) for a, c2 in [(1, 2), (2, 1), (3, 2), (4, 1)] for k1 in [1, 1, 2, 2] if c2 == k1)
    assert sorted((r.a__id, r.c__k1) for r in df.collect()) == want


def test_auto_join_never_pairs_children_of_a_shared_parent(spark):
    """Listed dimension-first, the diamond still starts at the fact table and
    only looks parents up, so no customer x supplier pairs are formed."""
    from cataloom.plans import tpch

    names = ["nation", "customer", "supplier", "orders", "lineitem"]
    cat = tpch.catalog(spark, "/root/testdata/sf0.001", names)
    out, steps = J.auto_join(cat, *[tpch.q(n) for n in names], return_edges=True)
    # starts at lineitem; every step adds a parent of an already joined table (N:1)
    seen = {"tpch.lineitem"}
    for table, edges in steps:
        assert any(e.parent == table and e.child in seen for e in edges), (table, edges)
        seen.add(table)
    assert seen == {tpch.q(n) for n in names}
    assert out.df.columns[0] == "nation__n_nationkey"
    ref = J.auto_join(cat, *[tpch.q(n) for n in reversed(names)]).df
    assert out.df.count() == ref.count()
    plan = out.df._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan


def test_range_join_picks_bin_width(spark):
    p = spark.createDataFrame([(i, float(i)) for i in range(100)], "pid int, v double")
    r = spark.createDataFrame([(0, 10.0, 19.5), (1, 50.0, 50.0), (2, 90.0, 200.0)], "rid int, lo double, hi double")
    got = sorted(tuple(x) for x in J.range_join(p, r, "v", "lo", "hi").select("pid", "rid").collect())
    want = sorted([(i, 0) for i in range(10, 20)] + [(50, 1)] + [(i, 2) for i in range(90, 100)])
    assert got == want


def test_range_join_outer_kinds_and_long_ranges(spark):
    points = [(i, v) for i, v in enumerate([1, 5, 5, 50, 900, 12345, None, -3])]
    ranges = [(0, 0, 6), (1, 4, 5), (2, -10, 100_000), (3, 9, 2), (4, None, 7), (5, 400, 401), (6, 5, 5)]
    p = spark.createDataFrame(points, "pid int, v int")
    r = spark.createDataFrame(ranges, "rid int, lo int, hi int")
    pairs = {(i, k) for i, v in points for k, lo, hi in ranges if None not in (v, lo, hi) and lo <= v <= hi}
    left = {(i, None) for i, _ in points} - {(i, None) for i, _ in pairs}
    right = {(None, k) for k, _, _ in ranges} - {(None, k) for _, k in pairs}
    want = {"inner": pairs, "left": pairs | left, "right": pairs | right, "full": pairs | left | right}
    for how, rows in want.items():
        got = [(x["pid"], x["rid"]) for x in J.range_join(p, r, "v", "lo", "hi", bin_width=2.0, how=how).collect()]
        assert len(got) == len(rows) and set(got) == rows, how
    assert sorted(x["pid"] for x in J.range_join(p, r, "v", "lo", "hi", how="left_anti").collect()) == sorted(i for i, _ in left)
    assert J.range_join(p, r.limit(0), "v", "lo", "hi", how="left").count() == len(points)


def test_salt_spreads_equal_rows(spark):
    hot = spark.range(1000).selectExpr("1 as k", "'same' as x").repartition(2)
    left, _ = J.salted(hot, spark.createDataFrame([(1,)], "k int"), 8)
    assert left.select(J.SALT).distinct().count() == 8
