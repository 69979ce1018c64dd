import datetime as dt
import random

import pytest

from cataloom.operators import aggregate as A


def test_aggregate_named(spark):
    df = spark.createDataFrame([("x", 1, 2.0), ("x", None, 4.0), ("y", 3, 1.0)], "city string, id int, paid double")
    out = A.aggregate(df, "city", count=("n", "id"), s=("sum", "paid"), m=("avg", "paid"))
    got = {r.city: (r["count"], r.s, r.m) for r in out.collect()}
    assert got == {"x": (1, 6.0, 3.0), "y": (1, 1.0, 1.0)}
    with pytest.raises(ValueError):
        A.aggregate(df, "city", bad=("nope", "id"))


def test_aggregate_multi_keys_and_having(spark):
    df = spark.createDataFrame([("a", "p", 1), ("a", "p", 2), ("a", "q", 3)], "k1 string, k2 string, v int")
    out = A.aggregate(df, ["k1", "k2"], total=("sum", "v")).filter("total > 2")
    assert sorted(tuple(r) for r in out.collect()) == [("a", "p", 3), ("a", "q", 3)]


def test_group_by_sql_many_exprs(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "g string, v int")
    out = A.group_by_sql(df, "g", "sum(v) AS s", "max(v) AS m", out_col_prefix="grp")
    assert out.columns == ["GRP_G", "GRP_S", "GRP_M"]
    assert sorted(tuple(r) for r in out.collect()) == [("a", 3, 2), ("b", 5, 5)]


def test_count_if(spark):
    df = spark.createDataFrame([("M",), ("R",), ("M",), (None,)], "d string")
    assert df.agg(A.count_if("d = 'M'").alias("n")).first().n == 2


D = dt.date


def _brute_latest(rows):
    """Reference semantics: max date per group, max id on that date, join back."""
    groups = {}
    for r in rows:
        k = (r[0], r[1])
        groups.setdefault(k, []).append(r)
    out = []
    for (k1, k2), rs in groups.items():
        if k1 is None or k2 is None:
            continue
        dates = [r[2] for r in rs if r[2] is not None]
        if not dates:
            continue
        md = max(dates)
        ids = [r[3] for r in rs if r[2] == md and r[3] is not None]
        if not ids:
            continue
        mi = max(ids)
        out += [r for r in rs if r[2] == md and r[3] == mi]
    return sorted(out, key=repr)


EDGE_ROWS = [
    (1, "a", D(2020, 1, 1), 5, "old"),
    (1, "a", D(2020, 2, 1), 7, "tie1"),
    (1, "a", D(2020, 2, 1), 7, "tie2"),
    (1, "a", D(2020, 2, 1), 6, "lower id"),
    (None, "a", D(2021, 1, 1), 9, "null key"),
    (2, "b", D(2020, 5, 1), None, "latest date, null id"),
    (2, "b", D(2020, 4, 1), 3, "earlier"),
    (3, "c", None, 4, "null date"),
    (3, "c", D(2019, 1, 1), 1, "only dated"),
]
SCHEMA = "k1 int, k2 string, d date, id int, tag string"


@pytest.mark.parametrize("method", ["struct_max", "window", "join_back"])
def test_latest_edge_cases(spark, method):
    df = spark.createDataFrame(EDGE_ROWS, SCHEMA)
    got = sorted(r.tag for r in A.latest_per_group(df, ["k1", "k2"], ["d", "id"], method=method).collect())
    assert got == ["only dated", "tie1", "tie2"]


def test_latest_methods_agree_random(spark):
    rng = random.Random(11)
    for trial in range(4):
        rows = []
        for i in range(300):
            rows.append((
                rng.choice([1, 2, 3, None]),
                rng.choice(["x", "y", None]),
                rng.choice([D(2020, 1, rng.randint(1, 4)), None]),
                rng.choice([rng.randint(1, 4), None]),
                f"r{i}",
            ))
        df = spark.createDataFrame(rows, SCHEMA)
        want = sorted(r[4] for r in _brute_latest(rows))
        for method in ["struct_max", "window", "join_back"]:
            got = sorted(r.tag for r in A.latest_per_group(df, ["k1", "k2"], ["d", "id"], method=method).collect())
            assert got == want, (trial, method)
        got = sorted(r.tag for r in A.latest_per_group(df, ["k1", "k2"], ["d", "id"], split_ties=3).collect())
        assert got == want, trial


def test_latest_struct_max_plan_has_no_window(spark):
    df = spark.createDataFrame(EDGE_ROWS, SCHEMA)
    lazy = A.latest_per_group(df, ["k1", "k2"], ["d", "id"], method="join_back", materialize_winners=False)
    plan = lazy._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "partial_max" in plan  # combined map-side before the shuffle
    assert "SortAggregate" not in plan


def test_latest_methods_agree_timestamp_bigint(spark):
    import datetime as dt

    rng = random.Random(5)
    base = dt.datetime(2001, 1, 1)
    rows = []
    for i in range(400):
        rows.append((
            rng.choice([1, 2, None]),
            rng.choice(["x", "y"]),
            rng.choice([base + dt.timedelta(seconds=rng.randint(0, 3), microseconds=rng.randint(0, 1)), None]),
            rng.choice([rng.randint(-2, 1) * (2**62), 2**63 - 1, None]),
            f"r{i}",
        ))
    df = spark.createDataFrame(rows, "k1 int, k2 string, d timestamp_ntz, id bigint, tag string")
    want = sorted(r[4] for r in _brute_latest(rows))
    for method in ["struct_max", "window", "join_back"]:
        got = sorted(r.tag for r in A.latest_per_group(df, ["k1", "k2"], ["d", "id"], method=method).collect())
        assert got == want, method
    plan = A.latest_per_group(df, ["k1", "k2"], ["d", "id"], method="join_back")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Window" not in plan


def test_group_keys_with_commas_inside(spark):
    assert A.split_expressions("a, coalesce(b, f(c, 1)) AS x, ',' , `q,r`") == ["a", "coalesce(b, f(c, 1)) AS x", "','", "`q,r`"]
    df = spark.createDataFrame([(None, 1), (2, 1), (1, 5)], "a int, b int")
    got = A.group_by_sql(df, "coalesce(a, b) AS k", "count(*) AS n").collect()
    assert sorted(tuple(r) for r in got) == [(1, 2), (2, 1)]
