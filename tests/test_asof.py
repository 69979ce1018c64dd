import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cataloom.operators.asof import asof_join

DAY = dt.date(2001, 1, 1)


def brute(left, right, forward=False, equal=True, tolerance=None):
    out = []
    for i, k, t in left:
        best = None
        for j, key, at, tie in right:
            if None in (k, t, key, at) or key != k:
                continue
            apart = (at - t).days if forward else (t - at).days
            if apart < 0 or (apart == 0 and not equal):
                continue
            if best is None or (-apart, tie) > (-best[0], best[2]):
                best = (apart, j, tie)
        if best and tolerance is not None and best[0] > tolerance:
            best = None
        out.append((i, best[1] if best else None))
    return sorted(out, key=repr)


def data(seed=3, n=400, hot=0):
    rng = random.Random(seed)
    day = lambda: rng.choice([None] + [DAY + dt.timedelta(days=rng.randrange(60)) for _ in range(12)])
    key = lambda: "hot" if rng.random() < hot else rng.choice([None, "a", "b", "c", "d"])
    left = [(i, key(), day()) for i in range(n)]
    right = [(1000 + i, key(), day(), rng.randrange(10**6)) for i in range(n // 2)]
    return left, right


def frames(spark, left, right):
    return spark.createDataFrame(left, "id int, k string, t date"), spark.createDataFrame(right, "rid int, key string, at date, tie int")


def pairs(df):
    return sorted(((r["id"], r["rid"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bucket_rows, part_rows", [(2_000_000, 500_000), (40, 3), (9, 1)])
@pytest.mark.parametrize("forward, equal", [(False, True), (True, True), (False, False), (True, False)])
def test_nearest_row_against_brute_force(spark, bucket_rows, part_rows, forward, equal):
    left, right = data()
    a, b = frames(spark, left, right)
    got = asof_join(a, b, [("k", "key")], ("t", "at"), ["tie"], direction="forward" if forward else "backward", allow_equal=equal, bucket_rows=bucket_rows, part_rows=part_rows)
    assert got.columns == ["id", "k", "t", "rid", "key", "at", "tie"]
    assert pairs(got) == brute(left, right, forward, equal)


def test_hot_member_spreads_over_buckets(spark):
    """A key with over a third of all rows: many (key, bucket) groups, same rows."""
    left, right = data(seed=8, n=900, hot=0.5)
    a, b = frames(spark, left, right)
    got = asof_join(a, b, [("k", "key")], ("t", "at"), ["tie"], bucket_rows=100, part_rows=20)
    assert pairs(got) == brute(left, right)
    text = got._jdf.queryExecution().toString()
    assert "__b" in text and "__p" in text  # windows run per key, bucket and part


def test_tolerance_inner_and_all_rows_of_one_moment(spark):
    left, right = data(seed=5)
    a, b = frames(spark, left, right)
    got = asof_join(a, b, [("k", "key")], ("t", "at"), ["tie"], tolerance=2)
    assert pairs(got) == brute(left, right, tolerance=2)
    inner = asof_join(a, b, [("k", "key")], ("t", "at"), ["tie"], how="inner")
    assert pairs(inner) == [p for p in brute(left, right) if p[1] is not None]
    left = [(i, "x", DAY) for i in range(60)]
    right = [(100 + i, "x", DAY, i) for i in range(5)]
    a, b = frames(spark, left, right)
    assert pairs(asof_join(a, b, [("k", "key")], ("t", "at"), ["tie"], bucket_rows=10, part_rows=7)) == sorted([(i, 104) for i in range(60)], key=repr)


def test_repeated_rows_timestamps_and_empty_sides(spark):
    a = spark.createDataFrame([(1, "x", dt.datetime(2001, 1, 1, 12)), (1, "x", dt.datetime(2001, 1, 1, 12)), (2, "x", dt.datetime(2000, 1, 1))], "id int, k string, t timestamp")
    b = spark.createDataFrame([(7, "x", dt.datetime(2001, 1, 1, 11, 59, 59)), (8, "x", dt.datetime(2001, 1, 1, 12, 0, 1))], "rid int, k string, t timestamp")
    got = asof_join(a, b, [("k", "k")], ("t", "t"))
    assert sorted(((r[0], r[3]) for r in got.collect()), key=repr) == [(1, 7), (1, 7), (2, None)]
    assert asof_join(a, b.where("false"), [("k", "k")], ("t", "t")).count() == 3
    assert asof_join(a.where("false"), b, [("k", "k")], ("t", "t")).count() == 0
    with pytest.raises(ValueError):
        asof_join(a, b.withColumn("t", F.lit("x")), [("k", "k")], ("t", "t"))


def test_keys_of_few_rows_take_one_shuffle(spark):
    """No groups by struct, no join back: sorted once, for the window."""
    left, right = data(seed=6)
    a, b = frames(spark, [r for r in left if None not in r], right)
    got = asof_join(a, b, [("k", "key")], ("t", "at"), ["tie"])
    assert pairs(got) == brute([r for r in left if None not in r], right)
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text and "Aggregate" not in text and text.count("Window") == 1
    a, b = frames(spark, left, right)  # rows without a key or time, beside hot and other keys
    assert pairs(asof_join(a, b, [("k", "key")], ("t", "at"), ["tie"], bucket_rows=50, part_rows=len(left) // 5)) == brute(left, right)
