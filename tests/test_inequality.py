import datetime as dt
import math
import operator
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from cataloom.operators import inequality as I
from cataloom.operators import join as J

OPS = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
rng = random.Random(1)


def value():
    return rng.choice([None, *range(12)])


LEFT = [(i, value(), value(), f"l{i}") for i in range(150)]
RIGHT = [(i, value(), value(), f"r{i}") for i in range(130)]


@pytest.fixture(scope="module")
def sides(spark):
    a = spark.createDataFrame(LEFT, "id long, x int, u int, s string").alias("a")
    return a, spark.createDataFrame(RIGHT, "id long, y int, v int, t string").alias("b")


def brute(match, how, left=LEFT, right=RIGHT):
    pairs = [(a, b) for a in left for b in right if match(a, b)]
    seen = {a[0] for a, _ in pairs}, {b[0] for _, b in pairs}
    out = [a + b for a, b in pairs]
    if how in ("left", "full"):
        out += [a + (None,) * 4 for a in left if a[0] not in seen[0]]
    if how in ("right", "full"):
        out += [(None,) * 4 + b for b in right if b[0] not in seen[1]]
    if how in ("left_semi", "left_anti"):
        out = [a for a in left if (a[0] in seen[0]) == (how == "left_semi")]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("one, two, how", [("<", ">", "inner"), ("<=", "<", "full"), (">=", ">=", "left_anti"), (">", "<=", "right"), ("<", "<=", "left_semi"), (">=", ">", "left")])
def test_two_inequalities_found_in_the_condition(sides, one, two, how):
    a, b = sides
    got = J.join_tables(a, b, f"a.x {one} b.y and a.u {two} b.v", how)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    want = brute(lambda l, r: None not in (l[1], l[2], r[1], r[2]) and OPS[one](l[1], r[1]) and OPS[two](l[2], r[2]), how)
    assert rows(got) == want


@pytest.mark.parametrize("how, cond, names", [("inner", "x > y AND i < j", ["j", "i", "y"]), ("full", "x > y AND i < j AND x + y <> 9", ["i"]), ("left", "x > y AND i < j", ["i", "j"])])
def test_only_the_wanted_columns_are_paired(spark, monkeypatch, how, cond, names):
    carried, paired = [], I.matching_rows
    monkeypatch.setattr(I, "matching_rows", lambda a, b, conditions, carry, rows: carried.append(carry) or paired(a, b, conditions, carry, rows))
    a = spark.range(0, 40, 1, 1).selectExpr("id AS i", "CAST(id * 7 % 11 AS INT) AS x", "repeat('long text ', 9) AS wide")
    b = spark.range(0, 30, 1, 1).selectExpr("id AS j", "CAST(id * 5 % 13 AS INT) AS y", "repeat('other text ', 9) AS broad")
    got = J.join_tables(a, b, cond, how, select_cols=names)
    assert got.columns == names
    want = a.join(b.hint("broadcast"), F.expr(cond), how).select(*names)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert not {"wide", "broad"} & {c for side in carried[0] for c in side}
    assert how != "inner" or carried == [(["i"], ["j", "y"])]
