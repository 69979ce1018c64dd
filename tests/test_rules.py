import datetime as dt

import pytest

from cataloom.functions import rules as R

D = dt.date


def col_values(spark, values, schema, expr):
    df = spark.createDataFrame([(i, *v) if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r.out for r in df.select("i", expr.alias("out")).orderBy("i").collect()]


def test_day_supply(spark):
    got = col_values(spark, [0, 1, 33, 34, 83, 84, None], "q int", R.normalized_day_supply("q"))
    assert got == [None, 30, 30, 60, 60, 90, None]


def test_age_and_minor(spark):
    as_of = D(2024, 6, 15)
    births = [D(2006, 6, 15), D(2006, 6, 16), None, D(1990, 6, 14)]
    ages = col_values(spark, births, "b date", R.member_age("b", as_of))
    assert ages == [18, 17, None, 34]
    minors = col_values(spark, births, "b date", R.minor_flag(R.member_age("b", as_of)))
    assert minors == ["N", "Y", "N", "N"]
    ages365 = col_values(spark, [D(2006, 6, 15)], "b date", R.member_age("b", as_of, "days365"))
    assert ages365 == [18]
    with pytest.raises(ValueError):
        R.member_age("b", as_of, "weeks")


def test_eligible(spark):
    as_of = D(2024, 1, 10)
    rows = [(D(2024, 1, 10), D(2024, 2, 1)), (D(2023, 1, 1), D(2024, 1, 10)), (D(2024, 2, 1), D(2024, 3, 1)),
            (D(2023, 1, 1), None)]
    assert col_values(spark, rows, "s date, e date", R.eligible_flag(as_of, "s", "e")) == ["Y", "Y", "N", "N"]


def test_retail_to_mail(spark):
    rows = [("Y", "R"), ("Y", "M"), ("N", "R"), (None, "R")]
    assert col_values(spark, rows, "m string, d string", R.retail_to_mail_flag("m", "d")) == ["Y", "N", "N", "N"]


def test_maintenance_choice(spark):
    rows = [
        ("MV", 20, "R", "Y", "Y"), ("MV", 21, "R", "Y", "Y"), ("MV", 33, "R", "Y", "Y"), ("MV", 34, "R", "N", "N"),
        ("MV", 83, "M", "N", "N"), ("MV", 84, "M", "N", "N"), ("MV", 84, "M", "Y", "N"), ("MV", 84, "M", "N", "Y"),
        ("NA", 25, "R", "N", "N"), ("MV", 25, "M", "N", "N"),
    ]
    got = col_values(spark, rows, "t string, q int, d string, r string, m string",
                     R.maintenance_choice_flag("t", "q", "d", "r", "m"))
    assert got == ["N", "Y", "Y", "N", "N", "Y", "N", "N", "N", "N"]


def test_ready_fill(spark):
    rows = [(5382, "PTL", None), (5383, "PTL", None), (5384, "CPV", ""), (5385, "PTL", None),
            (5383, "XXX", None), (5383, "PSV", "2001-01-01"), (None, None, None)]
    got = col_values(spark, rows, "p int, s string, o string", R.ready_fill_flag("p", "s", "o"))
    assert got == ["N", "Y", "Y", "N", "N", "N", "N"]
    # a DATE opt-out column works under ANSI mode too
    got = col_values(spark, [(5383, "PTL", None), (5383, "PTL", D(2001, 1, 1))], "p int, s string, o date",
                     R.ready_fill_flag("p", "s", "o"))
    assert got == ["Y", "N"]


def test_controlled(spark):
    assert col_values(spark, ["0", " ", "2", None], "c string", R.controlled_substance_flag("c")) == ["N", "N", "Y", "Y"]


def test_ffm_flag(spark):
    rows = [("Y", "M", 1), ("Y", "M", 2), ("Y", "R", 1), ("N", "M", 1), ("Y", "M", 0)]
    got = col_values(spark, rows, "m string, d string, n bigint", R.first_fill_at_mail_flag("m", "d", "n"))
    assert got == ["Y", "N", "N", "N", "N"]


def test_recent_fill_and_link_id(spark):
    as_of = D(2024, 7, 1)
    dates = [as_of - dt.timedelta(days=179), as_of - dt.timedelta(days=180), D(2025, 1, 1)]
    assert col_values(spark, dates, "f date", R.recent_fill("f", as_of)) == [True, False, True]
    links = ["12", "0", None, "abc"]
    assert col_values(spark, links, "l string", R.nonzero_id("l", text=True)) == [True, False, False, False]
    assert col_values(spark, [12, 0, None], "l long", R.nonzero_id("l")) == [True, False, False]
