"""Scalar rules on literal rows, with NULLs and edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ebbtide.functions import columns as c


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_safe_divide_modes(spark):
    df = spark.createDataFrame([(6, 3), (6, 0), (6, None), (6, -2), (None, 2), (None, 0)], "a int, b int")
    assert values(df, c.safe_divide("a", "b")) == [2.0, 0.0, 0.0, -3.0, None, 0.0]
    assert values(df, c.safe_divide("a", "b", mode="positive")) == [2.0, 0.0, 0.0, 0.0, None, 0.0]
    assert values(df, c.safe_divide("a", "b", default=-1.0))[1:3] == [-1.0, -1.0]


def test_age_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(v,) for v in (9, 10, 70, 71, 0, -5, None)], "bd int")
    assert values(df, c.null_outside("bd", 10, 70)) == [None, 10, 70, None, None, None, None]


def test_category_is_case_sensitive(spark):
    df = spark.createDataFrame([("male",), ("female",), ("Male",), ("",), (None,)], "g string")
    assert values(df, c.normalize_category("g", ["male", "female"])) == ["male", "female"] + ["unknown"] * 3


def test_flags_treat_null_as_no(spark):
    df = spark.createDataFrame([(1, 2), (2, 2), (None, 2), (1, None)], "a int, b int")
    assert values(df, c.less_flag("a", "b")) == [1, 0, 0, 0]
    assert values(df, c.present_flag("a")) == [1, 1, 0, 1]


def test_row_sum_is_null_when_one_part_is(spark):
    df = spark.createDataFrame([(1, 2), (1, None)], "a int, b int")
    assert values(df, c.row_sum(["a", "b"])) == [3, None]


def test_dates(spark):
    df = spark.createDataFrame([(20170228,), (20170230,), (None,)], "d int")
    assert values(df, c.parse_ymd("d")) == [dt.date(2017, 2, 28), None, None]
    odd = spark.createDataFrame([(20240229,), (20230229,), (20171301,), (20170100,), (2017021,), (201702011,), (-20170101,)], "d int")
    assert values(odd, c.parse_ymd("d")) == [dt.date(2024, 2, 29)] + [None] * 6
    with pytest.raises(Exception):
        values(df, c.parse_ymd("d", strict=True))
    assert values(df, c.ymd_month("d")) == [201702, 201702, None]
    one = df.limit(1)
    assert values(one, c.month_start(c.ymd_month("d"))) == [dt.date(2017, 2, 1)]
    assert values(one, c.days_between(c.parse_ymd("d"), c.date_literal("2017-03-01"))) == [1]
    assert values(one, c.days_between(c.date_literal("2017-03-01"), c.parse_ymd("d"))) == [-1]
    assert values(one, c.ymd_of(c.parse_ymd("d"))) == [20170228]


def test_days_between_counts_boundaries(spark):
    df = spark.sql("SELECT timestamp_ntz'2017-01-01 23:00:00' AS a, timestamp_ntz'2017-01-02 01:00:00' AS b")
    assert values(df, c.days_between("a", "b")) == [1]


def test_clip_zero_log_lift(spark):
    df = spark.createDataFrame([(7.0,), (0.0,), (None,)], "x double")
    assert values(df, c.clip_upper("x", 5)) == [5.0, 0.0, None]
    assert values(df, c.zero_to_null("x")) == [7.0, None, None]
    assert values(df, F.round(c.log1p("x"), 4)) == [2.0794, 0.0, None]
    assert values(df.limit(1), c.percent_lift("x", F.lit(3.5))) == [50.0]
    assert values(df, c.category_text("x"))[2] == "__missing__"


def test_window_filter_is_inclusive(spark):
    df = spark.createDataFrame([(20170131,), (20170201,), (20170228,), (20170301,)], "d int")
    assert df.where(c.in_ymd_window("d", (20170201, 20170228))).count() == 2
