import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fieldbook.functions import dates, nulls, numbers, student_t, text
from fieldbook.functions.geometry import EDGES_TYPE, great_circle_m, in_polygon, ring_edges


def one(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("Good",), ("Dead",), (None,)], "c string")
    assert [r.c for r in df.where(nulls.not_in("c", ["Poor", "Critical", "Dead"])).collect()] == ["Good", None]


def test_sums(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("b", None), ("c", None)], "g string, x int")
    rows = df.groupBy("g").agg(
        nulls.strict_sum("x").alias("s"), nulls.sum_or_zero("x").alias("z"),
        nulls.strict_max("x").alias("hi"), nulls.strict_min("x").alias("lo"), nulls.strict_mean("x").alias("m"),
    ).orderBy("g").collect()
    assert [tuple(r) for r in rows] == [("a", 3, 3, 2, 1, 1.5), ("b", None, 3, None, None, None), ("c", None, 0, None, None, None)]


def test_n_distinct_counts_null(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert df.agg(nulls.n_distinct("x")).first()[0] == 3
    assert df.where("x is not null").agg(nulls.n_distinct("x")).first()[0] == 2
    assert df.where("x > 9").agg(nulls.n_distinct("x")).first()[0] == 0


def test_if_else_and_marker(spark):
    df = spark.createDataFrame([(2021,), (2022,), (None,)], "y int")
    assert one(df, nulls.if_else(F.col("y") == 2021, F.lit("fix"), F.lit("as is"))) == ["fix", "as is", None]
    df = spark.createDataFrame([("N/A",), ("x",), (None,)], "c string")
    assert one(df, nulls.blank_to_null("c", "N/A")) == [None, "x", None]


def test_round_half_to_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,)], "x double")
    assert one(df, numbers.round_even("x")) == [0.0, 2.0, 2.0]


def test_text_to_numbers(spark):
    df = spark.createDataFrame([(" 3.7 ",), ("12",), ("x",), (None,)], "t string")
    assert one(df, numbers.text_to_int("t")) == [3, 12, None, None]
    assert one(df, numbers.text_to_double("t")) == [3.7, 12.0, None, None]


def test_ratio_and_percent_flags(spark):
    df = spark.createDataFrame([(0.0, 5.0), (0.0, 0.0), (10.0, 6.0), (10.0, -2.0), (None, 1.0)], "o double, r double")
    assert one(df, numbers.ratio("r", "o")) == [None, None, 0.6, -0.2, None]
    assert one(df, numbers.exceeds_percent("r", "o", 50)) == [True, None, True, False, None]


def test_text_comparison_against_number(spark):
    df = spark.createDataFrame([("11222",), ("N/A",)], "zip string")
    assert [r.zip for r in df.where(F.col("zip") == "11222").collect()] == ["11222"]


def test_remove_first(spark):
    df = spark.createDataFrame([("C1018",), ("12C-3",), ("77",), (None,)], "c string")
    assert one(df, text.remove_first("c", "[^0-9]")) == ["1018", "12-3", "77", None]
    df = spark.createDataFrame([("NAICS 52 Title 52", "52"), ("none", "9")], "t string, c string")
    assert one(df, text.remove_first_text("t", "c")) == ["NAICS  Title 52", "none"]


def test_text_helpers(spark):
    df = spark.createDataFrame([("Dallas, TX Metro Area",), ("Nowhere",)], "n string")
    assert one(df, text.state_code("n")) == ["TX", None]
    df = spark.createDataFrame([("\t a b \n",)], "n string")
    assert one(df, text.trim_space("n")) == ["a b"]
    assert one(spark.createDataFrame([("1,234,5",)], "n string"), text.remove_all("n", ",")) == ["12345"]
    assert text.title_case_name("weekly_hours_viewed") == "Weekly Hours Viewed"
    assert text.tidy_name("ZipCode(s)") == "ZipCode_s"


def test_dates(spark):
    df = spark.createDataFrame([("1/3/2023 9:05:00 PM",), ("01/31/2023 09:05:00 PM",), ("1/3/2023 21:05:00",), ("bad",)], "t string")
    assert one(df, dates.parse_mdy_hms("t")) == [
        dt.datetime(2023, 1, 3, 21, 5), dt.datetime(2023, 1, 31, 21, 5), dt.datetime(2023, 1, 3, 21, 5), None,
    ]
    # A local time that a daylight-saving zone skips.
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = spark.createDataFrame([("3/12/2023 2:30:00 AM",)], "t string")
        assert one(gap, dates.parse_mdy_hms("t")) == [dt.datetime(2023, 3, 12, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    df = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2023, 12, 31),)], "d date")
    assert one(df, dates.year_week_label("d")) == ["2023-52", "2023-52"]
    assert one(df, dates.week_start("d")) == [dt.date(2022, 12, 26), dt.date(2023, 12, 25)]
    df = spark.createDataFrame([(1979, "Jan"), (1980, "x")], "y int, m string")
    assert one(df, dates.parse_year_month("y", "m")) == [dt.date(1979, 1, 1), None]


def test_range_ends_at_midnight(spark):
    rows = [(dt.datetime(2023, 12, 31, 0, 0),), (dt.datetime(2023, 12, 31, 8, 0),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    assert [r.t for r in df.where(dates.between_midnights("t", "2013-01-01", "2023-12-31")).collect()] == [rows[0][0]]


def test_polygon_with_notch_and_boundary(spark):
    edges = ring_edges([(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2)])
    points = [(0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5), (3.0, 0.5), (2.0, 0.5), (1.0, 1.0), (0.0, 0.0)]
    df = spark.createDataFrame([(x, y, edges) for x, y in points], f"x double, y double, e {EDGES_TYPE}")
    assert one(df, in_polygon("x", "y", "e")) == [True, True, False, True, False, True, True, True]


def test_great_circle(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 0.0)], "lon double, lat double")
    far, same = one(df, great_circle_m("lon", "lat", 0.0, 0.0))
    assert far == pytest.approx(111195.1, abs=0.1) and same == 0.0


def test_student_t(spark):
    def at(fn, *pairs):
        df = spark.createDataFrame([(float(x), float(n)) for x, n in pairs], "x double, n double")
        return [r[0] for r in df.select(fn("x", "n")).collect()]

    # Known points of the distribution.
    assert at(student_t.t_quantile, (0.975, 7), (0.975, 1), (0.025, 7), (0.5, 3)) == [
        pytest.approx(2.364624, abs=1e-6), pytest.approx(12.7062047, abs=1e-6), pytest.approx(-2.364624, abs=1e-6), 0.0,
    ]
    assert at(student_t.t_two_sided, (1.959963985, 1e7)) == [pytest.approx(0.05, abs=1e-6)]
    assert at(student_t.t_upper_tail, (-1.0, 1)) == [pytest.approx(0.75)]
    # r = -0.213 over 9 years: p = 0.58, as published to two places.
    r = -0.213
    assert at(student_t.t_two_sided, (abs(r) * (7 / (1 - r * r)) ** 0.5, 7)) == [pytest.approx(0.582, abs=1e-3)]


def test_student_t_against_closed_forms(spark):
    """Tails for 1, 2 and 4 degrees and those of the normal distribution, and back by the quantile."""
    tails = {
        1.0: lambda t: 0.5 - math.atan(t) / math.pi,
        2.0: lambda t: 0.5 - t / (2 * math.sqrt(2 + t * t)),
        4.0: lambda t: 0.5 - 3 / 8 * (t / math.sqrt(1 + t * t / 4)) * (1 - t * t / (12 * (1 + t * t / 4))),
        1e8: lambda t: math.erfc(t / math.sqrt(2)) / 2,
    }
    points = [(t, n) for n in tails for t in (0.0, 1e-3, 0.4, 1.0, 1.22, 1.3, 2.0, 5.0, -0.7, -3.0)]
    df = spark.createDataFrame(points, "t double, n double")
    for r in df.select("t", "n", student_t.t_upper_tail("t", "n").alias("p"), student_t.t_two_sided("t", "n").alias("both")).collect():
        want = tails[r.n](r.t)
        assert r.p == pytest.approx(want, rel=1e-6 if r.n > 4 else 1e-9, abs=1e-12) and r.both == pytest.approx(2 * min(r.p, 1 - r.p))
    back = df.where("abs(t) < 4").withColumn("p", 1 - student_t.t_upper_tail("t", "n")).select("t", student_t.t_quantile("p", "n").alias("q"))
    assert all(r.q == pytest.approx(r.t, rel=1e-6, abs=1e-7) for r in back.collect())
    none = spark.createDataFrame([(None, 3.0), (1.0, None), (1.0, 0.0)], "t double, n double")
    assert [r[0] for r in none.select(student_t.t_two_sided("t", "n")).collect()] == [None] * 3
    far = spark.createDataFrame([(float("inf"), 3.0)], "t double, n double")
    assert far.select(student_t.t_two_sided("t", "n")).first()[0] == 0.0
