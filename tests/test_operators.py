import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldbook.functions import numbers
from fieldbook.functions.geometry import EDGES_TYPE, ring_edges
from fieldbook.operators import groups, joins, periods, quantiles, ranking, reshape, sets, spatial, stats


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def bag(df):
    return sorted(rows(df), key=str)


# --- joins ---


def test_natural_full_join_matches_null(spark):
    left = spark.createDataFrame([(1, "x"), (None, "y")], "k int, a string")
    right = spark.createDataFrame([(1, "p"), (None, "q")], "k int, b string")
    for how in ({}, {"right_unique": True}, {"spread": True}):
        got = joins.natural_full_join(left, right, **how).select("k", "a", "b")
        assert bag(got) == sorted([(1, "x", "p"), (None, "y", "q")], key=str)


def test_natural_full_join_multiplies_copies_and_keeps_the_rest(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (3, "w")], "k int, r string")
    got = joins.natural_full_join(left, right).select("k", "l", "r")
    want = [(1, "a", "x"), (1, "a", "y"), (1, "b", "x"), (1, "b", "y"), (2, "c", None), (3, None, "w"), (3, None, "z")]
    assert bag(got) == sorted(want, key=str)


def test_natural_full_joins_over_drifting_schemas(spark):
    a = spark.createDataFrame([(1, "z1")], "id int, z string")
    b = spark.createDataFrame([(1, "z1", "e"), (2, "z2", "f")], "id int, z string, extra string")
    c = spark.createDataFrame([(2, "m"), (3, "n")], "id int, main string")
    got = joins.natural_full_join(joins.natural_full_join(a, b), c).select("id", "z", "extra", "main")
    assert bag(got) == sorted([(1, "z1", "e", None), (2, "z2", "f", "m"), (3, None, None, "n")], key=str)
    with pytest.raises(ValueError):
        joins.natural_full_join(a, c.withColumn("id", F.col("id").cast("long")))


def test_natural_full_join_against_brute_force(spark):
    rng = random.Random(5)
    pick = lambda: rng.choice([None, 1, 2, 3, 4, 5, 6])
    # A third of the left rows are copies of one key.
    l = [(7, 7, i) for i in range(40)] + [(pick(), pick(), 100 + i) for i in range(80)]
    r = [(pick(), pick(), i) for i in range(60)] + [(7, 7, 500)]
    left = spark.createDataFrame(l, "a int, b int, x int")
    right = spark.createDataFrame(r, "a int, b int, y int")
    want = [(*p[:2], p[2], q[2]) for p in l for q in r if p[:2] == q[:2]]
    want += [(*p, None) for p in l if not any(p[:2] == q[:2] for q in r)]
    want += [(*q[:2], None, q[2]) for q in r if not any(p[:2] == q[:2] for p in l)]
    for spread in (False, True):
        assert bag(joins.natural_full_join(left, right, spread=spread).select("a", "b", "x", "y")) == sorted(want, key=str)


def test_positions_against_brute_force(spark):
    rng = random.Random(8)
    data = [(rng.choice([1, 2, None]), rng.choice([5, 5, 5, 5, 7, None]), f"{k:04d}" if k % 50 else None) for k in range(600)]
    df = spark.createDataFrame(data, "y int, n int, z string")
    for ascending in (False, True):
        got = ranking.with_position(df, ["y"], "n", "z", "rank", ascending, ranges=8).collect()
        assert len(got) == 600
        for y in (1, 2, None):
            rows = sorted((r for r in got if r.y == y), key=lambda r: r["rank"])
            assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
            order = [(r.n is None, (r.n or 0) * (1 if ascending else -1), r.z is None, r.z or "") for r in rows]
            assert order == sorted(order)


def test_group_sizes_from_one_evaluation(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("a"), (F.col("id") % 10).alias("b"), "id")
    sizes = {"n": ["a", "b"], "n_a": ["a"]}
    assert bag(groups.with_group_sizes(df, ["a", "b"], sizes, once=True)) == bag(groups.with_group_sizes(df, ["a", "b"], sizes))


def test_suffix_join_and_lookup(spark):
    left = spark.createDataFrame([(1, "A"), (2, "B")], "geoid int, name string")
    right = spark.createDataFrame([(1, "a")], "area int, name string")
    got = joins.suffix_join(left, right, [("geoid", "area")], ("_income", "_rent"))
    assert got.columns == ["geoid", "name_income", "name_rent"]
    assert rows(got, "geoid") == [(1, "A", "a"), (2, "B", None)]
    named = joins.lookup(left, "geoid", {"1": "one"}, "title")
    assert rows(named.select("geoid", "title"), "geoid") == [(1, "one"), (2, None)]
    with pytest.raises(ValueError):
        joins.equi_join(left, right, [("geoid", "area")])


# --- ranking ---


def test_top_n_ties_and_nulls(spark):
    df = spark.createDataFrame([(5,), (5,), (4,), (None,)], "x int")
    assert bag(ranking.top_n(df, "x", 1)) == [(5,), (5,)]
    assert bag(ranking.top_n(df, "x", 3)) == [(4,), (5,), (5,)]
    assert len(rows(ranking.top_n(df, "x", 4))) == 4
    assert bag(ranking.bottom_n(df, "x", 1)) == [(4,)]
    assert rows(ranking.top_n(df.where("x > 9"), "x", 2)) == []


def test_top_n_per_group_against_brute_force(spark):
    rng = random.Random(3)
    data = [("hot", rng.randint(0, 9)) for _ in range(200)] + [
        (rng.choice(["a", "b", None]), rng.choice([None, 1, 2, 3])) for _ in range(60)
    ]
    df = spark.createDataFrame(data, "g string, x int")
    for n in (1, 2, 5):
        want = []
        for g in {g for g, _ in data}:
            known = sorted((x for k, x in data if k == g and x is not None), reverse=True)
            cut = known[n - 1] if len(known) >= n else None
            whole = [(g, x) for k, x in data if k == g]
            # With one value wanted and none known the group stays as it is.
            want += [p for p in whole if cut is None or (p[1] is not None and p[1] >= cut)]
        assert bag(ranking.top_n_per_group(df, ["g"], "x", n)) == sorted(want, key=str)


def test_first_rows(spark):
    df = spark.createDataFrame([("e1", 2, "late"), ("e1", 1, "early"), ("e2", 1, "only")], "k string, pos int, v string")
    assert bag(ranking.first_per_key(df, ["k"], ["pos"])) == [("e1", 1, "early"), ("e2", 1, "only")]
    totals = spark.createDataFrame([("c", "t2", 9), ("c", "t1", 9), ("d", "t3", 1)], "c string, t string, h int")
    assert bag(ranking.top_one_per_group(totals, ["c"], "h", ["t"])) == [("c", "t1", 9), ("d", "t3", 1)]


def test_extremes_and_latest(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "w int")
    assert bag(ranking.at_extremes(df, "w")) == [(1,), (1,), (3,)]
    assert rows(ranking.latest(df, "w", [], 2)) == [(3,), (2,)]


# --- group values ---


def test_first_value_takes_earliest_day_then_smallest_rank(spark):
    day = lambda n: dt.date(1969, 12, 30) + dt.timedelta(days=n)
    data = [("a", day(2), 1), ("a", day(1), 3), ("a", day(1), 2), ("b", day(5), 7), (None, day(0), 4)]
    df = spark.createDataFrame(data, "t string, week date, rank int")
    got = groups.with_first_value(df, ["t"], "week", "rank", "first_week", "first_rank")
    assert bag(got.select("t", "rank", "first_week", "first_rank")) == sorted([
        ("a", 1, day(1), 2), ("a", 3, day(1), 2), ("a", 2, day(1), 2), ("b", 7, day(5), 7), (None, 4, day(0), 4),
    ], key=str)


def test_first_value_of_other_types(spark):
    day = lambda n: dt.date(2024, 1, n)
    for kind, values in (("long", [3_000_000_000, 5]), ("double", [0.5, 0.25])):
        df = spark.createDataFrame([("a", day(1), values[0]), ("a", day(2), values[1])], f"t string, week date, v {kind}")
        got = groups.with_first_value(df, ["t"], "week", "v", "first_week", "first_v")
        assert {(r.first_week, r.first_v) for r in got.collect()} == {(day(1), values[0])}
        with pytest.raises(Exception, match="32 bits"):
            df.groupBy("t").agg(groups.first_of_group("week", "v", "fw", "fv")["fv"]).collect()
    for kind in ("int", "long"):
        df = spark.createDataFrame([("a", day(1), None), ("a", day(2), 4), ("b", None, 1)], f"t string, week date, v {kind}")
        got = groups.with_first_value(df, ["t"], "week", "v", "first_week", "first_v")
        assert {(r.t, r.first_week, r.first_v) for r in got.collect()} == {("a", day(1), None), ("b", None, None)}


def test_top_n_ranked(spark):
    df = spark.createDataFrame([(0.1,), (0.3,), (0.3,), (None,), (-1.0,)], "x double")
    assert bag(ranking.top_n_ranked(df, "x", 2)) == bag(ranking.top_n(df, "x", 2)) == [(0.3,), (0.3,)]
    assert len(bag(ranking.top_n_ranked(df, "x", 5))) == len(bag(ranking.top_n(df, "x", 5))) == 5


def test_group_sizes(spark):
    df = spark.createDataFrame([("z", 1, 1), ("z", 1, 2), ("z", 2, 1), (None, 1, 1)], "zip string, y int, m int")
    got = groups.with_group_sizes(df, ["zip", "y", "m"], {"total": ["zip"], "year": ["zip", "y"], "month": ["zip", "y", "m"]})
    assert bag(got) == sorted([("z", 1, 1, 3, 2, 1), ("z", 1, 2, 3, 2, 1), ("z", 2, 1, 3, 1, 1), (None, 1, 1, 1, 1, 1)], key=str)


# --- quantiles and bins ---


def distributions():
    rng = np.random.default_rng(1)
    hot = np.concatenate([np.full(30_000, 7.25), rng.normal(size=30_000)])
    return {
        "smooth": rng.normal(size=40_000),
        "heavy tail": np.exp(rng.normal(scale=8, size=40_000)),
        "third equal": hot,
        "few values": rng.integers(0, 3, size=5_000).astype(float),
        "one": np.array([4.0]),
        "two": np.array([1.0, 2.0]),
        "infinite ends": np.array([-np.inf, 1.0, 2.0, np.inf]),
    }


@pytest.mark.parametrize("name", list(distributions()))
def test_exact_quantiles(spark, name):
    values = distributions()[name]
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(7)
    probs = [0.25, 0.5, 0.9] if name == "infinite ends" else [0.0, 0.1, 0.25, 0.5, 0.999, 1.0]
    probs = [0.5] if name == "infinite ends" else probs
    got = quantiles.exact_quantiles(df, "x", probs).first()[0]
    np.testing.assert_allclose(got, np.quantile(values, probs), rtol=1e-12, atol=1e-12)


def test_exact_quantiles_per_group_with_few_slices(spark, monkeypatch):
    """Digits that tell little only cost time: the result stays exact."""
    rng = random.Random(2)
    data = [(g, rng.gauss(0, 1)) for g in ["hot"] * 3000 + ["a", "b", None] * 50] + [("a", None), ("none", None)]
    df = spark.createDataFrame(data, "g string, x double")
    monkeypatch.setattr(quantiles, "SLICES", 2)
    got = {r.g: r.q for r in quantiles.exact_quantiles(df, "x", [0.1, 0.5, 0.9], ["g"], "q").collect()}
    assert set(got) == {"hot", "a", "b", None}
    for g, q in got.items():
        want = np.quantile([x for k, x in data if k == g and x is not None], [0.1, 0.5, 0.9])
        np.testing.assert_allclose(q, want, rtol=1e-12)


def test_digits_never_fall(spark):
    rng = random.Random(3)
    values = [rng.choice([-1, 1]) * 10 ** rng.uniform(-320, 308) for _ in range(2000)] + [0.0, 5e-324, -5e-324, 1.0, 2.0, 4.0, 2.0**52 - 1, 2.0**52]
    values += [math.nextafter(2.0**k, side) for k in range(-1000, 1000, 37) for side in (0, math.inf)] + [math.inf, -math.inf, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    digits = [r.d for r in df.select("x", quantiles.exponent(F.col("x")).alias("d")).orderBy("x").collect()]
    assert digits == sorted(digits) and len(set(digits)) > 1000
    low, high = F.lit(-3.7), F.lit(11.3)
    places = [r.d for r in spark.range(5000).select(((F.col("id") * 0.003) - 3.7).alias("x")).select("x", quantiles.slice_of(F.col("x"), low, high).alias("d")).orderBy("x").collect()]
    assert places == sorted(places) and places[0] == 0 and places[-1] < quantiles.SLICES


def test_bins(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 12)], "x int")
    got = quantiles.with_quantile_bin(df, "x", 10, "Decile", "category").orderBy("x").collect()
    assert [r.category_number for r in got] == [1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    assert got[-1].category == "Decile 10"
    same = spark.createDataFrame([(3,)] * 5, "x int")
    with pytest.raises(Exception, match="duplicate breaks"):
        quantiles.with_quantile_bin(same, "x", 10, "Decile", "category").collect()


# --- reshape ---


def test_split_to_rows_keeps_null(spark):
    df = spark.createDataFrame([("10001, 10002,10003",), (None,)], "z string")
    assert bag(reshape.split_to_rows(df, "z")) == [("10001",), ("10002",), ("10003",), (None,)]


def test_header_helpers(spark):
    df = spark.createDataFrame([("1", "2.9", 3)], "AB_code string, x_code string, depth_1 int")
    assert reshape.lower_names(df).columns == ["ab_code", "x_code", "depth_1"]
    assert reshape.format_titles(df).columns == ["Ab Code", "X Code", "Depth 1"]
    assert reshape.drop_prefixed(df, "depth").columns == ["AB_code", "x_code"]
    assert reshape.relocate(df, "depth_1").columns == ["depth_1", "AB_code", "x_code"]
    assert rows(reshape.ints_where_named(df, "code")) == [(1, 2, 3)]


def test_long_and_wide(spark):
    df = spark.createDataFrame([("p", "Up"), ("p", "Up"), ("q", "Down")], "k string, d string")
    assert rows(reshape.counts_wide(df, ["k"], "d", ["Up", "Down"]), "k") == [("p", 2, 0), ("q", 0, 1)]
    one = spark.createDataFrame([(1.0, 2)], "mean double, n int")
    assert rows(reshape.to_long(one, {"mean": "Mean", "n": "Rows"}, "statistic", "value")) == [("Mean", 1.0), ("Rows", 2.0)]
    label = reshape.bin_label("x", [(1, 10, "low"), (11, 18, "mid")], "Other")
    nums = spark.createDataFrame([(10,), (11,), (99,), (None,)], "x int")
    assert [r[0] for r in nums.select(label).collect()] == ["low", "mid", "Other", "Other"]


def test_report(spark):
    df = spark.createDataFrame([("a", 0.12345, 1234567.0), ("b", 0.5, 2.0)], "the_name string, share double, total double")
    shown = {"share": numbers.percent_text("share"), "total": numbers.grouped_text("total")}
    got = reshape.report(df, 1, [F.desc("total")], shown)
    assert got.columns == ["The Name", "Share", "Total"]
    assert rows(got) == [("a", "12.35%", "1,234,567")] or rows(got) == [("a", "12.34%", "1,234,567")]


# --- sets ---


def test_unions_and_completeness(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "y")], "x int, y string")
    assert bag(sets.bind_rows(a, b)) == [(1, None), (2, "y")]
    with pytest.raises(ValueError):
        sets.bind_same(a, b)
    found = spark.createDataFrame([(2009,), (2011,)], "year int")
    assert rows(sets.missing_keys(found, "year", range(2009, 2012))) == [(2010,)]
    with pytest.raises(ValueError, match="2010"):
        sets.require_complete(found, "year", range(2009, 2012))
    assert sets.require_complete(found, "year", [2009, 2011]) is found
    assert sets.years(2018, 2022, [2020]) == [2018, 2019, 2021, 2022]
    nulls = spark.createDataFrame([(1,), (None,), (1,)], "x int")
    assert rows(sets.count_groups(nulls, "x", "n")) == [(2,)]


# --- periods ---


def test_overlap_with_previous_present_period(spark):
    df = spark.createDataFrame([(2019, "a"), (2019, "b"), (2021, "b"), (2021, "c")], "y int, z string")
    assert rows(periods.overlap_with_previous(df, "y", "z", 10)) == [(2021, 1, 1, 10.0)]
    ragged = spark.createDataFrame([(y, z) for y in range(5) for z in "abcdef"[: y + 1]] + [(4, None), (3, None)], "y int, z string")
    sizes = {r.y: r.n for r in ragged.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    for r in periods.overlap_with_previous(ragged, "y", "z", 10).collect():
        assert r.overlap + r.new_entries == sizes[r.y]


def test_growth_and_change(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", 4, 10), ("b", 1, 5)], "k string, y int, n int")
    assert rows(periods.mean_growth(df, "k", "y", "n"), "k") == [("a", 0.25), ("b", None)]
    months = spark.createDataFrame([(1, 10.0), (2, 13.0), (3, 12.0), (4, 20.0)], "m int, v double")
    assert rows(periods.absolute_change(months, "m", "v", "change", "large").select("change", "large"), "m") == [
        (None, None), (3.0, False), (1.0, False), (8.0, True),
    ]


# --- statistics ---


def test_line(spark):
    df = spark.createDataFrame([(2.0, 1.0), (3.0, 2.0), (5.0, 3.0), (4.0, 5.0)], "x double, y double")
    line = stats.ols_line(df, "y", "x").first()
    assert (line.slope, line.intercept) == (pytest.approx(0.9), pytest.approx(-0.4))
    assert line.correlation == pytest.approx(0.68034, abs=1e-5)
    assert line.r_squared == pytest.approx(0.462857, abs=1e-6)
    assert line.p_value == pytest.approx(0.31966, abs=1e-5)
    fitted = stats.with_fitted_line(df, "y", "x").agg(F.sum("residual")).first()[0]
    assert fitted == pytest.approx(0, abs=1e-9)


def test_welch(spark):
    a, b = [3.0, 4.0, 1.0, 2.1], [490.2, 340.0, 433.9]
    df = spark.createDataFrame([(v, True) for v in a] + [(v, False) for v in b] + [(None, True), (5.0, None)], "v double, g boolean")
    t = stats.welch_t(df, "v", F.col("g")).first()
    assert t.statistic == pytest.approx(-9.5589, abs=1e-3)
    assert t.t_df == pytest.approx(2.0009, abs=1e-3)
    assert t.p_value == pytest.approx(0.01075, abs=1e-4)
    assert t.lower_ci < t.estimate < t.upper_ci
    assert t.estimate == pytest.approx(np.mean(a) - np.mean(b))
    one = stats.welch_t(df, "v", F.col("g"), "greater").first()
    assert one.p_value == pytest.approx(1 - t.p_value / 2)
    assert one.upper_ci == float("inf") and one.lower_ci > t.lower_ci


def test_difference_in_proportions(spark):
    df = spark.createDataFrame([(True, True), (False, True), (True, False), (None, False)], "r boolean, g boolean")
    assert stats.diff_in_props(df, F.col("r"), F.col("g")).first()[0] == -0.5


# --- space ---


def polygons(spark):
    notch = ring_edges([(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2)])
    hole = ring_edges([(10, 10), (20, 10), (20, 20), (10, 20)]) + ring_edges([(13, 13), (17, 13), (17, 17), (13, 17)])
    square = ring_edges([(2, 0), (4, 0), (4, 1), (2, 1)])
    return spark.createDataFrame([(1, notch), (2, hole), (3, square)], f"district int, edges {EDGES_TYPE}")


def test_join_polygons(spark):
    points = [(0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5), (3.0, 0.5), (15.0, 15.0), (11.0, 15.0), (2.0, 0.5), (50.0, 1.0)]
    df = spark.createDataFrame([*points, (None, 1.0)], "x double, y double")
    want = [(0.5, 0.5, 1), (1.5, 0.5, 1), (1.5, 1.5, None), (0.5, 1.5, 1), (3.0, 0.5, 3), (15.0, 15.0, None),
            (11.0, 15.0, 2), (2.0, 0.5, 1), (2.0, 0.5, 3), (50.0, 1.0, None), (None, 1.0, None)]
    for size in (0.25, 1.0, 7.0, 100.0):
        assert bag(spatial.join_polygons(df, polygons(spark), "x", "y", size)) == sorted(want, key=str)
        # A boundary point of two polygons appears once in the semi join.
        assert spatial.points_within(df, polygons(spark), "x", "y", size).count() == 6


def test_grid_join_equals_brute_force(spark):
    rng = random.Random(4)
    points = [(rng.uniform(-1, 22), rng.uniform(-1, 22)) for _ in range(2000)] + [(0.5, 0.5)] * 1000
    df = spark.createDataFrame(points, "x double, y double")
    located = spatial.join_polygons(df, polygons(spark), "x", "y", 0.7)
    assert located.count() == len(points)

    def inside(x, y, edges):
        return sum((e.y1 > y) != (e.y2 > y) and x < e.x1 + (y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) for e in edges) % 2

    shapes = polygons(spark).collect()
    want = {d.district: sum(inside(x, y, d.edges) for x, y in points) for d in shapes}
    got = {r.district: r["count"] for r in located.groupBy("district").count().collect() if r.district}
    assert got == want


def test_nearest(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, -1.0), (0.0, 2.0), (None, 0.0)], "lon double, lat double")
    got = spatial.nearest(df, "lon", "lat", 0.0, 0.0, 1)
    assert bag(got.select("lat")) == [(-1.0,), (1.0,)]


def test_nearest_box_keeps_every_near_point(spark):
    """Against all distances: near poles and the date line, with coordinates named in other ways, nulls and ties."""
    rng = random.Random(9)
    points = [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(3000)]
    points += [(x + 360, y) for x, y in points[:300]] + [(x, 180 - y) for x, y in points[300:400]] + [(541.0, 10.0), (None, 3.0), (2.0, None)]
    df = spark.createDataFrame(points, "lon double, lat double").repartition(4)
    for to_lon, to_lat in ((0.0, 0.0), (179.9, 12.0), (-179.9, -45.0), (10.0, 89.5), (200.0, -89.9), (-70.0, 41.0)):
        every = df.withColumn("distance", spatial.great_circle_m("lon", "lat", to_lon, to_lat))
        want = bag(ranking.bottom_n(every, "distance", 7))
        for sample in (7, 1000):
            assert bag(spatial.nearest(df, "lon", "lat", to_lon, to_lat, 7, sample=sample)) == want
    # Fewer located points than asked for: all rows, as without a box.
    few = spark.createDataFrame([(0.0, 1.0), (None, 0.0)], "lon double, lat double")
    assert spatial.nearest(few, "lon", "lat", 0.0, 0.0, 3).count() == 2


def test_nearest_box_reaches_the_scan(spark, tmp_path):
    spark.range(5000).selectExpr("(id % 360) - 180.0 as lon", "(id % 171) - 85.0 as lat", "id").write.parquet(str(tmp_path / "p"))
    plan = spatial.nearest(spark.read.parquet(str(tmp_path / "p")), "lon", "lat", 0.0, 0.0, 5)._jdf.queryExecution().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert pushed and all("lat" in line and "lon" in line for line in pushed)
