"""Analyses from landed files to results."""

import datetime as dt
import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldbook.functions.geometry import ring_edges
from fieldbook.plans import charts, housing, payroll, permits, trees
from fieldbook.sources import fixed_width


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_charts_from_files(spark, tmp_path):
    head = "week\tcategory\tweekly_rank\tshow_title\tseason_title\tweekly_hours_viewed\truntime\tweekly_views\tcumulative_weeks_in_top_10\n"
    rows = [
        "2021-09-19\tTV (Non-English)\t1\tSquid\tSquid: Season 1\t63\t8.3\t\t1",
        "2021-09-26\tTV (Non-English)\t1\tSquid\tSquid: Season 2\t100\t8.3\t\t2",
        "2021-11-14\tFilms (English)\t1\tNotice\tN/A\t118\t1.975\t\t1",
        "2021-11-21\tFilms (English)\t2\tNotice\tN/A\t236\t1.975\t5\t2",
        "2022-01-02\tFilms (English)\t2\tNotice\tN/A\t50\t1.975\t5\t3",
    ]
    (tmp_path / "g.tsv").write_text(head + "\n".join(rows) + "\n")
    g = charts.read_global(spark, str(tmp_path / "g.tsv"))
    assert g.where("season_title is null").count() == 3
    assert charts.title_hours(g, "Squid").first()[0] == 163
    assert charts.views_in_year(g, "Notice", 2021).first()[0] == pytest.approx(354 / (118 / 60))
    assert bag(charts.longest_film(g, ["Films (English)", "Films (Non-English)"])) == [("Notice", 118.0, "Films (English)")] * 3
    assert bag(charts.best_week_per_category(g)) == [("Notice", 236, "Films (English)"), ("Squid", 100, "TV (Non-English)")]
    assert bag(charts.best_total_per_category(g)) == [("Films (English)", "Notice", 404), ("TV (Non-English)", "Squid", 163)]
    shown = charts.preview(g, [F.asc("week")], 2)
    assert shown.columns[-1] == "Runtime (minutes)" and "Season Title" not in shown.columns and shown.count() == 2


def country(spark, rows):
    return spark.createDataFrame(
        [(c, dt.date.fromisoformat(w), cat, r, t, s, n) for c, w, cat, r, t, s, n in rows],
        "country_name string, week date, category string, weekly_rank int, show_title string, season_title string, cumulative_weeks_in_top_10 int",
    )


def test_country_charts(spark):
    c = country(spark, [
        ("US", "2021-01-03", "Films", 4, "Climber", None, 1),
        ("US", "2021-01-10", "Films", 1, "Climber", None, 2),
        ("US", "2021-01-03", "Films", 1, "Starter", None, 1),
        ("US", "2021-01-10", "Films", 2, "Starter", None, 2),
        ("RU", "2021-01-03", "TV", 2, "Show", "S1", 1),
        ("RU", "2021-01-10", "TV", 1, "Show", "S1", 2),
        ("US", "2021-01-10", "TV", 3, "Show", "S1", 1),
        ("US", "2021-01-10", "TV", 4, "Show", "S2", 1),
    ])
    assert bag(charts.climbed_to_top(c, "US", "Films")) == [("Climber",)]
    assert bag(charts.debut_countries(c, "TV")) == [("Show", "S1", 2), ("Show", "S2", 1)]
    assert bag(charts.charting_weeks(c, "Show")) == [("RU", 2), ("US", 1)]
    assert bag(charts.longest_run_per_country(c, "Show", "TV")) == [("RU", 2), ("US", 1)]
    assert charts.countries(c).first()[0] == 2
    assert bag(charts.short_histories(c, 2)) == []
    assert charts.last_week(c, "RU").first().week == dt.date(2021, 1, 10)
    assert charts.first_and_last_week(c).count() == 8


def test_industry_hierarchy_from_page(spark):
    listed = {"51": "Information", "518": "Data hosting", "5182": "Data processing", "51821": "Hosting",
              "31-33": "Manufacturing", "311": "Food", "3111": "Animal food", "31111": "Animal food 5", "518210": "six"}
    body = "".join(f"<tr><td>{k}</td><td>NAICS {k} {v}</td></tr>" for k, v in listed.items())
    page = f"<table id='naics_titles'><tr><th>Code</th><th>Industry Title</th></tr>{body}</table>"
    pages = spark.createDataFrame([(1, page)], "page_id int, html string")
    tree = housing.industry_hierarchy(housing.industry_titles(housing.industry_listing(pages)))
    assert bag(tree) == [
        ("Information", "Data hosting", "Data processing", "Hosting", 51, 518, 5182, 51821),
        ("Manufacturing", "Food", "Animal food", "Animal food 5", 31, 311, 3111, 31111),
    ]


def test_wages_from_archives(spark, tmp_path):
    for year in (2019, 2021):
        with zipfile.ZipFile(tmp_path / f"{year}_annual_singlefile.zip", "w") as z:
            z.writestr("a.csv", "area_fips,industry_code,annual_avg_emplvl,total_annual_wages\n"
                       "C1018,52,10,1000\nC1018,31-33,10,1000\nC1018,10,99,9\nC1018,518210,1,1\n01001,52,5,5\nC3562,52,0,7\n")
    paths = str(tmp_path) + "/*.zip"
    wages = housing.read_wages(spark, paths, [2019, 2021])
    assert bag(wages.where("year = 2019")) == [
        (2019, "C1018", 52, 10, 1000.0, 100.0), (2019, "C3562", 52, 0, 7.0, None),
    ]
    with pytest.raises(ValueError, match="2018"):
        housing.read_wages(spark, paths, [2018, 2019])
    with pytest.raises(ValueError, match="2019_annual_singlefile.zip: only"):
        housing.read_wages(spark, paths, [2019, 2021], least_bytes=10_000)
    landed = str(tmp_path / "wages")
    first = bag(housing.wages_once(spark, landed, paths, [2019, 2021]))
    assert first == bag(wages) == bag(housing.wages_once(spark, landed, "nowhere/*.zip", [2019, 2021]))
    (tmp_path / "2022_annual_singlefile.zip").write_bytes(b"broken")
    with pytest.raises(ValueError, match="2022_annual_singlefile.zip"):
        housing.read_wages(spark, paths, [2019, 2021])
    (tmp_path / "2022_annual_singlefile.zip").unlink()
    areas = spark.createDataFrame([(1018, "here"), (None, "nowhere")], "cbsa int, label string")
    assert bag(housing.wages_with_area(wages, areas, 52, "cbsa"))[0] == (2019, 10, 1018.0, "here")
    assert bag(housing.last_year_leading(wages, "C1018", 52)) == [(2021, "C1018", 10)]
    assert housing.sector_share_peak(wages, "C1018", 52).count() == 2


def test_load_measure(spark, tmp_path):
    rows = [(1, "A", "rent", 5.0, 0.1, 2019), (1, "A", "income", 9.0, 0.1, 2019), (1, "A", "rent", 6.0, 0.1, 2021)]
    table = spark.createDataFrame(rows, "geoid long, name string, variable string, estimate double, moe double, year int")
    table.write.partitionBy("year").parquet(str(tmp_path / "t"))
    got = housing.load_measure(spark, str(tmp_path / "t"), "rent", [2021], "monthly_rent")
    assert [r.asDict() for r in got.collect()] == [{"geoid": 1, "name": "A", "monthly_rent": 6.0, "year": 2021}]


def test_permit_years_bind(spark, tmp_path):
    (tmp_path / "tb3u2018.txt").write_text("x\n" * 11 + "123 10740  area\n" + " " * 47 + "    77\n")
    (tmp_path / "msa_201999.csv").write_text("x\n" * 5 + "CSA,CBSA,Name,Total\n1,10740,A,88\n")
    old = fixed_width.permit_table(fixed_width.read_whole_files(spark, str(tmp_path / "tb3u2018.txt")))
    new = fixed_width.permit_sheet(fixed_width.read_whole_files(spark, str(tmp_path / "msa_201999.csv")), 2, 4)
    both = housing.permits(old, new)
    assert bag(both) == [(10740, 77, 2018), (10740, 88, 2019)]
    population = spark.createDataFrame([(10740, "A, NM Metro Area", 2018, 7.0), (10740, "A, NM Metro Area", 2019, 8.0)],
                                       "geoid long, name string, year int, population double")
    assert housing.permit_rate(both, population, "10740", [2018, 2019]).first()[0] == pytest.approx(11.0)
    assert bag(housing.peak_permit_year(both, population, "10740", 2018, 2459).select("year")) == [(2018,)]
    assert bag(housing.most_permits(both, population, 2010, 2019)) == [("A, NM Metro Area", 165)]


def test_unknown_area_makes_its_state_unknown(spark):
    frame = lambda rows, c: spark.createDataFrame(rows, f"geoid int, name string, year int, {c} double")
    names = {1: "P, NM", 2: "Q, NM", 3: "R, TX"}
    income = frame([(g, n, 2015, 10.0 * g) for g, n in names.items()], "household_income")
    households = frame([(g, n, 2015, 2.0) for g, n in names.items()], "households")
    population = frame([(1, "P, NM", 2015, 4.0), (3, "R, TX", 2015, 6.0)], "population")
    got = housing.state_income(income, households, population, 2015, n=2)
    assert bag(got) == sorted([("NM", None, 60.0, None), ("TX", 6.0, 60.0, 10.0)], key=str)


def test_trees_from_pages(spark, tmp_path):
    def page(name, features):
        (tmp_path / name).write_text(json.dumps({"type": "FeatureCollection", "features": features}))

    def feature(kind, coordinates, **properties):
        return {"type": "Feature", "properties": properties, "geometry": {"type": kind, "coordinates": coordinates}}

    page("trees0.json", [feature("Point", [0.005, 0.005], tpcondition="Dead", genusspecies="oak"),
                         feature("Point", [0.006, 0.005], tpcondition="Good", genusspecies="oak")])
    page("trees1.json", [feature("Point", [0.025, 0.005], tpcondition=None, genusspecies="elm"),
                         feature("Point", [5.0, 5.0], tpcondition="Poor", genusspecies="fir")])
    square = lambda a: [[[a, 0], [a + 0.01, 0], [a + 0.01, 0.01], [a, 0.01], [a, 0]]]
    page("districts.json", [feature("Polygon", square(0.0), district=1, area=2.0), feature("Polygon", square(0.02), district=26, area=0.5)])
    points = trees.read_trees(spark, str(tmp_path) + "/trees*.json")
    districts = trees.read_districts(spark, str(tmp_path) + "/districts.json")
    located = trees.with_district(points, districts)
    assert bag(located.select("genusspecies", "district")) == sorted([("oak", 1), ("oak", 1), ("elm", 26), ("fir", None)], key=str)
    assert bag(trees.per_district(located, 1)) == [(1, 2)]
    assert bag(trees.density(located, 1)) == sorted([(26, 0.5, 1, 2.0)], key=str)
    assert bag(trees.dead_fraction(located, 1)) == [(1, 2, 1, 0.5)]
    assert bag(trees.species_in(located, "Manhattan")) == [("oak", 2)]
    assert bag(trees.conditions_in(located, 26)) == [(None, 1)]
    assert trees.closest(located, 0.0, 0.0, 1).first().genusspecies == "oak"
    healthy, unhealthy = trees.split_by_health(points, districts, 26)
    assert (healthy.count(), unhealthy.count()) == (1, 0)


def test_payroll_from_pages(spark):
    from fieldbook.operators.reshape import MONTHS

    head = "".join(f"<th>{m}</th>" for m in ["Year", *MONTHS])
    row = "<tr><td>1979</td>" + "<td>88,808</td><td>89,055</td>" + "<td></td>" * 10 + "</tr>"
    levels_page = f"<table><tr><td>x</td></tr></table><table><tr>{head}</tr>{row}</table>"
    levels = payroll.levels_from_pages(spark.createDataFrame([(1, levels_page)], "page_id int, html string")).drop("page_id")
    assert bag(levels) == [(dt.date(1979, 1, 1), 88808.0), (dt.date(1979, 2, 1), 89055.0)]
    revisions_page = (
        "<table id='1979'><tr><th>Month</th><th>1st</th><th>3rd</th><th>Revision</th></tr>"
        "<tr><td>January</td><td>325</td><td>243</td><td>-82</td></tr><tr><td>Total</td><td></td><td></td><td></td></tr></table>"
        "<table id='notes'><tr><td>Jan</td></tr></table>"
    )
    revisions = payroll.revisions_from_pages(spark.createDataFrame([(1, revisions_page)], "page_id int, html string"))
    assert bag(revisions) == [(dt.date(1979, 1, 1), 325.0, 243.0, -82.0)]
    combined = payroll.combine(levels, revisions)
    assert [r.revision for r in payroll.newest_first(combined).collect()] == [None, -82.0]
    assert {r.metric: r.value for r in payroll.revision_shares(combined).collect()}["Proportion of Negative Revisions"] == 1.0
    assert {r.statistic: r.value for r in payroll.level_statistics(combined).collect()}["Median"] == pytest.approx(88931.5)


def test_periods_of_years(spark):
    df = spark.createDataFrame([(1999,), (2000,), (2019,), (2020,), (None,)], "y int")
    assert [r[0] for r in df.select(payroll.period("y")).collect()] == ["Pre-2000", "2000-2019", "2000-2019", "Post-2020", None]


def test_permits_from_files(spark, tmp_path):
    (tmp_path / "new.csv").write_text(
        "EventID,EventType,StartDateTime,EndDateTime,EnteredOn,ParkingHeld,Borough,CommunityBoard(s),PolicePrecinct(s),Country,ZipCode(s)\n"
        '1,Shooting Permit,1/3/2023 9:05:00 PM,01/04/2023 06:00:00 AM,1/1/2023 1:00:00 AM,st,Brooklyn,1,94,US,"11222, 11211"\n'
        '9,Load-in,1/3/2023 9:05:00 PM,01/04/2023 06:00:00 AM,1/1/2023 1:00:00 AM,st,Brooklyn,1,94,US,11222\n'
    )
    head = "eventid,eventtype,startdatetime,enddatetime,enteredon,parkingheld,borough,communityboard_s,policeprecinct_s,country,zipcode_s\n"
    (tmp_path / "mid.csv").write_text(
        head + '1,Shooting Permit,2023-01-03 21:05:00,2023-01-04 06:00:00,2023-01-01 01:00:00,st,Brooklyn,1,94,US,"11222, 11211"\n'
        "2,Shooting Permit,2022-01-03 21:05:00,2022-01-04 06:00:00,2022-01-01 01:00:00,st,Queens,1,94,US,11101\n"
    )
    (tmp_path / "old.csv").write_text(
        head.replace("parkingheld,", "").replace("zipcode_s\n", "zipcode_s,main,cross_st_1,cross_st_2\n")
        + "2,Shooting Permit,2022-01-03 21:05:00,2022-01-04 06:00:00,2022-01-01 01:00:00,Queens,1,94,US,11101,a,b,c\n"
        "3,Shooting Permit,2013-01-01 00:00:00,2013-01-02 00:00:00,2012-12-30 00:00:00,Queens,1,94,US,,a,b,c\n"
        "3,Shooting Permit,2013-01-01 00:00:00,2013-01-02 00:00:00,2012-12-30 00:00:00,Queens,1,94,US,99999,b,b,c\n"
        "4,Shooting Permit,2023-12-31 08:00:00,2024-01-02 00:00:00,2012-12-30 00:00:00,Queens,1,94,US,11101,a,b,c\n"
    )
    got = permits.clean_permits(
        permits.read_newest(spark, str(tmp_path / "new.csv")), permits.read_mid(spark, str(tmp_path / "mid.csv")),
        permits.read_oldest(spark, str(tmp_path / "old.csv")), ["main"],
    )
    assert got.columns[:8] == ["eventid", "eventtype", "start_year", "start_month", "start_day", "end_year", "end_month", "end_day"]
    assert bag(got.select("eventid", "start_year", "end_day", "borough", "zipcode", "zip_count_total")) == sorted([
        (1, 2023, 4, "Brooklyn", "11222", 1), (1, 2023, 4, "Brooklyn", "11211", 1),
        (2, 2022, 4, "Queens", "11101", 1), (3, 2013, 2, "Queens", None, 1),
    ], key=str)


def test_permit_analyses(spark):
    counts = {2013: (5, 20), 2014: (6, 30), 2015: (9, 25), 2016: (4, 35), 2020: (50, 1)}
    data = [(y, "Brooklyn", "11222") for y, (a, _) in counts.items() for _ in range(a)]
    data += [(y, "Manhattan", f"100{i % 12:02d}") for y, (_, b) in counts.items() for i in range(b)]
    df = spark.createDataFrame(data, "start_year int, borough string, zipcode string")
    r = permits.zip_against_borough(df).first()
    want = np.corrcoef([5, 6, 9, 4], [20, 30, 25, 35])[0, 1]
    assert r.n == 4 and r.correlation == pytest.approx(want, abs=5e-4) and 0 < r.p_value < 1
    assert permits.distinct_zipcodes(df).first()[0] == 13
    assert permits.per_year(df).first().total_permits == 25
    assert permits.per_borough(df).first().borough == "Manhattan"
    named = permits.named_hotspots(df)
    assert named.where("start_year = 2020").count() == 0
    assert named.where("zipcode = '11222'").first().neighborhood == "Greenpoint, Brooklyn"
    hot = permits.hotspots(df, 3)
    assert hot.where("start_year = 2013 and rank = 1").first().zipcode == "11222"
    assert {r.zipcode: r.mean_growth for r in permits.zip_growth(df).collect()}["11222"] == pytest.approx(
        (6 / 5 + 9 / 6 + 4 / 9 + 50 / 4 - 4) / 4
    )


def test_zip_deciles(spark):
    data = [(f"z{i:02d}",) for i in range(1, 12) for _ in range(i)]
    got = permits.zip_deciles(spark.createDataFrame(data, "zipcode string")).orderBy("category_number").collect()
    assert [r.category_number for r in got] == list(range(1, 11))
    assert (got[0].total_productions, got[0].num_zip_codes) == (3, 2)
    assert sum(r.total_productions for r in got) == 66


def test_ring_closes_itself():
    assert ring_edges([(0, 0), (1, 0), (0, 1)]) == ring_edges([(0, 0), (1, 0), (0, 1), (0, 0)])
