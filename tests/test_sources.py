import datetime as dt
import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from fieldbook import schemas
from fieldbook.plans import permits
from fieldbook.session import shared_folder
from fieldbook.sources import archives, delimited, fixed_width, geojson, html_tables, materialise


def write(path, text):
    path.write_text(text)
    return str(path)


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_tsv_null_marker(spark, tmp_path):
    p = write(tmp_path / "c.tsv", "week\ttitle\n2021-07-04\tN/A\n2021-07-11\tx\n")
    schema = "week date, title string"
    assert set(bag(delimited.read_tsv(spark, p, schema, "N/A"))) == {
        (dt.date(2021, 7, 4), None), (dt.date(2021, 7, 11), "x"),
    }
    assert (dt.date(2021, 7, 4), "N/A") in bag(delimited.read_tsv(spark, p, schema))


def test_csv_gzip_tidy_and_bad_rows(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write("EventID,ZipCode(s)\n1,\"10001, 10002\"\nbad,x\n")
    got = delimited.read_csv_tidy(spark, str(tmp_path / "a.csv.gz"), "`EventID` int, `ZipCode(s)` string")
    assert got.columns == ["EventID", "ZipCode_s"]
    assert bag(got) == sorted([(1, "10001, 10002"), (None, "x")], key=str)


def test_year_slices_from_names_and_folders(spark, tmp_path):
    for year in (2009, 2010):
        write(tmp_path / f"housing_{year}.csv", f"x\n{year % 100}\n")
    df = delimited.read_csv(spark, str(tmp_path) + "/housing_*.csv", "x int")
    assert set(bag(delimited.with_slice_year(df))) == {(9, 2009), (10, 2010)}
    root = str(tmp_path / "table")
    delimited.write_parquet(spark.range(2019, 2023).select("id", F.col("id").cast("int").alias("year")), root, ["year"])
    plain = str(tmp_path / "plain")
    delimited.write_parquet(spark.range(2), plain)
    assert spark.read.parquet(plain).count() == 2
    got = delimited.read_year_folders(spark, root, "id long", [2019, 2021])
    assert bag(got) == [(2019, 2019), (2021, 2021)]
    assert "PartitionFilters: [year" in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("gz", [False, True])
def test_csv_sink(spark, tmp_path, gz):
    out = str(tmp_path / "out")
    delimited.write_csv(spark.createDataFrame([(1, "a")], "x int, y string"), out, gzip=gz)
    assert bag(delimited.read_csv(spark, out, "x int, y string")) == [(1, "a")]
    assert any(p.name.endswith(".csv.gz") == gz for p in (tmp_path / "out").glob("part-*"))


def test_read_through_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "t")
    assert materialise.read_through(spark, path, build).count() == 3
    assert materialise.read_through(spark, path, build).count() == 3
    assert len(calls) == 1
    # A table without its success marker was not finished and is built anew.
    (tmp_path / "t" / "_SUCCESS").unlink()
    materialise.read_through(spark, path, build)
    assert len(calls) == 2


def test_landed_tables_follow_their_inputs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.csv", "x\n1\n2\n")
    calls = []

    def build():
        calls.append(1)
        return delimited.read_csv(spark, str(tmp_path / "in"), "x int").repartition(2)

    def read():
        return bag(materialise.read_through(spark, path, build, str(tmp_path / "in" / "*.csv")))

    path = str(tmp_path / "t")
    assert read() == read() == [(1,), (2,)] and len(calls) == 1
    noted = materialise.manifest(spark, path)
    assert noted["rows"] == 2 and noted["inputs"]["files"] == 1 and noted["table"]["files"] >= 1
    # A further input, a changed one, and a part file that was lost: each makes the table anew.
    write(tmp_path / "in" / "b.csv", "x\n3\n")
    assert read() == [(1,), (2,), (3,)] and len(calls) == 2
    write(tmp_path / "in" / "b.csv", "x\n3\n4\n")
    assert read() == [(1,), (2,), (3,), (4,)] and len(calls) == 3
    next((tmp_path / "t").glob("part-*")).unlink()
    assert read() == [(1,), (2,), (3,), (4,)] and len(calls) == 4
    # Inputs that are gone leave the table as it is; an empty table lands too.
    for name in ("a.csv", "b.csv"):
        (tmp_path / "in" / name).unlink()
    assert len(read()) == 4 and len(calls) == 4
    materialise.land(spark, str(tmp_path / "e"), spark.createDataFrame([], "x int"))
    assert materialise.manifest(spark, str(tmp_path / "e"))["rows"] == 0


def test_keep_uses_the_checkpoint_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(materialise, "shared_folder", lambda _: str(tmp_path))
    kept = materialise.keep(spark.range(5).withColumn("x", F.col("id") * 2))
    assert kept.where("x = 8").count() == 1
    assert len(list(tmp_path.glob("kept-*"))) == 1


def test_checkpoint_folder_of_the_cluster_wins():
    class Stub:
        def __init__(self, named, master):
            self.named, self.master, self.conf, self.sparkContext, self.used = named, master, self, self, None

        def get(self, key, default):
            return self.named if key == "spark.checkpoint.dir" else default

        def getCheckpointDir(self):
            return self.used

        def setCheckpointDir(self, path):
            self.used = path

    assert shared_folder(Stub("hdfs:///shared", "yarn")) == "hdfs:///shared"
    local = Stub(None, "local[8]")
    assert shared_folder(local) == local.used == shared_folder(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Stub(None, "yarn"))


def listing(codes, counts):
    body = "".join(f"123 {c:<6}  area\n" for c in codes) + "".join(" " * 47 + f"{n:>6}\n" for n in counts)
    return "note 1\n" * 11 + body


def test_fixed_width_listing(spark, tmp_path):
    write(tmp_path / "tb3u2009.txt", listing([10180, 10420], [325, 7]))
    write(tmp_path / "tb3u2010.txt", listing([10180], [12]))
    got = fixed_width.permit_table(fixed_width.read_whole_files(spark, str(tmp_path)))
    assert bag(got) == [(10180, 12, 2010), (10180, 325, 2009), (10420, 7, 2009)]
    write(tmp_path / "tb3u2011.txt", listing([10180, 1], [12]))
    with pytest.raises(Exception, match="differ in number"):
        fixed_width.permit_table(fixed_width.read_whole_files(spark, str(tmp_path))).collect()


def test_sheet(spark, tmp_path):
    text = "t\n\n\n\n\nCSA,CBSA,Name,Total\n999,10180,Abilene,558\n,10420,Akron,9\n104,10580,Albany,3.0\n"
    write(tmp_path / "msaannual_2019.csv", text)
    got = fixed_width.permit_sheet(fixed_width.read_whole_files(spark, str(tmp_path)), 2, 4)
    assert bag(got) == [(10180, 558, 2019), (10580, 3, 2019)]


def test_sheet_with_quoted_names_by_header(spark, tmp_path):
    text = "t\n\n\n\n\nCSA,CBSA,Name,Total\n1,10740,\"Albuquerque, NM\",88\n2,10750,\"The \"\"B\"\"\",7\n3,10760,\"\",9\n"
    write(tmp_path / "msaannual_2020.csv", text)
    files = fixed_width.read_whole_files(spark, str(tmp_path))
    assert bag(fixed_width.permit_sheet(files)) == [(10740, 88, 2020), (10750, 7, 2020)]
    names = fixed_width.sheet_table(files, 5, {"name": "Name"}, F.lit(1)).select("name")
    assert bag(names) == [("Albuquerque, NM",), ('The "B"',)]
    with pytest.raises(Exception, match="no column Units"):
        fixed_width.permit_sheet(files, "CBSA", "Units").collect()


def test_columns_by_header_name(spark, tmp_path):
    schema = "country string, week date, rank int"
    write(tmp_path / "a.tsv", "Category\tweek\trank\tcountry\nTV\t2024-01-07\t1\tUS\n")
    assert delimited.read_tsv(spark, str(tmp_path / "a.tsv"), schema).columns == ["country", "week", "rank"]
    assert bag(delimited.read_tsv(spark, str(tmp_path / "a.tsv"), schema)) == [("US", dt.date(2024, 1, 7), 1)]
    assert bag(delimited.read_tsv(spark, str(tmp_path / "a.tsv"), schema, extra=True)) == [("US", dt.date(2024, 1, 7), 1, "TV")]
    with pytest.raises(ValueError, match="season"):
        delimited.read_tsv(spark, str(tmp_path / "a.tsv"), schema + ", season string")
    # A second file of another column order is read by its own header.
    write(tmp_path / "b.tsv", "country\tCategory\tweek\trank\nUS\tTV\t2024-01-07\t1\n")
    both = delimited.read_tsv(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")], schema)
    assert bag(both) == [("US", dt.date(2024, 1, 7), 1)] * 2


def test_files_of_unlike_column_order_in_one_call(spark, tmp_path):
    write(tmp_path / "a.csv", "x,y,z\n1,a,p\n")
    write(tmp_path / "b.csv", "\ufeffy,x\nb,2\n")
    with gzip.open(tmp_path / "c.csv.gz", "wt") as f:
        f.write('"y",more,x\nc,m,bad\nd,m,4\n')
    write(tmp_path / "empty.csv", "")
    folder = str(tmp_path)
    assert set(delimited.headers(spark, folder)) == {("x", "y", "z"), ("y", "x"), ("y", "more", "x")}
    assert bag(delimited.read_csv(spark, folder, "x int, y string")) == sorted([(1, "a"), (2, "b"), (None, "c"), (4, "d")], key=str)
    wide = delimited.read_csv(spark, folder, "x int", extra=True)
    assert set(wide.columns) == {"x", "y", "z", "more"} and wide.where("z is null and more is null").count() == 1
    with pytest.warns(UserWarning, match="c.csv.gz: 1 lines"):
        delimited.read_csv(spark, folder, "x int, y string", warn=True)
    counts = delimited.count_malformed(spark, folder, "x int").collect()
    assert [(r.file.rsplit("/", 1)[1], r.lines) for r in counts] == [("c.csv.gz", 1)]
    with pytest.raises(ValueError, match="z"):
        delimited.read_csv(spark, folder, "x int, z string")
    with pytest.raises(ValueError, match="no header"):
        delimited.read_csv(spark, str(tmp_path / "empty.csv"), "x int")


def test_cut_off_gzip_and_malformed_cells(spark, tmp_path):
    whole = gzip.compress("".join(["x,y\n", *(f"{k},{k * 7919 % 100003}\n" for k in range(100_000))]).encode())
    (tmp_path / "cut.csv.gz").write_bytes(whole[:len(whole) // 2])
    with pytest.raises(Exception, match="(?i)unexpected end|EOF"):
        delimited.read_csv(spark, str(tmp_path / "cut.csv.gz"), "x int, y int").collect()
    write(tmp_path / "bad.csv", "x,y\n1,2\nz,3\n4\n")
    assert sorted(r.line for r in delimited.malformed(spark, str(tmp_path / "bad.csv"), "x int, y int").collect()) == ["4", "z,3"]


def test_newest_permits_keep_their_further_columns(spark, tmp_path):
    header = "EventID,EventType,StartDateTime,EndDateTime,EnteredOn,EventAgency,ParkingHeld,Borough,CommunityBoard(s),PolicePrecinct(s),Category,SubCategoryName,Country,ZipCode(s)"
    write(tmp_path / "p.csv", header + "\n1,Shooting Permit,a,b,c,Office,d,Queens,1,2,Television,Cable,US,\"11101, 11102\"\n")
    got = permits.read_newest(spark, str(tmp_path / "p.csv")).first()
    assert (got.Country, got.ZipCode_s, got.Category, got.EventAgency) == ("US", "11101, 11102", "Television", "Office")


def test_pairing_pads_the_shorter_list(spark):
    df = spark.createDataFrame([("f", [1, 2], ["a"])], "path string, n array<int>, s array<string>")
    got = fixed_width.pair_by_position(df, F.col("n"), F.col("s"), ("x", "y")).select("path", "position", "x", "y")
    assert bag(got) == [("f", 1, 1, "a"), ("f", 2, 2, None)]


def test_zip_archives(spark, tmp_path):
    for year, value in ((2009, "5"), (2010, "6")):
        with zipfile.ZipFile(tmp_path / f"{year}_annual.zip", "w") as z:
            z.writestr(f"{year}.csv", f"extra,area_fips,code\nq,C1018,{value}\nq,01000,\n")
            z.writestr("readme.txt", "no table")
    (tmp_path / "2011_annual.zip").write_bytes(b"broken")
    with pytest.raises(Exception, match="2011_annual.zip"):
        archives.read_zipped_csv(spark, str(tmp_path) + "/*.zip", ["area_fips"]).collect()
    assert [r.path.split("/")[-1] for r in archives.broken(spark, str(tmp_path) + "/*.zip").collect()] == ["2011_annual.zip"]
    df = archives.read_zipped_csv(spark, str(tmp_path) + "/*.zip", ["area_fips", "code"], skip_broken=True)
    year = F.regexp_extract("path", r"(\d{4})_annual", 1)
    assert bag(df.select(year, "area_fips", "code")) == sorted(
        [("2009", "C1018", "5"), ("2009", "01000", None), ("2010", "C1018", "6"), ("2010", "01000", None)], key=str
    )
    small = archives.undersized(spark, str(tmp_path) + "/*.zip", 10).collect()
    assert [r.path.split("/")[-1] for r in small] == ["2011_annual.zip"]


def test_archive_beyond_four_gigabytes(spark, tmp_path):
    """A sparse archive of 5 GiB: its directory and its one table are all that is read."""
    large = tmp_path / "2020_annual.zip"
    with open(large, "wb") as file:
        file.truncate(5 << 30)
    with zipfile.ZipFile(large, "a", zipfile.ZIP_DEFLATED) as z:
        z.writestr("2020.csv", "area_fips,code\n" + "".join(f"C{k},{k}\n" for k in range(50_000)))
    df = archives.read_zipped_csv(spark, str(large), ["area_fips", "code"])
    assert df.agg(F.count("*"), F.max(F.col("code").cast("int"))).first()[:2] == (50_000, 49_999)
    assert archives.broken(spark, str(large)).count() == 0


def test_faults_come_beside_the_rows(spark, tmp_path):
    for year in (2009, 2010):
        with zipfile.ZipFile(tmp_path / f"{year}.zip", "w") as z:
            z.writestr(f"{year}.csv", "area_fips\n" + f"C{year}\n" * 3)
    whole = (tmp_path / "2010.zip").read_bytes()
    (tmp_path / "2010.zip").write_bytes(whole.replace(b"C2010\nC2010", b"C2010\nX2010", 1))
    (tmp_path / "2011.zip").write_bytes(b"broken")
    rows = archives.read_zipped_csv(spark, str(tmp_path) + "/*.zip", ["area_fips"], fault="fault").collect()
    assert [r.area_fips for r in rows if r.path.endswith("2009.zip")] == ["C2009"] * 3
    faults = {r.path.split("/")[-1]: r.fault for r in rows if r.fault}
    assert sorted(faults) == ["2010.zip", "2011.zip"] and "CRC" in faults["2010.zip"]
    assert all(r.area_fips is None for r in rows if r.fault)
    assert sorted(r.path.split("/")[-1] for r in archives.broken(spark, str(tmp_path) + "/*.zip").collect()) == ["2010.zip", "2011.zip"]


PAGE = """<html><body><table><tr><td>other</td></tr></table>
<TABLE id="naics_titles"><thead><tr><th>Code</th><th>Industry&nbsp;Title</th></tr></thead>
<tbody><tr><td>5182</td><td>NAICS 5182 <b>Data</b>
 processing</td></tr><tr><td colspan=2>wide</td></tr><tr><td rowspan="2">r</td><td>1</td></tr><tr><td>2</td></tr></tbody></TABLE>
</body></html>"""


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>none</p>"), (3, None)], "page_id long, html string")
    rows = html_tables.html_rows(pages, "page_id", "html")
    got = [(r.table_id, r.row_idx, r.is_header, r.cells) for r in rows.where("table_idx = 2").orderBy("row_idx").collect()]
    assert got == [
        ("naics_titles", 1, True, ["Code", "Industry Title"]),
        ("naics_titles", 2, False, ["5182", "NAICS 5182 Data processing"]),
        ("naics_titles", 3, False, ["wide", "wide"]),
        ("naics_titles", 4, False, ["r", "1"]),
        ("naics_titles", 5, False, ["r", "2"]),
    ]
    named = html_tables.table_columns(rows, F.col("table_id") == "naics_titles", ["page_id"], ["code", "title", "more"])
    assert bag(named)[0] == (1, "5182", "NAICS 5182 Data processing", None)


def test_nested_html_tables(spark):
    page = "<table><tr><td>a<table><tr><td>in</td></tr></table></td><td>b</td></tr></table>"
    rows = html_tables.html_rows(spark.createDataFrame([(1, page)], "id int, html string"), "id", "html")
    assert [(r.table_idx, r.cells) for r in rows.orderBy("table_idx").collect()] == [(1, ["a", "b"]), (2, ["in"])]


def feature(kind, coordinates, **properties):
    return {"type": "Feature", "properties": properties, "geometry": {"type": kind, "coordinates": coordinates}}


def test_geojson_pages(spark, tmp_path):
    square = [[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    hole = [[0.5, 0.5], [1.5, 0.5], [1.5, 1.5], [0.5, 1.5], [0.5, 0.5]]
    pages = [
        [feature("Point", [-73.9, 40.7], tpcondition="Good"), feature("Point", [-74, 40], tpcondition=None)],
        [feature("Polygon", [square, hole], district=1), feature("MultiPolygon", [[square], [hole]], district=2)],
    ]
    for i, features in enumerate(pages):
        write(tmp_path / f"p{i}.json", json.dumps({"type": "FeatureCollection", "features": features}))
    found = geojson.read_features(spark, str(tmp_path), "tpcondition: string, district: int")
    points = geojson.as_points(found).select("tpcondition", "lon", "lat")
    assert bag(points) == sorted([("Good", -73.9, 40.7), (None, -74.0, 40.0)], key=str)
    shapes = {r.district: r.edges for r in geojson.as_polygons(found).collect()}
    assert len(shapes[1]) == len(shapes[2]) == 8
    assert tuple(shapes[1][0]) == (0.0, 0.0, 2.0, 0.0)


def test_schemas_parse(spark):
    from pyspark.sql.types import StructType

    for name in dir(schemas):
        if name.isupper():
            assert StructType.fromDDL(getattr(schemas, name)).fields
