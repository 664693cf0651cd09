"""The analyses' inputs, derived from the test tables, in Spark and in SQL.

Each function returns a frame in the schema of ``fieldbook.schemas``; the constant beside it
is the same relation for the SQL side. Money is summed in whole cents to keep sums exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldbook.catalog.registry import Tables
from fieldbook.functions.geometry import EDGES_TYPE, ring_edges
from fieldbook.functions.text import trim_space
from fieldbook.operators.reshape import MONTHS, split_to_rows


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("long")


# --- charts ---------------------------------------------------------------------------

GLOBAL_CHART = """
SELECT CAST(l_shipdate AS DATE) AS week, p_type AS category, l_linenumber AS weekly_rank,
       p_name AS show_title, nullif(p_brand, 'Brand#1') AS season_title,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS weekly_hours_viewed,
       l_quantity / 8 AS runtime,
       CASE WHEN l_returnflag <> 'N' THEN CAST(l_quantity AS BIGINT) * 1000 END AS weekly_views,
       p_size AS cumulative_weeks_in_top_10
FROM lineitem JOIN part ON l_partkey = p_partkey"""


def global_chart(t: Tables) -> DataFrame:
    """Raw worldwide chart: the season marker 'N/A' is still in it."""
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_shipdate").cast("date").alias("week"),
        F.col("p_type").alias("category"),
        F.col("l_linenumber").alias("weekly_rank"),
        F.col("p_name").alias("show_title"),
        F.when(F.col("p_brand") == "Brand#1", "N/A").otherwise(F.col("p_brand")).alias("season_title"),
        cents("l_extendedprice").alias("weekly_hours_viewed"),
        (F.col("l_quantity") / 8).alias("runtime"),
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity").cast("long") * 1000).alias("weekly_views"),
        F.col("p_size").alias("cumulative_weeks_in_top_10"),
    )


COUNTRY_CHART = """
SELECT n_name AS country_name, CAST(o_orderdate AS DATE) AS week,
       CASE WHEN o_orderstatus = 'F' THEN 'Films' ELSE 'TV' END AS category,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS weekly_rank,
       concat('Title ', right(c_name, 2)) AS show_title,
       nullif(c_mktsegment, 'MACHINERY') AS season_title,
       CAST(floor(o_totalprice / 5000) AS INTEGER) AS cumulative_weeks_in_top_10, o_orderkey
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def _orders_of_nations(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )


def country_chart(t: Tables) -> DataFrame:
    return _orders_of_nations(t).select(
        F.col("n_name").alias("country_name"),
        F.col("o_orderdate").cast("date").alias("week"),
        F.when(F.col("o_orderstatus") == "F", "Films").otherwise("TV").alias("category"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("weekly_rank"),
        F.concat(F.lit("Title "), F.right("c_name", F.lit(2))).alias("show_title"),
        F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("season_title"),
        F.floor(F.col("o_totalprice") / 5000).cast("int").alias("cumulative_weeks_in_top_10"),
        "o_orderkey",
    )


# --- housing --------------------------------------------------------------------------

AREA_WIDE = """
SELECT c_custkey AS geoid,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN concat('Area ', c_custkey)
            ELSE concat('Area ', c_custkey, ', ', substr(c_mktsegment, 1, 2), ' Metro Area') END AS name,
       CAST(year(o_orderdate) AS INTEGER) AS year, c_nationkey, c_mktsegment,
       max(o_totalprice) AS household_income, min(o_totalprice) AS monthly_rent,
       count(*) * 1000.0 AS population, count(DISTINCT o_orderpriority) * 100.0 AS households
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY ALL"""

_KNOWN = "NOT (c_mktsegment = 'MACHINERY' AND c_nationkey = 0)"

AREA_VIEWS = {
    "area_wide": AREA_WIDE,
    "income": "SELECT geoid, name, year, household_income FROM area_wide",
    "rent": "SELECT geoid, name, year, monthly_rent FROM area_wide",
    "households": "SELECT geoid, name, year, CAST(households AS DOUBLE) AS households FROM area_wide",
    "population": "SELECT geoid, name, year, CAST(population AS DOUBLE) AS population FROM area_wide WHERE " + _KNOWN,
}
MEASURES = ["household_income", "monthly_rent", "population", "households"]


def area_measures(t: Tables) -> DataFrame:
    """Long statistics table; the population of some areas of one state is missing."""
    segment = F.col("c_mktsegment")
    name = F.concat(F.lit("Area "), F.col("c_custkey").cast("string"))
    wide = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(
            F.col("c_custkey").alias("geoid"),
            F.when(segment == "HOUSEHOLD", name).otherwise(
                F.concat(name, F.lit(", "), F.substring(segment, 1, 2), F.lit(" Metro Area"))
            ).alias("name"),
            F.year("o_orderdate").alias("year"),
            (~((segment == "MACHINERY") & (F.col("c_nationkey") == 0))).alias("known"),
        )
        .agg(
            F.max("o_totalprice").alias("household_income"),
            F.min("o_totalprice").alias("monthly_rent"),
            (F.count(F.lit(1)) * F.lit(1000.0)).alias("population"),
            (F.count_distinct("o_orderpriority") * F.lit(100.0)).alias("households"),
        )
    )
    long = wide.unpivot(["geoid", "name", "year", "known"], MEASURES, "variable", "estimate")
    return (
        long.where((F.col("variable") != "population") | F.col("known"))
        .withColumn("moe", F.lit(0.0)).select("geoid", "name", "variable", "estimate", "moe", "year")
    )


AREA_PERMITS = """
SELECT o_custkey AS cbsa, CAST(sum(CAST(floor(o_totalprice / 1000) AS INTEGER)) AS INTEGER) AS new_housing_units_permitted,
       CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders GROUP BY ALL"""


def area_permits(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_custkey").alias("cbsa"), F.year("o_orderdate").alias("year")).agg(
        F.sum(F.floor(F.col("o_totalprice") / 1000)).cast("int").alias("new_housing_units_permitted")
    ).select("cbsa", "new_housing_units_permitted", "year")


INDUSTRY_LISTING = """
SELECT DISTINCT code, concat('NAICS ', code, ' Group of ', code) AS industry_title
FROM (SELECT substr(full_code, 1, k) AS code
      FROM (SELECT concat(CAST(CAST(substr(p_brand, 7) AS INTEGER) + 50 AS VARCHAR),
                          lpad(CAST(p_size AS VARCHAR), 2, '0'), CAST(length(p_type) AS VARCHAR), '0') AS full_code FROM part),
           (SELECT unnest([2, 3, 4, 5, 6]) AS k))"""


def industry_listing(t: Tables) -> DataFrame:
    full = F.concat(
        (F.substring("p_brand", 7, 10).cast("int") + 50).cast("string"),
        F.lpad(F.col("p_size").cast("string"), 2, "0"),
        F.length("p_type").cast("string"),
        F.lit("0"),
    )
    codes = t.part.select(full.alias("full")).distinct().select(
        F.explode(F.array(*[F.substring("full", 1, k) for k in (2, 3, 4, 5, 6)])).alias("code")
    ).distinct()
    return codes.withColumn(
        "industry_title", F.concat(F.lit("NAICS "), F.col("code"), F.lit(" Group of "), F.col("code"))
    )


WAGES_RAW = """
SELECT CASE WHEN s_nationkey = 24 THEN 'US000' ELSE concat('C', CAST(1000 + s_nationkey AS VARCHAR)) END AS area_fips,
       CASE WHEN p_size BETWEEN 31 AND 33 THEN '31-33' WHEN p_size = 1 THEN '10' WHEN p_size = 2 THEN '518210'
            ELSE CAST(p_size + 50 AS VARCHAR) END AS industry_code,
       CAST(CAST(sum(l_quantity) AS BIGINT) AS VARCHAR) AS annual_avg_emplvl,
       CAST(CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS VARCHAR) AS total_annual_wages,
       CAST(year(l_shipdate) AS INTEGER) AS year
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
GROUP BY ALL"""

WAGES = """
SELECT year, fips, industry, employment, total_wages, total_wages / nullif(employment, 0) AS avg_wage
FROM (SELECT year, area_fips AS fips, CAST(industry_code AS INTEGER) AS industry,
             CAST(annual_avg_emplvl AS INTEGER) AS employment, CAST(total_annual_wages AS DOUBLE) AS total_wages
      FROM wages_raw
      WHERE length(industry_code) <= 5 AND area_fips LIKE 'C%' AND industry_code NOT LIKE '%-%')
WHERE industry <> 10"""

WAGE_VIEWS = {"wages_raw": WAGES_RAW, "wages": WAGES}


def wages_raw(t: Tables) -> DataFrame:
    size = F.col("p_size")
    code = (
        F.when(size.between(31, 33), "31-33").when(size == 1, "10").when(size == 2, "518210")
        .otherwise((size + 50).cast("string"))
    )
    area = F.when(F.col("s_nationkey") == 24, "US000").otherwise(
        F.concat(F.lit("C"), (F.col("s_nationkey") + 1000).cast("string"))
    )
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(
        t.supplier, F.col("l_suppkey") == F.col("s_suppkey")
    )
    return rows.groupBy(
        area.alias("area_fips"), code.alias("industry_code"), F.year("l_shipdate").alias("year")
    ).agg(
        F.sum("l_quantity").cast("long").cast("string").alias("annual_avg_emplvl"),
        F.sum(cents("l_extendedprice")).cast("string").alias("total_annual_wages"),
    )


# --- trees ----------------------------------------------------------------------------

TREES = """
SELECT CASE label WHEN 1 THEN 'Fair' WHEN 2 THEN 'Poor' WHEN 3 THEN 'Critical' WHEN 4 THEN 'Dead'
                  WHEN 5 THEN NULL ELSE 'Good' END AS tpcondition,
       concat('species ', CAST(label AS VARCHAR)) AS genusspecies,
       CAST(embedding[1] AS DOUBLE) AS lon, CAST(embedding[2] AS DOUBLE) AS lat, vec_id
FROM embeddings"""


def trees(t: Tables) -> DataFrame:
    label = F.col("label")
    return t.embeddings.select(
        F.when(label == 1, "Fair").when(label == 2, "Poor").when(label == 3, "Critical").when(label == 4, "Dead")
        .when(label == 5, F.lit(None)).otherwise("Good").alias("tpcondition"),
        F.concat(F.lit("species "), label.cast("string")).alias("genusspecies"),
        F.col("embedding")[0].cast("double").alias("lon"),
        F.col("embedding")[1].cast("double").alias("lat"),
        "vec_id",
    )


# Districts of the unit square of the test points: number, area and rings. The third is not
# convex, the fourth has a hole, the last two share an edge.
DISTRICT_RINGS = [
    (3, 0.0225, [[(-0.15, -0.15), (0.0, -0.15), (0.0, 0.0), (-0.15, 0.0)]]),
    (7, 0.01, [[(0.05, 0.05), (0.25, 0.05), (0.15, 0.15)]]),
    (12, 0.03, [[(0.0, -0.2), (0.2, -0.2), (0.2, -0.1), (0.1, -0.1), (0.1, 0.0), (0.0, 0.0)]]),
    (26, 0.05, [
        [(-0.25, 0.0), (0.0, 0.0), (0.0, 0.25), (-0.25, 0.25)],
        [(-0.15, 0.05), (-0.05, 0.05), (-0.05, 0.15), (-0.15, 0.15)],
    ]),
    (50, 0.02, [[(0.0, 0.0), (0.05, 0.0), (0.05, 0.3), (0.0, 0.3)]]),
]
DISTRICT_CELL = 0.05


def districts(t: Tables) -> DataFrame:
    rows = [(n, area, [e for ring in rings for e in ring_edges(ring)]) for n, area, rings in DISTRICT_RINGS]
    return t.spark.createDataFrame(rows, f"district int, area double, edges {EDGES_TYPE}")


def _edge_values(scale_x: float = 1.0, scale_y: float = 1.0) -> str:
    rows = [
        f"({n}, {area}, {x1 * scale_x!r}, {y1 * scale_y!r}, {x2 * scale_x!r}, {y2 * scale_y!r})"
        for n, area, rings in DISTRICT_RINGS
        for ring in rings
        for x1, y1, x2, y2 in ring_edges(ring)
    ]
    return (
        "SELECT district, CAST(area AS DOUBLE) AS area, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, "
        "CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2 FROM (VALUES " + ", ".join(rows)
        + ") v(district, area, x1, y1, x2, y2)"
    )


INSIDE = """
SELECT vec_id, district, area FROM (
  SELECT vec_id, district, area,
         sum(CASE WHEN (y1 > lat) <> (y2 > lat) AND lon < x1 + (lat - y1) * (x2 - x1) / nullif(y2 - y1, 0)
                  THEN 1 ELSE 0 END) AS crossings,
         bool_or((x2 - x1) * (lat - y1) - (y2 - y1) * (lon - x1) = 0
                 AND lon BETWEEN least(x1, x2) AND greatest(x1, x2)
                 AND lat BETWEEN least(y1, y2) AND greatest(y1, y2)) AS touches
  FROM trees, edges GROUP BY vec_id, district, area)
WHERE crossings % 2 = 1 OR touches"""

TREE_VIEWS = {
    "trees": TREES,
    "edges": _edge_values(),
    "inside": INSIDE,
    "located": "SELECT trees.*, district, area FROM trees LEFT JOIN inside USING (vec_id)",
}


# --- payroll --------------------------------------------------------------------------

LEVELS = """
SELECT CAST(o_orderdate AS DATE) AS date, sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 100 AS level
FROM orders GROUP BY 1"""

REVISIONS = """
SELECT date, original, final, final - original AS revision FROM (
  SELECT CAST(o_orderdate AS DATE) AS date,
         sum(CASE WHEN o_orderstatus = 'O' THEN CAST(round(o_totalprice) AS BIGINT) END)::DOUBLE AS original,
         sum(CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice) AS BIGINT) END)::DOUBLE AS final
  FROM orders GROUP BY 1)
WHERE original IS NOT NULL AND final IS NOT NULL"""

PAYROLL_VIEWS = {
    "levels": LEVELS,
    "revisions": REVISIONS,
    "combined": "SELECT levels.*, original, final, revision FROM levels LEFT JOIN revisions USING (date)",
}


def levels(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        (F.sum(cents("o_totalprice")) / 100).alias("level")
    )


def revisions(t: Tables) -> DataFrame:
    def of(status: str) -> Column:
        whole = F.round("o_totalprice").cast("long")
        return F.sum(F.when(F.col("o_orderstatus") == status, whole)).cast("double")

    return (
        t.orders.groupBy(F.col("o_orderdate").cast("date").alias("date"))
        .agg(of("O").alias("original"), of("F").alias("final"))
        .na.drop("any").withColumn("revision", F.col("final") - F.col("original"))
    )


def month_matrix(t: Tables, *keys: str) -> DataFrame:
    """Year x month matrix of order values as texts with thousands commas."""
    rows = t.orders if not keys else _orders_of_nations(t)
    month, whole = F.month("o_orderdate"), F.round("o_totalprice").cast("long")
    return rows.groupBy(*keys, F.year("o_orderdate").alias("year")).agg(
        *[F.format_number(F.sum(F.when(month == i, whole)), 0).alias(name) for i, name in enumerate(MONTHS, 1)]
    )


def matrix_pages(t: Tables) -> DataFrame:
    """One page per nation with a notice table and the year x month matrix as second table."""
    def row(tag: str, cells: list[Column]) -> Column:
        return F.concat(F.lit("<tr>"), *[
            F.concat(F.lit(f"<{tag}>"), F.coalesce(c, F.lit("")), F.lit(f"</{tag}>")) for c in cells
        ], F.lit("</tr>"))

    header = row("th", [F.lit("Year"), *[F.lit(m) for m in MONTHS]])
    lines = month_matrix(t, "c_nationkey").select(
        "c_nationkey", "year", row("td", [F.col("year").cast("string"), *[F.col(m) for m in MONTHS]]).alias("line")
    )
    # One line per calendar year and page.
    bodies = lines.groupBy("c_nationkey").agg(F.sort_array(F.collect_list(F.struct("year", "line"))).alias("rows"))
    return bodies.select(
        F.col("c_nationkey").alias("page_id"),
        F.concat(
            F.lit("<html><body><table><tr><td>Notice</td></tr></table><p>Series</p><table id=\"series\"><thead>"),
            header, F.lit("</thead><tbody>"),
            F.array_join(F.transform("rows", lambda r: r["line"]), ""),
            F.lit("</tbody></table></body></html>"),
        ).alias("html"),
    )


# --- permits --------------------------------------------------------------------------

PERMIT_BASE = """
SELECT o_orderkey AS eventid,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'Load-in' ELSE 'Shooting Permit' END AS eventtype,
       o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR AS startdatetime,
       o_orderdate + (24 * (1 + o_custkey % 5) + o_orderkey % 24) * INTERVAL 1 HOUR AS enddatetime,
       o_orderdate - INTERVAL 72 HOUR AS enteredon, o_orderpriority AS parkingheld, c_mktsegment AS borough,
       CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderstatus END AS communityboards,
       c_mktsegment AS policeprecincts, n_name AS country,
       CASE WHEN o_totalprice < 5000 THEN NULL
            WHEN o_orderstatus = 'F' THEN CAST(10000 + o_custkey % 120 AS VARCHAR)
            WHEN o_orderstatus = 'O' THEN concat(CAST(10000 + o_custkey % 120 AS VARCHAR), ', ', CAST(10000 + o_orderkey % 150 AS VARCHAR))
            ELSE concat(CAST(10000 + o_orderkey % 150 AS VARCHAR), ',', CAST(10000 + o_custkey % 120 AS VARCHAR), ',   ',
                        CAST(10000 + o_custkey % 7 AS VARCHAR)) END AS zipcodes,
       o_orderdate
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

_SHARED = ["eventid", "eventtype", "startdatetime", "enddatetime", "enteredon", "borough", "communityboards",
           "policeprecincts", "country", "zipcodes"]


def _full_join(left: str, right: str, keys: list[str]) -> str:
    columns = ", ".join(f"coalesce(a.{k}, b.{k}) AS {k}" for k in keys)
    match = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in keys)
    return f"SELECT {columns} FROM {left} a FULL JOIN {right} b ON {match}"


def _wanted(source: str) -> str:
    return (
        f"SELECT * FROM ({source}) WHERE eventtype = 'Shooting Permit' "
        "AND startdatetime BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '2001-06-30'"
    )


PERMIT_VIEWS = {
    "base": PERMIT_BASE,
    "newest": _wanted("SELECT * FROM base WHERE o_orderdate >= TIMESTAMP '1999-01-01'"),
    "mid": _wanted(
        "SELECT * REPLACE (CASE WHEN parkingheld = '2-HIGH' THEN 'moved' ELSE communityboards END AS communityboards) "
        "FROM base WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'"
    ),
    "oldest": _wanted(
        "SELECT * FROM base WHERE o_orderdate < TIMESTAMP '1998-07-01' "
        "AND eventid IN (SELECT l_orderkey FROM lineitem)"
    ),
    "recent": _full_join("newest", "mid", [*_SHARED, "parkingheld"]),
    "joined": _full_join("recent", "oldest", _SHARED),
    "exploded": """
        SELECT * EXCLUDE (zipcodes, list), trim(unnest(list)) AS zipcode
        FROM (SELECT *, CASE WHEN zipcodes IS NULL THEN [NULL] ELSE string_split_regex(zipcodes, ',\\s*') END AS list FROM joined)""",
    "permits": """
        SELECT eventid, eventtype, CAST(year(startdatetime) AS INTEGER) AS start_year,
               CAST(month(startdatetime) AS INTEGER) AS start_month, CAST(day(startdatetime) AS INTEGER) AS start_day,
               CAST(year(enddatetime) AS INTEGER) AS end_year, CAST(month(enddatetime) AS INTEGER) AS end_month,
               CAST(day(enddatetime) AS INTEGER) AS end_day, borough, zipcode,
               count(*) OVER (PARTITION BY zipcode, year(startdatetime)) AS zip_count_by_year,
               count(*) OVER (PARTITION BY zipcode, year(startdatetime), month(startdatetime)) AS zip_count_by_month,
               count(*) OVER (PARTITION BY zipcode) AS zip_count_total
        FROM exploded""",
}

# The analyses after the clean-up start from one permit file, split by zip code.
ROW_VIEWS = {
    "base": PERMIT_BASE,
    "permits": """
        SELECT CAST(year(startdatetime) AS INTEGER) AS start_year, borough, trim(unnest(list)) AS zipcode
        FROM (SELECT *, CASE WHEN zipcodes IS NULL THEN [NULL] ELSE string_split_regex(zipcodes, ',\\s*') END AS list FROM base)""",
}


def permit_rows(t: Tables) -> DataFrame:
    rows = split_to_rows(_permit_base(t).select("startdatetime", "borough", "zipcode_s"), "zipcode_s")
    return rows.select(F.year("startdatetime").alias("start_year"), "borough", trim_space("zipcode_s").alias("zipcode"))


def _permit_base(t: Tables) -> DataFrame:
    hour = F.col("o_orderkey") % 24

    def shifted(hours: Column) -> Column:
        return F.col("o_orderdate") + F.make_dt_interval(hours=hours.cast("int"))

    def code(column: str, count: int) -> Column:
        return (F.col(column) % count + 10000).cast("string")

    zips = (
        F.when(F.col("o_totalprice") < 5000, F.lit(None))
        .when(F.col("o_orderstatus") == "F", code("o_custkey", 120))
        .when(F.col("o_orderstatus") == "O", F.concat(code("o_custkey", 120), F.lit(", "), code("o_orderkey", 150)))
        .otherwise(F.concat(code("o_orderkey", 150), F.lit(","), code("o_custkey", 120), F.lit(",   "), code("o_custkey", 7)))
    )
    return _orders_of_nations(t).select(
        F.col("o_orderkey").alias("eventid"),
        F.when(F.col("o_orderpriority") == "5-LOW", "Load-in").otherwise("Shooting Permit").alias("eventtype"),
        shifted(hour).alias("startdatetime"),
        shifted((F.col("o_custkey") % 5 + 1) * 24 + hour).alias("enddatetime"),
        shifted(F.lit(-72)).alias("enteredon"),
        F.col("o_orderpriority").alias("parkingheld"),
        F.col("c_mktsegment").alias("borough"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderstatus")).alias("communityboard_s"),
        F.col("c_mktsegment").alias("policeprecinct_s"),
        F.col("n_name").alias("country"),
        zips.alias("zipcode_s"),
        "o_orderdate",
    )


def permits_newest(t: Tables) -> DataFrame:
    """Newest file: mixed-case names, times as 12-hour or 24-hour texts."""
    rows = _permit_base(t).where(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")).drop("o_orderdate")
    twelve = F.col("borough") == "BUILDING"

    def text(column: str) -> Column:
        return F.when(twelve, F.date_format(column, "M/d/yyyy h:mm:ss a")).otherwise(
            F.date_format(column, "MM/dd/yyyy HH:mm:ss")
        )

    texts = rows.withColumns({c: text(c) for c in ("startdatetime", "enddatetime", "enteredon")})
    return texts.withColumnsRenamed({
        "eventid": "EventID", "eventtype": "EventType", "startdatetime": "StartDateTime",
        "enddatetime": "EndDateTime", "enteredon": "EnteredOn", "parkingheld": "ParkingHeld",
        "borough": "Borough", "communityboard_s": "CommunityBoard_s", "policeprecinct_s": "PolicePrecinct_s",
        "country": "Country", "zipcode_s": "ZipCode_s",
    })


def permits_mid(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    rows = _permit_base(t).where(
        (day >= F.lit("1998-01-01").cast("timestamp_ntz")) & (day < F.lit("2000-01-01").cast("timestamp_ntz"))
    ).drop("o_orderdate")
    return rows.withColumn(
        "communityboard_s", F.when(F.col("parkingheld") == "2-HIGH", "moved").otherwise(F.col("communityboard_s"))
    )


def permits_oldest(t: Tables) -> DataFrame:
    """Oldest file: one row per location of an event, no parking column."""
    rows = _permit_base(t).where(F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp_ntz"))
    places = t.lineitem.select(
        F.col("l_orderkey").alias("eventid"), F.col("l_partkey").cast("string").alias("main"),
        F.col("l_returnflag").alias("cross_st_1"), F.col("l_linestatus").alias("cross_st_2"),
    )
    return rows.drop("parkingheld", "o_orderdate").join(places, "eventid")


OLDEST_ORDER = ["main", "cross_st_1", "cross_st_2"]
