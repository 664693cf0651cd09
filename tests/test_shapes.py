"""Plan shapes that decide whether a query survives far more data and hot keys."""

import math
import re
from collections import Counter

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F

from fieldbook.functions.geometry import EDGES_TYPE, ring_edges
from fieldbook.operators import groups, joins, quantiles, ranking, spatial

# Windows in one task: only over tables with one row per calendar period.
CALENDAR_WINDOWS = {"mom_change", "hotspot_overlap", "top10_overlap"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.REGISTRY))
def test_no_cross_joins_or_row_udfs(spark, sf, name):
    plan = plan_of(entry.queries()[name](spark, sf))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    single = re.search(r"Window \[[^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)
    assert not single or name in CALENDAR_WINDOWS


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = plan_of(entry.queries()["title_total"](spark, sf))
    assert "PushedFilters: [IsNotNull(p_name), EqualTo(p_name,red widget)" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double>" in plan


def test_first_row_is_cut_before_the_shuffle(spark, sf):
    plan = plan_of(entry.queries()["first_per_key"](spark, sf))
    assert re.search(r"Exchange hashpartitioning\(l_orderkey[^\n]*\n[^\n]*WindowGroupLimit[^\n]*Partial", plan)


def test_top_n_reuses_its_input_and_its_cut(spark, sf):
    df = entry.queries()["density_per_nation"](spark, sf)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and "ReusedSubquery" in final


def test_first_value_stays_a_hash_aggregate(spark):
    df = spark.createDataFrame([("a", 1)], "k string, r int").withColumn("d", F.current_date())
    plan = plan_of(df.groupBy("k").agg(*groups.first_of_group("d", "r", "fd", "fr").values()))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


@pytest.fixture
def tiny_partitions(spark):
    """Limits small enough for AQE to see skew in a few thousand rows."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def skewed(spark, rows=60_000):
    """A third of all rows under one key, over many input tasks."""
    spread = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    return spark.range(0, rows, 1, 16).select(spread.alias("k"), F.col("id").alias("v"), F.hash("id").alias("noise"))


def final_plan(df):
    rows = df.collect()
    return rows, plan_of(df).split("== Initial Plan ==")[0]


def test_hot_key_is_split_in_group_values(spark, tiny_partitions):
    df = groups.with_group_values(skewed(spark), ["k"], n=F.count(F.lit(1)))
    rows, plan = final_plan(df)
    assert "skew=true" in plan
    assert len(rows) == 60_000 and max(r.n for r in rows) > 20_000


def test_hot_key_is_split_in_natural_full_join(spark, tiny_partitions):
    right = spark.range(0, 100).select(F.col("id").alias("k"), F.lit("x").alias("side"))
    for unique in (False, True):
        rows, plan = final_plan(joins.natural_full_join(skewed(spark), right, right_unique=unique))
        assert "skew=true" in plan and "FullOuter" not in plan
        assert len(rows) == 60_000 and sum(r.side is not None for r in rows) > 20_000


def test_hot_group_is_split_in_top_n_per_group(spark, tiny_partitions):
    rows, plan = final_plan(ranking.top_n_per_group(skewed(spark), ["k"], "noise", 2))
    assert "skew=true" in plan
    assert len({r.k for r in rows}) == 5000


def test_crowded_cell_is_split_when_cells_are_many(spark, tiny_partitions):
    square = spark.createDataFrame([(1, ring_edges([(0, 0), (50, 0), (50, 50), (0, 50)]))], f"district int, edges {EDGES_TYPE}")
    points = skewed(spark).select((F.col("k") % 100 + 0.5).alias("x"), (F.col("k") % 70 + 0.5).alias("y"), "v")
    rows, plan = final_plan(spatial.join_polygons(points, square, "x", "y", 1.0))
    assert "SortMergeJoin" in plan and "skew=true" in plan
    assert len(rows) == 60_000
    assert all((r.district == 1) == (r.x < 50 and r.y < 50) for r in rows)


def test_few_cells_are_broadcast(spark):
    square = spark.createDataFrame([(1, ring_edges([(0, 0), (5, 0), (5, 5), (0, 5)]))], f"district int, edges {EDGES_TYPE}")
    points = spark.range(10).select(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"))
    assert "BroadcastHashJoin" in final_plan(spatial.join_polygons(points, square, "x", "y", 1.0))[1]


def test_one_large_polygon_is_cut_by_many_tasks(spark):
    corners = [(1000 + 900 * math.cos(k * math.tau / 10_000), 1000 + 900 * math.sin(k * math.tau / 10_000)) for k in range(10_000)]
    circle = spark.createDataFrame([(1, ring_edges(corners))], f"district int, edges {EDGES_TYPE}")
    cells = spatial.polygon_cells(circle, 20.0)
    parts = [r["count"] for r in cells.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    assert len(parts) >= 4 and max(parts) < sum(parts) / 2
    points = spark.range(5000).select((F.col("id") * 37 % 2000 + 0.5).cast("double").alias("x"), (F.col("id") * 101 % 2000 + 0.5).cast("double").alias("y"))
    inside = spatial.points_within(points, circle, "x", "y", 20.0).count()
    radius = F.sqrt(F.pow(F.col("x") - 1000, 2) + F.pow(F.col("y") - 1000, 2))
    assert inside == points.where(radius < 900 - 1e-3).count()


def scans(plan):
    return len(re.findall(r"FileScan", plan))


def test_permit_files_are_read_once(spark, tmp_path):
    """One full outer join per file, and one evaluation of their rows for counts and rows."""
    keys = "eventid long, eventtype string, startdatetime timestamp, zipcodes string"
    for name, extra in (("a", "x string"), ("b", "y string"), ("c", "z string")):
        spark.createDataFrame([(k, "t", None, "1, 2", name) for k in range(50)], f"{keys}, {extra}").write.parquet(str(tmp_path / name))
    a, b, c = (spark.read.parquet(str(tmp_path / n)) for n in "abc")
    joined = joins.natural_full_join(joins.natural_full_join(a, b, spread=True), c, spread=True)
    sized = groups.with_group_sizes(joined, ["zipcodes", "eventtype"], {"n": ["zipcodes", "eventtype"], "n_zip": ["zipcodes"]}, once=True)
    rows, plan = final_plan(sized)
    assert len(rows) == 50 and {r.n_zip for r in rows} == {50} and {r.z for r in rows} == {"c"}
    assert scans(plan) == 3


def test_quantiles_read_their_input_once(spark, tmp_path):
    spark.range(5000).select((F.col("id") % 7).alias("g"), F.sqrt("id").alias("x")).write.parquet(str(tmp_path / "q"))
    df = spark.read.parquet(str(tmp_path / "q"))
    assert scans(final_plan(quantiles.exact_quantiles(df, "x", [0.1, 0.5, 0.9]))[1]) == 1
    assert scans(final_plan(quantiles.exact_median(df, "x", ["g"]))[1]) == 1
    totals = df.groupBy("g").agg(F.sum("x").alias("total"))
    # The breaks are a subquery; what is left in the plan above it reads nothing of its own.
    assert scans(final_plan(quantiles.with_quantile_bin(totals, "total", 5, "Bin", "bin"))[1]) <= 1


def test_ties_are_ordered_in_many_tasks(spark, tiny_partitions):
    """A year of equal counts: no task orders more than a few ranges of its items."""
    df = spark.range(40_000).select(F.lit(2020).alias("year"), F.lit(1).alias("n"), F.format_string("item-%08d", "id").alias("item"))
    positions = ranking.with_position(df, ["year"], "n", "item", "rank", ranges=64)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = positions.select("item", "rank", F.spark_partition_id().alias("part")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = Counter(r.part for r in rows)
    assert len(parts) >= 4 and max(parts.values()) < 40_000 / 2
    assert all(int(r.item[5:]) + 1 == r["rank"] for r in rows)
