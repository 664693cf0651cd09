"""Every registered query against its SQL in DuckDB."""

import __spark_entry__ as entry
import compare
import pytest


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["category", "show_title", "total_hours"]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(entry.REGISTRY) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.REGISTRY))
def test_query(spark, sf, con, name):
    found = compare.differences(entry.queries()[name](spark, sf), con, entry.oracle_sql()[name])
    # On the smallest tables a filter on one area may rightly leave nothing.
    assert found is None or (found == "no rows" and sf.rstrip("/").endswith("sf0.001"))


@pytest.mark.parametrize("name, order", [
    ("permits_per_year", "start_year NULLS LAST"), ("permits_per_borough", "total_permits DESC NULLS LAST, borough"), ("ordered_categories", "n, p_brand"),
])
def test_order(spark, sf, con, name, order):
    df = entry.REGISTRY[name](spark, sf)
    wanted = con.execute(f"SELECT {', '.join(df.columns)} FROM ({entry.REGISTRY[name].sql}) ORDER BY {order}").fetchall()
    assert [tuple(r) for r in df.collect()] == wanted
