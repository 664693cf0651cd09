"""Single verbs on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldbook.catalog.registry import Tables, query, rounded
from fieldbook.functions.dates import between_midnights, parse_mdy_hms
from fieldbook.functions.nulls import blank_to_null, not_in
from fieldbook.functions.numbers import ratio, round_even, text_to_int
from fieldbook.functions.text import prefix, remove_all, remove_first, remove_first_text, trim_space
from fieldbook.operators.joins import equi_join, map_lookup as map_name
from fieldbook.operators.ranking import top_n
from fieldbook.operators.reshape import (
    drop_prefixed, format_titles, ints_where_named, lower_names, relocate, rename_all,
)
from fieldbook.operators.sets import bind_rows, difference, intersect, missing_keys


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) < 8")
def having_count(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where("n < 8")


@query("SELECT p_partkey, p_size FROM part QUALIFY rank() OVER (ORDER BY p_size DESC) = 1")
def largest_parts(t: Tables) -> DataFrame:
    return top_n(t.part.select("p_partkey", "p_size"), "p_size")


@query("""
SELECT n_name, count(*) AS count, round(count(*) / (n_nationkey + 1), 8) AS density
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, n_nationkey
QUALIFY rank() OVER (ORDER BY count(*) / (n_nationkey + 1) DESC) <= 10""")
def density_per_nation(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    counts = rows.groupBy("n_name", "n_nationkey").agg(F.count(F.lit(1)).alias("count"))
    dense = counts.withColumn("density", ratio(F.col("count"), F.col("n_nationkey") + 1)).drop("n_nationkey")
    return rounded(top_n(dense, "density", 10), 8, "density")


@query("""
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL, s_acctbal FROM supplier""")
def union_missing(t: Tables) -> DataFrame:
    customers = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"),
    )
    return bind_rows(customers, suppliers)


@query("""
SELECT 'both' AS part, count(*) AS n FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'customers only', count(*) FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'missing years', count(*) FROM (SELECT unnest(range(1993, 2003)) EXCEPT SELECT year(o_orderdate) FROM orders)""")
def set_ops(t: Tables) -> DataFrame:
    buyers = t.customer.select(F.col("c_nationkey").alias("n"))
    sellers = t.supplier.select(F.col("s_nationkey").alias("n"))
    found = t.orders.select(F.year("o_orderdate").alias("y"))

    def size(label: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("part"), "n")

    return bind_rows(
        size("both", intersect(buyers, sellers)), size("customers only", difference(buyers, sellers)),
        size("missing years", missing_keys(found, "y", range(1993, 2003))),
    )


@query("""
SELECT d.doc_id, d.lang, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE quality IS NULL OR quality NOT IN (0)""")
def not_in_keeps_null(t: Tables) -> DataFrame:
    labelled = equi_join(t.documents.select("doc_id", "lang"), t.labels.select("doc_id", "quality"), ["doc_id"], "left")
    return labelled.where(not_in("quality", [0]))


@query("""
SELECT c_custkey, CAST(substr(c_name, 10) AS INTEGER) AS number, regexp_replace(c_name, '[^0-9]', '') AS one_off,
       replace(c_name, '0', '') AS no_zero, concat(c_mktsegment, '-', CAST(c_nationkey AS VARCHAR)) AS label,
       CAST(trunc(c_acctbal) AS INTEGER) AS balance FROM customer""")
def code_clean(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        text_to_int(F.substring("c_name", 10, 100)).alias("number"),
        remove_first("c_name", "[^0-9]").alias("one_off"),
        remove_all("c_name", "0").alias("no_zero"),
        F.concat("c_mktsegment", F.lit("-"), F.col("c_nationkey").cast("string")).alias("label"),
        text_to_int(F.col("c_acctbal").cast("string")).alias("balance"),
    )


@query("""
SELECT o_orderkey, o_orderdate + (o_orderkey % 24) * INTERVAL 1 HOUR AS placed, CAST(year(o_orderdate) AS INTEGER) AS y,
       CAST(month(o_orderdate) AS INTEGER) AS m, CAST(day(o_orderdate) AS INTEGER) AS d FROM orders""")
def mdy_parse(t: Tables) -> DataFrame:
    """Times written month first, half of them with AM/PM, and parsed back."""
    placed = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    text = F.when(F.col("o_orderstatus") == "F", F.date_format(placed, "M/d/yyyy h:mm:ss a")).otherwise(
        F.date_format(placed, "MM/dd/yyyy HH:mm:ss")
    )
    parsed = t.orders.select("o_orderkey", text.alias("text")).select("o_orderkey", parse_mdy_hms("text").alias("placed"))
    return parsed.withColumns({"y": F.year("placed"), "m": F.month("placed"), "d": F.dayofmonth("placed")})


@query("""
SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority,
       CASE WHEN length(o_orderpriority) <= 8 THEN length(o_orderpriority) - 1 END AS depth, CAST(o_custkey AS VARCHAR) AS customer
FROM orders""")
def recode_and_depth(t: Tables) -> DataFrame:
    p = F.col("o_orderpriority")
    return t.orders.select(
        "o_orderkey", blank_to_null(p, "4-NOT SPECIFIED").alias("priority"),
        F.when(F.length(p) <= 8, F.length(p) - 1).cast("long").alias("depth"),
        F.col("o_custkey").cast("string").alias("customer"),
    )


@query("""
SELECT p_type, count(*) AS n, round(avg(p_retailprice) FILTER (p_size = 10 OR p_size = 20), 4) AS chosen_mean FROM part
WHERE p_name LIKE 's%' AND length(p_name) <= 10 AND p_brand NOT LIKE '%7%' AND p_size <> 10 + 3
  AND p_type IN ('SMALL', 'ECONOMY', 'LARGE') AND CAST(p_partkey AS VARCHAR) <> '11222' AND p_retailprice > 900 AND p_brand IS NOT NULL
GROUP BY p_type""")
def filter_mix(t: Tables) -> DataFrame:
    """Prefix, length, regex, sentinel, set, text-against-number and NULL filters together."""
    rows = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice").na.drop("any").where(
        F.col("p_name").startswith("s") & (F.length("p_name") <= 10) & ~F.col("p_brand").rlike("7")
        & (F.col("p_size") != 13) & F.col("p_type").isin("SMALL", "ECONOMY", "LARGE")
        & (F.col("p_partkey").cast("string") != "11222") & (F.col("p_retailprice") > 900)
        & F.col("p_brand").isNotNull()
    )
    chosen = F.avg(F.when(F.col("p_size").isin(10, 20), F.col("p_retailprice")))
    return rounded(rows.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), chosen.alias("chosen_mean")), 4, "chosen_mean")


@query("""
SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'""")
def time_range(t: Tables) -> DataFrame:
    return t.events.where(between_midnights("ts", "2024-01-05", "2024-01-20")).select("event_id", "ts")


@query("""
SELECT 'import' AS source, c_custkey AS "key", CAST(substr(c_name, 10) AS INTEGER) AS code_name, c_mktsegment AS segment,
       concat('ab ', lower(c_mktsegment)) AS "Lower Segment" FROM customer""")
def column_reshape(t: Tables) -> DataFrame:
    """Rename, lower-case, cast by name, drop by prefix, constant column, reorder, report headers."""
    df = lower_names(t.customer.withColumnRenamed("c_custkey", "KEY")).drop("c_nationkey", "not_there")
    df = df.withColumn("code_name", F.substring("c_name", 10, 100)).withColumnRenamed("c_mktsegment", "segment")
    df = drop_prefixed(ints_where_named(df, "code"), "c_")
    df = relocate(df.withColumn("source", F.lit("import")), "source", "key")
    titled = format_titles(df.select(F.concat(F.lit("ab "), F.lower("segment")).alias("lower_segment"), "*"))
    return rename_all(titled, lambda c: c if c == "Lower Segment" else c.lower().replace(" ", "_"))


@query("""
SELECT p_partkey, trim(concat(substr(title, 1, strpos(title, brand) - 1), substr(title, strpos(title, brand) + length(brand)))) AS title
FROM (SELECT p_partkey, substr(p_brand, 7) AS brand, concat(p_brand, ' ', p_name, ' ', substr(p_brand, 7), ' ') AS title FROM part)""")
def strip_by_column(t: Tables) -> DataFrame:
    """First occurrence of another column's text removed, then trimmed."""
    rows = t.part.select(
        "p_partkey", F.substring("p_brand", 7, 10).alias("brand"),
        F.concat("p_brand", F.lit(" "), "p_name", F.lit(" "), F.substring("p_brand", 7, 10), F.lit(" ")).alias("text"),
    )
    return rows.select("p_partkey", trim_space(remove_first_text("text", "brand")).alias("title"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status FROM orders""")
def map_lookup(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", map_name(F.col("o_orderstatus"), {"F": "finished", "O": "open"}).alias("status"))


@query("""
SELECT o_orderstatus, round_even(100 * count(*) / sum(count(*)) OVER (), 1) AS share, round_even(avg(o_totalprice), 0) AS mean_value
FROM orders GROUP BY o_orderstatus""")
def rounded_shares(t: Tables) -> DataFrame:
    total = t.orders.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("mean"))
    return counts.select(
        "o_orderstatus", round_even(ratio(F.col("n") * 100, total), 1).alias("share"),
        round_even("mean").alias("mean_value"),
    )


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand")
def ordered_categories(t: Tables) -> DataFrame:
    """Categories in the order of a measure."""
    return t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "p_brand")


@query("""
SELECT left(p_brand, 7) AS head, count(*) AS n, sum(p_size)::BIGINT AS size FROM part GROUP BY 1""")
def prefix_groups(t: Tables) -> DataFrame:
    return t.part.groupBy(prefix("p_brand", 7).alias("head")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("size")
    )


@query("""
SELECT n_name, round(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(*), 8) AS finished_share, max(o_totalprice) AS largest
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
QUALIFY rank() OVER (ORDER BY sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(*) DESC) <= 10""")
def finished_share(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    shares = rows.groupBy("n_name").agg(
        ratio(F.count_if(F.col("o_orderstatus") == "F"), F.count(F.lit(1))).alias("finished_share"),
        F.max("o_totalprice").alias("largest"),
    )
    return rounded(top_n(shares, "finished_share", 10), 8, "finished_share")
