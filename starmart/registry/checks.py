"""Integrity checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.operators import checks
from starmart.registry.sql import FACT_PARTS, WEATHER_PARTS, with_parts
from starmart.sources.testdata import star, table


def check_unique(spark, sf_dir):
    return checks.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def check_fk(spark, sf_dir):
    """Orders without any line, and lines' parts without a part (none)."""
    line = table(spark, sf_dir, "lineitem")
    orders = checks.orphans(table(spark, sf_dir, "orders"), ["o_orderkey"], line, ["l_orderkey"])
    parts = checks.orphans(line, ["l_partkey"], table(spark, sf_dir, "part"), ["p_partkey"])
    return orders.select(F.lit("orders").alias("enfant"), F.col("o_orderkey").alias("cle"), "n").unionByName(
        parts.select(F.lit("lineitem").alias("enfant"), F.col("l_partkey").alias("cle"), "n")
    )


def check_join_ready(spark, sf_dir):
    data = star(spark, sf_dir)
    return checks.join_readiness(data.fact, data.weather)


def check_lengths(spark, sf_dir):
    return checks.too_long(table(spark, sf_dir, "customer"), {"c_name": 18, "c_mktsegment": 9})


def rows_per_year(spark, sf_dir):
    return checks.rows_per(table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("annee")), "annee")


NAMES = ["check_unique", "check_fk", "check_join_ready", "check_lengths", "rows_per_year"]
QUERIES = {name: globals()[name] for name in NAMES}

ORACLES = {
    "check_unique": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "check_fk": """
        SELECT 'orders' AS enfant, o_orderkey AS cle, count(*) AS n FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 2
        UNION ALL SELECT 'lineitem', l_partkey, count(*) FROM lineitem
        WHERE l_partkey NOT IN (SELECT p_partkey FROM part) GROUP BY 2""",
    "check_join_ready": with_parts(
        FACT_PARTS,
        WEATHER_PARTS,
        query="""
        SELECT (SELECT count(*) FROM weather) AS weather_rows,
               (SELECT count(*) FROM weather) - (SELECT count(*) FROM (SELECT DISTINCT id_pays, date FROM weather)) AS duplicate_rows,
               (SELECT count(*) FROM (SELECT DISTINCT id_pays, date FROM fact) f ANTI JOIN weather USING (id_pays, date)) AS unmatched_keys,
               (SELECT count(*) FROM fact ANTI JOIN weather USING (id_pays, date)) AS unmatched_rows""",
    ),
    "check_lengths": """
        SELECT 'c_name' AS "column", CAST(18 AS BIGINT) AS "limit", max(length(c_name)) AS longest,
               count(*) FILTER (WHERE length(c_name) > 18) AS beyond FROM customer
        UNION ALL SELECT 'c_mktsegment', 9, max(length(c_mktsegment)),
               count(*) FILTER (WHERE length(c_mktsegment) > 9) FROM customer""",
    "rows_per_year": "SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, count(*) AS n FROM orders GROUP BY 1",
}
