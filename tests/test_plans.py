"""The plans: what reaches the scan, what is shuffled, what is never there."""

import tempfile

import pytest
from pyspark.sql import functions as F

from starmart.operators import keys, policies
from starmart.plans import star_queries
from starmart.plans.warehouse import Warehouse
from starmart.registry import catalog
from starmart.registry.checks import QUERIES as CHECKS
from starmart.registry.policies import QUERIES as POLICIES
from starmart.registry.scalars import QUERIES as SCALARS
from starmart.registry.star import QUERIES as QUESTIONS
from starmart.schemas import TABLES
from starmart.sources.testdata import TestStar, staging

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def warehouse(spark):
    base = TestStar(spark, SF_DIR)
    made = Warehouse(spark, tempfile.mkdtemp(prefix="run-"))
    made.load_dimension("dim_pays", base.country)
    made.load_dimension("dim_temps", base.calendar)
    weather = keys.dense_ids(base.weather, "id_meteo", ["id_pays", "date"])
    made.load_dimension("dim_meteo", weather.select(*TABLES["dim_meteo"].fieldNames()))
    made.load_accidents(staging(spark, SF_DIR))
    return made


@pytest.mark.parametrize("name", sorted({**QUESTIONS, **CHECKS, **POLICIES, **SCALARS}))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(catalog.queries()[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert unwanted not in text


def test_threshold_and_columns_reach_the_scan(warehouse):
    text = plan(star_queries.serious_by_weather(warehouse.star()))
    assert "GreaterThan(indice_gravite,4.0)" in text
    fact_scan = next(line for line in text.splitlines() if "fait_accident" in line)
    assert "nb_tues" not in fact_scan and "id_usager" not in fact_scan


def test_weather_questions_do_not_shuffle_the_fact(warehouse):
    """Every exchange sits above a partial aggregate."""
    text = plan(star_queries.victims_by_weather(warehouse.star()))
    lines = [line.strip(" +-:*") for line in text.splitlines()]
    for above, below in zip(lines, lines[1:]):
        if above.startswith("Exchange hashpartitioning"):
            assert "partial_" in below


def test_policy_prunes_folders(warehouse):
    seen = policies.as_role(
        warehouse.read("fait_accident"), "fait_accident", "francais", policies.WAREHOUSE_ACCESS
    )
    text = plan(seen)
    assert "PartitionFilters: [isnotnull(id_pays" in text or "(id_pays#" in text.split("PartitionFilters:")[1][:60]


def test_year_filter_prunes_folders(warehouse):
    fact = warehouse.spark.read.parquet(warehouse.path("fait_accident")).filter("annee = 1997")
    assert "annee" in plan(fact).split("PartitionFilters:")[1].split("]")[0]


def test_small_dimensions_are_counted_before_broadcast(warehouse, monkeypatch):
    from starmart.plans import warehouse as module

    star = warehouse.star()
    joined = star.fact.join(star.weather.select("id_pays", "date", "conditions"), ["id_pays", "date"])
    assert "BroadcastHashJoin" in plan(joined)
    monkeypatch.setattr(module, "BROADCAST_ROWS", 3)
    spark = warehouse.spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = warehouse.star()
        joined = big.fact.join(big.weather.select("id_pays", "date", "conditions"), ["id_pays", "date"])
        assert "Broadcast" not in plan(joined)
        want = {tuple(r) for r in star_queries.victims_by_weather(star).collect()}
        assert {tuple(r) for r in star_queries.victims_by_weather(big).collect()} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_built_warehouse_keeps_its_rules(warehouse):
    broken = warehouse.check().filter(F.col("broken") > 0).select("table", "rule").collect()
    assert [tuple(r) for r in broken] == []
