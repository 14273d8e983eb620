"""Build a stored warehouse from the test tables and time the questions on it.

Prints one JSON line.  ``q`` entries run on the warehouse as built; ``x`` entries
on copies of it, with as many copies as bring the fact to about 1.93 million
rows, the size the published reference times were taken at.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from starmart.operators.keys import dense_ids  # noqa: E402
from starmart.plans import cube, star_queries  # noqa: E402
from starmart.plans.star import shaped  # noqa: E402
from starmart.plans.warehouse import ID_OF, Warehouse  # noqa: E402
from starmart.session import local_session  # noqa: E402
from starmart.sources.scratch import scratch_path  # noqa: E402
from starmart.sources.testdata import TestStar, staging  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
PUBLISHED_FACTS = 1_928_568
RUNS = 3

QUESTIONS = {
    "n1_victims_by_weather": star_queries.victims_by_weather,
    "n2_top_days": star_queries.top_days,
    "n3_severity_by_country": star_queries.severity_by_country,
    "n4_severity_by_place_top10": star_queries.severity_by_place_top10,
    "n5_severity_rank_global": star_queries.severity_rank_global,
    "n6_avg_severity_by_weather_country": star_queries.avg_severity_by_weather_country,
    "n7_serious_by_weather": star_queries.serious_by_weather,
    "n8_serious_by_zone": star_queries.serious_by_zone,
    "n9_accidents_by_sex_severity": star_queries.accidents_by_sex_severity,
    "n11_severity_holiday_weather": star_queries.severity_holiday_weather,
}
REQUESTS = {
    "n12_cube_weather_rank": cube.weather_rank,
    "n13_cube_serious_cells": cube.serious_cells,
    "n14_cube_smoothed_zones": cube.smoothed_zones,
}


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def best(make) -> float:
    """Best of a few complete runs, planning included."""
    return round(min(timed(lambda: run(make())) for _ in range(RUNS)), 3)


def build(spark: SparkSession, times: dict[str, float]) -> Warehouse:
    base = TestStar(spark, SF_DIR)
    warehouse = Warehouse(spark, scratch_path(spark, "bench"))

    def weather() -> DataFrame:
        return shaped(dense_ids(base.weather, "id_meteo", ["id_pays", "date"]), "dim_meteo")

    steps = {
        "build_dim_pays": lambda: warehouse.load_dimension("dim_pays", shaped(base.country, "dim_pays")),
        "build_dim_temps": lambda: warehouse.load_dimension("dim_temps", base.calendar),
        "build_dim_meteo": lambda: warehouse.load_dimension("dim_meteo", weather()),
        "build_accidents": lambda: warehouse.load_accidents(staging(spark, SF_DIR)),
    }
    for name, step in steps.items():
        times[name] = round(timed(step), 3)
    return warehouse


def enlarged(warehouse: Warehouse, copies: int) -> Warehouse:
    """The same star with every accident repeated under new keys."""
    spark = warehouse.spark
    big = Warehouse(spark, scratch_path(spark, "bench-big"))
    steps = {c: (warehouse.read(t).agg(F.max(c)).first()[0] or 0) for t, c in ID_OF.items()}
    for table in ("dim_pays", "dim_temps", "dim_meteo"):
        big.append(table, warehouse.read(table))
    for table in ID_OF:
        df = warehouse.read(table)
        copied = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        moved = {c: F.col(c) + F.col("_copy") * F.lit(step) for c, step in steps.items() if c in df.columns}
        big.append(table, copied.withColumns(moved).drop("_copy"))
    return big


def main() -> None:
    spark = local_session(CPUS, int(CPUS), os.environ.get("BENCH_MEMORY", "12g"))
    # Starting the engine is no part of any query.
    run(spark.read.parquet(f"{SF_DIR}/nation.parquet").groupBy("n_regionkey").count())
    times: dict[str, float] = {}
    warehouse = build(spark, times)
    star = warehouse.star()
    for name, question in QUESTIONS.items():
        times[name] = best(lambda: question(star))

    view_path = scratch_path(spark, "bench-cube")
    times["v1_cube_build_and_write"] = round(timed(lambda: cube.write_cube(cube.cube_build(star), view_path)), 3)
    view = cube.read_cube(spark, view_path)
    for name, request in REQUESTS.items():
        times[name] = best(lambda: request(view))

    facts = star.fact.count()
    copies = max(1, round(PUBLISHED_FACTS / facts))
    big = enlarged(warehouse, copies).star()
    for name, question in QUESTIONS.items():
        times[f"x_{name}"] = best(lambda: question(big))

    print(
        json.dumps(
            {
                "metric": "total seconds of all timed jobs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
                "facts": facts,
                "x_facts": facts * copies,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
