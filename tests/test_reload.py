"""Calendar and weather delivered in two parts, the later years first."""

import datetime

from pyspark.sql import functions as F

from starmart.plans.calendar import calendar_staging, days_of_years, dim_temps, number_days
from starmart.plans.warehouse import Warehouse


def days(spark, years):
    return dim_temps(number_days(calendar_staging(days_of_years(spark, years))))


def test_calendar_in_two_loads(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"))
    warehouse.load_dimension("dim_temps", days(spark, [2007]))
    before = {r["date"]: r["id_date"] for r in warehouse.read("dim_temps").collect()}
    warehouse.load_dimension("dim_temps", days(spark, [2005, 2007]))
    warehouse.load_dimension("dim_temps", days(spark, [2005]))
    after = {r["date"]: r["id_date"] for r in warehouse.read("dim_temps").collect()}
    assert warehouse.read("dim_temps").count() == len(after) == 730
    assert {d: after[d] for d in before} == before
    assert sorted(after.values()) == list(range(1, 731))
    assert set(after) == {r["date"] for r in days(spark, [2005, 2007]).collect()}
    assert warehouse.read("dim_temps").schema["id_date"].dataType == days(spark, [2005]).schema["id_date"].dataType


def test_weather_in_two_loads(spark, tmp_path):
    def weather(*rows):
        schema = "id_meteo int, id_pays int, date date, conditions string"
        return spark.createDataFrame(rows, schema)

    warehouse = Warehouse(spark, str(tmp_path / "w"))
    day = datetime.date
    warehouse.load_dimension("dim_meteo", weather((1, 2, day(2007, 1, 1), "pluie"), (2, 2, day(2007, 1, 2), "pluie")))
    warehouse.load_dimension("dim_meteo", weather((1, 1, day(2005, 1, 1), "nuageux"), (2, 2, day(2007, 1, 1), "autre")))
    got = [tuple(r) for r in warehouse.read("dim_meteo").select("id_meteo", "id_pays", F.year("date"), "conditions").orderBy("id_meteo").collect()]
    assert got == [(1, 2, 2007, "pluie"), (2, 2, 2007, "pluie"), (3, 1, 2005, "nuageux")]
