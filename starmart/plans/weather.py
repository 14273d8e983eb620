"""Daily weather dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.scalars import weather_label
from starmart.operators.keys import dense_ids, keep_first
from starmart.operators.ordered import exact_median
from starmart.schemas import TABLES
from starmart.sources.scratch import stored

MEASURES = ["temp_min", "temp_max", "precipitations", "vent"]


def daily_means(readings: DataFrame) -> DataFrame:
    """Mean of each measure per source file, country and day; missing readings are skipped."""
    return (
        readings.filter(F.col("date").isNotNull())
        .groupBy("fichier", "id_pays", "date")
        .agg(*[F.avg(m).alias(m) for m in MEASURES])
    )


def with_label(daily: DataFrame) -> DataFrame:
    """Weather word, judged before gaps are filled."""
    return daily.withColumn(
        "conditions", weather_label(F.col("precipitations"), F.col("vent"), F.col("temp_max"))
    )


def filled(daily: DataFrame) -> DataFrame:
    """Missing rain is 0; missing wind is the median of all countries, or 0 if there is none."""
    middle = exact_median(daily, "vent").scalar()
    return daily.withColumn("precipitations", F.coalesce("precipitations", F.lit(0.0))).withColumn(
        "vent", F.coalesce(F.col("vent"), middle, F.lit(0.0))
    )


def dim_meteo(readings: DataFrame, start: int = 1) -> DataFrame:
    """Readings (fichier, id_pays, date, measures) to one numbered row per country and day.

    The daily means are stored: the median and the table both need them, and the
    readings are parsed once.
    """
    daily = filled(with_label(stored(daily_means(readings), "daily")))
    one = keep_first(daily, ["id_pays", "date"], ["fichier"])
    numbered = dense_ids(one, "id_meteo", ["id_pays", "date"], start)
    return numbered.select(*[F.col(f.name).cast(f.dataType) for f in TABLES["dim_meteo"].fields])
