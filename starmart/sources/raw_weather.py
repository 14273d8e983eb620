"""French and British weather files to readings of one shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import dates
from starmart.functions.scalars import numeric_or
from starmart.sources.columns import find_column
from starmart.sources.delimited import Layout, list_files, manifest, read_layouts

FR, UK = 1, 2


def _reading(country: int, layout: Layout, date: str, low: Column, high: Column, rain: Column, wind: Column) -> DataFrame:
    return layout.rows.select(
        F.col("src_file").alias("fichier"),
        F.lit(country).alias("id_pays"),
        dates.date_any(F.col(f"`{date}`")).alias("date"),
        low.alias("temp_min"),
        high.alias("temp_max"),
        rain.alias("precipitations"),
        wind.alias("vent"),
    )


def fr_readings(layout: Layout) -> DataFrame:
    """Liquid rain only, as the British files have nothing else."""
    columns, rows = layout.columns, layout.rows
    date = find_column(columns, ["DATE", "AAAAMMJJ"], required=True)
    mean = find_column(columns, ["T", "temperature", "temp"])
    low = find_column(columns, ["TINF_H"]) or mean
    high = find_column(columns, ["TSUP_H"]) or mean
    if low is None:
        raise ValueError(f"no temperature among {columns}")
    return _reading(
        FR,
        layout,
        date,
        numeric_or(rows, low, None),
        numeric_or(rows, high, None),
        numeric_or(rows, find_column(columns, ["PRELIQ"]), 0.0),
        numeric_or(rows, find_column(columns, ["FF", "vent", "wind"]), None),
    )


def uk_readings(layout: Layout) -> DataFrame:
    """One temperature, used as lowest and highest."""
    columns, rows = layout.columns, layout.rows
    date = find_column(columns, ["date"], required=True)
    temperature = numeric_or(rows, find_column(columns, ["temp", "temperature"], required=True), None)
    rain = find_column(columns, ["precipitation", "precip", "rainfall", "rain"], required=True)
    wind = find_column(columns, ["wind_speed", "windspeed", "wind"])
    return _reading(
        UK, layout, date, temperature, temperature, numeric_or(rows, rain, None), numeric_or(rows, wind, None)
    )


def read_weather(spark: SparkSession, fr_root: str, uk_root: str, years: list[int] | None = None) -> DataFrame:
    """Readings of both countries; missing files are an error, and so is having none of ``years``."""
    frames = []
    for root, pattern, separators, shape in [
        (fr_root, "meteo_fr_*.csv", [";", ","], fr_readings),
        (uk_root, "meteo_uk_*.csv", [","], uk_readings),
    ]:
        files = list_files(spark, root, pattern)
        if years is not None:
            # a file named for other years is not opened; one without a year, or for a span of years, is
            named = F.regexp_extract_all("name", F.lit(r"\d{4}"), F.lit(0))
            one = F.size(named) == 1
            files = files.where(~one | F.element_at(F.when(one, named), 1).cast("int").isin(list(years)))
        described = manifest(files, separators)
        layouts = read_layouts(spark, described)
        if not layouts:
            raise FileNotFoundError(f"no {pattern} below {root}")
        frames += [shape(layout) for layout in layouts]
    readings = reduce(DataFrame.unionByName, frames)
    return readings if years is None else readings.filter(F.year("date").isin(years))
