"""Yearly outputs and Parquet/CSV tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.loading import read_if_present


def write_by_year(df: DataFrame, path: str, years: Sequence[int], year: str = "annee", mode: str = "append") -> None:
    """One folder per listed year; years without rows make none.

    The rebalance gathers a year's rows into few files and splits a year that is
    too big for one task.
    """
    kept = df.filter(F.col(year).isin(list(years)))
    kept.hint("rebalance", year).write.mode(mode).partitionBy(year).parquet(path)


def write_missing_years(df: DataFrame, path: str, years: Sequence[int], year: str = "annee") -> None:
    """Only the years the output lacks (one row per year comes to the driver)."""
    stored = read_if_present(df, path)
    done = set() if stored is None else {r[0] for r in stored.select(year).distinct().collect()}
    todo = [y for y in years if y not in done]
    if todo:
        write_by_year(df, path, todo, year)


def redo_years(df: DataFrame, path: str, years: Sequence[int], year: str = "annee") -> None:
    """Replace the listed years and leave the others."""
    kept = df.filter(F.col(year).isin(list(years))).hint("rebalance", year)
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year).parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV with a header; an existing folder gets further files."""
    df.write.mode("append").options(header=True, sep=sep).csv(path)
