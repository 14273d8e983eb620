"""One-pass profile of a source."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def profile(df: DataFrame, source: str) -> DataFrame:
    """Per column: position, rows, nulls, least and greatest value as text, in a single aggregate.

    Arrays, maps and structs have no least and greatest value.
    """

    def text(name: str) -> Column:
        nested = isinstance(df.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType))
        return F.lit(None).cast("string") if nested else F.col(f"`{name}`").cast("string")

    stats = [
        F.struct(
            F.lit(source).alias("source"),
            F.lit(i).alias("position"),
            F.lit(c).alias("colonne"),
            F.count(F.lit(1)).alias("lignes"),
            F.count_if(F.col(f"`{c}`").isNull()).alias("nuls"),
            F.min(text(c)).alias("minimum"),
            F.max(text(c)).alias("maximum"),
        )
        for i, c in enumerate(df.columns, 1)
    ]
    return df.agg(F.array(*stats).alias("_stats")).select(F.inline("_stats"))


def profile_sources(sources: Mapping[str, DataFrame | Exception]) -> DataFrame:
    """Profiles of several sources; one that could not be opened gives its error instead."""
    parts = []
    spark = next((s.sparkSession for s in sources.values() if isinstance(s, DataFrame)), None)
    if spark is None:
        raise ValueError("no readable source")
    for name, source in sources.items():
        if isinstance(source, DataFrame):
            parts.append(profile(source, name).withColumn("erreur", F.lit(None).cast("string")))
        else:
            parts.append(spark.range(1).select(F.lit(name).alias("source"), F.lit(str(source)).alias("erreur")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
