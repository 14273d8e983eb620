"""Roll-ups over a pre-aggregated grain, grouping sets and mergeable measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measures:
    """Mergeable aggregate states: output name -> input column."""

    sums: Mapping[str, str]
    means: Mapping[str, str]
    mins: Mapping[str, str]
    maxs: Mapping[str, str]

    def first_level(self) -> list[Column]:
        """States from detail rows."""
        out = [F.count(F.lit(1)).alias("n")]
        out += [F.sum(c).cast("bigint").alias(name) for name, c in self.sums.items()]
        for name, c in self.means.items():
            out.append(F.sum(F.col(c).cast("double")).alias(f"{name}_sum"))
            out.append(F.count(c).alias(f"{name}_cnt"))
        out += [F.min(c).alias(name) for name, c in self.mins.items()]
        out += [F.max(c).alias(name) for name, c in self.maxs.items()]
        return out

    def merge(self) -> list[Column]:
        """States from states."""
        out = [F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n")]
        out += [F.sum(name).cast("bigint").alias(name) for name in self.sums]
        for name in self.means:
            out.append(F.sum(f"{name}_sum").alias(f"{name}_sum"))
            out.append(F.coalesce(F.sum(f"{name}_cnt"), F.lit(0)).cast("bigint").alias(f"{name}_cnt"))
        out += [F.min(name).alias(name) for name in self.mins]
        out += [F.max(name).alias(name) for name in self.maxs]
        return out


def finest_grain(df: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    return df.groupBy(*keys).agg(*measures.first_level())


def merge_grain(grain: DataFrame, keys: Sequence[str], measures: Measures) -> DataFrame:
    """Merge grains of several loads into one."""
    return grain.groupBy(*keys).agg(*measures.merge())


def rollup_grain(
    grain: DataFrame, keys: Sequence[str], measures: Measures, keep_grand_total: bool = True
) -> DataFrame:
    """All roll-up levels of a grain, with ``gid`` telling them apart.

    Rows are copied once per level, so it is the grain that is copied and not
    the detail.  An empty grain still gives the grand-total row when asked: one
    neutral row (n = 0) is added before and the groups made of it alone dropped.
    """
    if keep_grand_total:
        # One literal row, read by every session without input of its own.
        neutral = grain.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("n"))
        grain = grain.unionByName(neutral, allowMissingColumns=True)
    levels = grain.rollup(*keys).agg(F.grouping_id().cast("bigint").alias("gid"), *measures.merge())
    if keep_grand_total:
        grand = (1 << len(keys)) - 1
        levels = levels.filter((F.col("n") > 0) | (F.col("gid") == grand))
    return levels


def level_gid(key_count: int, prefix: int) -> int:
    """``gid`` of the roll-up level that keeps the first ``prefix`` keys."""
    return (1 << (key_count - prefix)) - 1


def grouping_sets(
    df: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]], aggregates: Sequence[Column]
) -> DataFrame:
    """GROUPING SETS with ``gid``."""
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in keys]).agg(
        F.grouping_id().cast("bigint").alias("gid"), *aggregates
    )
