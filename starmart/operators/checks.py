"""Integrity checks Spark does not enforce on write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.schemas import RULES, TableRules


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count ``n``; null keys are exempt."""
    known = df.na.drop(subset=list(keys))
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(child: DataFrame, child_keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str]) -> DataFrame:
    """Foreign keys without a parent, with their row count ``n``; null keys are allowed.

    Child keys are counted first: a parent with very many children is one row in
    the join.  Both sides are shuffled: files of running ids are far smaller than the ids, so a
    broadcast by file size could hold all of a large parent.
    """
    used = child.na.drop(subset=list(child_keys)).groupBy(*child_keys).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(parent_keys)])
    match = reduce(
        lambda a, b: a & b, [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(child_keys)]
    )
    return used.join(known.hint("merge"), match, "left_anti")


def too_long(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """One row per limited column: longest value, limit and rows beyond it, in one pass."""
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(w).cast("bigint").alias("limit"),
            F.coalesce(F.max(F.length(c)), F.lit(0)).cast("bigint").alias("longest"),
            F.count_if(F.length(c) > w).alias("beyond"),
        )
        for c, w in widths.items()
    ]
    return df.agg(F.array(*cells).alias("_cells")).select(F.inline("_cells"))


def check_table(name: str, tables: Mapping[str, DataFrame], rules: TableRules | None = None) -> DataFrame:
    """All broken rules of one table: (table, rule, broken)."""
    rules = rules or RULES[name]
    df = tables[name]
    parts = []

    def report(rule: str, broken: DataFrame) -> DataFrame:
        return broken.select(F.lit(name).alias("table"), F.lit(rule).alias("rule"), F.col("broken"))

    count = F.count(F.lit(1)).alias("broken")
    for keys in rules.unique:
        parts.append(report(f"unique({','.join(keys)})", duplicate_keys(df, keys).agg(count)))
    for keys, parent, parent_keys in rules.foreign:
        missing = orphans(df, keys, tables[parent], parent_keys)
        parts.append(report(f"foreign({','.join(keys)})->{parent}", missing.agg(count)))
    if rules.widths:
        rule = F.format_string("width(%s<=%d)", "column", "limit")
        parts.append(too_long(df, rules.widths).select(F.lit(name).alias("table"), rule.alias("rule"), F.col("beyond").alias("broken")))
    return reduce(DataFrame.unionByName, parts)


def join_readiness(fact: DataFrame, weather: DataFrame, keys: Sequence[str] = ("id_pays", "date")) -> DataFrame:
    """One row: weather rows, duplicate weather keys, fact keys and fact rows without weather."""
    keys = list(keys)
    days = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    per_key = weather.groupBy(*keys).agg(F.count(F.lit(1)).alias("_weather"))
    return days.join(per_key, keys, "full_outer").agg(
        F.coalesce(F.sum("_weather"), F.lit(0)).cast("bigint").alias("weather_rows"),
        F.coalesce(F.sum(F.col("_weather") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"),
        F.count_if(F.col("_rows").isNotNull() & F.col("_weather").isNull()).alias("unmatched_keys"),
        F.coalesce(F.sum(F.when(F.col("_weather").isNull(), F.col("_rows"))), F.lit(0))
        .cast("bigint")
        .alias("unmatched_rows"),
    )


def rows_per(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
