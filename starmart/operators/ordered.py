"""Global order statistics without a single-task window: rank, prefix sums, median."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.sources.scratch import stored

# Largest table that may go through one task or be broadcast: two numbers per
# row, so about 32 MB.  Beyond it the range-partitioned way is taken.
SMALL_ROWS = 1_000_000


def range_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def partition_offsets(df: DataFrame, part: str, weight: str, offset: str) -> DataFrame:
    """Total ``weight`` of all lower-numbered partitions.

    One row per partition, so the ordering window is bounded by the partition
    count, never by the data.
    """
    totals = df.groupBy(part).agg(F.sum(weight).alias("_w"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum("_w").over(before), F.lit(0)).alias(offset))


def value_positions(
    df: DataFrame,
    value: str,
    descending: bool = False,
    small_rows: int = SMALL_ROWS,
    partitions: int | None = None,
) -> tuple[DataFrame, bool]:
    """Distinct values with their count ``n`` and the rows strictly ahead, ``ahead``.

    Counting first makes every value one row, however often it occurs, so a hot
    value costs no more than a rare one.  Nulls come last.  The flag tells
    whether the result was counted to be at most ``small_rows`` rows.
    """
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    counts = stored(df.groupBy(value).agg(F.count(F.lit(1)).alias("n")), "value-counts")
    small = counts.count() <= small_rows
    if small:
        before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))), True
    ranged = stored(
        counts.repartitionByRange(partitions or range_partitions(df), order).withColumn(
            "_part", F.spark_partition_id()
        ),
        "value-ranges",
    )
    offsets = partition_offsets(ranged, "_part", "n", "_offset")
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    positions = (
        ranged.withColumn("_in", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_part")
        .select(value, "n", (F.col("_in") + F.col("_offset")).alias("ahead"))
    )
    return positions, False


def global_rank(
    df: DataFrame,
    value: str,
    rank: str,
    store_input: bool = True,
    small_rows: int = SMALL_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """RANK() over the whole table, highest value first, nulls last.

    The input is read twice (count, join back); ``store_input`` writes it to a
    scratch table so that it is computed once.  The join back is on the value:
    its other side has one row per value and is broadcast when counted small;
    otherwise the hot values are split by the skew-join rule.
    """
    if store_input:
        df = stored(df, "rank-input")
    positions, small = value_positions(df, value, True, small_rows, partitions)
    ranks = positions.select(F.col(value).alias("_value"), (F.col("ahead") + 1).alias(rank))
    if small:
        ranks = F.broadcast(ranks)
    joined = df.join(ranks, F.col(value).eqNullSafe(F.col("_value")), "inner")
    return joined.select(*df.columns, F.col(rank).cast("bigint"))


def exact_median(df: DataFrame, value: str, small_rows: int = SMALL_ROWS) -> DataFrame:
    """One row ``median``: the exact middle, or the mean of the two middle values.

    Nulls are skipped; an all-null column gives a null median.
    """
    known = df.select(value).filter(F.col(value).isNotNull())
    positions, _ = value_positions(known, value, False, small_rows)
    size = positions.agg(F.sum("n")).scalar()
    low = F.floor((size - 1) / 2)
    high = F.ceil((size - 1) / 2)

    def at(position: Column) -> Column:
        hit = (F.col("ahead") <= position) & (position < F.col("ahead") + F.col("n"))
        return F.max(F.when(hit, F.col(value)))

    return positions.agg(((at(low) + at(high)) / 2).alias("median"))
