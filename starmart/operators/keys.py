"""Surrogate keys, first row per key and keep-first de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.ordered import SMALL_ROWS, partition_offsets, range_partitions
from starmart.sources.scratch import stored

ROWS_PER_PARTITION_BITS = 33


def dense_ids(
    df: DataFrame,
    id_col: str,
    order_by: Sequence[str],
    start: int = 1,
    partitions: int | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Number all rows start, start+1, ... along ``order_by``, nulls first.

    Rows are range-partitioned and sorted, numbered inside each partition, and
    shifted by the rows of the partitions before.  ``order_by`` should identify
    a row (source position as last column does), both for repeatable ids and so
    that a key with very many rows still splits over several ranges.

    Columns in ``drop`` only serve the order and are not carried further.

    The ranged rows are written once: range limits are drawn from a sample, and
    the counting and the numbering have to see the same limits.
    """
    order = [F.col(c).asc_nulls_first() for c in order_by]
    ranged = (
        df.repartitionByRange(partitions or range_partitions(df), *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", ROWS_PER_PARTITION_BITS))
        .withColumn("_local", F.col("_at").bitwiseAND(F.lit((1 << ROWS_PER_PARTITION_BITS) - 1)))
        .drop("_at", *drop)
    )
    ranged = stored(ranged, "ranged")
    offsets = partition_offsets(ranged.withColumn("_one", F.lit(1)), "_part", "_one", "_offset")
    numbered = ranged.join(F.broadcast(offsets), "_part")
    return numbered.select(
        (F.col("_local") + F.col("_offset") + F.lit(start)).cast("bigint").alias(id_col),
        *[c for c in df.columns if c not in drop],
    )


def block_ids(
    df: DataFrame, id_col: str, block: Sequence[str], row: str, start: int = 1, drop: Sequence[str] = ()
) -> DataFrame | None:
    """Number rows start, start+1, ... along (block, row) without moving them.

    For a stored table whose ``row`` already runs up by one inside each block, as
    row numbers given while reading file splits do.  Blocks are counted and
    shifted; the rows are only joined with the broadcast shifts.  Gives None when
    some block has gaps or there are too many blocks: then the rows have to be
    ordered (``dense_ids``).
    """
    blocks = stored(
        df.groupBy(*block).agg(
            F.count(F.lit(1)).alias("_n"), F.min(row).alias("_first"), F.max(row).alias("_last")
        ),
        "blocks",
    )
    gaps = F.count_if(F.col("_last") - F.col("_first") + 1 != F.col("_n"))
    total, broken = blocks.agg(F.count(F.lit(1)), gaps).first()
    if broken or total > SMALL_ROWS:
        return None
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.lit(start) - F.col("_first")
    shifts = blocks.select(*[F.col(b).alias(f"_b{i}") for i, b in enumerate(block)], shift.alias("_shift"))
    same = [F.col(b).eqNullSafe(F.col(f"_b{i}")) for i, b in enumerate(block)]
    numbered = df.join(F.broadcast(shifts), same)
    return numbered.select(
        (F.col(row) + F.col("_shift")).cast("bigint").alias(id_col), *[c for c in df.columns if c not in drop]
    )


def next_id(table: DataFrame, id_col: str) -> int:
    """First unused id: stored maximum plus one (one number to the driver)."""
    return (table.agg(F.max(id_col)).first()[0] or 0) + 1


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    values: Sequence[str] | None = None,
) -> DataFrame:
    """The row that comes first along ``order_by`` for each key.

    A minimum over (order, values) is combined before the shuffle, so a key with
    very many rows sends one row per input partition.  Null keys form a group.
    """
    values = [c for c in (values or df.columns) if c not in keys]
    ordering = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)])
    payload = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(values)])
    best = df.groupBy(*keys).agg(F.min(F.struct(ordering.alias("o"), payload.alias("v"))).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.v.v{i}").alias(c) for i, c in enumerate(values)])


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """De-duplicate on ``keys``, keeping the first row along ``order_by``."""
    return first_per_key(df, keys, order_by).select(*df.columns)


def natural_key(*parts: Column) -> Column:
    """Readable text key of several columns."""
    return F.concat_ws("-", *[p.cast("string") for p in parts])
