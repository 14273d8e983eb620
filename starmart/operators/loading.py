"""Incremental loads: existing rows are never overwritten."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.checks import duplicate_keys
from starmart.operators.keys import keep_first
from starmart.sources.scratch import stored


# A batch of this many rows may have its keys broadcast (about 50 MB).
SMALL_BATCH = 500_000


def not_in_target(batch: DataFrame, target: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose key the target lacks; a null in the key never collides."""
    if target is None:
        return batch
    return batch.join(target.select(*keys), list(keys), "left_anti").select(*batch.columns)


def _only_in_batch(target: DataFrame | None, batch: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The target's keys that a stored batch has as well, if the batch is counted small.

    Its keys are broadcast, so a big target is scanned but not shuffled.  For a
    larger batch the target comes back whole and meets it in a shuffled join, which is asked
    for: by the size of its compressed files Spark would broadcast millions of keys.
    """
    if target is None:
        return None
    if batch.count() > SMALL_BATCH:
        return target.hint("merge")
    wanted = F.broadcast(batch.select(*keys).na.drop())
    return target.select(*keys).join(wanted, list(keys), "left_semi")


def new_records(batch: DataFrame, known: DataFrame, natural_key: Sequence[str]) -> DataFrame:
    """Batch records whose natural key is not stored yet, duplicates included."""
    batch = stored(batch, "batch")
    return not_in_target(batch, _only_in_batch(known, batch, natural_key), natural_key)


def rows_of_wanted(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``wanted``, a stored table of keys (repeats allowed); a null in the key matches nothing.

    Rows of groups (few, part of the key) without a wanted key are left out first.  Mostly all or nearly
    all others are wanted: the distinct keys that are not, counted to be few, are broadcast, and no
    row moves.  Otherwise rows and wanted keys meet in a shuffled join, whatever the size of the keys' files.
    """
    if wanted.count() <= SMALL_BATCH:
        return rows.join(F.broadcast(wanted.select(*keys)), list(keys), "left_semi").select(*rows.columns)
    groups = F.broadcast(wanted.select(*group).distinct())
    near = rows.na.drop(subset=list(keys)).join(groups, list(group), "left_semi").select(*rows.columns)
    many = wanted.hint("merge")
    others = stored(near.select(*keys).distinct().join(many, list(keys), "left_anti"), "unwanted")
    if others.count() <= SMALL_BATCH:
        return near.join(F.broadcast(others), list(keys), "left_anti").select(*rows.columns)
    return near.join(many, list(keys), "left_semi").select(*rows.columns)


def rows_to_insert(
    batch: DataFrame,
    target: DataFrame | None,
    unique_keys: Sequence[Sequence[str]],
    order_by: Sequence[str],
) -> DataFrame:
    """Rows an insert-if-absent of ``batch`` in ``order_by`` order would add.

    ``unique_keys[0]`` is the primary key and has no nulls; the others may, and
    then never collide.  ``order_by`` must order the batch completely.
    """
    if len(unique_keys) == 1:
        # One key: the first row of each key wins.  De-duplicating before the
        # anti join leaves one row per key to shuffle, whatever the repeats.
        firsts = keep_first(batch, unique_keys[0], order_by)
        return firsts if target is None else new_records(firsts, target, unique_keys[0])
    return _greedy_insert(batch, target, unique_keys, order_by)


def _greedy_insert(
    batch: DataFrame,
    target: DataFrame | None,
    unique_keys: Sequence[Sequence[str]],
    order_by: Sequence[str],
) -> DataFrame:
    """Several unique keys: a row is refused only by a row that was itself accepted.

    When no two remaining rows collide all are accepted, which is the ordinary
    case.  Otherwise a round accepts the rows that come first under all their
    keys and drops the rows those collide with; the first remaining row always
    is among the accepted, so it ends.
    """
    batch = stored(batch, "batch")
    left = batch
    for keys in unique_keys:
        left = not_in_target(left, _only_in_batch(target, batch, keys), keys)
    left = stored(left, "insert-left")
    accepted = left.limit(0)
    place = F.struct(*order_by)
    while not left.isEmpty():
        if all(duplicate_keys(left, keys).isEmpty() for keys in unique_keys):
            return accepted.unionByName(left)
        winners = left
        for keys in unique_keys:
            firsts = left.na.drop(subset=list(keys)).groupBy(*keys).agg(F.min(place).alias("_first"))
            winners = (
                winners.join(firsts, list(keys), "left")
                .filter(F.col("_first").isNull() | (F.col("_first") == place))
                .select(*left.columns)
            )
        # Equal rows tie on everything: one of them is enough.
        winners = stored(winners.dropDuplicates(list(unique_keys[0])), "insert-won")
        accepted = accepted.unionByName(winners)
        for keys in unique_keys:
            left = not_in_target(left, winners, keys)
        left = stored(left, "insert-left")
    return accepted


def insert_if_absent(
    batch: DataFrame,
    path: str,
    unique_keys: Sequence[Sequence[str]],
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
) -> None:
    """Append the absent rows to the Parquet table at ``path`` (single writer).

    A table that does not exist yet is created.
    """
    target = read_if_present(batch, path)
    rows = rows_to_insert(batch, target, unique_keys, order_by)
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def read_if_present(like: DataFrame, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None while there is none."""
    spark = like.sparkSession
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.schema(like.schema).parquet(path) if fs.exists(jpath) else None


