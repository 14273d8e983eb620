"""Helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fold(doc_id: Column | str, folds: int) -> Column:
    """The contract's fold of a row: crc32 of the id written as text, modulo ``folds``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary") if isinstance(doc_id, str) else doc_id) % folds


def least_hashed(rows: DataFrame, key: str, most: Callable[[object], int]) -> DataFrame:
    """``key, doc_id``: of each key's distinct ids the ``most(key)`` of least hash, nulls aside.

    Keys are few: they are counted and listed on the driver.  A cut on the hash that twice as many
    ids are expected to pass comes first, so what is ranked is as small as the sample, even
    where one key holds most of the rows.
    """
    ids = rows.where(F.col(key).isNotNull() & F.col("doc_id").isNotNull()).select(key, "doc_id")
    counts = {r[0]: r[1] for r in ids.groupBy(key).agg(F.approx_count_distinct("doc_id")).collect()}
    hashed = F.xxhash64("doc_id")
    passed, last = F.lit(False), F.lit(0)
    for value, n in sorted(counts.items()):
        cut = -(2**63) + int(min(1.0, 2 * most(value) / n) * 2**64)
        passed = passed | ((F.col(key) == F.lit(value)) & (hashed <= F.lit(min(cut, 2**63 - 1))))
        last = F.when(F.col(key) == F.lit(value), F.lit(most(value))).otherwise(last)
    turn = F.row_number().over(Window.partitionBy(key).orderBy("_hash", "doc_id"))
    few = ids.where(passed).distinct().withColumn("_hash", hashed)
    return few.withColumn("_turn", turn).where(F.col("_turn") <= last).select(key, "doc_id")


# Bytes of a batch that goes to Python, and rows that are taken out of it at once.
BATCH_BYTES = "8m"
BATCH_DEFAULT = 64 << 20
ROWS_AT_ONCE = 500

LONGEST_REMEMBERED = 80


class Remembered(dict):
    """Values of a function, computed once while they are in use.

    When ``most`` values are held they become the older half, in which values are still found
    and from which those that are used move over; the half before is dropped.  So the
    memory is bounded and common keys stay.  Long keys are not held.
    """

    def __init__(self, function: Callable, most: int) -> None:
        super().__init__()
        self.function, self.most, self.older = function, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        if len(key) <= LONGEST_REMEMBERED:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def bounded_batches(spark: SparkSession) -> None:
    """Lets a batch for Python hold ``BATCH_BYTES`` in place of Spark's default of 64 MB.

    A task's memory is a multiple of its batch.  Another value that the session has stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name).strip("bB") == str(BATCH_DEFAULT):
        spark.conf.set(name, BATCH_BYTES)


def per_row(df: DataFrame, schema: str, rows: Callable[[pa.RecordBatch], Iterator[dict | None] | dict]) -> DataFrame:
    """``mapInArrow`` with a function from one batch to a dict of columns.

    Batches are bounded in bytes and ``rows`` gets ``ROWS_AT_ONCE`` of one, so a task's memory does
    not grow with the table.  ``rows`` may return one dict of equally long columns or
    yield several.
    """
    bounded_batches(df.sparkSession)
    fields = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                made = rows(batch.slice(at, ROWS_AT_ONCE))
                for columns in [made] if isinstance(made, dict) else made:
                    arrays = [_array(columns[f.name], f.type) for f in fields]
                    yield pa.RecordBatch.from_arrays(arrays, schema=fields)

    return df.mapInArrow(run, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs run inside are removed as each of them ends."""
    before = spark.conf.get(FILE_CLEANUP, None)
    if before is None:
        yield
        return
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(FILE_CLEANUP, before)
