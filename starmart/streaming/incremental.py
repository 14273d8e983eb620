"""Incremental load as a stream of arriving files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from starmart.operators.loading import insert_if_absent


def load_stream(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    unique_keys: Sequence[Sequence[str]],
    order_by: Sequence[str],
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Insert-if-absent of every Parquet file that arrived below ``source``.

    A batch that is run again after a failure finds its rows present and adds
    nothing, so no state and no watermark is kept.  Runs until all files are
    taken and then stops.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def add(batch: DataFrame, _batch_id: int) -> None:
        insert_if_absent(batch, target, unique_keys, order_by)

    return (
        reader.parquet(source)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
