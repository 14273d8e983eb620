"""Records of delimited files whose quoted fields run over line ends.

A line maps "is a quoted field open before it" to "is one open after it".  Such maps are constant,
the identity or a flip, so the state before any line is the last constant before it, turned by
the flips since: a running sum in each file block.  The blocks of a file are put
together the same way, and lines then meet the line their record starts with.  No file is
read by one task, and a record may run over the border of blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.sources.scratch import stored

QUOTE = '"'
# Within a line: outside of quotes, inside, right behind a quote that may have closed, at the line's start.
OUTSIDE, INSIDE, CLOSED, START = range(4)


def open_after(line: Column, sep: str, start: int) -> Column:
    """1 if a quoted field is open at the end of ``line``, else 0; ``start`` is ``START`` or ``INSIDE``.

    A quote opens a field only where the field begins, and a doubled one inside is text.
    """
    pieces = F.split(line, QUOTE, -1)

    def at_quote(state: Column, before: Column) -> Column:
        begins = before.endswith(sep) | ((state == START) & (before == ""))
        return (
            F.when(state == INSIDE, CLOSED)
            .when((state == CLOSED) & (before == ""), INSIDE)
            .otherwise(F.when(begins, INSIDE).otherwise(OUTSIDE))
        )

    last = F.aggregate(F.slice(pieces, 1, F.size(pieces) - 1), F.lit(start), at_quote)
    return F.when(line.contains(QUOTE), (last == INSIDE).cast("int")).otherwise(int(start == INSIDE))


def _with_state(rows: DataFrame, closed: str, opened: str, keys: Sequence[str], place: str) -> DataFrame:
    """``_zero`` and ``_one``: the state before each row if the first row of its group is met with 0 or 1.

    ``closed`` and ``opened`` are the states a row makes of 0 and of 1.
    """
    before = Window.partitionBy(*keys).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    flip = ((F.col(closed) == 1) & (F.col(opened) == 0)).cast("int")
    turned = rows.withColumn("_flips", F.coalesce(F.sum(flip).over(before), F.lit(0)))
    constant = F.when(F.col(closed) == F.col(opened), F.struct(F.col(closed).alias("state"), F.col("_flips").alias("flips")))
    known = turned.withColumn("_known", F.last(constant, ignorenulls=True).over(before))
    fixed = (F.col("_known.state") + F.col("_flips") - F.col("_known.flips")) % 2
    turns = F.col("_flips") % 2
    return known.withColumn("_zero", F.coalesce(fixed, turns)).withColumn("_one", F.coalesce(fixed, 1 - turns)).drop("_flips", "_known")


def read_records(spark: SparkSession, paths: Sequence[str], sep: str, encoding: str = "UTF-8") -> DataFrame:
    """``src_file, src_block, src_row, record``: the records behind the header, lines joined by a line feed.

    The block is that of the record's first line, and rows run up in it.  Blank lines between
    records are no records.  A file that ends inside quotes is an error, as no reading of it
    is the right one.
    """
    value = F.col("value") if encoding == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    read = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        value.alias("value"),
    )
    states = read.select("*", open_after(F.col("value"), sep, START).alias("closed"), open_after(F.col("value"), sep, INSIDE).alias("opened"))
    lines = stored(_with_state(states, "closed", "opened", ["src_file", "block"], "at"), "quoted-lines")

    def after(state: str) -> Column:
        return F.when(F.col(state) == 1, F.col("opened")).otherwise(F.col("closed"))

    sums = lines.groupBy("src_file", "block").agg(
        F.max_by(after("_zero"), "at").alias("closed"),
        F.max_by(after("_one"), "at").alias("opened"),
        F.count_if(F.col("_zero") == 0).alias("starts_closed"),
        F.count_if(F.col("_one") == 0).alias("starts_opened"),
    )
    met = _with_state(sums, "closed", "opened", ["src_file"], "block").withColumnRenamed("_zero", "met").drop("_one")
    starts = F.when(F.col("met") == 1, F.col("starts_opened")).otherwise(F.col("starts_closed"))
    earlier = Window.partitionBy("src_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.when(F.col("starts") > 0, F.struct("block", F.col("starts").alias("row")))
    blocks = met.withColumn("starts", starts).withColumn("left", after("met")).withColumn("begun", F.last(begun, ignorenulls=True).over(earlier))
    blocks = stored(blocks.select("src_file", "block", "met", "left", "begun"), "quoted-blocks")
    ends = blocks.groupBy("src_file").agg(F.max_by("left", "block").alias("left"))
    unclosed = ends.where("left = 1").select("src_file").limit(1).collect()
    if unclosed:
        raise ValueError(f"a quoted field is never closed in {unclosed[0]['src_file']}")

    placed = lines.join(blocks, ["src_file", "block"])
    begins = F.when(F.col("met") == 1, F.col("_one")).otherwise(F.col("_zero")) == 0
    upto = Window.partitionBy("src_file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("row", F.sum(begins.cast("long")).over(upto))
    own = F.struct("block", "row")
    joined = (
        placed.withColumn("first", F.when(F.col("row") > 0, own).otherwise(F.col("begun")))
        .groupBy("src_file", F.col("first.block").alias("src_block"), F.col("first.row").alias("src_row"))
        .agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("lines"))
    )
    records = joined.select("src_file", "src_block", "src_row", F.array_join(F.col("lines.value"), "\n").alias("record"))
    header = (F.col("src_block") == 0) & (F.col("src_row") == 1)
    return records.where(~header & (F.trim("record") != ""))
