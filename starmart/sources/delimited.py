"""Delimited text files of unknown separator, encoding and header."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.dates import last_year_in_name
from starmart.functions.scalars import BLANKS, NBSP, clean_strings
from starmart.plans.star import POSITION
from starmart.sources.records import START, open_after, read_records

SEPARATORS = [",", ";", "\t", " "]
CORRUPT = "_corrupt_record"


def list_files(spark: SparkSession, root: str | Sequence[str], pattern: str = "*") -> DataFrame:
    """(path, name, length) of the files below ``root``; contents are not read."""
    roots = [root] if isinstance(root, str) else list(root)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(roots)
    )
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def _occurrences(text: Column, piece: str) -> Column:
    """How often the character ``piece`` occurs."""
    if len(piece.encode()) > 1:
        return F.length(text) - F.length(F.translate(text, piece, ""))
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(piece), F.lit("")))


def _unquoted(text: Column) -> Column:
    return F.when(text.contains('"'), F.regexp_replace(text, '"[^"]*"', "")).otherwise(text)


def manifest(
    files: DataFrame, separators: Sequence[str] = SEPARATORS, default: str = ","
) -> DataFrame:
    """Per file: encoding, separator, header, the year in its name, and whether quoted fields run over line ends.

    Every line of every file is looked at, in one distributed pass.  The encoding is UTF-8
    when all lines are valid UTF-8, else Latin-1.  The separator is the candidate whose count in
    the header is the usual count of the file's lines; of several, or if none is, the one
    that occurs most in the header, the earlier one on a tie.
    """
    spark = files.sparkSession
    paths = [row["path"] for row in files.select("path").collect()]
    schema = "path string, name string, length bigint, encoding string, ligne string, sep string, n_sep int, annee int, coupe boolean"
    if not paths:
        return spark.createDataFrame([], schema)
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id(), "value").alias("line"),
        "value",
    )
    unquoted = _unquoted(F.col("value"))
    usual = [F.mode(_occurrences(unquoted, s), deterministic=True).alias(f"usual_{i}") for i, s in enumerate(separators)]
    # no line that starts outside of quotes ends inside of them: every line is a record
    cut = [F.bool_or(open_after(F.col("value"), s, START) == 1).alias(f"cut_{i}") for i, s in enumerate(separators)]
    seen = lines.groupBy("path").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("valid"), F.min("line")["value"].alias("first"), *usual, *cut
    )
    known = files.select("path", "name", "length").join(seen, "path", "left")
    decoded = F.when(F.col("valid"), F.col("first")).otherwise(F.decode(F.col("first").cast("binary"), "ISO-8859-1"))
    line = F.btrim(F.coalesce(decoded, F.lit("")), F.lit("\r\n\ufeff"))
    counts = [_occurrences(F.col("ligne"), s) for s in separators]
    best = F.array_max(
        F.array(
            *[
                F.struct(
                    ((n > 0) & (n == F.col(f"usual_{i}"))).alias("usual"),
                    n.alias("n"),
                    F.lit(-i).alias("rang"),
                    F.lit(s).alias("sep"),
                    F.coalesce(f"cut_{i}", F.lit(False)).alias("coupe"),
                )
                for i, (n, s) in enumerate(zip(counts, separators, strict=True))
            ]
        )
    )
    encoding = F.when(F.coalesce("valid", F.lit(True)), "UTF-8").otherwise("ISO-8859-1")
    return (
        known.withColumn("encoding", encoding)
        .withColumn("ligne", line)
        .withColumn("best", best)
        .select(
            "path",
            "name",
            "length",
            "encoding",
            "ligne",
            F.when(F.col("best.n") > 0, F.col("best.sep")).otherwise(default).alias("sep"),
            F.col("best.n").alias("n_sep"),
            last_year_in_name(F.col("name")).alias("annee"),
            ((F.col("best.n") > 0) & F.col("best.coupe")).alias("coupe"),
        )
    )


def recent_files(files: DataFrame, min_year: int) -> DataFrame:
    """Files whose last year in the name is not before ``min_year``; undated names stay."""
    last = last_year_in_name(F.col("name"))
    return files.filter(last.isNull() | (last >= min_year))


@dataclass
class Layout:
    """Files that share separator, encoding, header and way of reading, read as one table."""

    columns: list[str]
    rows: DataFrame


def header_names(line: str, sep: str) -> list[str]:
    names = [n.replace(NBSP, "").strip(BLANKS).strip('"') for n in line.split(sep)]
    return [n or f"_c{i}" for i, n in enumerate(names)]


def read_layouts(spark: SparkSession, described: DataFrame, spread: int | None = None) -> list[Layout]:
    """Read every file of a manifest, one scan per distinct layout.

    Only the manifest (paths and headers) comes to the driver, which Spark needs
    for its file index anyway.
    """
    groups: dict[tuple[str, str, str, bool], list[str]] = {}
    for row in described.select("path", "sep", "encoding", "ligne", "coupe").collect():
        groups.setdefault((row["sep"], row["encoding"], row["ligne"], row["coupe"]), []).append(row["path"])
    layouts = []
    for (sep, encoding, line, cut), paths in sorted(groups.items()):
        columns = header_names(line, sep)
        layouts.append(Layout(columns, read_delimited(spark, sorted(paths), columns, sep, encoding, spread, cut)))
    return layouts


def read_delimited(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Sequence[str],
    sep: str,
    encoding: str = "UTF-8",
    spread: int | None = None,
    cut: bool = False,
) -> DataFrame:
    """Text columns of headed files, cleaned, with each row's source position.

    Rows with too many fields are dropped, rows with too few are filled with
    nulls.  The parser only reports "other field count", so the reported line is
    counted again, quoted parts left aside.  ``spread`` redistributes the rows
    over that many tasks, for gzip files that a single task has to unpack.
    ``cut`` files have quoted fields over line ends: their lines are put together first.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "quote": '"', "escape": '"'}
    too_many = _occurrences(_unquoted(F.col(CORRUPT)), sep) > len(columns) - 1
    # Never true; keeps a data column in the scan, without which the reported line cannot be read.
    no_line = F.length(F.col(f"`{columns[0]}`")) < 0
    wanted = ~F.coalesce(too_many, no_line, F.lit(False))
    if cut:
        fields = ", ".join(f"`{name}` string" for name in (c.replace("`", "``") for c in schema.fieldNames()))
        parsed = read_records(spark, paths, sep, encoding).withColumn("record", F.from_csv("record", fields, options))
        fitting = parsed.select("record.*", "src_file", "src_block", "src_row").filter(wanted)
        # rows kept of one block run up by one, as below
        row = F.row_number().over(Window.partitionBy("src_file", "src_block").orderBy("src_row"))
        placed = fitting.drop(CORRUPT).withColumn("src_row", row.cast("long"))
    else:
        raw = spark.read.schema(schema).options(header=True, encoding=encoding, columnPruning=False, **options).csv(list(paths))
        fitting = raw.select(
            "*",
            F.col("_metadata.file_path").alias("src_file"),
            F.col("_metadata.file_block_start").alias("src_block"),
        ).filter(wanted)
        # Numbered after the filter: rows kept of one split run up by one.
        placed = fitting.drop(CORRUPT).withColumn("src_row", F.monotonically_increasing_id())
    cleaned = clean_strings(placed, skip=["src_file"])
    return cleaned.repartition(spread) if spread else cleaned


def read_all(spark: SparkSession, described: DataFrame, spread: int | None = None) -> DataFrame:
    """All layouts in one table; a column a file lacks is null there."""
    frames = [layout.rows for layout in read_layouts(spark, described, spread)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def position() -> Column:
    """Orderable position of a row: file, block, row.  Rows of one block are numbered upward."""
    return F.struct(*POSITION)


def missing_sources(present: DataFrame, wanted: DataFrame, keys: Sequence[str], on_missing: str = "skip") -> DataFrame:
    """Wanted sources with ``present`` true or false; ``error`` raises when one is absent."""
    found = present.select(*keys).distinct().withColumn("present", F.lit(True))
    report = wanted.join(found, list(keys), "left").withColumn("present", F.coalesce("present", F.lit(False)))
    if on_missing == "error":
        absent = report.filter(~F.col("present")).limit(1).collect()
        if absent:
            raise FileNotFoundError(f"missing source: {absent[0].asDict()}")
    return report
