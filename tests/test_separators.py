"""Separators are counted by bytes, whatever the encoding of the line."""

import pytest
from pyspark.sql import functions as F

from starmart.functions.scalars import clean_text
from starmart.sources import delimited


@pytest.mark.parametrize("text, found", [("café;x;y", 2), (";é;", 2), ("", 0), ("é", 0), ('"a;b";c', 2)])
@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_separators_of_a_raw_line(spark, text, found, encoding):
    """A Latin-1 letter before a separator looks like the start of a longer character."""
    line = spark.createDataFrame([(bytearray(text.encode(encoding)),)], "b binary").select(F.col("b").cast("string").alias("value"))
    row = line.select(delimited._occurrences(F.col("value"), ";"), delimited._occurrences(delimited._unquoted(F.col("value")), ";")).first()
    assert tuple(row) == (found, 1 if '"' in text else found)


def test_cells_are_searched_and_not_looked_up_by_character(spark):
    cells = spark.createDataFrame([(" a b ",), (" NA",), (" nan ",), (None,), ("é ",)], "t string")
    assert [r[0] for r in cells.select(clean_text(F.col("t"))).collect()] == ["ab", "NA", None, None, "é"]
    assert "translate" not in cells.select(clean_text(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
