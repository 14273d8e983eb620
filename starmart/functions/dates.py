"""Date parsing and calendar expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmart import codebooks


def _two_digits(text: Column) -> Column:
    text = F.trim(text.cast("string"))
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date from a known year and unpadded month and day; impossible days are null."""
    joined = F.concat(year.cast("string"), F.lit("-"), _two_digits(month), F.lit("-"), _two_digits(day))
    return F.try_to_date(joined, "yyyy-MM-dd")


def date_day_first(text: Column) -> Column:
    """Day-first date, ISO accepted as well."""
    return F.coalesce(F.try_to_date(text, "d/M/yyyy"), F.try_to_date(text, "yyyy-MM-dd"))


def date_any(text: Column) -> Column:
    """Compact, then ISO, then whatever the engine reads as a date."""
    text = F.trim(text)
    return F.coalesce(
        F.try_to_date(text, "yyyyMMdd"),
        F.try_to_date(text, "yyyy-MM-dd"),
        text.try_cast("date"),
    )


def year_in_text(text: Column) -> Column:
    """The first four digits in a row, which start every date form in use."""
    return F.nullif(F.regexp_extract(text, r"\d{4}", 0), F.lit("")).cast("int")


def last_year_in_name(name: Column) -> Column:
    """Last group of four digits in a file name, null when there is none."""
    years = F.regexp_extract_all(name, F.lit(r"(\d{4})"), 1)
    return F.try_element_at(years, F.lit(-1)).cast("int")


def iso_weekday(day: Column) -> Column:
    return F.weekday(day) + 1


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def _word(words: Sequence[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), position)


def day_name(day: Column) -> Column:
    return _word(codebooks.DAY_NAMES, iso_weekday(day))


def month_name(day: Column) -> Column:
    return _word(codebooks.MONTH_NAMES, F.month(day))


def season(day: Column) -> Column:
    month = F.month(day)
    expr = None
    for name, months in codebooks.SEASONS.items():
        expr = F.when(month.isin(months), name) if expr is None else expr.when(month.isin(months), name)
    return expr
