"""Cleaning, decoding and measure expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import codebooks

NBSP = "\u00a0"
BLANKS = " \t\n\r\f\u000b"
NUMBER = r"^[ \t]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[ \t]*$"
KMH_PER_MPH = 1.60934


def clean_text(text: Column) -> Column:
    """Drop no-break spaces, trim, and turn missing-value words into null."""
    # replace searches bytes; translate would look up every character of every cell
    trimmed = F.btrim(F.replace(text, F.lit(NBSP), F.lit("")), F.lit(BLANKS))
    missing = text.isin(codebooks.NULL_WORDS_AT_READ) | trimmed.isin(codebooks.NULL_WORDS_AFTER_TRIM)
    return F.when(~missing, trimmed)


def clean_strings(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """``clean_text`` over every string column in one projection."""
    return df.select(
        *[
            clean_text(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType) and f.name not in skip
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def to_number(text: Column) -> Column:
    """Double of a plain decimal literal; anything else is null.

    The pattern keeps out forms the cast would take but the sources do not mean
    as numbers ("7d", "NaN", "Infinity").
    """
    text = text.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_integer(text: Column) -> Column:
    """Number truncated toward zero."""
    return to_number(text).try_cast("bigint")


def safe_int(text: Column) -> Column:
    """Non-negative integer or null."""
    value = to_integer(text)
    return F.when(value >= 0, value)


def nonzero_code(text: Column) -> Column:
    """Positive integer code as text; zero and non-numeric codes are null."""
    value = to_integer(text)
    return F.when(value > 0, value.cast("string"))


def decimal_comma(text: Column) -> Column:
    return to_number(F.translate(text, ",", "."))


def numeric_or(df: DataFrame, name: str | None, default: float | None) -> Column:
    """Numeric value of a column, or a constant when the source lacks it."""
    if name is None:
        return F.lit(default).cast("double")
    return to_number(F.col(f"`{name}`"))


def label_map(book: Mapping[int, str]) -> Column:
    pairs = [F.lit(item) for code, label in book.items() for item in (code, label)]
    return F.create_map(*pairs)


def decode(code: Column, book: Mapping[int, str], default: str = "Unknown") -> Column:
    """Label of an integer code; unknown and unparsable codes get ``default``."""
    return F.coalesce(F.try_element_at(label_map(book), to_integer(code).try_cast("int")), F.lit(default))


def truncate(text: Column, width: int) -> Column:
    return F.substring(text, 1, width)


def bool_flag(text: Column) -> Column:
    """0/1 text to boolean; missing stays null."""
    return to_number(text) != F.lit(0.0)


def mph_to_kmh(speed: Column, legacy: bool = False) -> Column:
    if legacy:
        return speed.cast("int")
    return F.round(speed.cast("double") * F.lit(KMH_PER_MPH)).cast("int")


def age_from_birth_year(file_year: Column, birth: Column) -> Column:
    """File year minus birth year when the latter is written in digits."""
    written = birth.cast("string").rlike(r"^-?[0-9.]*[0-9][0-9.]*$")
    return F.when(written, (file_year.cast("bigint") - to_integer(birth)).cast("int"))


def round_half_up(value: Column, digits: int) -> Column:
    """Decimal rounding, half away from zero, returned as double.

    Ten extra digits absorb the last-bit noise of binary sums, so every engine
    with exact decimals agrees.
    """
    return F.round(value.cast("decimal(38,10)"), digits).cast("double")


def round2(value: Column) -> Column:
    return round_half_up(value, 2)


def mean2(total: Column, count: Column) -> Column:
    """Rounded mean from a sum and a count; null for an empty group."""
    return round2(F.when(count > 0, total.cast("double") / count))


def victims(killed: Column, serious: Column, slight: Column) -> Column:
    return killed + serious + slight


def severity_index(killed: Column, serious: Column, slight: Column) -> Column:
    return (killed * 3 + serious * 2 + slight).cast("double")


def severity_band(index: Column) -> Column:
    return (
        F.when(index >= 10, "10+")
        .when(index >= 4, "4-9")
        .when(index >= 1, "1-3")
        .when(index >= 0, "0")
    )


def scaled_score(value: Column, low: Column, high: Column) -> Column:
    """Linear map of [low, high] to [1, 5]; a flat range scores 1."""
    return F.when(high > low, F.lit(1.0) + F.lit(4.0) * (value - low) / (high - low)).otherwise(
        F.when(value.isNotNull(), F.lit(1.0))
    )


def weather_label(
    rain: Column,
    wind: Column,
    temp_max: Column,
    rain_above: float = 2.0,
    wind_from: float = 40.0,
    warm_from: float = 20.0,
) -> Column:
    """First matching weather word; missing measures never match."""
    return (
        F.when(F.coalesce(rain, F.lit(0.0)) > rain_above, "pluie")
        .when(wind >= wind_from, "vent_fort")
        .when(temp_max >= warm_from, "ensoleille")
        .otherwise("nuageux")
    )


def zone(departement: Column, district: Column) -> Column:
    return F.coalesce(departement, district)


def title_kind(title: Column) -> Column:
    """File kind named by a resource title; the first matching rule wins."""
    low = F.lower(title)
    return (
        F.when(low.contains("caract") | low.contains("carct"), "caracteristiques")
        .when(low.contains("lieu"), "lieux")
        .when(low.contains("imm"), "vehicules_immatricules")
        .when(low.contains("vehicules_") | low.contains("vehicules-2"), "vehicules")
        .when(low.contains("usag"), "usagers")
    )


def first_listed_year(title: Column, years: Sequence[int]) -> Column:
    """First year of the list whose digits occur in the title."""
    return F.coalesce(*[F.when(title.contains(str(y)), F.lit(y)) for y in years])
