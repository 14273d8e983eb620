"""Calendar dimension and public holidays."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.functions import dates, scalars
from starmart.schemas import TABLES

# Public holidays by rule.  Offsets are days from Easter Sunday.
FR_FIXED = [(1, 1), (5, 1), (5, 8), (7, 14), (8, 15), (11, 1), (11, 11), (12, 25)]
FR_EASTER = [1, 39, 50]
UK_EASTER = [-2, 1]
UK_FIRST_MONDAYS = [5]
UK_LAST_MONDAYS = [(5, 31), (8, 31)]
# Month, day, and the days to add when it falls on a Saturday or a Sunday.
UK_WITH_SUBSTITUTE = [(1, 1, 2, 1), (12, 25, 2, 2), (12, 26, 2, 2)]
# One-off days, (country, date).
ONE_OFF = [("UK", "1999-12-31"), ("UK", "2002-06-03"), ("UK", "2011-04-29"), ("UK", "2012-06-05")]


def with_easter(years: DataFrame, year: str = "annee") -> DataFrame:
    """Add Easter Sunday (Gregorian) to a table of years."""
    return (
        years.withColumn("_a", F.expr(f"{year} % 19"))
        .withColumn("_b", F.expr(f"{year} div 100"))
        .withColumn("_c", F.expr(f"{year} % 100"))
        .withColumn("_h", F.expr("(19 * _a + _b - _b div 4 - (_b - (_b + 8) div 25 + 1) div 3 + 15) % 30"))
        .withColumn("_l", F.expr("(32 + 2 * (_b % 4) + 2 * (_c div 4) - _h - _c % 4) % 7"))
        .withColumn("_p", F.expr("_h + _l - 7 * ((_a + 11 * _h + 22 * _l) div 451) + 114"))
        .withColumn("paques", F.expr(f"make_date({year}, cast(_p div 31 as int), cast(_p % 31 + 1 as int))"))
        .drop("_a", "_b", "_c", "_h", "_l", "_p")
    )


def _day(month: int, day: int) -> Column:
    return F.make_date(F.col("annee"), F.lit(month), F.lit(day))


def _with_substitute(month: int, day: int, saturday: int, sunday: int) -> list[Column]:
    own = _day(month, day)
    shift = F.when(F.weekday(own) == 5, saturday).when(F.weekday(own) == 6, sunday).otherwise(0)
    return [own, F.date_add(own, shift)]


def holidays(years: DataFrame) -> DataFrame:
    """(country, date) of every public holiday of the given years (column ``annee``).

    About thirty rows a year, whatever the size of the facts.
    """
    table = with_easter(years.select("annee").distinct())
    fr = [_day(m, d) for m, d in FR_FIXED] + [F.date_add("paques", n) for n in FR_EASTER]
    uk = [F.date_add("paques", n) for n in UK_EASTER]
    # next_day is strictly later, so step back a day to allow the day itself.
    uk += [F.next_day(F.date_sub(_day(m, 1), 1), "Mon") for m in UK_FIRST_MONDAYS]
    uk += [F.next_day(F.date_sub(_day(m, d), 7), "Mon") for m, d in UK_LAST_MONDAYS]
    for rule in UK_WITH_SUBSTITUTE:
        uk += _with_substitute(*rule)
    one_off = [
        F.struct(F.lit(c).alias("country"), F.when(F.year(F.lit(d)) == F.col("annee"), F.lit(d).cast("date")).alias("date"))
        for c, d in ONE_OFF
    ]
    entries = [F.struct(F.lit("FR").alias("country"), d.alias("date")) for d in fr]
    entries += [F.struct(F.lit("UK").alias("country"), d.alias("date")) for d in uk]
    return (
        table.select(F.inline(F.array(*entries, *one_off)))
        .filter(F.col("date").isNotNull())
        .distinct()
    )


def holiday_flags(years: DataFrame) -> DataFrame:
    """One row per holiday date with a flag per country."""
    return holidays(years).groupBy("date").agg(
        F.max(F.col("country") == "FR").alias("est_ferie_fr"),
        F.max(F.col("country") == "UK").alias("est_ferie_uk"),
    )


def days_of_years(spark: SparkSession, years: Sequence[int]) -> DataFrame:
    """Every valid date of the listed years (365 or 366 rows each)."""
    table = spark.createDataFrame([(y,) for y in years], "annee int")
    span = F.sequence(_day(1, 1), _day(12, 31))
    return table.select(F.explode(span).alias("date"))


def days_spanned(frames: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Every date between the first and the last one seen in the given columns."""
    ends = [df.agg(F.min(c).cast("date").alias("a"), F.max(c).cast("date").alias("b")) for df, c in frames]
    both = reduce(DataFrame.unionByName, ends).agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return both.filter(F.col("a").isNotNull()).select(F.explode(F.sequence("a", "b")).alias("date"))


def calendar_staging(days: DataFrame) -> DataFrame:
    """All calendar parts and both countries' holiday flags."""
    flags = holiday_flags(days.select(F.year("date").alias("annee")))
    day = F.col("date")
    return days.join(flags, "date", "left").select(
        "date",
        F.dayofmonth(day).alias("jour"),
        F.month(day).alias("mois"),
        F.year(day).alias("annee"),
        F.quarter(day).alias("trimestre"),
        dates.iso_weekday(day).alias("jour_semaine"),
        dates.day_name(day).alias("nom_jour"),
        dates.month_name(day).alias("nom_mois"),
        dates.is_weekend(day).cast("int").alias("est_weekend"),
        F.coalesce(F.col("est_ferie_fr"), F.lit(False)).cast("int").alias("est_ferie_fr"),
        F.coalesce(F.col("est_ferie_uk"), F.lit(False)).cast("int").alias("est_ferie_uk"),
        dates.season(day).alias("saison"),
    )


def number_days(staging: DataFrame) -> DataFrame:
    """Add ``id_temps`` 1, 2, ... in date order.

    Position within the year plus the days of the earlier years present: the
    only ordering window runs over one row per year.
    """
    per_year = staging.groupBy("annee").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("annee").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_year.select("annee", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("annee").orderBy("date"))
    return (
        staging.join(offsets, "annee")
        .withColumn("id_temps", (F.col("_off") + inside).cast("int"))
        .select("id_temps", *staging.columns)
    )


def dim_temps(staging: DataFrame, holiday: str = "est_ferie_fr") -> DataFrame:
    """Warehouse time table from calendar staging: rename, drop, flags to boolean, no hour."""
    flag = {c: scalars.bool_flag(F.col(c)) for c in ("est_weekend", holiday)}
    shaped = staging.withColumnRenamed("id_temps", "id_date").select(
        "id_date",
        F.col("date").cast("date"),
        "annee",
        "mois",
        "jour",
        F.lit(None).cast("int").alias("heure"),
        "saison",
        flag["est_weekend"].alias("est_weekend"),
        flag[holiday].alias("est_jour_ferie"),
    )
    return shaped.select(*[F.col(f.name).cast(f.dataType) for f in TABLES["dim_temps"].fields])
