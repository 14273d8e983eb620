"""The analytical questions over a star of DataFrames.

Each function takes the star's tables.  Country, calendar and weather have at most
one row per country and day: the warehouse marks them for broadcast after counting
them, and a larger one is joined by shuffle.  Place, person and vehicle grow with
the facts; no hint is given for them, so Spark shuffles them by key, splits skewed
keys, and broadcasts them only when their measured size is below its limit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.scalars import mean2, severity_band, zone
from starmart.operators.ordered import global_rank

DAY_KEY = ["id_pays", "date"]
SERIOUS_ABOVE = 4


@dataclass
class Star:
    fact: DataFrame
    country: DataFrame
    calendar: DataFrame
    place: DataFrame
    weather: DataFrame
    person: DataFrame
    vehicle: DataFrame


def _with_weather(star: Star, fact: DataFrame) -> DataFrame:
    return fact.join(star.weather.select(*DAY_KEY, "conditions"), DAY_KEY)


def _with_country(star: Star, df: DataFrame) -> DataFrame:
    return df.join(star.country.select("id_pays", "nom_pays"), "id_pays")


def _severity(out: str = "gravite_moyenne") -> Column:
    return mean2(F.sum("indice_gravite"), F.count("indice_gravite")).alias(out)


def _count(out: str) -> Column:
    return F.count(F.lit(1)).alias(out)


def _daily(star: Star, fact: DataFrame) -> DataFrame:
    """Accidents, victims and severity per country and day, with the day's weather.

    A day's accidents share their weather, so the fact is reduced before it meets
    the weather table: a few hundred rows leave each task, and neither side of the
    join is large or skewed.
    """
    days = fact.groupBy(*DAY_KEY).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("nb_victimes_total").alias("_victims"),
        F.sum("indice_gravite").alias("_sum"),
        F.count("indice_gravite").alias("_cnt"),
    )
    return _with_weather(star, days)


def _daily_severity(out: str = "gravite_moyenne") -> Column:
    return mean2(F.sum("_sum"), F.sum("_cnt")).alias(out)


def _daily_count(out: str) -> Column:
    return F.sum("_n").cast("bigint").alias(out)


def victims_by_weather(star: Star) -> DataFrame:
    victims = F.sum("_victims").cast("bigint").alias("nb_victimes_meteo")
    return _daily(star, star.fact).groupBy("conditions").agg(victims)


def top_days(star: Star, size: int = 10) -> DataFrame:
    return (
        _daily(star, star.fact)
        .groupBy("date", "conditions")
        .agg(_daily_count("nb_accident"))
        .orderBy(F.desc("nb_accident"), "date", "conditions")
        .limit(size)
    )


def severity_by_country(star: Star) -> DataFrame:
    return star.fact.groupBy("id_pays").agg(F.sum("indice_gravite").alias("gravite"))


def _severity_by_place(star: Star) -> DataFrame:
    """Summed before the place table is met: it only confirms the (country, place) pair."""
    sums = star.fact.groupBy("id_pays", "id_lieu").agg(F.sum("indice_gravite").alias("gravite"))
    return sums.join(star.place.select("id_pays", "id_lieu"), ["id_pays", "id_lieu"], "left_semi")


def severity_by_place_top10(star: Star, size: int = 10) -> DataFrame:
    return (
        _severity_by_place(star)
        .orderBy(F.col("gravite").desc_nulls_last(), "id_pays", "id_lieu")
        .limit(size)
    )


def severity_by_place_weather(star: Star) -> DataFrame:
    sums = (
        _with_weather(star, star.fact)
        .groupBy("id_pays", "id_lieu", "conditions")
        .agg(F.sum("indice_gravite").alias("gravite"))
    )
    return sums.join(star.place.select("id_pays", "id_lieu"), ["id_pays", "id_lieu"], "left_semi")


def severity_rank_global(star: Star) -> DataFrame:
    return global_rank(severity_by_place_weather(star), "gravite", "rang")


def avg_severity_by_weather_country(star: Star) -> DataFrame:
    return (
        _with_country(star, _daily(star, star.fact))
        .groupBy("nom_pays", "conditions")
        .agg(_daily_severity(), _daily_count("nb_accidents"))
        .orderBy("nom_pays", F.col("gravite_moyenne").desc_nulls_last(), "conditions")
    )


def _serious(star: Star, min_exclusive: float) -> DataFrame:
    return star.fact.filter(F.col("indice_gravite") > min_exclusive)


def serious_by_weather(star: Star, min_exclusive: float = SERIOUS_ABOVE) -> DataFrame:
    return (
        _daily(star, _serious(star, min_exclusive))
        .groupBy("conditions")
        .agg(_daily_count("nb_accidents_graves"), _daily_severity())
        .orderBy(F.col("gravite_moyenne").desc_nulls_last(), "conditions")
    )


def serious_by_zone(
    star: Star, min_exclusive: float = SERIOUS_ABOVE, at_least: int = 50, size: int = 20
) -> DataFrame:
    """Group by both zone columns, show their first known one.

    The place join comes first: it is the one that shuffles, and the rows are
    still without labels there.
    """
    place = star.place.select("id_lieu", "departement", "district")
    placed = _serious(star, min_exclusive).join(place, "id_lieu")
    return (
        _with_country(star, _with_weather(star, placed))
        .groupBy("nom_pays", "departement", "district", "conditions")
        .agg(_count("nb_accidents_graves"), _severity())
        .filter(F.col("nb_accidents_graves") >= at_least)
        .select(
            "nom_pays",
            zone(F.col("departement"), F.col("district")).alias("zone"),
            "conditions",
            "nb_accidents_graves",
            "gravite_moyenne",
        )
        .orderBy(F.col("gravite_moyenne").desc_nulls_last(), "nom_pays", "zone", "conditions")
        .limit(size)
    )


def _with_sex(star: Star) -> DataFrame:
    return star.fact.join(star.person.select("id_usager", "sexe"), "id_usager")


def accidents_by_sex_severity(star: Star) -> DataFrame:
    """The person is the one the accident points at, so each accident is one row here."""
    counts = (
        _with_sex(star)
        .groupBy("id_pays", "sexe", "indice_gravite")
        .agg(F.count(F.lit(1)).alias("nb_accidents"))
    )
    return _with_country(star, counts).select("id_pays", "nom_pays", "sexe", "indice_gravite", "nb_accidents")


def accidents_by_sex_severity_literal(star: Star) -> DataFrame:
    """People joined on country alone, without building that product.

    A (country, severity) pair counts the same accidents for every sex present
    in the country, so both sides are reduced first.
    """
    accidents = star.fact.groupBy("id_pays", "indice_gravite").agg(
        F.count(F.lit(1)).alias("nb_accidents")
    )
    sexes = star.person.select("id_pays", "sexe").distinct()
    both = _with_country(star, accidents.join(sexes, "id_pays"))
    return both.select("id_pays", "nom_pays", "sexe", "indice_gravite", "nb_accidents")


def accidents_by_sex_severity_rollup(star: Star) -> DataFrame:
    """Country, sex and severity band with sub-totals; ``gid`` names the level.

    Counted to the finest level first, so that the roll-up copies counts only.
    """
    keys = ["nom_pays", "sexe", "tranche"]
    grain = (
        _with_country(star, _with_sex(star))
        .groupBy("nom_pays", "sexe", severity_band(F.col("indice_gravite")).alias("tranche"))
        .agg(_count("_n"))
    )
    return grain.rollup(*keys).agg(
        F.grouping_id().cast("bigint").alias("gid"), F.sum("_n").cast("bigint").alias("nb_accidents")
    )


def severity_holiday_weather(star: Star) -> DataFrame:
    """Mean severity on holidays and other days, by weather."""
    return (
        _daily(star, star.fact)
        .join(star.calendar.select("date", "est_jour_ferie"), "date")
        .groupBy("est_jour_ferie", "conditions")
        .agg(_daily_count("nb_accidents"), _daily_severity())
    )


def severity_holiday_by_country(star: Star, holidays: DataFrame) -> DataFrame:
    """The same, an accident being judged by the holidays (id_pays, date) of its own country."""
    own = holidays.select(*DAY_KEY, F.lit(True).alias("est_jour_ferie"))
    return (
        _daily(star, star.fact)
        .join(own, DAY_KEY, "left")
        .groupBy(F.coalesce("est_jour_ferie", F.lit(False)).alias("est_jour_ferie"), "conditions")
        .agg(_daily_count("nb_accidents"), _daily_severity())
    )


def severity_bands(star: Star) -> DataFrame:
    return star.fact.groupBy(severity_band(F.col("indice_gravite")).alias("tranche")).agg(
        F.count(F.lit(1)).alias("nb_accidents")
    )
