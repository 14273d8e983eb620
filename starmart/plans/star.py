"""Dimensions and fact from staged accidents, people and vehicles."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import codebooks
from starmart.functions.scalars import severity_index, victims
from starmart.operators.keys import block_ids, dense_ids, first_per_key
from starmart.schemas import TABLES
from starmart.sources.scratch import stored

ENTITY_ORDER = ["id_pays", "annee", "pos"]
# Accident numbers are those of a country and year; another year may use one again.
ENTITY_KEY = ["id_pays", "annee", "cle"]
# Fields of a position that was given while reading files.
POSITION = ["src_file", "src_block", "src_row"]


@dataclass
class Staging:
    """Both countries in one shape.

    ``cle`` is the accident's key in its source, ``pos`` an orderable source
    position, ``veh_src`` the vehicle's number inside the accident ('' when the
    source has none to match on).

    * accidents: id_pays, annee, cle, date, pos
    * places: id_pays, annee, cle, pos and the place columns
    * people: id_pays, annee, cle, veh_src, pos and the person columns
    * vehicles: id_pays, annee, cle, veh_src, pos and the vehicle columns
    """

    accidents: DataFrame
    places: DataFrame
    people: DataFrame
    vehicles: DataFrame

    def union(self, other: "Staging") -> "Staging":
        return Staging(
            *[
                getattr(self, part).unionByName(getattr(other, part))
                for part in ("accidents", "places", "people", "vehicles")
            ]
        )


@dataclass
class KeyedStaging:
    """Staging with surrogate keys."""

    accidents: DataFrame
    places: DataFrame
    people: DataFrame
    vehicles: DataFrame
    starts: Mapping[str, int] = field(default_factory=dict)


def number_entities(df: DataFrame, id_col: str, start: int = 1) -> DataFrame:
    """Key one entity table in source order.

    Rows as read from files are stored, so that the files are parsed once, and
    numbered where they are; others are sorted into key order.
    """
    if df.schema["pos"].dataType.fieldNames() == POSITION:
        df = stored(df, "staged")
        block = ["id_pays", "annee", *POSITION[:-1]]
        flat = df.select("*", "pos.*")
        numbered = block_ids(flat, id_col, block, POSITION[-1], start, ["pos", *POSITION])
        if numbered is not None:
            return numbered
    return dense_ids(df, id_col, ENTITY_ORDER, start, drop=["pos"])


def assign_keys(
    staging: Staging, starts: Mapping[str, int] | None = None, kept: DataFrame | None = None
) -> KeyedStaging:
    """Number every entity in source order, countries and years in turn.

    ``kept`` (key and id_accident) are accidents that have a number and keep it.
    """
    starts = dict(starts or {})

    def number(df: DataFrame, id_col: str) -> DataFrame:
        return number_entities(df, id_col, starts.get(id_col, 1))

    def number_accidents(df: DataFrame) -> DataFrame:
        if kept is None:
            return number(df, "id_accident")
        df = stored(df, "accidents")
        old = df.join(kept.select(*ENTITY_KEY, "id_accident").hint("merge"), ENTITY_KEY)
        # a number that is listed twice keeps its id once; the others are new rows
        first = first_per_key(old, ["id_accident"], ["pos"]).select("id_accident", *df.columns)
        taken = first.select(*ENTITY_KEY, "pos")
        rest = dense_ids(df.join(taken, [*ENTITY_KEY, "pos"], "left_anti"), "id_accident", ENTITY_ORDER, starts.get("id_accident", 1))
        return first.unionByName(rest).drop("pos")

    return KeyedStaging(
        number_accidents(staging.accidents),
        number(staging.places, "id_lieu"),
        number(staging.people, "id_usager"),
        number(staging.vehicles, "id_vehicule"),
        starts,
    )


def shaped(df: DataFrame, table: str, *more: str) -> DataFrame:
    """The warehouse columns and types of ``table``, and ``more`` columns as they are."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[table].fields], *more)


def dim_pays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(codebooks.COUNTRIES, TABLES["dim_pays"])


def person_measures(people: DataFrame) -> DataFrame:
    """Per accident: casualties by severity and the first listed person.

    Keys grow with source order, so the smallest one is the first listed.
    """
    label = F.col("gravite")
    return people.groupBy(*ENTITY_KEY).agg(
        F.count_if(label == "Killed").alias("nb_tues"),
        F.count_if(label == "Seriously injured").alias("nb_blesses_graves"),
        F.count_if(label == "Slightly injured").alias("nb_blesses_legers"),
        F.min(F.struct("id_usager", "veh_src")).alias("first"),
    )


def vehicle_counts(vehicles: DataFrame) -> DataFrame:
    return vehicles.groupBy(*ENTITY_KEY).agg(F.count(F.lit(1)).alias("nb_vehicules"))


def first_vehicles(vehicles: DataFrame) -> DataFrame:
    """First vehicle of each (accident, vehicle number)."""
    numbered = vehicles.withColumn("veh_src", F.coalesce("veh_src", F.lit("")))
    return numbered.groupBy(*ENTITY_KEY, "veh_src").agg(F.min("id_vehicule").alias("id_vehicule"))


def last_places(places: DataFrame) -> DataFrame:
    """Repeated place rows of an accident: the last one counts."""
    return places.groupBy(*ENTITY_KEY).agg(F.max("id_lieu").alias("id_lieu"))


def with_weather_id(fact: DataFrame, weather: DataFrame) -> DataFrame:
    return fact.join(weather.select("id_pays", "date", "id_meteo"), ["id_pays", "date"], "left")


def fact_staging(keyed: KeyedStaging, weather: DataFrame | None = None, with_year: bool = False) -> DataFrame:
    """One row per accident, incomplete ones included, with its source key.

    Everything is reduced to one row per accident before joining, so no accident
    is too large for a join task.
    """
    people = person_measures(keyed.people)
    joined = (
        keyed.accidents.select("id_accident", *ENTITY_KEY, "date")
        .join(people, ENTITY_KEY, "left")
        .join(last_places(keyed.places), ENTITY_KEY, "left")
        .join(vehicle_counts(keyed.vehicles), ENTITY_KEY, "left")
        .withColumn("veh_src", F.coalesce("first.veh_src", F.lit("")))
        .join(first_vehicles(keyed.vehicles), [*ENTITY_KEY, "veh_src"], "left")
    )
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("nb_tues", "nb_blesses_graves", "nb_blesses_legers")}
    fact = joined.select(
        "id_accident",
        "cle",
        "id_pays",
        "date",
        "id_lieu",
        F.col("first.id_usager").alias("id_usager"),
        "id_vehicule",
        *[expr.alias(name) for name, expr in counts.items()],
        victims(*counts.values()).alias("nb_victimes_total"),
        F.coalesce("nb_vehicules", F.lit(1)).alias("nb_vehicules"),
        severity_index(*counts.values()).alias("indice_gravite"),
        *(["annee"] if with_year else []),
    )
    return fact if weather is None else with_weather_id(fact, weather)


def finalize_fact(fact: DataFrame, *more: str) -> DataFrame:
    """Complete rows only, in warehouse types."""
    return shaped(fact.na.drop(subset=["date", "id_lieu", "id_usager", "id_vehicule"]), "fait_accident", *more)


def build_tables(keyed: KeyedStaging, with_year: bool = False) -> dict[str, DataFrame]:
    """The warehouse tables that come from accident files, and their source keys.

    ``with_year`` adds the files' year, by which they are stored.
    """
    more = ["annee"] if with_year else []
    return {
        "dim_localisation": shaped(keyed.places, "dim_localisation", *more),
        "dim_usager": shaped(keyed.people, "dim_usager", *more),
        "dim_vehicule": shaped(keyed.vehicles, "dim_vehicule", *more),
        "fait_accident": finalize_fact(fact_staging(keyed, with_year=with_year), *more),
        "cle_accident": keyed.accidents.select(*ENTITY_KEY, "id_accident"),
    }
