"""The stored roll-up of the star, its refresh and the requests on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmart.functions.scalars import mean2, round2, zone
from starmart.operators.rollup import (
    Measures,
    finest_grain,
    grouping_sets,
    level_gid,
    merge_grain,
    rollup_grain,
)
from starmart.plans.star_queries import DAY_KEY, Star
from starmart.sources import snapshots

VIEW = "cube"

KEYS = [
    "nom_pays",
    "annee",
    "saison",
    "est_weekend",
    "est_jour_ferie",
    "conditions",
    "departement",
    "district",
    "type_route",
    "sexe",
    "cat_usager",
]
MEASURES = Measures(
    sums={
        "total_tues": "nb_tues",
        "total_blesses_graves": "nb_blesses_graves",
        "total_blesses_legers": "nb_blesses_legers",
        "total_victimes": "nb_victimes_total",
    },
    means={"gravite": "indice_gravite", "temp_min": "temp_min", "temp_max": "temp_max"},
    mins={"gravite_min": "indice_gravite"},
    maxs={"gravite_max": "indice_gravite"},
)
BY_WEATHER = KEYS.index("conditions") + 1


def cube_detail(star: Star) -> DataFrame:
    """Fact rows with every cube key; the vehicle table only confirms existence.

    The tables that need a shuffle come first, while the rows are narrow; the
    labels of the small ones are added where the rows then are.
    """
    return (
        star.fact.join(star.vehicle.select("id_vehicule"), "id_vehicule", "left_semi")
        .join(star.person.select("id_usager", "sexe", "cat_usager"), "id_usager")
        .join(star.place.select("id_lieu", "departement", "district", "type_route"), "id_lieu")
        .join(star.country.select("id_pays", "nom_pays"), "id_pays")
        .join(star.calendar.select("date", "annee", "saison", "est_weekend", "est_jour_ferie"), "date")
        .join(star.weather.select(*DAY_KEY, "conditions", "temp_min", "temp_max"), DAY_KEY)
    )


def cube_grain(star: Star) -> DataFrame:
    """One row per combination of all keys, with states that can be merged."""
    return finest_grain(cube_detail(star), KEYS, MEASURES)


def cube_levels(grain: DataFrame, keep_grand_total: bool = True) -> DataFrame:
    return rollup_grain(grain, KEYS, MEASURES, keep_grand_total)


def cube_view(levels: DataFrame) -> DataFrame:
    """The columns a reader of the stored view sees, level number included."""
    return levels.select(
        "nom_pays",
        "annee",
        "saison",
        "est_weekend",
        "est_jour_ferie",
        "conditions",
        zone(F.col("departement"), F.col("district")).alias("zone"),
        "departement",
        "district",
        "type_route",
        "sexe",
        "cat_usager",
        "gid",
        F.col("n").alias("nb_accidents"),
        *MEASURES.sums,
        mean2(F.col("gravite_sum"), F.col("gravite_cnt")).alias("gravite_moyenne"),
        "gravite_min",
        "gravite_max",
        mean2(F.col("temp_min_sum"), F.col("temp_min_cnt")).alias("temp_min_moyenne"),
        mean2(F.col("temp_max_sum"), F.col("temp_max_cnt")).alias("temp_max_moyenne"),
        "gravite_sum",
        "gravite_cnt",
    )


def cube_build(star: Star) -> DataFrame:
    return cube_view(cube_levels(cube_grain(star)))


def refresh_incremental(stored_grain: DataFrame, new_rows: Star) -> DataFrame:
    """New grain after an append-only load: the stored states and those of the new rows."""
    return merge_grain(stored_grain.unionByName(cube_grain(new_rows)), KEYS, MEASURES)


def write_cube(view: DataFrame, path: str) -> None:
    """Store the view by level, so that a request reads the level it needs only.

    A refresh is a new version beside the old one: requests that are open go on reading that, a
    refresh that breaks leaves it in place, and levels that the new view lacks are gone with it.
    """
    batch = snapshots.Batch(snapshots.latest(snapshots.Folder(view.sparkSession, path)))
    batch.replace(VIEW, view.hint("rebalance", "gid"), ["gid"])
    batch.publish()


def read_cube(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The current version of the stored view; filters on ``gid`` choose folders."""
    return snapshots.latest(snapshots.Folder(spark, path)).read(VIEW, schema)


def _weighted() -> Column:
    return mean2(F.sum("gravite_sum"), F.sum("gravite_cnt")).alias("gravite_moyenne")


def _mean_of_cells() -> Column:
    """Unweighted mean of the rounded cell means, summed exactly."""
    cell = F.col("gravite_moyenne").cast("decimal(20,2)")
    return (F.sum(cell).cast("double") / F.count(cell)).alias("_mean")


def _accidents(name: str) -> Column:
    return F.sum("nb_accidents").cast("bigint").alias(name)


def _ranked(grouped: DataFrame) -> DataFrame:
    """Rank of the weather words within each country (a handful of rows each)."""
    best_first = Window.partitionBy("nom_pays").orderBy(F.col("_mean").desc_nulls_last())
    return grouped.select(
        "nom_pays",
        "conditions",
        "nb_accidents",
        round2(F.col("_mean")).alias("gravite_moyenne"),
        F.rank().over(best_first).cast("bigint").alias("rang_conditions"),
    ).orderBy("nom_pays", "rang_conditions", "conditions")


def weather_rank(cube: DataFrame) -> DataFrame:
    """Mean severity by country and weather, ranked, from the level ending in weather."""
    level = cube.filter(F.col("gid") == level_gid(len(KEYS), BY_WEATHER))
    mean = (F.sum("gravite_sum") / F.sum("gravite_cnt")).alias("_mean")
    return _ranked(level.groupBy("nom_pays", "conditions").agg(_accidents("nb_accidents"), mean))


def weather_rank_legacy(cube: DataFrame) -> DataFrame:
    """Over all levels at once: each accident counts once per level that shows weather."""
    rows = cube.filter(F.col("nom_pays").isNotNull() & F.col("conditions").isNotNull())
    return _ranked(rows.groupBy("nom_pays", "conditions").agg(_accidents("nb_accidents"), _mean_of_cells()))


def _finest(cube: DataFrame) -> DataFrame:
    return cube.filter(F.col("gid") == 0)


def _labelled_sets(rows: DataFrame, legacy: bool) -> DataFrame:
    mean = _mean_of_cells() if legacy else _weighted()
    sets = [["nom_pays", "conditions"], ["nom_pays"], []]
    out = grouping_sets(rows, ["nom_pays", "conditions"], sets, [_accidents("nb_accidents_graves"), mean])
    value = round2(F.col("_mean")) if legacy else F.col("gravite_moyenne")
    return out.select(
        F.coalesce("nom_pays", F.lit("TOTAL")).alias("nom_pays"),
        F.coalesce("conditions", F.lit("TOUTES")).alias("conditions"),
        "gid",
        "nb_accidents_graves",
        value.alias("gravite_moyenne"),
    ).orderBy("nom_pays", F.col("gravite_moyenne").desc_nulls_last(), "conditions", "gid")


def serious_cells(cube: DataFrame, min_exclusive: float = 4) -> DataFrame:
    """Accidents in cells whose mean severity is high, with sub-totals."""
    return _labelled_sets(_finest(cube).filter(F.col("gravite_moyenne") > min_exclusive), False)


def serious_cells_legacy(cube: DataFrame, min_exclusive: float = 4) -> DataFrame:
    return _labelled_sets(cube.filter(F.col("gravite_moyenne") > min_exclusive), True)


def _smoothed(grouped: DataFrame, at_least: int, size: int) -> DataFrame:
    """Mean over the neighbouring weather words of a zone; only those words share a frame."""
    frame = Window.partitionBy("nom_pays", "zone").orderBy(F.col("conditions").asc_nulls_last()).rowsBetween(-1, 1)
    return (
        grouped.filter(F.col("nb_accidents_graves") >= at_least)
        .select(
            "nom_pays",
            "zone",
            "conditions",
            "nb_accidents_graves",
            round2(F.col("_mean")).alias("gravite_moyenne"),
            round2(
                F.sum(F.col("_mean").cast("decimal(20,10)")).over(frame).cast("double")
                / F.count("_mean").over(frame)
            ).alias("gravite_lissee"),
        )
        .orderBy(
            F.col("gravite_moyenne").desc_nulls_last(),
            F.col("nom_pays").asc_nulls_last(),
            F.col("zone").asc_nulls_last(),
            F.col("conditions").asc_nulls_last(),
        )
        .limit(size)
    )


def smoothed_zones(cube: DataFrame, min_exclusive: float = 4, at_least: int = 50, size: int = 20) -> DataFrame:
    """Zones with many accidents in high-severity cells and their smoothed severity."""
    rows = _finest(cube).filter((F.col("gravite_moyenne") > min_exclusive) & F.col("zone").isNotNull())
    mean = (F.sum("gravite_sum") / F.sum("gravite_cnt")).alias("_mean")
    grouped = rows.groupBy("nom_pays", "zone", "conditions").agg(_accidents("nb_accidents_graves"), mean)
    return _smoothed(grouped, at_least, size)


def smoothed_zones_legacy(
    cube: DataFrame, min_exclusive: float = 4, at_least: int = 50, size: int = 20
) -> DataFrame:
    rows = cube.filter((F.col("gravite_moyenne") > min_exclusive) & F.col("zone").isNotNull())
    grouped = rows.groupBy("nom_pays", "zone", "conditions").agg(
        _accidents("nb_accidents_graves"), _mean_of_cells()
    )
    return _smoothed(grouped, at_least, size)
