"""French and British accident files to the common staging shape."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import codebooks
from starmart.functions import dates, geo, scalars
from starmart.plans.star import Staging
from starmart.sources.columns import find_by_words, find_field
from starmart.sources.deliveries import FR, KINDS, UK
from starmart.sources.delimited import Layout, header_names, list_files, manifest, position, read_layouts

POSITION_TYPE = "struct<src_file:string,src_block:bigint,src_row:bigint>"


def _no_text() -> Column:
    return F.lit(None).cast("string")


def _file_year() -> Column:
    return dates.last_year_in_name(F.substring_index("src_file", "/", -1))


def _maybe(columns: list[str], name: str | None) -> Column:
    """Text of a column, null when the file has none."""
    return F.col(f"`{name}`") if name and name in columns else _no_text()


def files_of_years(spark: SparkSession, root: str, pattern: str, years: Sequence[int] | None) -> DataFrame:
    files = list_files(spark, root, pattern)
    return files if years is None else files.filter(dates.last_year_in_name(F.col("name")).isin(list(years)))


def read_kind(
    spark: SparkSession,
    root: str,
    pattern: str,
    shape: Callable[[Layout], DataFrame],
    years: Sequence[int] | None = None,
) -> DataFrame:
    """All files of one kind, each layout shaped on its own, then put together.

    Files of other years are not opened.
    """
    described = manifest(files_of_years(spark, root, pattern, years))
    frames = [shape(layout) for layout in read_layouts(spark, described)]
    if not frames:
        raise FileNotFoundError(f"no {pattern} below {root}")
    return reduce(DataFrame.unionByName, frames)


def _entity(country: int, key: Column) -> list[Column]:
    return [
        F.lit(country).alias("id_pays"),
        _file_year().alias("annee"),
        key.alias("cle"),
        position().alias("pos"),
    ]


# --- France ---------------------------------------------------------------


def fr_accidents(layout: Layout) -> DataFrame:
    date = dates.date_from_parts(_file_year(), F.col("mois"), F.col("jour"))
    raw = [_maybe(layout.columns, c).alias(c) for c in ("com", "dep", "lat", "long")]
    return layout.rows.select(*_entity(FR, F.col("Num_Acc")), date.alias("date"), *raw)


def fr_places(layout: Layout) -> DataFrame:
    raw = [_maybe(layout.columns, c).alias(c) for c in ("catr", "vma")]
    return layout.rows.select(_file_year().alias("annee"), F.col("Num_Acc").alias("cle"), position().alias("lieu_pos"), *raw)


def fr_located(accidents: DataFrame, places: DataFrame) -> DataFrame:
    """Accidents with their place rows; repeats of a place row stay, in file order.

    A place row is many times as long as its line, as it holds its position, so it is not broadcast by its file's size.
    """
    lat, lon = geo.degrees_pair(F.col("lat"), F.col("long"))
    return accidents.join(places.hint("merge"), ["annee", "cle"], "left").select(
        "id_pays",
        "annee",
        "cle",
        F.struct("pos", "lieu_pos").alias("pos"),
        scalars.nonzero_code(F.col("com")).alias("commune"),
        scalars.truncate(F.col("dep"), 20).alias("departement"),
        _no_text().alias("district"),
        scalars.decode(F.col("catr"), codebooks.FR_ROAD).alias("type_route"),
        scalars.safe_int(F.col("vma")).cast("int").alias("vitesse_limite"),
        lat.alias("latitude"),
        lon.alias("longitude"),
    )


def fr_people(layout: Layout) -> DataFrame:
    def text(name: str) -> Column:
        return _maybe(layout.columns, name)

    return layout.rows.select(
        *_entity(FR, F.col("Num_Acc")),
        F.coalesce(text("id_vehicule"), F.lit("")).alias("veh_src"),
        scalars.age_from_birth_year(_file_year(), text("an_nais")).alias("age"),
        scalars.decode(text("sexe"), codebooks.FR_SEX).alias("sexe"),
        scalars.nonzero_code(text("place")).alias("place_vehicule"),
        scalars.decode(text("grav"), codebooks.FR_SEVERITY).alias("gravite"),
        scalars.decode(text("catu"), codebooks.FR_USER).alias("cat_usager"),
    )


def fr_vehicles(layout: Layout) -> DataFrame:
    def text(name: str) -> Column:
        return _maybe(layout.columns, name)

    return layout.rows.select(
        *_entity(FR, F.col("Num_Acc")),
        F.coalesce(text("id_vehicule"), F.lit("")).alias("veh_src"),
        scalars.decode(text("catv"), codebooks.FR_VEHICLE).alias("type_vehicule"),
        scalars.decode(text("manv"), codebooks.FR_MANOEUVRE).alias("manoeuvre"),
        F.coalesce(scalars.safe_int(text("occutc")).cast("int"), F.lit(0)).alias("nb_occupants"),
        scalars.decode(text("motor"), codebooks.FR_ENGINE).alias("motorisation"),
    )


def stage_fr(spark: SparkSession, root: str, years: Sequence[int] | None = None) -> Staging:
    accidents = read_kind(spark, root, KINDS[FR]["caracteristiques"], fr_accidents, years)
    places = read_kind(spark, root, KINDS[FR]["lieux"], fr_places, years)
    return Staging(
        accidents.select("id_pays", "annee", "cle", "date", "pos"),
        fr_located(accidents, places),
        read_kind(spark, root, KINDS[FR]["usagers"], fr_people, years),
        read_kind(spark, root, KINDS[FR]["vehicules"], fr_vehicles, years),
    )


# --- United Kingdom -------------------------------------------------------


def _indexed(layout: Layout) -> Column:
    name = find_field(layout.columns, "index")
    return F.col(name) if name else _no_text()


def uk_collisions(layout: Layout) -> DataFrame:
    def text(name: str | None) -> Column:
        return _maybe(layout.columns, name)

    return layout.rows.select(
        *_entity(UK, _indexed(layout)),
        dates.date_day_first(text(find_by_words(layout.columns, ["date"]))).alias("date"),
        text("local_authority_ons_district").alias("district"),
        text("first_road_class").alias("route"),
        text("speed_limit").alias("vitesse"),
        text("latitude").alias("lat"),
        text("longitude").alias("lon"),
    ).filter(F.col("cle").isNotNull())


def uk_located(collisions: DataFrame, legacy_speed: bool = False) -> DataFrame:
    speed = scalars.safe_int(F.col("vitesse"))
    return collisions.select(
        "id_pays",
        "annee",
        "cle",
        F.struct("pos", F.lit(None).cast(POSITION_TYPE).alias("lieu_pos")).alias("pos"),
        _no_text().alias("commune"),
        _no_text().alias("departement"),
        scalars.truncate(F.col("district"), 50).alias("district"),
        scalars.decode(F.col("route"), codebooks.UK_ROAD).alias("type_route"),
        scalars.mph_to_kmh(speed, legacy_speed).alias("vitesse_limite"),
        geo.round6(scalars.to_number(F.col("lat"))).alias("latitude"),
        geo.round6(scalars.to_number(F.col("lon"))).alias("longitude"),
    )


def uk_people(layout: Layout) -> DataFrame:
    def text(*words: str, exclude: tuple[str, ...] = ()) -> Column:
        return _maybe(layout.columns, find_by_words(layout.columns, [*words, "casualty"], exclude))

    role = scalars.decode(text("class"), codebooks.UK_CLASS)
    has_role = find_by_words(layout.columns, ["class", "casualty"]) is not None
    return layout.rows.select(
        *_entity(UK, _indexed(layout)),
        F.lit("").alias("veh_src"),
        scalars.safe_int(text("age", exclude=("band",))).cast("int").alias("age"),
        scalars.decode(text("sex"), codebooks.UK_SEX).alias("sexe"),
        (role if has_role else _no_text()).alias("place_vehicule"),
        scalars.decode(text("severity"), codebooks.UK_SEVERITY).alias("gravite"),
        role.alias("cat_usager"),
    )


def uk_vehicles(layout: Layout) -> DataFrame:
    def text(word: str, exclude: tuple[str, ...] = ()) -> Column:
        return _maybe(layout.columns, find_by_words(layout.columns, [word], exclude))

    return layout.rows.select(
        *_entity(UK, _indexed(layout)),
        F.lit("").alias("veh_src"),
        scalars.decode(text("vehicle_type"), codebooks.UK_VEHICLE).alias("type_vehicule"),
        scalars.decode(text("manoeuvre", ("historic",)), codebooks.UK_MANOEUVRE).alias("manoeuvre"),
        F.lit(0).alias("nb_occupants"),
        scalars.decode(text("propulsion"), codebooks.UK_ENGINE).alias("motorisation"),
    )


def years_without_index(spark: SparkSession, root: str, years: Sequence[int]) -> list[int]:
    """Years with a collision file that has no index column; only headers are looked at."""
    files = files_of_years(spark, root, KINDS[UK]["collision"], years)
    heads = [(r["name"], r["path"]) for r in files.collect()]
    if not heads:
        return []
    first = (
        spark.read.text([path for _, path in heads])
        .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")
        .where("at = 0")
        .withColumn("place", F.monotonically_increasing_id())
        .groupBy("path")
        .agg(F.min_by("value", "place").alias("line"))
    )
    year = dates.last_year_in_name(F.element_at(F.split("path", "/"), -1)).alias("annee")
    return sorted({r["annee"] for r in first.select(year, "line").collect() if not find_field(header_names(r["line"].lstrip("\ufeff"), ","), "index")})


def stage_uk(
    spark: SparkSession, root: str, years: Sequence[int] | None = None, legacy_speed: bool = False
) -> Staging:
    collisions = read_kind(spark, root, KINDS[UK]["collision"], uk_collisions, years)
    people = read_kind(spark, root, KINDS[UK]["casualty"], uk_people, years)
    vehicles = read_kind(spark, root, KINDS[UK]["vehicle"], uk_vehicles, years)
    return Staging(
        collisions.select("id_pays", "annee", "cle", "date", "pos"),
        uk_located(collisions, legacy_speed),
        people,
        vehicles,
    )
