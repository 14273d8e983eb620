"""Calendar, weather, surrogate keys, dimensions and the fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.operators.keys import dense_ids, keep_first
from starmart.plans import star as build
from starmart.plans import weather as weather_plan
from starmart.plans.calendar import calendar_staging, days_spanned, dim_temps, holidays, number_days
from starmart.registry.sql import CALENDAR_PARTS, COUNTRY_PARTS, FACT_PARTS, HOLIDAY_PARTS, with_parts
from starmart.sources.testdata import TestStar, staging, star, table


# --- calendar -------------------------------------------------------------


def _calendar_staging(spark, sf_dir):
    return number_days(calendar_staging(days_spanned([(table(spark, sf_dir, "orders"), "o_orderdate")])))


def dim_calendar(spark, sf_dir):
    return _calendar_staging(spark, sf_dir)


def dim_date_project(spark, sf_dir):
    return dim_temps(_calendar_staging(spark, sf_dir))


def calendar_holidays(spark, sf_dir):
    """Orders placed on each country's public holidays."""
    days = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    free = holidays(days.select(F.year("date").alias("annee")))
    return days.join(free, "date").select("country", "date", "n")


# --- weather --------------------------------------------------------------


def _readings(spark, sf_dir):
    """Line items as weather readings of three source files."""
    base = TestStar(spark, sf_dir)
    where = base.table("supplier").join(base.nations(), F.col("s_nationkey") == F.col("n_nationkey"))
    return (
        base.table("lineitem")
        .join(where.select("s_suppkey", "id_pays"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.concat(F.lit("meteo_"), "l_returnflag").alias("fichier"),
            "id_pays",
            F.col("l_shipdate").cast("date").alias("date"),
            F.col("l_quantity").alias("temp_min"),
            (F.col("l_quantity") + F.col("l_linenumber")).alias("temp_max"),
            F.when(F.col("l_linestatus") == "O", F.round(F.col("l_discount") * 100) - 3).alias("precipitations"),
            F.when(F.col("l_linenumber") > 3, F.round(F.col("l_tax") * 100) * 10).alias("vent"),
        )
    )


def weather_daily_mean(spark, sf_dir):
    return weather_plan.daily_means(_readings(spark, sf_dir))


def dedupe_keep_first(spark, sf_dir):
    daily = weather_plan.daily_means(_readings(spark, sf_dir))
    return keep_first(daily, ["id_pays", "date"], ["fichier"])


def dim_weather(spark, sf_dir):
    return weather_plan.dim_meteo(_readings(spark, sf_dir))


DAILY_PARTS = """
daily AS (
  SELECT 'meteo_' || l_returnflag AS fichier, n_regionkey AS id_pays, CAST(l_shipdate AS DATE) AS date,
         avg(l_quantity) AS temp_min, avg(l_quantity + l_linenumber) AS temp_max,
         avg(CASE WHEN l_linestatus = 'O' THEN round(l_discount * 100) - 3 END) AS precipitations,
         avg(CASE WHEN l_linenumber > 3 THEN round(l_tax * 100) * 10 END) AS vent
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY 1, 2, 3
)"""
FIRST_DAILY = "SELECT * FROM daily QUALIFY row_number() OVER (PARTITION BY id_pays, date ORDER BY fichier) = 1"


# --- keys -----------------------------------------------------------------


def surrogate_sequence(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderdate", "o_orderkey")
    return dense_ids(orders, "id", ["o_orderdate", "o_orderkey"])


# --- dimensions and fact --------------------------------------------------


def dim_country(spark, sf_dir):
    """Countries with the orders placed in them."""
    base = star(spark, sf_dir)
    placed = base.fact_staging().groupBy("id_pays").agg(F.count(F.lit(1)).alias("nb_accidents"))
    return base.country.join(placed, "id_pays", "left")


def _numbered(spark, sf_dir, part, id_col):
    return build.number_entities(getattr(staging(spark, sf_dir), part), id_col)


def dim_place(spark, sf_dir):
    return build.shaped(_numbered(spark, sf_dir, "places", "id_lieu"), "dim_localisation")


def dim_person(spark, sf_dir):
    return build.shaped(_numbered(spark, sf_dir, "people", "id_usager"), "dim_usager")


def dim_vehicle(spark, sf_dir):
    return build.shaped(_numbered(spark, sf_dir, "vehicles", "id_vehicule"), "dim_vehicule")


def fact_first_user(spark, sf_dir):
    people = _numbered(spark, sf_dir, "people", "id_usager")
    return build.person_measures(people).select(
        "id_pays", "cle", F.col("first.id_usager").alias("id_usager"), F.col("first.veh_src").alias("veh_src")
    )


def fact_first_vehicle(spark, sf_dir):
    """First vehicle of each accident and source vehicle number."""
    return build.first_vehicles(_numbered(spark, sf_dir, "vehicles", "id_vehicule")).drop("annee")


def fact_first_vehicle_uk(spark, sf_dir):
    """Files without a vehicle number: the first vehicle of the accident."""
    vehicles = _numbered(spark, sf_dir, "vehicles", "id_vehicule")
    return build.first_vehicles(vehicles.withColumn("veh_src", F.lit(None).cast("string"))).drop("annee")


def fact_vehicle_count(spark, sf_dir):
    """Vehicles per accident, one where none is listed."""
    parts = staging(spark, sf_dir)
    counts = build.vehicle_counts(parts.vehicles)
    return parts.accidents.join(counts, build.ENTITY_KEY, "left").select(
        "id_pays", "cle", F.coalesce("nb_vehicules", F.lit(1)).cast("bigint").alias("nb_vehicules")
    )


def fr_place_left_join(spark, sf_dir):
    """Accidents with their place rows (lines here): repeats multiply, the last row wins."""
    parts = staging(spark, sf_dir)
    accidents = parts.accidents.select("id_pays", "annee", "cle", F.col("pos").alias("a"))
    repeated = parts.people.select("id_pays", "cle", F.col("pos").alias("b"))
    places = accidents.join(repeated, ["id_pays", "cle"], "left").select(
        "id_pays", "annee", "cle", F.struct("a", "b").alias("pos")
    )
    numbered = dense_ids(places, "id_lieu", build.ENTITY_ORDER)
    return build.last_places(numbered).drop("annee")


def fact_weather_lookup(spark, sf_dir):
    base = star(spark, sf_dir)
    weather = dense_ids(base.weather.select("id_pays", "date"), "id_meteo", ["id_pays", "date"])
    return build.with_weather_id(base.fact.select("id_accident", "id_pays", "date"), weather)


def _keyed(spark, sf_dir):
    return build.assign_keys(staging(spark, sf_dir))


def fact_build(spark, sf_dir):
    """All accidents, incomplete ones included, before loading."""
    return build.fact_staging(_keyed(spark, sf_dir))


def fact_finalize(spark, sf_dir):
    return build.finalize_fact(build.fact_staging(_keyed(spark, sf_dir)))


def build_summary(spark, sf_dir):
    """Row counts of every table of a whole build."""
    tables = build.build_tables(_keyed(spark, sf_dir))
    tables["dim_meteo"] = dim_weather(spark, sf_dir)
    tables["dim_temps"] = dim_date_project(spark, sf_dir)
    tables["dim_pays"] = star(spark, sf_dir).country
    counts = [
        df.agg(F.count(F.lit(1)).alias("lignes")).select(F.lit(name).alias("nom"), "lignes")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def union_sources(spark, sf_dir):
    """Orders delivered as one file per status, put together again."""
    orders = table(spark, sf_dir, "orders")
    parts = [orders.filter(F.col("o_orderstatus") == s) for s in "FOP"]
    return reduce(DataFrame.unionByName, parts).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("premier"), F.max("o_orderkey").alias("dernier")
    )


NAMES = [
    "dim_calendar", "dim_date_project", "calendar_holidays", "weather_daily_mean", "dedupe_keep_first",
    "dim_weather", "surrogate_sequence", "dim_country", "dim_place", "dim_person", "dim_vehicle",
    "fact_first_user", "fact_first_vehicle", "fact_first_vehicle_uk", "fact_vehicle_count",
    "fr_place_left_join", "fact_weather_lookup", "fact_build", "fact_finalize", "build_summary", "union_sources",
]
QUERIES = {name: globals()[name] for name in NAMES}

ACCIDENT_PARTS = """
acc AS (
  SELECT o_orderkey AS cle, n_regionkey AS id_pays, n_name, c_mktsegment, CAST(o_orderdate AS DATE) AS date,
         year(o_orderdate) AS annee, row_number() OVER (ORDER BY n_regionkey, year(o_orderdate), o_orderkey) AS id_accident
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
lines AS (
  SELECT acc.*, lineitem.*, CAST(l_partkey AS VARCHAR) AS veh_src,
         row_number() OVER (ORDER BY id_pays, annee, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
           l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS id
  FROM acc JOIN lineitem ON cle = l_orderkey
)"""
SEVERITY = """CASE l_returnflag WHEN 'R' THEN 'Killed' WHEN 'A' THEN 'Seriously injured'
              ELSE 'Slightly injured' END"""
BUILD_SQL = """
SELECT a.id_accident, a.cle, a.id_pays, a.date, a.id_accident AS id_lieu, u.id AS id_usager, v.id AS id_vehicule,
       coalesce(m.killed, 0) AS nb_tues, coalesce(m.serious, 0) AS nb_blesses_graves,
       coalesce(m.slight, 0) AS nb_blesses_legers,
       coalesce(m.killed + m.serious + m.slight, 0) AS nb_victimes_total,
       coalesce(m.n, 1) AS nb_vehicules,
       CAST(coalesce(3 * m.killed + 2 * m.serious + m.slight, 0) AS DOUBLE) AS indice_gravite
FROM acc a
LEFT JOIN (SELECT cle, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS killed,
                  count(*) FILTER (WHERE l_returnflag = 'A') AS serious,
                  count(*) FILTER (WHERE l_returnflag = 'N') AS slight FROM lines GROUP BY cle) m ON m.cle = a.cle
LEFT JOIN (SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY cle ORDER BY id) = 1) u ON u.cle = a.cle
LEFT JOIN (SELECT cle, veh_src, min(id) AS id FROM lines GROUP BY 1, 2) v
       ON v.cle = a.cle AND v.veh_src = u.veh_src"""

ORACLES = {
    "dim_calendar": with_parts(
        CALENDAR_PARTS,
        query="""
        SELECT id_date AS id_temps, date, jour, mois, annee, CAST(quarter(date) AS INTEGER) AS trimestre,
               CAST(isodow(date) AS INTEGER) AS jour_semaine,
               list_extract(['Lundi','Mardi','Mercredi','Jeudi','Vendredi','Samedi','Dimanche'], isodow(date)) AS nom_jour,
               list_extract(['Janvier','Février','Mars','Avril','Mai','Juin','Juillet','Août','Septembre','Octobre',
                             'Novembre','Décembre'], mois) AS nom_mois,
               CAST(est_weekend AS INTEGER) AS est_weekend, CAST(est_jour_ferie AS INTEGER) AS est_ferie_fr,
               CAST(date IN (SELECT date FROM holiday WHERE country = 'UK') AS INTEGER) AS est_ferie_uk, saison
        FROM calendar""",
    ),
    "dim_date_project": with_parts(CALENDAR_PARTS, query="SELECT * FROM calendar"),
    "calendar_holidays": with_parts(
        HOLIDAY_PARTS,
        query="""SELECT country, date, count(*) AS n FROM orders JOIN holiday ON date = CAST(o_orderdate AS DATE)
                 GROUP BY country, date""",
    ),
    "weather_daily_mean": with_parts(DAILY_PARTS, query="SELECT * FROM daily"),
    "dedupe_keep_first": with_parts(DAILY_PARTS, query=FIRST_DAILY),
    "dim_weather": with_parts(
        DAILY_PARTS,
        query=f"""
        SELECT row_number() OVER (ORDER BY id_pays, date) AS id_meteo, id_pays, date, temp_max, temp_min,
               coalesce(precipitations, 0) AS precipitations,
               coalesce(vent, (SELECT median(vent) FROM daily), 0) AS vent,
               CASE WHEN coalesce(precipitations, 0) > 2.0 THEN 'pluie' WHEN vent >= 40 THEN 'vent_fort'
                    WHEN temp_max >= 20 THEN 'ensoleille' ELSE 'nuageux' END AS conditions
        FROM ({FIRST_DAILY})""",
    ),
    "surrogate_sequence": """
        SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderdate, o_orderkey FROM orders""",
    "dim_country": with_parts(
        COUNTRY_PARTS,
        FACT_PARTS,
        query="""SELECT id_pays, code_pays, nom_pays, nb_accidents FROM country
                 LEFT JOIN (SELECT id_pays, count(*) AS nb_accidents FROM fact_staging GROUP BY 1) USING (id_pays)""",
    ),
    "dim_place": with_parts(
        ACCIDENT_PARTS,
        query="""
        SELECT id_accident AS id_lieu, id_pays, NULL::VARCHAR AS commune,
               CASE WHEN id_pays <= 1 THEN n_name END AS departement,
               CASE WHEN id_pays > 1 THEN c_mktsegment END AS district, c_mktsegment AS type_route,
               NULL::INTEGER AS vitesse_limite, NULL::DOUBLE AS latitude, NULL::DOUBLE AS longitude FROM acc""",
    ),
    "dim_person": with_parts(
        ACCIDENT_PARTS,
        query=f"""
        SELECT id AS id_usager, id_pays, NULL::INTEGER AS age,
               CASE WHEN l_linestatus = 'O' THEN 'Male' ELSE 'Female' END AS sexe, NULL::VARCHAR AS place_vehicule,
               {SEVERITY} AS gravite,
               CASE WHEN l_linenumber <= 3 THEN 'Driver' WHEN l_linenumber <= 5 THEN 'Passenger'
                    ELSE 'Pedestrian' END AS cat_usager FROM lines""",
    ),
    "dim_vehicle": with_parts(
        ACCIDENT_PARTS,
        query="""
        SELECT id AS id_vehicule, id_pays, p_type AS type_vehicule, p_brand AS manoeuvre, p_size AS nb_occupants,
               'Unknown' AS motorisation FROM lines JOIN part ON p_partkey = l_partkey""",
    ),
    "fact_first_user": with_parts(
        ACCIDENT_PARTS,
        query="""SELECT id_pays, cle, id AS id_usager, veh_src FROM lines
                 QUALIFY row_number() OVER (PARTITION BY cle ORDER BY id) = 1""",
    ),
    "fact_first_vehicle": with_parts(
        ACCIDENT_PARTS,
        query="SELECT id_pays, cle, veh_src, min(id) AS id_vehicule FROM lines GROUP BY 1, 2, 3",
    ),
    "fact_first_vehicle_uk": with_parts(
        ACCIDENT_PARTS,
        query="SELECT id_pays, cle, '' AS veh_src, min(id) AS id_vehicule FROM lines GROUP BY 1, 2, 3",
    ),
    "fact_vehicle_count": with_parts(
        ACCIDENT_PARTS,
        query="""SELECT a.id_pays, a.cle, coalesce(n, 1) AS nb_vehicules FROM acc a
                 LEFT JOIN (SELECT cle, count(*) AS n FROM lines GROUP BY 1) USING (cle)""",
    ),
    "fr_place_left_join": with_parts(
        ACCIDENT_PARTS,
        query="""SELECT id_pays, cle, max(i) AS id_lieu FROM (
                   SELECT a.id_pays, a.cle, row_number() OVER (ORDER BY a.id_accident, l.id) AS i
                   FROM acc a LEFT JOIN lines l ON l.cle = a.cle) GROUP BY 1, 2""",
    ),
    "fact_weather_lookup": with_parts(
        FACT_PARTS,
        query="""
        SELECT id_accident, id_pays, date, id_meteo FROM fact LEFT JOIN (
          SELECT id_pays, date, row_number() OVER (ORDER BY id_pays, date) AS id_meteo
          FROM (SELECT DISTINCT n_regionkey AS id_pays, CAST(l_shipdate AS DATE) AS date
                FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey))
        USING (id_pays, date)""",
    ),
    "fact_build": with_parts(ACCIDENT_PARTS, query=BUILD_SQL),
    "fact_finalize": with_parts(
        ACCIDENT_PARTS,
        query=f"""SELECT * EXCLUDE (cle) REPLACE (CAST(nb_tues AS INTEGER) AS nb_tues,
                         CAST(nb_blesses_graves AS INTEGER) AS nb_blesses_graves,
                         CAST(nb_blesses_legers AS INTEGER) AS nb_blesses_legers,
                         CAST(nb_victimes_total AS INTEGER) AS nb_victimes_total,
                         CAST(nb_vehicules AS INTEGER) AS nb_vehicules)
                  FROM ({BUILD_SQL}) WHERE id_usager IS NOT NULL AND id_vehicule IS NOT NULL""",
    ),
    "build_summary": with_parts(
        ACCIDENT_PARTS,
        DAILY_PARTS,
        CALENDAR_PARTS,
        query=f"""
        SELECT 'dim_localisation' AS nom, count(*) AS lignes FROM acc
        UNION ALL SELECT 'dim_usager', count(*) FROM lines
        UNION ALL SELECT 'dim_vehicule', count(*) FROM lines JOIN part ON p_partkey = l_partkey
        UNION ALL SELECT 'fait_accident', count(*) FROM ({BUILD_SQL}) WHERE id_usager IS NOT NULL AND id_vehicule IS NOT NULL
        UNION ALL SELECT 'cle_accident', count(*) FROM acc
        UNION ALL SELECT 'dim_meteo', count(*) FROM ({FIRST_DAILY})
        UNION ALL SELECT 'dim_temps', count(*) FROM calendar
        UNION ALL SELECT 'dim_pays', count(*) FROM region""",
    ),
    "union_sources": """
        SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS premier, max(o_orderkey) AS dernier
        FROM orders GROUP BY 1""",
}
