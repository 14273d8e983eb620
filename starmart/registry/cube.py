"""The stored roll-up, its refresh and the requests on it."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.plans import cube
from starmart.registry.sql import (
    CALENDAR_PARTS,
    COUNTRY_PARTS,
    FACT_PARTS,
    PERSON_PARTS,
    PLACE_PARTS,
    WEATHER_PARTS,
    round2,
    with_parts,
)
from starmart.sources.scratch import scratch_path, stored
from starmart.sources.testdata import star

VIEW_COLUMNS = [
    *cube.KEYS[:6],
    "zone",
    *cube.KEYS[6:],
    "gid",
    "nb_accidents",
    *cube.MEASURES.sums,
    "gravite_moyenne",
    "gravite_min",
    "gravite_max",
    "temp_min_moyenne",
    "temp_max_moyenne",
]


def _view(spark, sf_dir):
    return cube.cube_build(star(spark, sf_dir))


def cube_build(spark, sf_dir):
    return _view(spark, sf_dir).select(*VIEW_COLUMNS)


def cube_refresh(spark, sf_dir):
    """A stored view of the years up to 1998, then a full recomputation in its place, read back."""
    path = scratch_path(spark, "cube")
    base = star(spark, sf_dir)
    cube.write_cube(cube.cube_build(_Part(base, F.year("date") <= 1998)), path)
    view = cube.cube_build(base)
    cube.write_cube(view, path)
    return cube.read_cube(spark, path, view.schema).select(*VIEW_COLUMNS)


class _Part:
    """A star whose fact is one load; the dimensions are shared."""

    def __init__(self, base, keep):
        self.fact = base.fact.filter(keep)
        for name in ("country", "calendar", "weather", "vehicle", "person", "place"):
            setattr(self, name, getattr(base, name))


def cube_refresh_incremental(spark, sf_dir):
    """Stored grain of the years up to 1998, then the later years merged in."""
    base = star(spark, sf_dir)
    first = _Part(base, F.year("date") <= 1998)
    later = _Part(base, F.year("date") > 1998)
    grain = stored(cube.cube_grain(first), "cube-grain")
    merged = cube.refresh_incremental(grain, later)
    return cube.cube_view(cube.cube_levels(merged)).select(*VIEW_COLUMNS)


def stored_view(spark, sf_dir):
    """The view as a refresh leaves it: requests read its folders, not the star."""
    path, view = scratch_path(spark, "cube"), _view(spark, sf_dir)
    cube.write_cube(view, path)
    return cube.read_cube(spark, path, view.schema)


def _request(question):
    return lambda spark, sf_dir: question(stored_view(spark, sf_dir))


QUERIES = {
    "cube_build": cube_build,
    "cube_refresh": cube_refresh,
    "cube_refresh_incremental": cube_refresh_incremental,
    "cube_q1": _request(cube.weather_rank),
    "cube_q1_legacy": _request(cube.weather_rank_legacy),
    "cube_q2": _request(cube.serious_cells),
    "cube_q2_legacy": _request(cube.serious_cells_legacy),
    "cube_q3": _request(cube.smoothed_zones),
    "cube_q3_legacy": _request(cube.smoothed_zones_legacy),
}

KEY_LIST = ", ".join(cube.KEYS)
CUBE_PARTS = f"""
detail AS (
  SELECT nom_pays, annee, saison, est_weekend, est_jour_ferie, conditions, departement, district,
         type_route, sexe, cat_usager, temp_min, temp_max, f.*
  FROM fact f
  JOIN country c ON c.id_pays = f.id_pays
  JOIN calendar t ON t.date = f.date
  JOIN weather m ON m.id_pays = f.id_pays AND m.date = f.date
  JOIN part v ON v.p_partkey = f.id_vehicule
  JOIN person u ON u.id_usager = f.id_usager
  JOIN place l ON l.id_lieu = f.id_lieu
),
cube AS (
  SELECT {KEY_LIST}, coalesce(departement, district) AS zone,
         CAST(grouping({KEY_LIST}) AS BIGINT) AS gid,
         count(*) AS nb_accidents,
         CAST(sum(nb_tues) AS BIGINT) AS total_tues,
         CAST(sum(nb_blesses_graves) AS BIGINT) AS total_blesses_graves,
         CAST(sum(nb_blesses_legers) AS BIGINT) AS total_blesses_legers,
         CAST(sum(nb_victimes_total) AS BIGINT) AS total_victimes,
         {round2("sum(indice_gravite) / count(*)")} AS gravite_moyenne,
         min(indice_gravite) AS gravite_min, max(indice_gravite) AS gravite_max,
         {round2("sum(temp_min) / count(temp_min)")} AS temp_min_moyenne,
         {round2("sum(temp_max) / count(temp_max)")} AS temp_max_moyenne,
         sum(indice_gravite) AS gravite_sum, count(indice_gravite) AS gravite_cnt
  FROM detail GROUP BY ROLLUP ({KEY_LIST})
)"""


def _over_cube(query: str) -> str:
    return with_parts(
        FACT_PARTS,
        COUNTRY_PARTS,
        WEATHER_PARTS,
        PLACE_PARTS,
        PERSON_PARTS,
        CALENDAR_PARTS,
        CUBE_PARTS,
        query=query,
    )


CELL_MEAN = "(CAST(sum(CAST(gravite_moyenne AS DECIMAL(20,2))) AS DOUBLE) / count(gravite_moyenne))"
TRUE_MEAN = "(sum(gravite_sum) / sum(gravite_cnt))"


def _rank_sql(where: str, mean: str) -> str:
    return f"""
SELECT nom_pays, conditions, nb_accidents, {round2("mean")} AS gravite_moyenne,
       rank() OVER (PARTITION BY nom_pays ORDER BY mean DESC NULLS LAST) AS rang_conditions
FROM (SELECT nom_pays, conditions, CAST(sum(nb_accidents) AS BIGINT) AS nb_accidents, {mean} AS mean
      FROM cube WHERE {where} GROUP BY nom_pays, conditions)
ORDER BY nom_pays, rang_conditions, conditions"""


def _sets_sql(where: str, mean: str) -> str:
    return f"""
SELECT coalesce(nom_pays, 'TOTAL') AS nom_pays, coalesce(conditions, 'TOUTES') AS conditions,
       CAST(grouping(nom_pays, conditions) AS BIGINT) AS gid,
       CAST(sum(nb_accidents) AS BIGINT) AS nb_accidents_graves, {round2(mean)} AS gravite_moyenne
FROM cube WHERE {where}
GROUP BY GROUPING SETS ((nom_pays, conditions), (nom_pays), ())"""


def _zones_sql(where: str, mean: str) -> str:
    smooth = "CAST(sum(CAST(mean AS DECIMAL(20,10))) OVER w AS DOUBLE) / count(mean) OVER w"
    return f"""
SELECT nom_pays, zone, conditions, nb_accidents_graves, {round2("mean")} AS gravite_moyenne,
       {round2(smooth)} AS gravite_lissee
FROM (SELECT nom_pays, zone, conditions, CAST(sum(nb_accidents) AS BIGINT) AS nb_accidents_graves,
             {mean} AS mean
      FROM cube WHERE {where} GROUP BY nom_pays, zone, conditions HAVING sum(nb_accidents) >= 50)
WINDOW w AS (PARTITION BY nom_pays, zone ORDER BY conditions NULLS LAST ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)
ORDER BY gravite_moyenne DESC NULLS LAST, nom_pays NULLS LAST, zone NULLS LAST, conditions NULLS LAST LIMIT 20"""


VIEW_SQL = _over_cube(f"SELECT {', '.join(VIEW_COLUMNS)} FROM cube")
LEVEL_6 = f"gid = {(1 << 5) - 1}"
ORACLES = {
    "cube_build": VIEW_SQL,
    "cube_refresh": VIEW_SQL,
    "cube_refresh_incremental": VIEW_SQL,
    "cube_q1": _over_cube(_rank_sql(LEVEL_6, TRUE_MEAN)),
    "cube_q1_legacy": _over_cube(_rank_sql("nom_pays IS NOT NULL AND conditions IS NOT NULL", CELL_MEAN)),
    "cube_q2": _over_cube(_sets_sql("gid = 0 AND gravite_moyenne > 4", TRUE_MEAN)),
    "cube_q2_legacy": _over_cube(_sets_sql("gravite_moyenne > 4", CELL_MEAN)),
    "cube_q3": _over_cube(_zones_sql("gid = 0 AND gravite_moyenne > 4 AND zone IS NOT NULL", TRUE_MEAN)),
    "cube_q3_legacy": _over_cube(_zones_sql("gravite_moyenne > 4 AND zone IS NOT NULL", CELL_MEAN)),
}
