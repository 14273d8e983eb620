"""Analytical questions over the star."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.plans import star_queries as q
from starmart.plans.calendar import holidays
from starmart.registry.sql import (
    CALENDAR_PARTS,
    COUNTRY_PARTS,
    FACT_PARTS,
    HOLIDAY_PARTS,
    PERSON_PARTS,
    PLACE_PARTS,
    WEATHER_PARTS,
    round2,
    with_parts,
)
from starmart.sources.testdata import star

MEAN = round2("sum(indice_gravite) / count(*)")


def _on_star(question):
    return lambda spark, sf_dir: question(star(spark, sf_dir))


QUERIES = {
    name: _on_star(getattr(q, name))
    for name in [
        "victims_by_weather",
        "top_days",
        "severity_by_country",
        "severity_by_place_top10",
        "severity_rank_global",
        "avg_severity_by_weather_country",
        "serious_by_weather",
        "serious_by_zone",
        "accidents_by_sex_severity",
        "accidents_by_sex_severity_literal",
        "accidents_by_sex_severity_rollup",
        "severity_holiday_weather",
        "severity_bands",
    ]
}



def severity_holiday_by_country(spark, sf_dir):
    """The first two countries keep French holidays, the others British ones."""
    data = star(spark, sf_dir)
    free = holidays(data.calendar.select("annee"))
    followed = F.when(F.col("id_pays") <= 1, "FR").otherwise("UK").alias("country")
    own = data.country.select("id_pays", followed).join(free, "country").select("id_pays", "date")
    return q.severity_holiday_by_country(data, own)


QUERIES["severity_holiday_by_country"] = severity_holiday_by_country

BAND = """CASE WHEN indice_gravite >= 10 THEN '10+' WHEN indice_gravite >= 4 THEN '4-9'
               WHEN indice_gravite >= 1 THEN '1-3' ELSE '0' END"""

ORACLES = {
    "victims_by_weather": with_parts(
        FACT_PARTS,
        WEATHER_PARTS,
        query="""SELECT conditions, CAST(sum(nb_victimes_total) AS BIGINT) AS nb_victimes_meteo
                 FROM fact JOIN weather USING (id_pays, date) GROUP BY conditions""",
    ),
    "top_days": with_parts(
        FACT_PARTS,
        WEATHER_PARTS,
        query="""SELECT date, conditions, count(*) AS nb_accident
                 FROM fact JOIN weather USING (id_pays, date) GROUP BY date, conditions
                 ORDER BY nb_accident DESC, date, conditions LIMIT 10""",
    ),
    "severity_by_country": with_parts(
        FACT_PARTS,
        query="SELECT id_pays, sum(indice_gravite) AS gravite FROM fact GROUP BY id_pays",
    ),
    "severity_by_place_top10": with_parts(
        FACT_PARTS,
        PLACE_PARTS,
        query="""SELECT id_pays, id_lieu, sum(indice_gravite) AS gravite
                 FROM fact JOIN place USING (id_pays, id_lieu) GROUP BY id_pays, id_lieu
                 ORDER BY gravite DESC NULLS LAST, id_pays, id_lieu LIMIT 10""",
    ),
    "severity_rank_global": with_parts(
        FACT_PARTS,
        PLACE_PARTS,
        WEATHER_PARTS,
        query="""SELECT id_pays, id_lieu, conditions, sum(indice_gravite) AS gravite,
                        rank() OVER (ORDER BY sum(indice_gravite) DESC NULLS LAST) AS rang
                 FROM fact JOIN place USING (id_pays, id_lieu) JOIN weather USING (id_pays, date)
                 GROUP BY id_pays, id_lieu, conditions""",
    ),
    "avg_severity_by_weather_country": with_parts(
        FACT_PARTS,
        COUNTRY_PARTS,
        WEATHER_PARTS,
        query=f"""SELECT nom_pays, conditions, {MEAN} AS gravite_moyenne, count(*) AS nb_accidents
                  FROM fact JOIN country USING (id_pays) JOIN weather USING (id_pays, date)
                  GROUP BY nom_pays, conditions ORDER BY nom_pays, gravite_moyenne DESC, conditions""",
    ),
    "serious_by_weather": with_parts(
        FACT_PARTS,
        WEATHER_PARTS,
        query=f"""SELECT conditions, count(*) AS nb_accidents_graves, {MEAN} AS gravite_moyenne
                  FROM fact JOIN weather USING (id_pays, date) WHERE indice_gravite > 4
                  GROUP BY conditions ORDER BY gravite_moyenne DESC, conditions""",
    ),
    "serious_by_zone": with_parts(
        FACT_PARTS,
        COUNTRY_PARTS,
        PLACE_PARTS,
        WEATHER_PARTS,
        query=f"""SELECT nom_pays, coalesce(departement, district) AS zone, conditions,
                         count(*) AS nb_accidents_graves, {MEAN} AS gravite_moyenne
                  FROM fact JOIN place USING (id_lieu) JOIN weather ON fact.id_pays = weather.id_pays
                       AND fact.date = weather.date JOIN country ON fact.id_pays = country.id_pays
                  WHERE indice_gravite > 4
                  GROUP BY nom_pays, departement, district, conditions HAVING count(*) >= 50
                  ORDER BY gravite_moyenne DESC NULLS LAST, nom_pays, zone, conditions LIMIT 20""",
    ),
    "accidents_by_sex_severity": with_parts(
        FACT_PARTS,
        COUNTRY_PARTS,
        PERSON_PARTS,
        query="""SELECT fact.id_pays, nom_pays, sexe, indice_gravite, count(DISTINCT id_accident) AS nb_accidents
                 FROM fact JOIN person USING (id_usager) JOIN country ON country.id_pays = fact.id_pays
                 GROUP BY ALL""",
    ),
    "accidents_by_sex_severity_literal": with_parts(
        FACT_PARTS,
        COUNTRY_PARTS,
        PERSON_PARTS,
        query="""SELECT f.id_pays, nom_pays, sexe, indice_gravite, nb_accidents
                 FROM (SELECT id_pays, indice_gravite, count(DISTINCT id_accident) AS nb_accidents
                       FROM fact GROUP BY ALL) f
                 JOIN (SELECT DISTINCT id_pays, sexe FROM person) p ON p.id_pays = f.id_pays
                 JOIN country c ON c.id_pays = f.id_pays""",
    ),
    "accidents_by_sex_severity_rollup": with_parts(
        FACT_PARTS,
        COUNTRY_PARTS,
        PERSON_PARTS,
        query=f"""SELECT nom_pays, sexe, tranche, CAST(grouping(nom_pays, sexe, tranche) AS BIGINT) AS gid,
                         count(*) AS nb_accidents
                  FROM (SELECT nom_pays, sexe, {BAND} AS tranche
                        FROM fact JOIN person USING (id_usager) JOIN country ON country.id_pays = fact.id_pays)
                  GROUP BY ROLLUP (nom_pays, sexe, tranche)""",
    ),
    "severity_holiday_weather": with_parts(
        FACT_PARTS,
        WEATHER_PARTS,
        CALENDAR_PARTS,
        query=f"""SELECT est_jour_ferie, conditions, count(*) AS nb_accidents, {MEAN} AS gravite_moyenne
                  FROM fact JOIN weather USING (id_pays, date) JOIN calendar USING (date)
                  GROUP BY est_jour_ferie, conditions""",
    ),
    "severity_holiday_by_country": with_parts(
        FACT_PARTS,
        WEATHER_PARTS,
        HOLIDAY_PARTS,
        query=f"""SELECT EXISTS (SELECT 1 FROM holiday h WHERE h.date = fact.date
                                 AND h.country = CASE WHEN fact.id_pays <= 1 THEN 'FR' ELSE 'UK' END) AS est_jour_ferie,
                         conditions, count(*) AS nb_accidents, {MEAN} AS gravite_moyenne
                  FROM fact JOIN weather USING (id_pays, date) GROUP BY 1, 2""",
    ),
    "severity_bands": with_parts(
        FACT_PARTS,
        query=f"SELECT {BAND} AS tranche, count(*) AS nb_accidents FROM fact GROUP BY 1",
    ),
}
