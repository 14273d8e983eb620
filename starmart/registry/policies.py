"""Row policies by role."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from starmart.operators.policies import WAREHOUSE_ACCESS, as_role, update_as_role
from starmart.plans.warehouse import Warehouse
from starmart.registry.sql import FACT_PARTS, PERSON_PARTS, with_parts
from starmart.schemas import TABLES
from starmart.sources.scratch import scratch_path
from starmart.sources.testdata import star

# A role that may read the fact but has no policy on it, and a doctor who may also update.
RULES = replace(
    WAREHOUSE_ACCESS,
    grants=[
        *WAREHOUSE_ACCESS.grants,
        ("visiteur", "fait_accident", "select"),
        ("medecin", "dim_usager", "update"),
    ],
)


def _fact_as(role):
    def query(spark, sf_dir):
        seen = as_role(star(spark, sf_dir).fact, "fait_accident", role, RULES)
        return seen.groupBy("id_pays").agg(F.count(F.lit(1)).alias("nb_accidents"))

    return query


def policy_medecin(spark, sf_dir):
    seen = as_role(star(spark, sf_dir).person, "dim_usager", "medecin", RULES)
    return seen.groupBy("gravite").agg(F.count(F.lit(1)).alias("nb_usagers"))


def policy_policier(spark, sf_dir):
    seen = as_role(star(spark, sf_dir).vehicle, "dim_vehicule", "policier", RULES)
    return seen.agg(F.count(F.lit(1)).alias("nb_vehicules"))


def policy_denied_rows(spark, sf_dir):
    seen = as_role(star(spark, sf_dir).fact, "fait_accident", "visiteur", RULES)
    return seen.agg(F.count(F.lit(1)).alias("nb_accidents"))


def policy_cross_country(spark, sf_dir):
    seen = as_role(star(spark, sf_dir).fact, "fait_accident", "francais", RULES)
    return seen.filter(F.col("id_pays") == 2).agg(F.count(F.lit(1)).alias("nb_accidents"))


def policy_update(spark, sf_dir):
    """The doctor marks the people they may see; the others stay."""
    people = star(spark, sf_dir).person
    changed = update_as_role(people, "dim_usager", "medecin", {"cat_usager": F.lit("Suivi")}, RULES)
    return changed.groupBy("gravite", "cat_usager").agg(F.count(F.lit(1)).alias("nb_usagers"))


def policy_update_stored(spark, sf_dir):
    """The doctor's update written to a stored table of people and read from its next version."""
    warehouse = Warehouse(spark, scratch_path(spark, "policy-warehouse"))
    given = star(spark, sf_dir).person.withColumn("id_usager", F.xxhash64("id_usager"))
    columns = [F.col(f.name) if f.name in given.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in TABLES["dim_usager"]]
    warehouse.append("dim_usager", given.select(*columns))
    warehouse.update_as_role("dim_usager", "medecin", {"cat_usager": F.lit("Suivi")}, RULES)
    return warehouse.read("dim_usager").groupBy("gravite", "cat_usager").agg(F.count(F.lit(1)).alias("nb_usagers"))


QUERIES = {
    "policy_francais": _fact_as("francais"),
    "policy_anglais": _fact_as("anglais"),
    "policy_admin": _fact_as("admin_global"),
    "policy_medecin": policy_medecin,
    "policy_policier": policy_policier,
    "policy_denied_rows": policy_denied_rows,
    "policy_cross_country": policy_cross_country,
    "policy_update": policy_update,
    "policy_update_stored": policy_update_stored,
}

BY_COUNTRY = "SELECT id_pays, count(*) AS nb_accidents FROM fact {} GROUP BY id_pays"
UPDATED = with_parts(
    PERSON_PARTS,
    query="""SELECT gravite, CASE WHEN gravite <> 'Slightly injured' THEN 'Suivi' ELSE cat_usager END AS cat_usager,
                    count(*) AS nb_usagers FROM person GROUP BY 1, 2""",
)
ORACLES = {
    "policy_francais": with_parts(FACT_PARTS, query=BY_COUNTRY.format("WHERE id_pays = 1")),
    "policy_anglais": with_parts(FACT_PARTS, query=BY_COUNTRY.format("WHERE id_pays = 2")),
    "policy_admin": with_parts(FACT_PARTS, query=BY_COUNTRY.format("")),
    "policy_medecin": with_parts(
        PERSON_PARTS,
        query="""SELECT gravite, count(*) AS nb_usagers FROM person
                 WHERE gravite IN ('Killed', 'Seriously injured') GROUP BY gravite""",
    ),
    "policy_policier": "SELECT count(*) AS nb_vehicules FROM part",
    "policy_denied_rows": with_parts(FACT_PARTS, query="SELECT count(*) AS nb_accidents FROM fact WHERE false"),
    "policy_cross_country": with_parts(
        FACT_PARTS, query="SELECT count(*) AS nb_accidents FROM fact WHERE id_pays = 1 AND id_pays = 2"
    ),
    "policy_update": UPDATED,
    "policy_update_stored": UPDATED,
}
