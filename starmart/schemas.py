"""Warehouse table types, keys and width limits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}


def _struct(columns: str) -> T.StructType:
    """Struct of "name type" pairs, without needing a session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TABLES = {
    "dim_pays": _struct("id_pays int, code_pays string, nom_pays string"),
    "dim_temps": _struct(
        "id_date int, date date, annee int, mois int, jour int, heure int, "
        "saison string, est_weekend boolean, est_jour_ferie boolean"
    ),
    "dim_localisation": _struct(
        "id_lieu bigint, id_pays int, commune string, departement string, district string, "
        "type_route string, vitesse_limite int, latitude double, longitude double"
    ),
    "dim_meteo": _struct(
        "id_meteo bigint, id_pays int, date date, temp_max double, temp_min double, "
        "precipitations double, vent double, conditions string"
    ),
    "dim_usager": _struct(
        "id_usager bigint, id_pays int, age int, sexe string, place_vehicule string, "
        "gravite string, cat_usager string"
    ),
    "dim_vehicule": _struct(
        "id_vehicule bigint, id_pays int, type_vehicule string, manoeuvre string, "
        "nb_occupants int, motorisation string"
    ),
    "fait_accident": _struct(
        "id_accident bigint, id_pays int, date date, id_lieu bigint, id_usager bigint, "
        "id_vehicule bigint, nb_tues int, nb_blesses_graves int, nb_blesses_legers int, "
        "nb_victimes_total int, nb_vehicules int, indice_gravite double"
    ),
}

# Kept beside the warehouse's own tables: which source key has which id, and which files were taken.
EXTRA_TABLES = {
    "cle_accident": _struct("id_pays int, annee int, cle string, id_accident bigint"),
    "livraison": _struct("id_pays int, annee int, genre string, fichier string, taille bigint, etat string"),
}


@dataclass(frozen=True)
class TableRules:
    """What a relational store would enforce and Spark has to check."""

    unique: list[list[str]]
    foreign: list[tuple[list[str], str, list[str]]] = field(default_factory=list)
    widths: dict[str, int] = field(default_factory=dict)


_TO_COUNTRY = (["id_pays"], "dim_pays", ["id_pays"])

RULES = {
    "dim_pays": TableRules([["id_pays"]], widths={"code_pays": 10, "nom_pays": 100}),
    "dim_temps": TableRules([["id_date"], ["date"]], widths={"saison": 20}),
    "dim_localisation": TableRules(
        [["id_lieu"]],
        [_TO_COUNTRY],
        {"commune": 50, "departement": 20, "district": 50, "type_route": 50},
    ),
    "dim_meteo": TableRules([["id_meteo"], ["id_pays", "date"]], [_TO_COUNTRY], {"conditions": 50}),
    "dim_usager": TableRules(
        [["id_usager"]],
        [_TO_COUNTRY],
        {"sexe": 20, "place_vehicule": 50, "gravite": 50, "cat_usager": 50},
    ),
    "dim_vehicule": TableRules(
        [["id_vehicule"]],
        [_TO_COUNTRY],
        {"type_vehicule": 50, "manoeuvre": 100, "motorisation": 30},
    ),
    "fait_accident": TableRules(
        [["id_accident"]],
        [
            _TO_COUNTRY,
            (["id_lieu"], "dim_localisation", ["id_lieu"]),
            (["id_usager"], "dim_usager", ["id_usager"]),
            (["id_vehicule"], "dim_vehicule", ["id_vehicule"]),
        ],
    ),
}

# Dimensions before the fact, so that foreign keys can be checked on arrival.
LOAD_ORDER = [
    "dim_pays",
    "dim_temps",
    "dim_meteo",
    "dim_localisation",
    "dim_usager",
    "dim_vehicule",
    "fait_accident",
]
