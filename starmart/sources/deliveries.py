"""Which accident files were delivered, which years are complete, and which of them are to be taken.

The unit is a country's year: it needs one file at least of every kind.  A French year that lacks a kind is
an error; a British one is skipped, and so is one whose collision files have no index column.  A
taken year is remembered with its files and their sizes (table ``livraison``).  The same
files again are passed over without being opened; another set of files, or a file of
another size, has the whole year taken anew.

There is a row for a file, so all of this is small; file contents are not read here.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions import dates
from starmart.schemas import EXTRA_TABLES
from starmart.sources.delimited import list_files

FR, UK = 1, 2
UK_PREFIX = "dft-road-casualty-statistics"
# The file kinds of a year by country, and their file names.
KINDS = {
    FR: {kind: f"{kind}_*.csv" for kind in ("caracteristiques", "lieux", "usagers", "vehicules")},
    UK: {kind: f"{UK_PREFIX}-{kind}-*.csv" for kind in ("collision", "casualty", "vehicle")},
}
NEW, CORRECTED, TAKEN, INCOMPLETE = "nouveau", "corrige", "pris", "incomplet"


class IncompleteYear(FileNotFoundError):
    """A French year lacks one of its four files."""


def delivered(spark: SparkSession, root: str, country: int, years: Sequence[int] | None = None) -> DataFrame:
    """``id_pays, annee, genre, fichier, taille`` of the files below ``root``; names without a year are left out."""
    kinds = []
    for kind, pattern in KINDS[country].items():
        files = list_files(spark, root, pattern).select(
            F.lit(country).alias("id_pays"),
            dates.last_year_in_name(F.col("name")).alias("annee"),
            F.lit(kind).alias("genre"),
            F.col("path").alias("fichier"),
            F.col("length").alias("taille"),
        )
        kinds.append(files)
    files = reduce(DataFrame.unionByName, kinds).where(F.col("annee").isNotNull())
    return files if years is None else files.where(F.col("annee").isin(list(years)))


def year_states(files: DataFrame, ledger: DataFrame | None) -> DataFrame:
    """``id_pays, annee, etat, manque``: what is to be done with each delivered year, and the kinds it lacks."""
    wanted = F.when(F.col("id_pays") == FR, F.array(*map(F.lit, KINDS[FR]))).otherwise(F.array(*map(F.lit, KINDS[UK])))
    content = F.array_sort(F.collect_set(F.struct("genre", "fichier", "taille")))
    now = files.groupBy("id_pays", "annee").agg(content.alias("maintenant"), F.collect_set("genre").alias("genres"))
    if ledger is None:
        before = files.sparkSession.createDataFrame([], EXTRA_TABLES["livraison"])
    else:
        before = ledger.where(F.col("etat") == TAKEN)
    taken = before.groupBy("id_pays", "annee").agg(content.alias("avant"))
    missing = F.array_sort(F.array_except(wanted, F.col("genres")))
    state = (
        F.when(F.size("manque") > 0, INCOMPLETE)
        .when(F.col("avant").isNull(), NEW)
        .when(F.col("avant") == F.col("maintenant"), TAKEN)
        .otherwise(CORRECTED)
    )
    both = now.join(taken, ["id_pays", "annee"], "left").withColumn("manque", missing)
    return both.select("id_pays", "annee", state.alias("etat"), "manque")


@dataclass(frozen=True)
class Plan:
    """Years by what happens to them: (country, year) pairs."""

    new: list[tuple[int, int]]
    corrected: list[tuple[int, int]]
    same: list[tuple[int, int]]
    incomplete: list[tuple[int, int]]

    @property
    def wanted(self) -> list[tuple[int, int]]:
        return sorted(self.new + self.corrected)

    def years(self, country: int) -> list[int]:
        return [y for c, y in self.wanted if c == country]

    def without(self, skipped: Sequence[tuple[int, int]]) -> Plan:
        """The same with ``skipped`` years among the incomplete ones."""
        gone = set(skipped)
        left = [[p for p in part if p not in gone] for part in (self.new, self.corrected)]
        return Plan(left[0], left[1], self.same, sorted({*self.incomplete, *gone}))


def plan(states: DataFrame) -> Plan:
    """The plan of ``year_states``; raises for a French year that lacks a kind."""
    by: dict[str, list[tuple[int, int]]] = {NEW: [], CORRECTED: [], TAKEN: [], INCOMPLETE: []}
    for r in sorted(states.collect(), key=lambda r: (r["id_pays"], r["annee"])):
        if r["etat"] == INCOMPLETE and r["id_pays"] == FR:
            raise IncompleteYear(f"year {r['annee']} lacks {', '.join(r['manque'])}")
        by[r["etat"]].append((r["id_pays"], r["annee"]))
    return Plan(by[NEW], by[CORRECTED], by[TAKEN], by[INCOMPLETE])


def recorded(files: DataFrame, made: Plan, ledger: DataFrame | None) -> DataFrame:
    """The ledger after a load by ``made``: its years' files, and the others as they were."""
    pairs = lambda some: reduce(lambda a, b: a | b, [(F.col("id_pays") == c) & (F.col("annee") == y) for c, y in some], F.lit(False))
    names = EXTRA_TABLES["livraison"].fieldNames()
    now = files.where(pairs(made.wanted)).withColumn("etat", F.lit(TAKEN))
    waiting = files.where(pairs(made.incomplete)).withColumn("etat", F.lit(INCOMPLETE))
    rows = now.unionByName(waiting).select(*names)
    if ledger is not None:
        rows = rows.unionByName(ledger.where(~pairs([*made.wanted, *made.incomplete])).select(*names))
    return rows
