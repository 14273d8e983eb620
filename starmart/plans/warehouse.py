"""A warehouse folder: whole build, incremental load, reading back."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import codebooks
from starmart.operators.checks import check_table
from starmart.operators.keys import dense_ids, next_id
from starmart.operators.loading import new_records, rows_of_wanted, rows_to_insert
from starmart.operators.policies import WAREHOUSE_ACCESS, AccessRules, may_change, update_as_role
from starmart.plans.calendar import calendar_staging, days_of_years, dim_temps, number_days
from starmart.plans.star import ENTITY_KEY, Staging, assign_keys, build_tables, dim_pays
from starmart.plans.star_queries import Star
from starmart.plans.weather import dim_meteo
from starmart.schemas import EXTRA_TABLES, LOAD_ORDER, RULES, TABLES, TableRules
from starmart.sources import deliveries, snapshots
from starmart.sources.raw_accidents import stage_fr, stage_uk, years_without_index
from starmart.sources.raw_weather import read_weather
from starmart.sources.scratch import stored

# About 50 MB of the few columns a question takes from a dimension.
BROADCAST_ROWS = 500_000

YEAR_LAYOUT = ["id_pays", "annee"]
ENTITY_TABLES = ["dim_localisation", "dim_usager", "dim_vehicule", "fait_accident", "cle_accident"]

ID_OF = {
    "fait_accident": "id_accident",
    "dim_localisation": "id_lieu",
    "dim_usager": "id_usager",
    "dim_vehicule": "id_vehicule",
}


class BrokenRules(ValueError):
    """A load would break keys or references; nothing of it is published."""


class Warehouse:
    """Parquet tables below one folder, read and loaded version by version (``sources.snapshots``).

    Every load is a batch: readers see all of it or nothing, and one that breaks can be run
    again.  Loads called inside ``with warehouse.batch()`` are one batch together.
    One writer at a time; a second one is refused when it publishes.
    """

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.version = version
        self.folder = snapshots.Folder(spark, self.root)
        self._batch: snapshots.Batch | None = None

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def snapshot(self) -> snapshots.Snapshot:
        """The open batch, the version asked for, or the current one."""
        if self._batch is not None:
            return self._batch
        return snapshots.latest(self.folder) if self.version is None else snapshots.opened(self.folder, self.version)

    @contextmanager
    def batch(self) -> Iterator[snapshots.Batch]:
        """One version for all writes inside; an error publishes nothing."""
        if self._batch is not None:
            yield self._batch
            return
        self._batch = snapshots.Batch(snapshots.latest(self.folder))
        try:
            yield self._batch
            self._batch.publish()
        finally:
            self._batch = None

    def read(self, table: str) -> DataFrame:
        return self.snapshot().read(table, TABLES.get(table) or EXTRA_TABLES[table])

    def append(self, table: str, rows: DataFrame, gathered: bool = False) -> None:
        """Add rows in the table's layout.

        Tables that come from accident files are stored by country and year, so that country policies
        and year filters read only their folders and a corrected year is exchanged as a whole.
        The year is that of the rows' ``annee``, or of the fact's date.  The rebalance gives
        each folder few files, and a country that holds most rows several of them.  ``gathered`` rows lie by
        country and year already, a few of them in a task, and are written where they are.
        """
        with self.batch() as batch:
            if table in ENTITY_TABLES:
                if "annee" not in rows.columns:
                    rows = rows.withColumn("annee", F.year("date") if "date" in rows.columns else F.lit(0))
                batch.append(table, rows if gathered else rows.hint("rebalance", *YEAR_LAYOUT), YEAR_LAYOUT)
            else:
                batch.append(table, rows)

    def has(self, table: str) -> bool:
        return self.snapshot().has(table)

    def broadcast_if_small(self, table: str) -> DataFrame:
        """Marked for broadcast only when counted small; the count reads file footers."""
        df = self.read(table)
        return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df

    def star(self) -> Star:
        """Country, calendar and weather have a row per country and day at most."""
        return Star(
            fact=self.read("fait_accident"),
            country=self.broadcast_if_small("dim_pays"),
            calendar=self.broadcast_if_small("dim_temps"),
            place=self.read("dim_localisation"),
            weather=self.broadcast_if_small("dim_meteo"),
            person=self.read("dim_usager"),
            vehicle=self.read("dim_vehicule"),
        )

    def load_dimension(self, table: str, rows: DataFrame) -> None:
        """Insert if absent on every unique key of the table.

        Days are known by their natural key: those not stored yet get ids above the stored ones,
        whatever ids the batch came with, and stored days keep theirs.
        """
        keys = RULES[table].unique
        with self.batch() as batch:
            known = self.read(table) if self.has(table) else None
            if len(keys) > 1 and known is not None:
                (id_col,), natural = keys[0], keys[1]
                new = new_records(rows, known, natural).drop(id_col)
                ids = F.col(id_col).cast(rows.schema[id_col].dataType).alias(id_col)
                numbered = dense_ids(new, id_col, natural, start=next_id(known, id_col))
                rows = numbered.select(*[ids if c == id_col else c for c in rows.columns])
            batch.append(table, rows_to_insert(rows, known, keys, keys[0]))

    def load_accidents(self, staging: Staging, corrected: Sequence[tuple[int, int]] = (), check: bool = True) -> None:
        """Append the accidents whose source key is not stored; new keys go on above the old.

        Incomplete accidents are remembered as well, so that their people and places are
        not loaded again.  ``corrected`` names (country, year) pairs that ``staging`` holds anew and in whole:
        their stored rows are left out of the new version, accidents that were known keep their id, and
        people, places and vehicles are new rows.  With ``check`` the references of the new
        facts are looked up before anything is published.
        """
        parts = ("accidents", "places", "people", "vehicles")
        staging = Staging(*[getattr(staging, p).withColumn("cle", F.col("cle").cast("string")) for p in parts])
        with self.batch() as batch:
            starts, kept = None, None
            if self.has("cle_accident"):
                known = self.read("cle_accident")
                starts = {id_col: next_id(self.read(table), id_col) for table, id_col in ID_OF.items()}
                starts["id_accident"] = next_id(known, "id_accident")
                redone = self._of_years(corrected)
                if corrected:
                    kept = stored(known.where(redone), "corrected-keys")
                    known = known.where(~redone)
                    for table in ENTITY_TABLES:
                        batch.drop(table, [f"id_pays={c}/annee={y}" for c, y in corrected])
                accidents = stored(new_records(staging.accidents, known, ENTITY_KEY), "new-accidents")
                fresh = accidents.select(*ENTITY_KEY)
                rest = [rows_of_wanted(getattr(staging, part), fresh, ENTITY_KEY, YEAR_LAYOUT) for part in parts[1:]]
                staging = Staging(accidents, *rest)
            tables = build_tables(assign_keys(staging, starts, kept), with_year=True)
            for name in [*(t for t in LOAD_ORDER if t in tables), "cle_accident"]:
                # rows numbered along country and year lie together already
                self.append(name, tables[name], gathered=name != "fait_accident" and (name != "cle_accident" or kept is None))
            if check and self.has("dim_pays"):
                self._check_new(batch)

    def load_files(self, raw: Mapping[str, str], years: Sequence[int] | None = None, check: bool = True) -> deliveries.Plan:
        """Take the delivered accident years that are complete and not taken yet, in one version.

        A corrected year (other files than were taken, or other sizes) takes the place of the stored
        one.  Gives what became of every delivered year; with nothing to take no version is made.
        """
        spark = self.spark
        kinds = [(deliveries.FR, raw["accidents_fr"]), (deliveries.UK, raw["accidents_uk"])]
        files = stored(reduce(DataFrame.unionByName, [deliveries.delivered(spark, root, c, years) for c, root in kinds]), "deliveries")
        ledger = self.read("livraison") if self.has("livraison") else None
        made = deliveries.plan(deliveries.year_states(files, ledger))
        made = made.without([(deliveries.UK, y) for y in years_without_index(spark, raw["accidents_uk"], made.years(deliveries.UK))])
        if not made.wanted:
            return made
        with self.batch() as batch:
            stages = [(deliveries.FR, stage_fr, raw["accidents_fr"]), (deliveries.UK, stage_uk, raw["accidents_uk"])]
            parts = [stage(spark, root, made.years(c)) for c, stage, root in stages if made.years(c)]
            self.load_accidents(reduce(Staging.union, parts), made.corrected, check)
            batch.replace("livraison", deliveries.recorded(files, made, ledger).coalesce(1))
        return made

    def update_as_role(self, table: str, role: str, changes: Mapping[str, Column], rules: AccessRules = WAREHOUSE_ACCESS) -> list[str]:
        """Write the changes of a role to the rows it may see and change, as a new version; gives the parts written anew.

        Only parts of the table (a load's folder of a country and year) that hold such a row are
        read whole and written again; the other parts are carried over as they are.  Readers of the
        version before keep it.  Without such a row no version is made.
        """
        mine = may_change(table, role, rules)
        held = self.snapshot().read(table).where(mine)
        # names of parts, which the version lists anyway
        part = F.regexp_extract(F.col("_metadata.file_path"), r"/(lot=.*)/[^/]*$", 1)
        touched = sorted(r["part"] for r in held.select(part.alias("part")).distinct().collect())
        if not touched:
            return []
        with self.batch() as batch:
            rows = snapshots.Snapshot(batch.folder, batch.version, {table: touched}).read(table)
            batch.parts[table] = [p for p in batch.parts[table] if p not in touched]
            self.append(table, update_as_role(rows, table, role, changes, rules))
        return touched

    @staticmethod
    def _of_years(pairs: Sequence[tuple[int, int]]) -> Column:
        return reduce(lambda a, b: a | b, [(F.col("id_pays") == c) & (F.col("annee") == y) for c, y in pairs], F.lit(False))

    def _check_new(self, batch: snapshots.Batch) -> None:
        """References and widths of the rows this batch wrote; looks at new rows only."""
        before = batch.base.parts
        new = {t: [p for p in parts if p not in before.get(t, [])] for t, parts in batch.parts.items()}
        written = snapshots.Snapshot(batch.folder, batch.version, {t: p for t, p in new.items() if p and t in RULES})
        broken = []
        for name in written.parts:
            rules = RULES[name]
            # keys are given by this load above all stored ones, so what is left to check are references and widths
            rules = TableRules([], rules.foreign, rules.widths)
            tables = {name: written.read(name, TABLES[name]), **{p: self.read(p) for _, p, _ in rules.foreign}}
            broken.append(check_table(name, tables, rules))
        found = reduce(DataFrame.unionByName, broken).where("broken > 0").collect() if broken else []
        if found:
            raise BrokenRules("; ".join(f"{r['table']}: {r['rule']} broken by {r['broken']}" for r in found))

    def check(self) -> DataFrame:
        """Broken unique, foreign-key and width rules of every table."""
        tables = {name: self.read(name) for name in LOAD_ORDER}
        return reduce(DataFrame.unionByName, [check_table(name, tables) for name in LOAD_ORDER])

    def summary(self) -> DataFrame:
        counts = [
            self.read(name).agg(F.count(F.lit(1)).alias("lignes")).select(F.lit(name).alias("nom"), "lignes")
            for name in [*LOAD_ORDER, "cle_accident"]
        ]
        return reduce(DataFrame.unionByName, counts)


def build_warehouse(spark: SparkSession, raw: Mapping[str, str], root: str, years=None) -> Warehouse:
    """From raw folders (accidents_fr, accidents_uk, meteo_fr, meteo_uk) to a loaded warehouse, as one version.

    Run again over more files it loads what is new or corrected.
    """
    years = list(years or codebooks.WAREHOUSE_YEARS)
    warehouse = Warehouse(spark, root)
    with warehouse.batch():
        warehouse.load_dimension("dim_pays", dim_pays(spark))
        warehouse.load_dimension("dim_temps", dim_temps(number_days(calendar_staging(days_of_years(spark, years)))))
        warehouse.load_dimension("dim_meteo", dim_meteo(read_weather(spark, raw["meteo_fr"], raw["meteo_uk"], years)))
        warehouse.load_files(raw, years)
    return warehouse
