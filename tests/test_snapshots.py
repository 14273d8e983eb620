"""Loads that break, come late, are corrected or refused."""

import datetime
import os
import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from raw_fixture import FR_FILES, PREFIX, UK_FILES, write_raw

from starmart.operators.policies import WAREHOUSE_ACCESS
from starmart.plans.star import Staging, dim_pays
from starmart.plans.warehouse import BrokenRules, Warehouse
from starmart.sources import deliveries, snapshots
from starmart.sources.raw_accidents import years_without_index

DAY = datetime.date
TABLES = ["dim_localisation", "dim_usager", "dim_vehicule", "fait_accident", "cle_accident"]


def fresh():
    return tempfile.mkdtemp(prefix="run-")


def tiny(spark, *accidents):
    """Staging of (country, year, key, severities) with a place, and a vehicle for each person."""
    pos = "pos struct<n: int>"
    acc, places, people, vehicles = [], [], [], []
    for i, (country, year, key, grades) in enumerate(accidents):
        acc.append((country, year, key, DAY(year, 1, 2), (i,)))
        places.append((country, year, key, (i,), "1", "d", None, "Motorway", 50, 1.0, 2.0))
        for j, grade in enumerate(grades):
            people.append((country, year, key, "", (10 * i + j,), 30, "Male", None, grade, "Driver"))
            vehicles.append((country, year, key, "", (10 * i + j,), "Car", "Parked", 1, "Petrol"))
    head = "id_pays int, annee int, cle string"
    return Staging(
        spark.createDataFrame(acc, f"{head}, date date, {pos}"),
        spark.createDataFrame(places, f"{head}, {pos}, commune string, departement string, district string, type_route string, vitesse_limite int, latitude double, longitude double"),
        spark.createDataFrame(people, f"{head}, veh_src string, {pos}, age int, sexe string, place_vehicule string, gravite string, cat_usager string"),
        spark.createDataFrame(vehicles, f"{head}, veh_src string, {pos}, type_vehicule string, manoeuvre string, nb_occupants int, motorisation string"),
    )


def content(warehouse):
    return {t: sorted(map(str, warehouse.read(t).collect())) for t in TABLES}


FIRST = [(1, 2005, "A", ["Killed"]), (2, 2005, "A", ["Slightly injured", "Killed"])]
MORE = [*FIRST, (1, 2006, "A", ["Seriously injured"]), (2, 2006, "B", [])]


@pytest.mark.parametrize("broken_write", [0, len(TABLES) - 1])
def test_a_load_that_breaks_leaves_nothing_and_can_be_run_again(spark, monkeypatch, broken_write):
    whole, warehouse = Warehouse(spark, fresh()), Warehouse(spark, fresh())
    for w in (whole, warehouse):
        w.load_accidents(tiny(spark, *FIRST))
    before, version = content(warehouse), warehouse.snapshot().version
    whole.load_accidents(tiny(spark, *MORE))
    real, calls = snapshots.Batch.append, []

    def append(self, table, rows, partition_by=()):
        real(self, table, rows, partition_by)
        calls.append(table)
        if len(calls) == broken_write + 1:
            raise OSError("lost")

    monkeypatch.setattr(snapshots.Batch, "append", append)
    with pytest.raises(OSError):
        warehouse.load_accidents(tiny(spark, *MORE))
    monkeypatch.setattr(snapshots.Batch, "append", real)
    assert content(warehouse) == before and warehouse.snapshot().version == version
    warehouse.load_accidents(tiny(spark, *MORE))
    assert content(warehouse) == content(whole)


def test_parts_of_broken_loads_and_old_versions_are_swept(spark):
    warehouse = Warehouse(spark, fresh())
    warehouse.load_accidents(tiny(spark, *FIRST))
    with pytest.raises(ZeroDivisionError), warehouse.batch():
        warehouse.load_accidents(tiny(spark, *MORE))
        1 / 0
    after_first = content(warehouse)
    warehouse.load_accidents(tiny(spark, *MORE))
    old = Warehouse(spark, warehouse.root, version=1)
    assert content(old) == after_first != content(warehouse)
    now = content(warehouse)
    removed = snapshots.sweep(warehouse.folder, keep=1)
    assert f"{snapshots.VERSIONS}/00000001.json" in removed and sum("cle_accident/" in r for r in removed) == 1
    assert content(warehouse) == now and snapshots.sweep(warehouse.folder, keep=1) == []


def test_a_second_writer_is_refused(spark):
    root = fresh()
    one, two = Warehouse(spark, root), Warehouse(spark, root)
    with pytest.raises(snapshots.ConcurrentLoad), one.batch():
        one.append("dim_pays", dim_pays(spark))
        two.append("dim_pays", dim_pays(spark).limit(1))
    assert one.read("dim_pays").count() == 1


def test_a_load_with_a_country_nobody_knows_is_refused(spark):
    warehouse = Warehouse(spark, fresh())
    warehouse.append("dim_pays", dim_pays(spark))
    warehouse.load_accidents(tiny(spark, *FIRST))
    before = content(warehouse)
    with pytest.raises(BrokenRules, match="foreign"):
        warehouse.load_accidents(tiny(spark, (7, 2005, "X", ["Killed"])))
    wide = tiny(spark, (1, 2007, "Y", ["Killed"]))
    wide.places = wide.places.withColumn("commune", F.repeat(F.lit("x"), 51))
    with pytest.raises(BrokenRules, match="width"):
        warehouse.load_accidents(wide)
    assert content(warehouse) == before


def test_a_corrected_year_takes_the_place_of_the_old_one(spark):
    warehouse = Warehouse(spark, fresh())
    warehouse.load_accidents(tiny(spark, *MORE))
    ids = {(r["id_pays"], r["annee"], r["cle"]): r["id_accident"] for r in warehouse.read("cle_accident").collect()}
    corrected = tiny(spark, (1, 2005, "N", ["Killed"]), (1, 2005, "A", ["Killed", "Killed"]), (1, 2005, "A", []))
    warehouse.load_accidents(corrected, corrected=[(1, 2005)])
    after = [(r["id_pays"], r["annee"], r["cle"], r["id_accident"]) for r in warehouse.read("cle_accident").collect()]
    kept = {a[:3]: a[3] for a in after if a[:3] in ids}
    assert (1, 2005, "A", ids[1, 2005, "A"]) in after and len(after) == 6 and len({a[3] for a in after}) == 6
    assert all(kept[k] == ids[k] for k in ids if k != (1, 2005, "A"))
    fact = {r["id_accident"]: r for r in warehouse.read("fait_accident").collect()}
    assert fact[ids[1, 2005, "A"]]["nb_tues"] == 2 and len(fact) == len(warehouse.read("fait_accident").collect())
    assert warehouse.read("dim_usager").where("id_pays = 1").count() == 4


# Deliveries -------------------------------------------------------------


def write(folder, files):
    for name, (encoding, text) in files.items():
        with open(os.path.join(folder, name), "w", encoding=encoding, newline="") as out:
            out.write(text)


def facts(warehouse):
    keys = warehouse.read("cle_accident").select("id_accident", "annee", "cle")
    fact = warehouse.read("fait_accident").join(keys, "id_accident")
    return sorted(tuple(r) for r in fact.select("id_pays", "annee", "cle", "nb_tues", "nb_victimes_total", "nb_vehicules", "indice_gravite").collect())


def test_years_come_complete_late_and_corrected(spark):
    raw = write_raw(fresh())
    at_once = Warehouse(spark, fresh())
    assert at_once.load_files(raw).wanted == [(1, 2005), (1, 2007), (2, 2005)]
    late = {f"{PREFIX}-casualty-2005.csv": UK_FILES[f"{PREFIX}-casualty-2005.csv"]}
    os.remove(os.path.join(raw["accidents_uk"], *late))
    short = FR_FILES["usagers_2007.csv"][1].rsplit("\n", 2)[0] + "\n"
    write(raw["accidents_fr"], {"usagers_2007.csv": ("utf-8", short)})
    warehouse = Warehouse(spark, fresh())
    made = warehouse.load_files(raw)
    assert made.incomplete == [(2, 2005)] and made.wanted == [(1, 2005), (1, 2007)]
    assert facts(warehouse) != facts(at_once)
    states = {(r["id_pays"], r["annee"]): r["etat"] for r in warehouse.read("livraison").collect()}
    assert states == {(1, 2005): deliveries.TAKEN, (1, 2007): deliveries.TAKEN, (2, 2005): deliveries.INCOMPLETE}
    write(raw["accidents_uk"], late)
    write(raw["accidents_fr"], {"usagers_2007.csv": FR_FILES["usagers_2007.csv"]})
    made = warehouse.load_files(raw)
    assert made.new == [(2, 2005)] and made.corrected == [(1, 2007)] and made.same == [(1, 2005)]
    assert facts(warehouse) == facts(at_once)
    version = warehouse.snapshot().version
    assert warehouse.load_files(raw).wanted == [] and warehouse.snapshot().version == version


def test_a_french_year_without_a_file_is_an_error(spark):
    raw = write_raw(fresh())
    os.remove(os.path.join(raw["accidents_fr"], "lieux_2007.csv"))
    warehouse = Warehouse(spark, fresh())
    with pytest.raises(deliveries.IncompleteYear, match="2007 lacks lieux"):
        warehouse.load_files(raw)
    assert not warehouse.has("fait_accident")
    assert warehouse.load_files(raw, [2005]).wanted == [(1, 2005), (2, 2005)]


def test_a_british_year_without_index_is_skipped(spark):
    raw = write_raw(fresh())
    renamed = {n.replace("2005", "2006"): (e, t.replace("accident_index", "number", 1) if "collision" in n else t) for n, (e, t) in UK_FILES.items()}
    write(raw["accidents_uk"], renamed)
    assert years_without_index(spark, raw["accidents_uk"], [2005, 2006]) == [2006]
    warehouse = Warehouse(spark, fresh())
    made = warehouse.load_files(raw)
    assert made.incomplete == [(2, 2006)] and (2, 2005) in made.wanted
    assert {r["annee"] for r in warehouse.read("cle_accident").where("id_pays = 2").collect()} == {2005}


def test_a_number_used_again_in_another_year_is_another_accident(spark):
    raw = write_raw(fresh())
    write(raw["accidents_fr"], {n.replace("2007", "2006"): (e, t) for n, (e, t) in FR_FILES.items() if "2007" in n})
    warehouse = Warehouse(spark, fresh())
    warehouse.load_files(raw)
    twice = warehouse.read("fait_accident").join(warehouse.read("cle_accident").where("cle = 'B1'").select("id_accident", "annee"), "id_accident")
    got = sorted((r["annee"], r["nb_victimes_total"], r["nb_vehicules"]) for r in twice.collect())
    assert got == [(2006, 1, 2), (2007, 1, 2)] and warehouse.read("dim_localisation").where("departement = '310'").count() == 2


def test_tables_without_rows_can_be_read(spark):
    batch = snapshots.Batch(snapshots.latest(snapshots.Folder(spark, fresh())))
    schema = T.StructType().add("a", "int").add("k", "int")
    batch.append("t", spark.createDataFrame([], schema), ["k"])
    batch.append("u", spark.createDataFrame([], schema))
    made = batch.publish()
    assert made.has("t") and made.read("t", schema).count() == 0 and made.read("u", schema).count() == 0


def test_an_update_rewrites_only_parts_with_rows_of_the_role(spark):
    warehouse = Warehouse(spark, fresh())
    warehouse.load_accidents(tiny(spark, *FIRST))
    warehouse.load_accidents(tiny(spark, (1, 2006, "B", ["Slightly injured"]), (2, 2006, "B", ["Killed", "Slightly injured"])))
    old = warehouse.snapshot()
    rules = replace(WAREHOUSE_ACCESS, grants=[*WAREHOUSE_ACCESS.grants, ("medecin", "dim_usager", "update")])
    change = {"cat_usager": F.lit("Suivi")}
    before = {r["id_usager"]: r for r in warehouse.read("dim_usager").collect()}
    touched = warehouse.update_as_role("dim_usager", "medecin", change, rules)
    assert sorted(p.split("/", 1)[1] for p in touched) == ["id_pays=1/annee=2005", "id_pays=2/annee=2005", "id_pays=2/annee=2006"]
    new = warehouse.snapshot()
    assert new.version == old.version + 1
    # the part without such a row is carried over, and no other table changes
    assert [p for p in old.parts["dim_usager"] if p not in touched] == [p for p in new.parts["dim_usager"] if p in old.parts["dim_usager"]]
    assert len(new.parts["dim_usager"]) == len(old.parts["dim_usager"])
    assert {t: p for t, p in new.parts.items() if t != "dim_usager"} == {t: p for t, p in old.parts.items() if t != "dim_usager"}
    after = {r["id_usager"]: r.asDict() for r in warehouse.read("dim_usager").collect()}
    assert after == {i: {**r.asDict(), "cat_usager": "Suivi" if r["gravite"] == "Killed" else r["cat_usager"]} for i, r in before.items()}
    assert {r["id_usager"]: r for r in Warehouse(spark, warehouse.root, old.version).read("dim_usager").collect()} == before
    # a corrected year is still exchanged as a whole afterwards
    warehouse.load_accidents(tiny(spark, (1, 2005, "A", ["Slightly injured"])), [(1, 2005)])
    assert {r["cat_usager"] for r in warehouse.read("dim_usager").where("id_pays = 1").collect()} <= {"Driver"}
    with pytest.raises(PermissionError):
        warehouse.update_as_role("dim_usager", "medecin", change)


def test_an_update_without_rows_makes_no_version(spark):
    warehouse = Warehouse(spark, fresh())
    warehouse.load_accidents(tiny(spark, (1, 2005, "A", ["Slightly injured"])))
    rules = replace(WAREHOUSE_ACCESS, grants=[*WAREHOUSE_ACCESS.grants, ("medecin", "dim_usager", "update")])
    version = warehouse.snapshot().version
    assert warehouse.update_as_role("dim_usager", "medecin", {"cat_usager": F.lit("Suivi")}, rules) == []
    assert warehouse.snapshot().version == version
