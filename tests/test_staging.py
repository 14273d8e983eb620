"""The test tables as staged files, and what a load takes of offered rows, on literal rows."""

from datetime import datetime

import pytest

from starmart.operators import loading
from starmart.plans import star as build
from starmart.sources.testdata import staging

DAY = datetime(1998, 5, 1)
KEY = ["id_pays", "annee", "cle"]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")

    write("nation", [(0, "FRANCE", 0)], "n_nationkey int, n_name string, n_regionkey int")
    write("customer", [(1, 0, "A"), (2, 0, "B")], "c_custkey bigint, c_nationkey int, c_mktsegment string")
    write("orders", [(8, 1, DAY), (7, 2, DAY), (9, None, DAY)], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp")
    write("part", [(5, "T5", "B5", 50), (6, "T6", "B6", 60)], "p_partkey bigint, p_type string, p_brand string, p_size int")
    line = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    rows = [
        (8, 6, 1, 1, 2.0, "A", "O", DAY), (8, 6, 1, 1, 1.0, "R", "F", DAY), (8, 6, 1, 1, None, "N", "O", DAY),
        (8, 5, 1, None, 9.0, "R", "O", DAY), (7, 5, 1, 2, 1.0, "A", "F", None), (7, 4, 1, 1, 1.0, "N", "F", DAY), (9, 5, 1, 1, 1.0, "N", "F", DAY),
    ]
    write("lineitem", rows, line)
    return root


def test_lines_are_numbered_along_the_whole_line(spark, sf_dir):
    """Lines that agree in their key are told apart by the rest of the line, nulls first."""
    people = build.number_entities(staging(spark, sf_dir).people, "id_usager").orderBy("id_usager").collect()
    assert [(r["id_usager"], r["cle"], r["veh_src"], r["gravite"]) for r in people] == [
        (1, 7, "4", "Slightly injured"), (2, 7, "5", "Seriously injured"), (3, 8, "5", "Killed"),
        (4, 8, "6", "Slightly injured"), (5, 8, "6", "Killed"), (6, 8, "6", "Seriously injured"),
    ]
    vehicles = build.number_entities(staging(spark, sf_dir).vehicles, "id_vehicule").orderBy("id_vehicule").collect()
    assert [(r["cle"], r["type_vehicule"]) for r in vehicles] == [(7, "T5"), (8, "T5"), (8, "T6"), (8, "T6"), (8, "T6")]


def test_base_tables_are_joined_once_and_positions_are_narrow(spark, sf_dir):
    parts = staging(spark, sf_dir)
    for part in (parts.accidents, parts.people):
        assert "Exchange" not in part._jdf.queryExecution().executedPlan().toString()
    for part in (parts.people, parts.vehicles):
        assert part.schema["pos"].dataType.fieldNames() == ["l_orderkey", "place"]


@pytest.mark.parametrize("few", [0, 2, 500_000])
@pytest.mark.parametrize("orphans", [0, 5])
def test_rows_of_wanted_keys(spark, monkeypatch, few, orphans):
    monkeypatch.setattr(loading, "SMALL_BATCH", few)
    rows = [(c, y, str(k % 4), k) for k in range(8) for c in (1, 2) for y in (1998, 1999, None)]
    rows += [(1, 1999, f"orphan{k}", 0) for k in range(orphans)] + [(None, 1999, "1", 0), (1, 1999, None, 0)]
    offered = spark.createDataFrame(rows, "id_pays int, annee int, cle string, n int")
    wanted = spark.createDataFrame([(1, 1999, str(k)) for k in (0, 1, 2, 3, 3)] + [(2, None, "1"), (None, 1999, "1")], "id_pays int, annee int, cle string")
    got = loading.rows_of_wanted(offered, wanted, KEY, KEY[:2])
    assert sorted(got.collect()) == sorted(offered.join(wanted, KEY, "left_semi").collect()) and got.count() == 8
    text = got._jdf.queryExecution().executedPlan().toString()
    if few == 2 and not orphans:
        # the rows that are looked up do not move
        assert "SortMergeJoin" not in text and "hashpartitioning" not in text.split("LeftAnti")[-1].split("BroadcastExchange")[0]


def test_numbered_rows_are_written_where_they_are(spark, tmp_path):
    """Only the fact, which comes out of joins, is gathered by country and year before it is written."""
    from starmart.plans.warehouse import Warehouse

    warehouse, seen = Warehouse(spark, str(tmp_path)), {}
    append = warehouse.append
    warehouse.append = lambda table, rows, gathered=False: (seen.update({table: gathered}), append(table, rows, gathered))
    day = "id_pays int, annee int, cle string, date date, pos struct<n:int>"
    accidents = spark.createDataFrame([(1, 1998, "a", DAY.date(), (1,)), (2, 1999, "b", DAY.date(), (2,))], day)
    place = "id_pays int, annee int, cle string, pos struct<n:int>, commune string, departement string, district string, type_route string, vitesse_limite int, latitude double, longitude double"
    person = "id_pays int, annee int, cle string, veh_src string, pos struct<n:int>, age int, sexe string, place_vehicule string, gravite string, cat_usager string"
    vehicle = "id_pays int, annee int, cle string, veh_src string, pos struct<n:int>, type_vehicule string, manoeuvre string, nb_occupants int, motorisation string"
    keyed = [(1, 1998, "a", (1,)), (2, 1999, "b", (2,))]
    parts = build.Staging(
        accidents,
        spark.createDataFrame([(*k, *[None] * 7) for k in keyed], place),
        spark.createDataFrame([(*k[:3], "", k[3], *[None] * 5) for k in keyed], person),
        spark.createDataFrame([(*k[:3], "", k[3], *[None] * 4) for k in keyed], vehicle),
    )
    warehouse.load_accidents(parts)
    assert [t for t, gathered in seen.items() if not gathered] == ["fait_accident"]
    assert sorted(r["id_pays"] for r in warehouse.read("dim_usager").collect()) == [1, 2]
    assert warehouse.read("fait_accident").count() == 2
