"""Tables that grow with the input are not broadcast by the size of their files."""

from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from starmart.operators import checks, loading
from starmart.plans.star import KeyedStaging, Staging, assign_keys
from starmart.registry import raw
from starmart.schemas import EXTRA_TABLES, TABLES
from starmart.sources.raw_accidents import fr_located
from starmart.sources.scratch import stored

KEY = ["id_pays", "annee", "cle"]
PLACED = "struct<src_file:string,src_block:bigint,src_row:bigint>"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def one_row(spark, schema):
    return stored(spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema]), "one-row")


def test_described_facts(spark):
    read = lambda name: one_row(spark, TABLES.get(name) or EXTRA_TABLES[name])
    text = plan(raw.described(SimpleNamespace(read=read)))
    assert "Broadcast" not in text and text.count("SortMergeJoin") == 4


def test_references(spark):
    child, parent = stored(spark.range(5).toDF("a"), "child"), stored(spark.range(3).toDF("b"), "parent")
    missing = checks.orphans(child, ["a"], parent, ["b"])
    assert "Broadcast" not in plan(missing)
    assert sorted(r["a"] for r in missing.collect()) == [3, 4]


def test_places_of_accidents(spark):
    accidents = spark.createDataFrame(
        [(1, 2005, "a", ("f", 0, 1), None, None, None, "75"), (1, 2005, "b", ("f", 0, 2), None, None, None, "75")],
        f"id_pays int, annee int, cle string, pos {PLACED}, lat string, long string, com string, dep string",
    )
    places = spark.createDataFrame([(2005, "a", ("g", 0, 1), "1", "50"), (2005, "a", ("g", 0, 2), "1", "70")], f"annee int, cle string, lieu_pos {PLACED}, catr string, vma string")
    located = fr_located(accidents, stored(places, "places"))
    assert "Broadcast" not in plan(located)
    assert sorted((r["cle"], r["vitesse_limite"] or 0) for r in located.collect()) == [("a", 50), ("a", 70), ("b", 0)]


def test_a_large_batch_meets_the_whole_target(spark, monkeypatch):
    monkeypatch.setattr(loading, "SMALL_BATCH", 2)
    batch, known = spark.range(5).toDF("k"), stored(spark.range(3).toDF("k"), "known")
    new = loading.new_records(batch, known, ["k"])
    assert "Broadcast" not in plan(new)
    assert sorted(r["k"] for r in new.collect()) == [3, 4]


def test_many_wanted_keys(spark, monkeypatch):
    """Only the groups, which are few, are broadcast; the keys that are not wanted are looked up without it as well."""
    monkeypatch.setattr(loading, "SMALL_BATCH", 2)
    seen = []
    monkeypatch.setattr(loading, "stored", lambda df, label: seen.append(plan(df)) or stored(df, label))
    rows = stored(spark.createDataFrame([(1, 1999, str(k), k) for k in range(9)], "id_pays int, annee int, cle string, n int"), "rows")
    wanted = stored(rows.where("n < 4").select(*KEY), "wanted")
    got = loading.rows_of_wanted(rows, wanted, KEY, KEY[:2])
    for text in (plan(got), *seen):
        assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" in text
    assert sorted(r["n"] for r in got.collect()) == [0, 1, 2, 3]


def test_numbers_that_are_kept(spark):
    accidents = spark.createDataFrame([(1, 1999, "a", date(1999, 1, 1), (1,)), (1, 1999, "b", date(1999, 1, 1), (2,))], "id_pays int, annee int, cle string, date date, pos struct<n:int>")
    kept = stored(spark.createDataFrame([(1, 1999, "b", 7)], "id_pays int, annee int, cle string, id_accident bigint"), "kept")
    others = accidents.select(*KEY, "pos", F.lit("").alias("veh_src"))
    keyed: KeyedStaging = assign_keys(Staging(accidents, others, others, others), {"id_accident": 8}, kept)
    text = plan(keyed.accidents)
    assert "SortMergeJoin" in text.split("Union")[1]
    assert sorted((r["cle"], r["id_accident"]) for r in keyed.accidents.collect()) == [("a", 8), ("b", 7)]


@pytest.fixture
def tables(spark, tmp_path):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    write("nation", [(0, "N0", 0), (1, "N1", 3), (2, "N2", None)], "n_nationkey int, n_name string, n_regionkey int")
    write("customer", [(k, k, "S") for k in (0, 1, 2)], "c_custkey bigint, c_nationkey int, c_mktsegment string")
    day = date(1998, 2, 3)
    write("orders", [(10, 0, day), (11, 1, day), (12, 2, day), (13, 9, day), (14, 0, None)], "o_orderkey bigint, o_custkey bigint, o_orderdate date")
    line = [(5, 6, 4.0, 1.0, 0.0, 0.0, "R", "O", day)]
    write(
        "lineitem",
        [(o, n, *rest) for o in (10, 11, 12, 13) for n in (1, 4) for rest in line],
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date",
    )
    return str(tmp_path)


def test_raw_lines_are_joined_once(spark, tables):
    """Lines of both countries' kinds; an order of no region or no customer has none, one without a day those of its kinds."""
    lines = raw.raw_lines(spark, tables)
    text = plan(lines)
    assert text.count("struct<l_orderkey") == 1 and text.count("FileScan") == 10  # accidents for headers, bodies and lines
    assert lines.columns == ["dossier", "genre", "annee", "place", "value"]
    found = {}
    for r in lines.collect():
        found.setdefault((r["dossier"], r["genre"], r["annee"]), []).append((r["place"] and r["place"]["cle"], r["value"]))
    heads = raw.FR_HEADS | raw.UK_HEADS
    folder = {k: "accidents_fr" if k in raw.FR_HEADS else "accidents_uk" for k in heads}
    body = {
        "caracteristiques": [(10, "10;2;3;;;1;N0")],
        "lieux": [(10, "10;4;50")],
        "usagers": [(10, "10;5;1904;2;1;1;1"), (10, "10;5;1904;2;1;4;2")],
        "vehicules": [(10, "10;5;7;1;1;1"), (10, "10;5;7;4;4;1")],
        "collision": [(11, "11,03/02/1998,S,3,30,,")],
        "casualty": [(11, "11,1,1,4,1"), (11, "11,2,1,4,1")],
        "vehicle": [(11, "11,9,1,1"), (11, "11,9,4,1")],
    }
    expected = {(folder[k], k, 1998): [(None, heads[k]), *rows] for k, rows in body.items()}
    undated = {"caracteristiques": [(14, "14;;;;;1;N0")], "lieux": [(14, "14;4;50")]}
    expected |= {(folder[k], k, None): [(None, heads[k]), *undated.get(k, [])] for k in heads}
    assert {k: sorted(v, key=str) for k, v in found.items()} == {k: sorted(v, key=str) for k, v in expected.items()}
    assert plan(lines.where("genre = 'casualty'")).count("struct<l_orderkey") == 1
