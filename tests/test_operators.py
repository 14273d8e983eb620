"""Distributed operators against the plain way, on data with a hot key."""

import random
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart.operators import checks, keys, loading, ordered, policies, rollup
from starmart.plans import cube, star_queries
from starmart.sources.testdata import star, table

SF_DIR = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted([tuple(r) for r in df.select(*(columns or df.columns)).collect()], key=repr)


@pytest.fixture(scope="module")
def hot(spark):
    """Six thousand rows; a third share one value, some are null."""
    rnd = random.Random(7)
    data = []
    for i in range(6000):
        value = 5.0 if i % 3 == 0 else (None if i % 50 == 1 else float(rnd.randrange(900)))
        data.append((i, value, rnd.randrange(10**6)))
    return spark.createDataFrame(data, "id int, value double, noise int").repartition(7, "noise")


@pytest.mark.parametrize("small_rows", [10**6, 10])
def test_rank_equals_plain_window(hot, small_rows):
    plain = hot.withColumn("rang", F.rank().over(Window.orderBy(F.col("value").desc_nulls_last())).cast("bigint"))
    got = ordered.global_rank(hot, "value", "rang", small_rows=small_rows, partitions=6)
    assert rows(got, "id", "rang") == rows(plain, "id", "rang")


@pytest.mark.parametrize("small_rows", [10**6, 10])
def test_median_is_exact(spark, hot, small_rows):
    want = hot.agg(F.median("value")).first()[0]
    assert ordered.exact_median(hot, "value", small_rows).first()[0] == want
    even = spark.createDataFrame([(1.0,), (4.0,), (None,), (2.0,), (10.0,)], "value double")
    assert ordered.exact_median(even, "value", small_rows).first()[0] == 3.0
    empty = even.filter("value < 0")
    assert ordered.exact_median(empty, "value", small_rows).first()[0] is None


def test_ids_are_dense_ordered_and_repeatable(hot):
    want = {
        r["id"]: r["n"]
        for r in hot.withColumn(
            "n", F.row_number().over(Window.orderBy(F.col("value").asc_nulls_first(), "id"))
        ).collect()
    }
    for parts in (1, 5, 16):
        got = keys.dense_ids(hot.repartition(parts), "key", ["value", "id"], start=101, partitions=parts)
        assert {r["id"]: r["key"] - 100 for r in got.collect()} == want


def test_block_numbering_equals_sorting(hot):
    """Rows numbered inside their blocks get the ids a full sort would give; gaps send it there."""
    from starmart.sources.scratch import stored

    rows_in = hot.select("id", F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("row"))
    kept = stored(rows_in, "test")
    got = keys.block_ids(kept, "key", ["block"], "row", start=11)
    assert rows(got, "key", "id") == rows(keys.dense_ids(kept, "key", ["block", "row"], start=11), "key", "id")
    assert sorted(r["key"] for r in got.collect()) == list(range(11, 6011))
    assert keys.block_ids(kept.filter("id % 7 != 3"), "key", ["block"], "row") is None


def test_hot_value_spreads_over_ranges(hot):
    """The position in the ordering lets one value span several ranges."""
    ranged = hot.repartitionByRange(6, "value", "id").groupBy(F.spark_partition_id().alias("p"))
    sizes = [r[1] for r in ranged.agg(F.count(F.lit(1))).collect()]
    assert max(sizes) < 6000 / 3


def test_first_per_key(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), ("b", 5, None), (None, 3, "z"), (None, 4, "w")], "k string, pos int, v string"
    )
    assert rows(keys.first_per_key(df, ["k"], ["pos"], ["v"])) == rows(
        spark.createDataFrame([("a", "y"), ("b", None), (None, "z")], "k string, v string")
    )


def test_literal_country_join_on_small_sample(spark):
    """Reduced sides give what the full country product gives."""
    data = star(spark, SF_DIR)

    class Small:
        fact = data.fact.filter("id_accident < 60")
        person = data.person.filter("id_usager like '1%'")
        country = data.country

    product = (
        Small.fact.select("id_pays", "indice_gravite", "id_accident")
        .join(Small.person.select("id_pays", "sexe"), "id_pays")
        .groupBy("id_pays", "sexe", "indice_gravite")
        .agg(F.count_distinct("id_accident").alias("nb_accidents"))
    )
    got = star_queries.accidents_by_sex_severity_literal(Small)
    columns = ("id_pays", "sexe", "indice_gravite", "nb_accidents")
    assert rows(got, *columns) == rows(product, *columns)


def test_rollup_from_grain_equals_direct(spark):
    df = table(spark, SF_DIR, "lineitem").withColumn(
        "flag", F.when(F.col("l_returnflag") != "A", F.col("l_returnflag"))
    )
    names = ["flag", "l_linestatus", "l_linenumber"]
    m = rollup.Measures({"q": "l_quantity"}, {"price": "l_extendedprice"}, {"lo": "l_quantity"}, {"hi": "l_quantity"})
    got = rollup.rollup_grain(rollup.finest_grain(df, names, m), names, m)
    direct = df.rollup(*names).agg(
        F.grouping_id().cast("bigint").alias("gid"),
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").cast("bigint").alias("q"),
        F.min("l_quantity").alias("lo"),
        F.max("l_quantity").alias("hi"),
    )
    columns = [*names, "gid", "n", "q", "lo", "hi"]
    assert rows(got, *columns) == rows(direct, *columns)
    assert got.filter("gid = 0").agg(F.sum("n")).first()[0] == df.count()


def test_empty_rollup_keeps_the_grand_total(spark):
    data = star(spark, SF_DIR)

    class Empty:
        fact = data.fact.filter("id_accident < 0")
        country, calendar, weather = data.country, data.calendar, data.weather
        vehicle, person, place = data.vehicle, data.person, data.place

    got = cube.cube_build(Empty).select("gid", "nb_accidents", "total_tues", "gravite_moyenne").collect()
    assert [tuple(r) for r in got] == [(2047, 0, None, None)]
    assert cube.cube_levels(cube.cube_grain(Empty), keep_grand_total=False).count() == 0


def brute_insert(batch, target, unique_keys):
    """Row by row, as a store with unique constraints would do it."""
    seen = [set() for _ in unique_keys]
    kept = []

    def values(row):
        return [tuple(row[c] for c in k) for k in unique_keys]

    for row in target:
        for s, v in zip(seen, values(row)):
            s.add(v)
    for row in batch:
        vs = values(row)
        if any(None not in v and v in s for s, v in zip(seen, vs)):
            continue
        kept.append(row)
        for s, v in zip(seen, vs):
            s.add(v)
    return kept


@pytest.mark.parametrize("seed", range(4))
def test_insert_if_absent_with_two_keys(spark, seed):
    rnd = random.Random(seed)
    schema = "pos int, id int, pays int, jour int"

    def make(n, start):
        return [
            {"pos": start + i, "id": rnd.randrange(40), "pays": 1 if rnd.random() < 0.5 else 2,
             "jour": None if rnd.random() < 0.1 else rnd.randrange(25)}
            for i in range(n)
        ]

    unique = [["id"], ["pays", "jour"]]
    target = brute_insert(make(8, 0), [], unique)
    batch = make(120, 1000)
    got = loading.rows_to_insert(
        spark.createDataFrame([tuple(r.values()) for r in batch], schema).repartition(5, "jour"),
        spark.createDataFrame([tuple(r.values()) for r in target], schema),
        unique,
        ["pos"],
    )
    want = brute_insert(batch, target, unique)
    assert sorted(r["pos"] for r in got.collect()) == [r["pos"] for r in want]


def test_inserting_twice_is_inserting_once(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/table"
    batch = table(spark, SF_DIR, "orders")
    for _ in range(2):
        loading.insert_if_absent(batch, path, [["o_orderkey"]], ["o_orderdate"])
    assert spark.read.parquet(path).count() == batch.count()


def test_incremental_cube_is_the_full_cube(spark):
    from starmart.registry.cube import VIEW_COLUMNS, cube_refresh_incremental

    full = cube.cube_build(star(spark, SF_DIR)).select(*VIEW_COLUMNS)
    assert rows(cube_refresh_incremental(spark, SF_DIR)) == rows(full)


def test_policies(spark):
    rules = policies.WAREHOUSE_ACCESS
    fact = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "id_accident int, id_pays int")
    people = spark.createDataFrame(
        [("Killed", "a"), ("Slightly injured", "b"), (None, "c")], "gravite string, cat_usager string"
    )
    assert rows(policies.as_role(fact, "fait_accident", "francais", rules)) == [(1, 1)]
    assert policies.as_role(fact, "fait_accident", "admin_global", rules).count() == 3
    with pytest.raises(PermissionError):
        policies.as_role(fact, "dim_vehicule", "medecin", rules)
    with pytest.raises(PermissionError):
        policies.update_as_role(people, "dim_usager", "medecin", {"cat_usager": F.lit("x")}, rules)
    # A table nobody protects shows all its rows to who was granted it.
    assert policies.as_role(fact, "dim_pays", "admin_global", rules).count() == 3


def test_checks_report_broken_rules(spark):
    from starmart.schemas import TableRules

    parent = spark.createDataFrame([(1, "abc")], "id int, nom string")
    child = spark.createDataFrame([(1, 1, "x"), (1, 9, "longer"), (2, None, None)], "cle int, id int, mot string")
    rules = TableRules([["cle"]], [(["id"], "parent", ["id"])], {"mot": 3})
    got = dict(rows(checks.check_table("child", {"child": child, "parent": parent}, rules), "rule", "broken"))
    assert got == {"unique(cle)": 1, "foreign(id)->parent": 1, "width(mot<=3)": 1}
