"""Incremental loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.operators.loading import new_records, rows_to_insert
from starmart.plans.star import Staging
from starmart.plans.warehouse import Warehouse
from starmart.registry.conforming import ACCIDENT_PARTS, BUILD_SQL
from starmart.registry.sql import with_parts
from starmart.sources.scratch import scratch_path, stored
from starmart.sources.testdata import staging, table
from starmart.streaming.incremental import load_stream

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def load_insert_if_absent(spark, sf_dir):
    """Lines offered under their order key to a table that has the finished orders."""
    target = (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .select(F.col("o_orderkey").alias("cle"), F.lit(0).alias("ligne"), F.lit(-1).cast("bigint").alias("piece"))
    )
    batch = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("cle"), F.col("l_linenumber").alias("ligne"), F.col("l_partkey").alias("piece")
    )
    return target.unionByName(rows_to_insert(batch, target, [["cle"]], ["ligne", "piece"]))


def load_insert_two_keys(spark, sf_dir):
    """Orders offered to a table where both the order and (customer, day) are unique.

    The table has the finished orders, the last of a customer's day each; all orders are offered, so
    the batch meets stored orders, stored days and, in itself, days that occur again.
    """
    orders = table(spark, sf_dir, "orders")
    batch = orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("date"))
    done = batch.join(orders.where("o_orderstatus = 'F'").select("o_orderkey"), "o_orderkey", "left_semi")
    target = done.groupBy("o_custkey", "date").agg(F.max("o_orderkey").alias("o_orderkey")).select(*batch.columns)
    return target.unionByName(rows_to_insert(batch, target, [["o_orderkey"], ["o_custkey", "date"]], ["o_orderkey"]))


def detect_new_records(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    known = orders.filter(F.col("o_orderstatus") == "F")
    return new_records(orders, known, ["o_orderkey"])


def _deliveries(spark, sf_dir):
    """The years up to 1998, and all years; what is offered more than once is stored, as files are."""
    whole = staging(spark, sf_dir)
    everything = Staging(whole.accidents, stored(whole.places, "test-places"), whole.people, stored(whole.vehicles, "test-vehicles"))
    parts = ("accidents", "places", "people", "vehicles")
    return Staging(*[getattr(everything, part).filter(F.col("annee") <= 1998) for part in parts]), everything


def incremental_load(spark, sf_dir):
    """A first load of the years up to 1998, then all years offered again."""
    first, everything = _deliveries(spark, sf_dir)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.load_accidents(first)
    warehouse.load_accidents(everything)
    return warehouse.read("fait_accident")


class _Lost(Exception):
    """Stands for a driver that is lost."""


def load_after_crash(spark, sf_dir):
    """A load that is lost after its last write, before it is published, and is then run again."""
    first, everything = _deliveries(spark, sf_dir)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.load_accidents(first)
    try:
        with warehouse.batch():
            warehouse.load_accidents(everything)
            raise _Lost
    except _Lost:
        pass
    warehouse.load_accidents(everything)
    return warehouse.read("fait_accident")


def incremental_load_stream(spark, sf_dir):
    """Orders arriving as files: the finished ones, then all of them, one file per batch."""
    orders = table(spark, sf_dir, "orders")
    source, target, checkpoint = (scratch_path(spark, f"stream-{part}") for part in ("in", "out", "log"))
    for delivery in (orders.filter(F.col("o_orderstatus") == "F"), orders):
        delivery.write.mode("append").parquet(source)
    load_stream(
        spark, source, orders.schema, target, checkpoint, [["o_orderkey"]], ["o_orderdate"], files_per_batch=1
    ).awaitTermination()
    return spark.read.schema(orders.schema).parquet(target)


NAMES = [
    "load_insert_if_absent", "load_insert_two_keys", "detect_new_records", "incremental_load",
    "incremental_load_stream", "load_after_crash",
]
QUERIES = {name: globals()[name] for name in NAMES}

LOT = "CASE WHEN annee <= 1998 THEN 1 ELSE 2 END"
LOADED_PARTS = ACCIDENT_PARTS.replace(
    "OVER (ORDER BY n_regionkey, year(o_orderdate),",
    "OVER (ORDER BY CASE WHEN year(o_orderdate) <= 1998 THEN 1 ELSE 2 END, n_regionkey, year(o_orderdate),",
).replace("OVER (ORDER BY id_pays, annee,", f"OVER (ORDER BY {LOT}, id_pays, annee,")

ORACLES = {
    "load_insert_if_absent": """
        SELECT o_orderkey AS cle, 0 AS ligne, CAST(-1 AS BIGINT) AS piece FROM orders WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) = 1""",
    # The primary key is unique in the batch, so of the orders that meet nothing stored the first of each customer and day wins.
    "load_insert_two_keys": """
        WITH offered AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS date, o_orderstatus FROM orders),
        target AS (SELECT max(o_orderkey) AS o_orderkey, o_custkey, date FROM offered WHERE o_orderstatus = 'F' GROUP BY 2, 3)
        SELECT * FROM target
        UNION ALL
        SELECT min(o_orderkey), o_custkey, date FROM offered o
        WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = o.o_orderkey OR (t.o_custkey = o.o_custkey AND t.date = o.date))
        GROUP BY o_custkey, date""",
    "detect_new_records": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'F'",
    "incremental_load": with_parts(
        LOADED_PARTS,
        query=f"""SELECT * EXCLUDE (cle) REPLACE (CAST(nb_tues AS INTEGER) AS nb_tues,
                         CAST(nb_blesses_graves AS INTEGER) AS nb_blesses_graves,
                         CAST(nb_blesses_legers AS INTEGER) AS nb_blesses_legers,
                         CAST(nb_victimes_total AS INTEGER) AS nb_victimes_total,
                         CAST(nb_vehicules AS INTEGER) AS nb_vehicules)
                  FROM ({BUILD_SQL}) WHERE id_usager IS NOT NULL AND id_vehicule IS NOT NULL""",
    ),
    "incremental_load_stream": "SELECT * FROM orders",
}
ORACLES["load_after_crash"] = ORACLES["incremental_load"]
