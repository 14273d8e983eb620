"""Raw-shaped accident and weather files made of the test tables, through to a loaded warehouse.

Orders of the first two regions are French accidents, the others British ones; lines are people and
vehicles.  Spark writes the files (one for a country, kind and year, as they are published), and
the readers, the delivery ledger and the loads work on them as on any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.plans.warehouse import Warehouse, build_warehouse
from starmart.sources.deliveries import FR, KINDS, UK, UK_PREFIX, delivered, year_states
from starmart.sources.scratch import scratch_path
from starmart.sources.snapshots import Folder
from starmart.sources.testdata import table

FR_HEADS = {
    "caracteristiques": "Num_Acc;mois;jour;lat;long;com;dep",
    "lieux": "Num_Acc;catr;vma",
    "usagers": "Num_Acc;id_vehicule;an_nais;grav;sexe;place;catu",
    "vehicules": "Num_Acc;id_vehicule;catv;manv;occutc;motor",
}
UK_HEADS = {
    "collision": "accident_index,date,local_authority_ons_district,first_road_class,speed_limit,latitude,longitude",
    "casualty": "accident_index,casualty_class,sex_of_casualty,age_of_casualty,casualty_severity",
    "vehicle": "accident_index,vehicle_type,vehicle_manoeuvre,propulsion_code",
}
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _joined(sep: str, *cells: Column) -> Column:
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cells])


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dossier, genre, annee, place, value``: every line of every file; headers have the first place.

    Accidents, and lines with their accidents, are joined once each and give the lines of all their kinds; kinds
    that a reader leaves out are not put together.  Tables that grow are not broadcast by the size of their files.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("date"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment").hint("merge")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    acc = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    acc = acc.withColumn("annee", F.year("date"))
    lineitem = table(spark, sf_dir, "lineitem")
    line = acc.join(lineitem.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    fr, cle, n = F.col("n_regionkey") <= 1, F.col("o_orderkey"), F.col("l_linenumber")
    flag, quantity = F.col("l_returnflag"), F.col("l_quantity").cast("int")
    person = F.when(n <= 3, 1).when(n <= 5, 2).otherwise(3)
    sex = F.when(F.col("l_linestatus") == "O", 1).otherwise(2)
    of_accident = {
        "caracteristiques": _joined(";", cle, F.month("date"), F.dayofmonth("date"), F.lit(""), F.lit(""), F.col("c_nationkey") + 1, F.col("n_name")),
        "lieux": _joined(";", cle, F.lit(4), 50 + 10 * (F.col("o_custkey") % 9)),
        "collision": _joined(",", cle, F.date_format("date", "dd/MM/yyyy"), F.col("c_mktsegment"), F.lit(3), 20 + 10 * (F.col("o_custkey") % 6), F.lit(""), F.lit("")),
    }
    of_line = {
        "usagers": _joined(";", cle, F.col("l_partkey"), 1900 + quantity, F.when(flag == "R", 2).when(flag == "A", 3).otherwise(4), sex, n, person),
        "vehicules": _joined(";", cle, F.col("l_partkey"), F.lit(7), n, n, F.lit(1)),
        "casualty": _joined(",", cle, person, sex, quantity, F.when(flag == "R", 1).when(flag == "A", 2).otherwise(3)),
        "vehicle": _joined(",", cle, F.lit(9), n, F.lit(1)),
    }
    no_line = F.struct(*[F.lit(None).cast(lineitem.schema[c].dataType).alias(c) for c in LINE_ORDER])
    folder = F.when(F.col("genre").isin(list(KINDS[FR])), "accidents_fr").otherwise("accidents_uk").alias("dossier")
    parts = []
    for rows, values, ordered in [(acc, of_accident, no_line), (line, of_line, F.struct(*LINE_ORDER))]:
        kinds = [F.array(*[F.lit(k) for k in values if k in KINDS[country]]) for country in (FR, UK)]
        place = F.struct(cle.alias("cle"), ordered.alias("ligne")).alias("place")
        value = reduce(lambda case, kind: case.when(F.col("genre") == kind[0], kind[1]), values.items(), F)
        body = rows.withColumn("genre", F.explode(F.when(fr, kinds[0]).when(~fr, kinds[1])))
        parts.append(body.select(folder, "genre", "annee", place, value.alias("value")))
    heads = FR_HEADS | UK_HEADS
    named = F.explode(F.array(*[F.struct(F.lit(k).alias("genre"), F.lit(v).alias("value")) for k, v in heads.items()])).alias("head")
    head = acc.select("annee").distinct().select("annee", named).select("annee", "head.*")
    first = F.lit(None).cast(parts[0].schema["place"].dataType).alias("place")
    return reduce(DataFrame.unionByName, [head.select(folder, "genre", "annee", first, "value"), *parts])


def weather_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reading for every line of a supplier's region and day (France), the day's means (United Kingdom)."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    read = table(spark, sf_dir, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    read = read.select(F.col("l_shipdate").cast("date").alias("date"), "n_regionkey", F.col("l_quantity").cast("int").alias("q"), F.col("l_linenumber").alias("n"))
    read = read.withColumn("annee", F.year("date"))
    fr = read.where("n_regionkey <= 1").select("annee", F.col("date").alias("place"), _joined(";", F.date_format("date", "yyyyMMdd"), F.col("q"), F.col("q") - 2, F.col("q") + 2, F.col("n"), F.lit(0)).alias("value"))
    days = read.where("n_regionkey > 1").groupBy("annee", "date").agg(F.max("q").alias("q"), F.max("n").alias("n"))
    uk = days.select("annee", F.col("date").alias("place"), _joined(",", F.col("date"), F.col("q"), F.col("n"), F.lit(30)).alias("value"))
    parts = []
    for folder, kind, rows, head in [("meteo_fr", "meteo_fr", fr, "DATE;T;TINF_H;TSUP_H;FF;PRELIQ"), ("meteo_uk", "meteo_uk", uk, "date,temp,precipitation,wind_speed")]:
        heads = rows.select("annee").distinct().select("annee", F.lit(None).cast("date").alias("place"), F.lit(head).alias("value"))
        parts.append(heads.unionByName(rows).select(F.lit(folder).alias("dossier"), F.lit(kind).alias("genre"), "*"))
    return reduce(DataFrame.unionByName, parts)


def file_name() -> Column:
    """The published name of a kind's file of a year."""
    british = F.col("genre").isin(list(KINDS[UK]))
    return F.concat(F.when(british, F.concat(F.lit(f"{UK_PREFIX}-"), "genre", F.lit("-"))).otherwise(F.concat("genre", F.lit("_"))), "annee", F.lit(".csv"))


def deliver(lines: DataFrame, root: str) -> None:
    """Writes the files below ``root``; one that is there already gives way."""
    spark = lines.sparkSession
    pending = Folder(spark, scratch_path(spark, "raw-pending"))
    named = lines.withColumn("fichier", file_name())
    ordered = named.repartition("dossier", "fichier").sortWithinPartitions("dossier", "fichier", F.col("place").asc_nulls_first())
    ordered.select("dossier", "fichier", "value").write.partitionBy("dossier", "fichier").text(pending.root)
    target = Folder(spark, root)
    for folder in pending.children():
        target.fs.mkdirs(target.at(folder.split("=", 1)[1]))
        for name in pending.children(folder):
            (part,) = [n for n in pending.children(folder, name, folders=False) if n.startswith("part-")]
            place = (folder.split("=", 1)[1], name.split("=", 1)[1])
            target.remove(*place)
            target.fs.rename(pending.at(folder, name, part), target.at(*place))


def folders(root: str) -> dict[str, str]:
    return {name: f"{root}/{name}" for name in ("accidents_fr", "accidents_uk", "meteo_fr", "meteo_uk")}


def years_of(spark: SparkSession, sf_dir: str) -> list[int]:
    return sorted(r[0] for r in table(spark, sf_dir, "orders").select(F.year("o_orderdate")).distinct().collect())


def described(warehouse: Warehouse) -> DataFrame:
    """Every fact with its source number and with what its place, person and vehicle say.

    The tables grow with the facts, and their files say little of their rows' size: all are shuffled.
    """
    keys = warehouse.read("cle_accident").select("id_accident", F.col("cle").cast("bigint").alias("cle"), "annee")
    fact = warehouse.read("fait_accident").join(keys.hint("merge"), "id_accident")
    place = warehouse.read("dim_localisation").select("id_lieu", "commune", "departement", "district", "vitesse_limite")
    person = warehouse.read("dim_usager").select("id_usager", "age", "sexe", "gravite", "cat_usager")
    vehicle = warehouse.read("dim_vehicule").select("id_vehicule", "type_vehicule", "nb_occupants")
    joined = fact.join(place.hint("merge"), "id_lieu").join(person.hint("merge"), "id_usager").join(vehicle.hint("merge"), "id_vehicule")
    return joined.drop("id_accident", "id_lieu", "id_usager", "id_vehicule")


def raw_warehouse(spark, sf_dir):
    """All files of all years, read, staged and loaded in one version."""
    root = scratch_path(spark, "raw")
    deliver(raw_lines(spark, sf_dir), root)
    deliver(weather_lines(spark, sf_dir), root)
    return described(build_warehouse(spark, folders(root), scratch_path(spark, "raw-warehouse"), years_of(spark, sf_dir)))


def load_late_files(spark, sf_dir):
    """Collisions before their casualties, half of the French people before all of them, then everything twice.

    The years that come late or corrected end as if all files had come at once.
    """
    root, lines = scratch_path(spark, "raw-late"), raw_lines(spark, sf_dir)
    warehouse = Warehouse(spark, scratch_path(spark, "late-warehouse"))
    raw = folders(root)
    first = (F.col("genre") != "casualty") & ((F.col("genre") != "usagers") | F.col("place").isNull() | (F.col("place.cle") % 2 == 0))
    deliver(lines.where(first), root)
    warehouse.load_files(raw)
    deliver(lines.where(F.col("genre").isin("casualty", "usagers")), root)
    warehouse.load_files(raw)
    warehouse.load_files(raw)
    return described(warehouse)


def missing_year_rule(spark, sf_dir):
    """What is to be done with every year when British years before the last lack a kind by turns."""
    root = scratch_path(spark, "raw-gaps")
    last = max(years_of(spark, sf_dir))
    gone = F.element_at(F.array(*map(F.lit, KINDS[UK])), (F.col("annee") % len(KINDS[UK]) + 1).cast("int"))
    lines = raw_lines(spark, sf_dir)
    deliver(lines.where((F.col("genre") != gone) | (F.col("annee") == last)), root)
    raw = folders(root)
    files = delivered(spark, raw["accidents_fr"], FR).unionByName(delivered(spark, raw["accidents_uk"], UK))
    states = year_states(files, None)
    return states.select("id_pays", "annee", "etat", F.array_join("manque", ",").alias("manque"))


QUERIES = {f.__name__: f for f in (raw_warehouse, load_late_files, missing_year_rule)}

ACCIDENTS = """
acc AS (
  SELECT o_orderkey AS cle, CASE WHEN n_regionkey <= 1 THEN 1 ELSE 2 END AS id_pays, CAST(year(o_orderdate) AS INTEGER) AS annee,
         CAST(o_orderdate AS DATE) AS date, o_custkey, c_nationkey, c_mktsegment, n_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
lines AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
      l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS place
  FROM lineitem
)"""
DESCRIBED = f"""
WITH {ACCIDENTS}
SELECT a.cle, a.annee, a.id_pays, a.date,
       CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS INTEGER) AS nb_tues,
       CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS INTEGER) AS nb_blesses_graves,
       CAST(count(*) FILTER (WHERE l_returnflag = 'N') AS INTEGER) AS nb_blesses_legers,
       CAST(count(*) AS INTEGER) AS nb_victimes_total, CAST(count(*) AS INTEGER) AS nb_vehicules,
       CAST(sum(CASE l_returnflag WHEN 'R' THEN 3 WHEN 'A' THEN 2 ELSE 1 END) AS DOUBLE) AS indice_gravite,
       CASE WHEN id_pays = 1 THEN CAST(c_nationkey + 1 AS VARCHAR) END AS commune,
       CASE WHEN id_pays = 1 THEN n_name END AS departement, CASE WHEN id_pays = 2 THEN c_mktsegment END AS district,
       CAST(CASE WHEN id_pays = 1 THEN 50 + 10 * (o_custkey % 9)
            ELSE list_extract([32, 48, 64, 80, 97, 113], CAST(o_custkey % 6 + 1 AS INTEGER)) END AS INTEGER) AS vitesse_limite,
       CAST(CASE WHEN id_pays = 1 THEN annee - 1900 - min(CAST(l_quantity AS INTEGER)) FILTER (WHERE place = 1)
            ELSE min(CAST(l_quantity AS INTEGER)) FILTER (WHERE place = 1) END AS INTEGER) AS age,
       min(CASE l_linestatus WHEN 'O' THEN 'Male' ELSE 'Female' END) FILTER (WHERE place = 1) AS sexe,
       min(CASE l_returnflag WHEN 'R' THEN 'Killed' WHEN 'A' THEN 'Seriously injured' ELSE 'Slightly injured' END) FILTER (WHERE place = 1) AS gravite,
       min(CASE WHEN l_linenumber <= 3 THEN 'Driver' WHEN l_linenumber <= 5 THEN 'Passenger' ELSE 'Pedestrian' END) FILTER (WHERE place = 1) AS cat_usager,
       'Car' AS type_vehicule,
       CAST(CASE WHEN id_pays = 1 THEN min(l_linenumber) FILTER (WHERE place = 1) ELSE 0 END AS INTEGER) AS nb_occupants
FROM acc a JOIN lines ON l_orderkey = a.cle
GROUP BY a.cle, a.annee, a.id_pays, a.date, o_custkey, c_nationkey, c_mktsegment, n_name"""

ORACLES = {
    "raw_warehouse": DESCRIBED,
    "load_late_files": DESCRIBED,
    "missing_year_rule": f"""
        WITH {ACCIDENTS}
        SELECT DISTINCT 1 AS id_pays, annee, 'nouveau' AS etat, '' AS manque FROM acc
        UNION ALL
        SELECT DISTINCT 2, annee, CASE WHEN annee = (SELECT max(annee) FROM acc) THEN 'nouveau' ELSE 'incomplet' END,
               CASE WHEN annee = (SELECT max(annee) FROM acc) THEN '' ELSE list_extract(['collision', 'casualty', 'vehicle'], annee % 3 + 1) END
        FROM acc""",
}
