"""The bundled test tables seen as a star, and as staged source files.

Orders play the accidents, line items the people involved, customers the places,
parts the vehicles and regions the countries.  All but the weather is derived
lazily, so column pruning reaches the Parquet scans of the base tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmart.functions.scalars import severity_index, victims, weather_label
from starmart.operators.keys import natural_key
from starmart.plans.calendar import calendar_staging, days_spanned, dim_temps, number_days
from starmart.plans.star import Staging
from starmart.sources.scratch import stored

PERSON_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def person_id() -> Column:
    return natural_key(*[F.col(c) for c in PERSON_KEY])


def severity_label(flag: Column) -> Column:
    return F.when(flag == "R", "Killed").when(flag == "A", "Seriously injured").otherwise("Slightly injured")


def sex_label(status: Column) -> Column:
    return F.when(status == "O", "Male").otherwise("Female")


def user_label(line: Column) -> Column:
    return F.when(line <= 3, "Driver").when(line <= 5, "Passenger").otherwise("Pedestrian")


def day(stamp: str) -> Column:
    return F.col(stamp).cast("date")


class TestStar:
    """Star over one data folder; a table is planned when a question first asks for it."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = table(self.spark, self.sf_dir, name)
        return self._tables[name]

    @cached_property
    def country(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").alias("id_pays"),
            F.upper(F.substring("r_name", 1, 2)).alias("code_pays"),
            F.col("r_name").alias("nom_pays"),
        )

    def nations(self) -> DataFrame:
        return self.table("nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("id_pays"))

    @cached_property
    def calendar(self) -> DataFrame:
        days = days_spanned([(self.table("orders"), "o_orderdate")])
        return dim_temps(number_days(calendar_staging(days)))

    @cached_property
    def place(self) -> DataFrame:
        customer = self.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        french_like = F.col("id_pays") <= 1
        return customer.join(self.nations(), F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("id_lieu"),
            "id_pays",
            F.when(french_like, F.col("n_name")).alias("departement"),
            F.when(~french_like, F.col("c_mktsegment")).alias("district"),
            F.col("c_mktsegment").alias("type_route"),
        )

    @cached_property
    def weather(self) -> DataFrame:
        """One row per (region of the supplier, shipping day), stored like the real dimension.

        Stored, its size is known when a question is planned, and the facts need
        no shuffle to meet it.
        """
        supplier = self.table("supplier").select("s_suppkey", "s_nationkey")
        where = supplier.join(self.nations(), F.col("s_nationkey") == F.col("n_nationkey")).select(
            "s_suppkey", "id_pays"
        )
        readings = self.table("lineitem").select(
            "l_suppkey",
            day("l_shipdate").alias("date"),
            F.col("l_quantity").cast("bigint").alias("q"),
            F.round(F.col("l_discount") * 100).cast("bigint").alias("d"),
            F.round(F.col("l_tax") * 100).cast("bigint").alias("t"),
        )
        daily = (
            readings.join(where, F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy("id_pays", "date")
            .agg(
                F.count(F.lit(1)).alias("n"),
                *[F.sum(c).alias(c) for c in "qdt"],
                F.min("q").cast("double").alias("temp_min"),
            )
        )
        measured = daily.select(
            "id_pays",
            "date",
            (F.col("q") / F.col("n") - F.lit(5.0)).alias("temp_max"),
            "temp_min",
            (F.col("d") / F.col("n") - F.lit(3.2)).alias("precipitations"),
            (F.lit(10.0) * F.col("t") / F.col("n") - F.lit(1.0)).alias("vent"),
        )
        label = weather_label(F.col("precipitations"), F.col("vent"), F.col("temp_max"))
        return stored(measured.withColumn("conditions", label), "weather")

    @cached_property
    def person(self) -> DataFrame:
        """One row per line; ties on the line's key take the smallest labels."""
        line = self.table("lineitem").select(*PERSON_KEY, "l_returnflag", "l_linestatus")
        one = line.groupBy(*PERSON_KEY).agg(
            F.min("l_returnflag").alias("flag"), F.min("l_linestatus").alias("status")
        )
        where = self.order_country()
        return one.join(where, F.col("l_orderkey") == F.col("o_orderkey")).select(
            person_id().alias("id_usager"),
            "id_pays",
            sex_label(F.col("status")).alias("sexe"),
            severity_label(F.col("flag")).alias("gravite"),
            user_label(F.col("l_linenumber")).alias("cat_usager"),
        )

    @cached_property
    def vehicle(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("id_vehicule"), F.col("p_type").alias("type_vehicule")
        )

    def order_country(self) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", "o_custkey", day("o_orderdate").alias("date"))
        customer = self.table("customer").select("c_custkey", "c_nationkey")
        where = customer.join(self.nations(), F.col("c_nationkey") == F.col("n_nationkey"))
        return orders.join(where, F.col("o_custkey") == F.col("c_custkey")).select(
            "o_orderkey", "id_pays", "date", F.col("o_custkey").alias("id_lieu")
        )

    def line_measures(self) -> DataFrame:
        """Casualties, line count and first line of each order, in one shuffle."""
        flag = F.col("l_returnflag")
        return self.table("lineitem").groupBy("l_orderkey").agg(
            F.count_if(flag == "R").alias("nb_tues"),
            F.count_if(flag == "A").alias("nb_blesses_graves"),
            F.count_if(flag == "N").alias("nb_blesses_legers"),
            F.count(F.lit(1)).alias("nb_vehicules"),
            F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("first"),
        )

    def fact_staging(self) -> DataFrame:
        """Every order, also those without lines."""
        counts = {
            c: F.coalesce(F.col(c), F.lit(0)) for c in ("nb_tues", "nb_blesses_graves", "nb_blesses_legers")
        }
        first = [F.col("l_orderkey")] + [F.col(f"first.{c}") for c in PERSON_KEY[1:]]
        joined = self.order_country().join(
            self.line_measures(), F.col("o_orderkey") == F.col("l_orderkey"), "left"
        )
        return joined.select(
            F.col("o_orderkey").alias("id_accident"),
            "id_pays",
            "date",
            "id_lieu",
            F.when(F.col("first").isNotNull(), natural_key(*first)).alias("id_usager"),
            F.col("first.l_partkey").alias("id_vehicule"),
            *[e.alias(c) for c, e in counts.items()],
            victims(*counts.values()).alias("nb_victimes_total"),
            F.coalesce("nb_vehicules", F.lit(1)).alias("nb_vehicules"),
            severity_index(*counts.values()).alias("indice_gravite"),
        )

    @cached_property
    def fact(self) -> DataFrame:
        return self.fact_staging().na.drop(subset=["date", "id_lieu", "id_usager", "id_vehicule"])


def star(spark: SparkSession, sf_dir: str) -> TestStar:
    return TestStar(spark, sf_dir)


class _TestStaging(Staging):
    """Orders and their lines as staged accident files; a part is planned when it is first asked for.

    The accidents, and the lines with their accidents, are stored once, as files are, so that
    parts and loads that share them do not join the base tables again.  A line's position is
    its order and its place among the order's lines, along the whole line.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.base = TestStar(spark, sf_dir)

    @cached_property
    def _located(self) -> DataFrame:
        accidents = self.base.order_country().select(
            "id_pays", F.year("date").alias("annee"), F.col("o_orderkey").alias("cle"), "date", "id_lieu"
        )
        return stored(accidents, "test-accidents")

    @cached_property
    def accidents(self) -> DataFrame:
        return self._located.select("id_pays", "annee", "cle", "date", F.struct(F.col("cle").alias("o_orderkey")).alias("pos"))

    @cached_property
    def places(self) -> DataFrame:
        accidents = self._located.select("id_pays", "annee", "cle", F.struct(F.col("cle").alias("o_orderkey")).alias("pos"), "id_lieu")
        return accidents.join(self.base.place.drop("id_pays"), "id_lieu").select(
            "id_pays",
            "annee",
            "cle",
            "pos",
            F.lit(None).cast("string").alias("commune"),
            "departement",
            "district",
            "type_route",
            F.lit(None).cast("int").alias("vitesse_limite"),
            F.lit(None).cast("double").alias("latitude"),
            F.lit(None).cast("double").alias("longitude"),
        )

    @cached_property
    def _lines(self) -> DataFrame:
        line = self.base.table("lineitem")
        # nulls first, as structs are ordered
        along = [*PERSON_KEY[1:], *[c for c in line.columns if c not in PERSON_KEY]]
        place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*along)).alias("place")
        placed = line.select("l_orderkey", place, "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus")
        joined = self._located.select("id_pays", "annee", "cle").join(placed, F.col("cle") == F.col("l_orderkey"))
        return stored(joined.drop("l_orderkey"), "test-lines")

    def _line_entity(self) -> list[Column]:
        return [
            F.col("id_pays"), F.col("annee"), F.col("cle"), F.col("l_partkey").cast("string").alias("veh_src"),
            F.struct(F.col("cle").alias("l_orderkey"), "place").alias("pos"),
        ]

    @cached_property
    def people(self) -> DataFrame:
        return self._lines.select(
            *self._line_entity(),
            F.lit(None).cast("int").alias("age"),
            sex_label(F.col("l_linestatus")).alias("sexe"),
            F.lit(None).cast("string").alias("place_vehicule"),
            severity_label(F.col("l_returnflag")).alias("gravite"),
            user_label(F.col("l_linenumber")).alias("cat_usager"),
        )

    @cached_property
    def vehicles(self) -> DataFrame:
        part = self.base.table("part").select("p_partkey", "p_type", "p_brand", "p_size")
        lines = self._lines.select("id_pays", "annee", "cle", "place", "l_partkey")
        return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
            *self._line_entity(),
            F.col("p_type").alias("type_vehicule"),
            F.col("p_brand").alias("manoeuvre"),
            F.col("p_size").alias("nb_occupants"),
            F.lit("Unknown").alias("motorisation"),
        )


def staging(spark: SparkSession, sf_dir: str) -> Staging:
    """Orders and their lines as staged accident files."""
    return _TestStaging(spark, sf_dir)
