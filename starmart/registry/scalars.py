"""Cleaning, decoding and measure functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart import codebooks
from starmart.functions import dates, scalars
from starmart.functions.geo import degrees_pair
from starmart.plans.weather import filled, with_label
from starmart.registry.sql import FACT_PARTS, WEATHER_PARTS, with_parts
from starmart.sources.testdata import star, table


def _count_by(df, *columns):
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def scalar_clean_strings(spark, sf_dir):
    nbsp = F.lit(scalars.NBSP)
    raw = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(nbsp, F.lit(" "), "c_name", nbsp, F.lit("  ")).alias("nom"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("N/A"))
        .when(F.col("c_mktsegment") == "FURNITURE", F.lit(" nan "))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(nbsp, F.lit("None")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lit("NA"))
        .otherwise(F.concat(F.lit("\t"), "c_mktsegment", F.lit(" ")))
        .alias("segment"),
    )
    return scalars.clean_strings(raw)


def _priority_code():
    """Orders' priority digit, as decimal text, plain text or the whole label."""
    digit = F.substring("o_orderpriority", 1, 1)
    return (
        F.when(F.col("o_orderstatus") == "F", F.concat(digit, F.lit(".9")))
        .when(F.col("o_orderstatus") == "O", digit)
        .otherwise(F.col("o_orderpriority"))
    )


PRIORITY_SQL = """CASE o_orderstatus WHEN 'F' THEN substr(o_orderpriority, 1, 1) || '.9'
                       WHEN 'O' THEN substr(o_orderpriority, 1, 1) ELSE o_orderpriority END"""


def scalar_decode(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(_priority_code().alias("brut"))
    return _count_by(raw.withColumn("gravite", scalars.decode(F.col("brut"), codebooks.FR_SEVERITY)), "brut", "gravite")


def codebook_rows():
    return [
        (country, book, code, label)
        for (country, book), entries in codebooks.BOOKS.items()
        for code, label in entries.items()
    ]


def codebook_table(spark, sf_dir):
    """Quantities read as codes of every book; lines are counted per code before the join."""
    books = spark.createDataFrame(codebook_rows(), "pays string, livre string, code int, libelle string")
    codes = _count_by(table(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("int").alias("code")), "code")
    return codes.join(books, "code").groupBy("pays", "livre", "libelle").agg(F.sum("n").alias("n"))


def _signed_text():
    """Quantity minus 25 as text: whole, with decimals, with a letter, or empty."""
    shifted = (F.col("l_quantity") - 25).cast("bigint").cast("string")
    return (
        F.when(F.col("l_returnflag") == "N", shifted)
        .when(F.col("l_returnflag") == "A", F.concat(shifted, F.lit(".75")))
        .when(F.col("l_linestatus") == "O", F.concat(F.lit("B"), shifted))
        .otherwise("")
    )


SIGNED_SQL = """CASE WHEN l_returnflag = 'N' THEN CAST(CAST(l_quantity - 25 AS BIGINT) AS VARCHAR)
                     WHEN l_returnflag = 'A' THEN CAST(l_quantity - 25 AS BIGINT) || '.75'
                     WHEN l_linestatus = 'O' THEN 'B' || CAST(l_quantity - 25 AS BIGINT) ELSE '' END"""


def scalar_safe_int(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(_signed_text().alias("brut"))
    return _count_by(raw.withColumn("valeur", scalars.safe_int(F.col("brut"))), "brut", "valeur")


def scalar_nonzero_code(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string"))
        .when(F.col("o_orderstatus") == "O", F.lit("0"))
        .otherwise(F.concat(F.lit("2A"), F.col("o_custkey").cast("string")))
        .alias("brut")
    )
    return _count_by(raw.withColumn("code", scalars.nonzero_code(F.col("brut"))), "brut", "code")


def scalar_to_numeric(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "N", F.col("l_quantity").cast("string"))
        .when(F.col("l_returnflag") == "A", F.concat(F.col("l_linenumber").cast("string"), F.lit("e2")))
        .when(F.col("l_linestatus") == "O", F.lit("NaN"))
        .otherwise("7d")
        .alias("brut")
    )
    parsed = raw.select(
        "brut",
        scalars.numeric_or(raw, "brut", None).alias("valeur"),
        scalars.numeric_or(raw, None, 0.0).alias("pluie_absente"),
        scalars.numeric_or(raw, None, None).alias("vent_absent"),
    )
    return _count_by(parsed, *parsed.columns)


def scalar_decimal_comma(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        F.translate(F.col("l_extendedprice").cast("string"), ".", ",").alias("brut")
    )
    return _count_by(raw.withColumn("prix", scalars.decimal_comma(F.col("brut"))), "brut", "prix")


def scalar_truncate(spark, sf_dir):
    name = F.concat_ws(" / ", "c_name", "c_mktsegment", "c_name", "c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        scalars.truncate(name, 20).alias("court"),
        scalars.truncate(name, 50).alias("long"),
        scalars.truncate(F.lit(None).cast("string"), 50).alias("absent"),
    )


def scalar_age(spark, sf_dir):
    born = (2000 - F.col("l_quantity")).cast("int").cast("string")
    raw = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("annee"),
        F.when(F.col("l_returnflag") == "N", born)
        .when(F.col("l_returnflag") == "A", F.concat(born, F.lit(".0")))
        .when(F.col("l_linestatus") == "O", F.lit("inconnu"))
        .alias("naissance"),
    )
    aged = raw.withColumn("age", scalars.age_from_birth_year(F.col("annee"), F.col("naissance")))
    return _count_by(aged, "annee", "naissance", "age")


def scalar_bool(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", F.lit("1"))
        .when(F.col("o_orderstatus") == "O", F.lit("0.0"))
        .alias("brut")
    )
    return _count_by(raw.withColumn("drapeau", scalars.bool_flag(F.col("brut"))), "brut", "drapeau")


def scalar_mph_to_kmh(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        scalars.mph_to_kmh(F.col("p_size")).alias("km_h"),
        scalars.mph_to_kmh(F.col("p_size"), legacy=True).alias("brut"),
    )


def geo_normalise(spark, sf_dir):
    """Metric pairs, degree pairs and unreadable pairs made from the customer key."""
    place = star(spark, sf_dir).place.select("id_lieu", "id_pays")
    k = F.col("id_lieu")

    def text(column):
        return column.cast("string")

    metric_lat = F.concat(text(6100000 + (k * 7919) % 1000000), F.lit(",25"))
    metric_lon = F.concat(text(100000 + (k * 104729) % 1100000), F.lit(",5"))
    lat = (
        F.when(F.col("id_pays") <= 1, metric_lat)
        .when(F.col("id_pays") <= 3, F.concat(text(k % 90), F.lit(",1234567")))
        .otherwise("inconnu")
    )
    lon = F.when(F.col("id_pays") <= 1, metric_lon).otherwise(F.concat(F.lit("-"), text(k % 180), F.lit(".5")))
    latitude, longitude = degrees_pair(lat, lon)
    return place.select("id_lieu", latitude.alias("latitude"), longitude.alias("longitude"))


GEO_SQL = """WITH raw AS (
  SELECT c_custkey AS k, n_regionkey AS r, 6100000 + (c_custkey * 7919) % 1000000 + 0.25::DOUBLE AS northing,
         100000 + (c_custkey * 104729) % 1100000 + 0.5::DOUBLE AS easting
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
c AS (SELECT 6378137.0::DOUBLE AS a, sqrt(2 * f - f * f) AS e FROM (SELECT 1 / 298.257222101::DOUBLE AS f)),
p AS (SELECT a, e, radians(44.0::DOUBLE) AS p1, radians(49.0::DOUBLE) AS p2, radians(46.5::DOUBLE) AS p0 FROM c),
m AS (SELECT *, cos(p1) / sqrt(1 - (e * sin(p1)) ** 2) AS m1, cos(p2) / sqrt(1 - (e * sin(p2)) ** 2) AS m2,
  tan(pi() / 4 - p1 / 2) / ((1 - e * sin(p1)) / (1 + e * sin(p1))) ** (e / 2) AS t1,
  tan(pi() / 4 - p2 / 2) / ((1 - e * sin(p2)) / (1 + e * sin(p2))) ** (e / 2) AS t2,
  tan(pi() / 4 - p0 / 2) / ((1 - e * sin(p0)) / (1 + e * sin(p0))) ** (e / 2) AS t0 FROM p),
n AS (SELECT *, ln(m1 / m2) / ln(t1 / t2) AS n FROM m),
s AS (SELECT *, a * m1 / (n * t1 ** n) AS af FROM n),
polar AS (SELECT k, r, e, n, af, easting - 700000 AS x, af * t0 ** n - (northing - 6600000) AS y FROM raw, s),
it AS (SELECT k, r, e, atan2(x, y) / n + radians(3.0::DOUBLE) AS lon,
              (sqrt(x * x + y * y) / af) ** (1 / n) AS t FROM polar),
i0 AS (SELECT *, pi() / 2 - 2 * atan(t) AS l0 FROM it),
i1 AS (SELECT *, pi() / 2 - 2 * atan(t * ((1 - e * sin(l0)) / (1 + e * sin(l0))) ** (e / 2)) AS l1 FROM i0),
i2 AS (SELECT *, pi() / 2 - 2 * atan(t * ((1 - e * sin(l1)) / (1 + e * sin(l1))) ** (e / 2)) AS l2 FROM i1),
i3 AS (SELECT *, pi() / 2 - 2 * atan(t * ((1 - e * sin(l2)) / (1 + e * sin(l2))) ** (e / 2)) AS l3 FROM i2),
i4 AS (SELECT *, pi() / 2 - 2 * atan(t * ((1 - e * sin(l3)) / (1 + e * sin(l3))) ** (e / 2)) AS l4 FROM i3),
i5 AS (SELECT *, pi() / 2 - 2 * atan(t * ((1 - e * sin(l4)) / (1 + e * sin(l4))) ** (e / 2)) AS l5 FROM i4)
SELECT k AS id_lieu,
  CASE WHEN r <= 1 THEN CAST(round(CAST(degrees(l5) AS DECIMAL(38,12)), 6) AS DOUBLE)
       WHEN r <= 3 THEN CAST((k % 90) || '.123457' AS DOUBLE) END AS latitude,
  CASE WHEN r <= 1 THEN CAST(round(CAST(degrees(lon) AS DECIMAL(38,12)), 6) AS DOUBLE)
       WHEN r <= 3 THEN -(k % 180) - 0.5::DOUBLE END AS longitude
FROM i5"""


def date_assemble(spark, sf_dir):
    """Day and month unpadded; open orders get a day that does not exist."""
    raw = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("annee"),
        F.month("o_orderdate").cast("string").alias("mois"),
        F.when(F.col("o_orderstatus") == "P", F.lit("31"))
        .otherwise(F.dayofmonth("o_orderdate").cast("string"))
        .alias("jour"),
    )
    return _count_by(
        raw.withColumn("date", dates.date_from_parts(F.col("annee"), F.col("mois"), F.col("jour"))),
        "annee", "mois", "jour", "date",
    )


def date_parse_dayfirst(spark, sf_dir):
    stamp = F.col("o_orderdate")
    raw = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", F.date_format(stamp, "dd/MM/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format(stamp, "yyyy-MM-dd"))
        .otherwise(F.date_format(stamp, "MM/31/yyyy"))
        .alias("brut")
    )
    return _count_by(raw.withColumn("date", dates.date_day_first(F.col("brut"))), "brut", "date")


def _mixed_date_text():
    stamp = F.col("o_orderdate")
    return (
        F.when(F.col("o_orderpriority").startswith("1"), F.date_format(stamp, "yyyyMMdd"))
        .when(F.col("o_orderpriority").startswith("2"), F.date_format(stamp, " yyyy-MM-dd"))
        .when(F.col("o_orderpriority").startswith("3"), F.date_format(stamp, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("o_orderpriority").startswith("4"), F.concat(F.lit("an "), F.date_format(stamp, "yyyy")))
        .otherwise("inconnue")
    )


MIXED_SQL = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN strftime(o_orderdate, '%Y%m%d')
  WHEN '2' THEN ' ' || strftime(o_orderdate, '%Y-%m-%d') WHEN '3' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
  WHEN '4' THEN 'an ' || strftime(o_orderdate, '%Y') ELSE 'inconnue' END"""


def date_parse_multi(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(_mixed_date_text().alias("brut"))
    return _count_by(raw.withColumn("date", dates.date_any(F.col("brut"))), "brut", "date")


def date_year_regex(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(_mixed_date_text().alias("brut"))
    return _count_by(raw.withColumn("annee", dates.year_in_text(F.col("brut"))), "brut", "annee")


def calendar_parts(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    parts = table(spark, sf_dir, "orders").select(
        day.alias("date"),
        F.dayofmonth(day).alias("jour"),
        F.month(day).alias("mois"),
        F.year(day).alias("annee"),
        F.quarter(day).alias("trimestre"),
        dates.iso_weekday(day).alias("jour_semaine"),
        dates.day_name(day).alias("nom_jour"),
        dates.month_name(day).alias("nom_mois"),
        dates.is_weekend(day).alias("est_weekend"),
        dates.season(day).alias("saison"),
    )
    return _count_by(parts, *parts.columns)


def _gappy_weather(spark, sf_dir):
    """Weather with missing wind, rain and warmth on days of particular minima."""

    def without(column, minimum):
        return F.when(F.col("temp_min") != minimum, F.col(column)).alias(column)

    return star(spark, sf_dir).weather.select(
        "id_pays",
        "date",
        "temp_min",
        without("temp_max", 3),
        without("precipitations", 2),
        without("vent", 1),
    )


GAPPY_PARTS = """
gappy AS (SELECT id_pays, date, temp_min,
                 CASE WHEN temp_min <> 3 THEN temp_max END AS temp_max,
                 CASE WHEN temp_min <> 2 THEN precipitations END AS precipitations,
                 CASE WHEN temp_min <> 1 THEN vent END AS vent FROM weather),
labelled AS (
  SELECT *, CASE WHEN coalesce(precipitations, 0) > 2.0 THEN 'pluie' WHEN vent >= 40 THEN 'vent_fort'
                 WHEN temp_max >= 20 THEN 'ensoleille' ELSE 'nuageux' END AS conditions FROM gappy)"""


def weather_conditions(spark, sf_dir):
    return with_label(_gappy_weather(spark, sf_dir))


def weather_fill(spark, sf_dir):
    return filled(with_label(_gappy_weather(spark, sf_dir)))


def fact_measures(spark, sf_dir):
    return star(spark, sf_dir).fact_staging().select(
        "id_accident", "nb_tues", "nb_blesses_graves", "nb_blesses_legers", "nb_victimes_total", "indice_gravite"
    )


def severity_score(spark, sf_dir):
    """Both limits are scalar sub-queries: one row each, no join."""
    fact = star(spark, sf_dir).fact.select("id_accident", "indice_gravite")
    low = fact.agg(F.min("indice_gravite")).scalar()
    high = fact.agg(F.max("indice_gravite")).scalar()
    score = scalars.scaled_score(F.col("indice_gravite"), low, high)
    return fact.select("id_accident", scalars.round2(score).alias("score"))


NAMES = [
    "scalar_clean_strings", "scalar_decode", "codebook_table", "scalar_safe_int", "scalar_nonzero_code",
    "scalar_to_numeric", "scalar_decimal_comma", "scalar_truncate", "scalar_age", "scalar_bool",
    "scalar_mph_to_kmh", "geo_normalise", "date_assemble", "date_parse_dayfirst", "date_parse_multi",
    "date_year_regex", "calendar_parts", "weather_conditions", "weather_fill", "fact_measures", "severity_score",
]
QUERIES = {name: globals()[name] for name in NAMES}


def _words(words, start=1):
    return ", ".join(f"({i}, '{w}')" for i, w in enumerate(words, start))


ORACLES = {
    "scalar_clean_strings": """
        SELECT c_custkey, c_name AS nom,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_mktsegment END AS segment FROM customer""",
    "scalar_decode": f"""
        SELECT brut, CASE trunc(TRY_CAST(brut AS DOUBLE)) WHEN 1 THEN 'Uninjured' WHEN 2 THEN 'Killed'
               WHEN 3 THEN 'Seriously injured' WHEN 4 THEN 'Slightly injured' ELSE 'Unknown' END AS gravite,
               count(*) AS n
        FROM (SELECT {PRIORITY_SQL} AS brut FROM orders) GROUP BY 1, 2""",
    "codebook_table": f"""
        SELECT pays, livre, libelle, count(*) AS n FROM lineitem
        JOIN (VALUES {", ".join(str(r) for r in codebook_rows())}) AS b(pays, livre, code, libelle)
          ON b.code = l_quantity GROUP BY 1, 2, 3""",
    "scalar_safe_int": f"""
        SELECT brut, CASE WHEN v >= 0 THEN v END AS valeur, count(*) AS n
        FROM (SELECT brut, CAST(trunc(TRY_CAST(brut AS DOUBLE)) AS BIGINT) AS v
              FROM (SELECT {SIGNED_SQL} AS brut FROM lineitem)) GROUP BY 1, 2""",
    "scalar_nonzero_code": """
        SELECT CASE o_orderstatus WHEN 'F' THEN CAST(o_custkey AS VARCHAR) WHEN 'O' THEN '0'
                    ELSE '2A' || o_custkey END AS brut,
               CASE WHEN o_orderstatus = 'F' AND o_custkey > 0 THEN CAST(o_custkey AS VARCHAR) END AS code,
               count(*) AS n FROM orders GROUP BY 1, 2""",
    "scalar_to_numeric": """
        SELECT brut, valeur, 0.0::DOUBLE AS pluie_absente, NULL::DOUBLE AS vent_absent, count(*) AS n FROM (
          SELECT CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS VARCHAR)
                      WHEN l_returnflag = 'A' THEN l_linenumber || 'e2'
                      WHEN l_linestatus = 'O' THEN 'NaN' ELSE '7d' END AS brut,
                 CASE WHEN l_returnflag = 'N' THEN l_quantity
                      WHEN l_returnflag = 'A' THEN 100.0::DOUBLE * l_linenumber END AS valeur
          FROM lineitem) GROUP BY 1, 2""",
    "scalar_decimal_comma": """
        SELECT replace(CAST(l_extendedprice AS VARCHAR), '.', ',') AS brut, l_extendedprice AS prix, count(*) AS n
        FROM lineitem GROUP BY 1, 2""",
    "scalar_truncate": """
        SELECT c_custkey, substr(t, 1, 20) AS court, substr(t, 1, 50) AS long, NULL::VARCHAR AS absent
        FROM (SELECT c_custkey, c_name || ' / ' || c_mktsegment || ' / ' || c_name || ' / ' || c_mktsegment AS t
              FROM customer)""",
    "scalar_age": """
        SELECT annee, naissance, CASE WHEN naissance <> 'inconnu' THEN annee - born END AS age, count(*) AS n FROM (
          SELECT CAST(year(l_shipdate) AS INTEGER) AS annee, CAST(2000 - l_quantity AS INTEGER) AS born,
                 CASE WHEN l_returnflag = 'N' THEN CAST(CAST(2000 - l_quantity AS INTEGER) AS VARCHAR)
                      WHEN l_returnflag = 'A' THEN CAST(2000 - l_quantity AS INTEGER) || '.0'
                      WHEN l_linestatus = 'O' THEN 'inconnu' END AS naissance FROM lineitem) GROUP BY 1, 2, 3""",
    "scalar_bool": """
        SELECT CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '0.0' END AS brut,
               CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS drapeau, count(*) AS n
        FROM orders GROUP BY 1, 2""",
    "scalar_mph_to_kmh": """
        SELECT p_partkey, CAST(round(p_size * 1.60934::DOUBLE) AS INTEGER) AS km_h, p_size AS brut FROM part""",
    "geo_normalise": GEO_SQL,
    "date_assemble": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS annee, CAST(month(o_orderdate) AS VARCHAR) AS mois,
               CASE WHEN o_orderstatus = 'P' THEN '31' ELSE CAST(day(o_orderdate) AS VARCHAR) END AS jour,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE)
                    WHEN day(last_day(o_orderdate)) = 31 THEN CAST(last_day(o_orderdate) AS DATE) END AS date,
               count(*) AS n FROM orders GROUP BY 1, 2, 3, 4""",
    "date_parse_dayfirst": """
        SELECT brut, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS date, count(*) AS n
        FROM (SELECT o_orderstatus, o_orderdate,
                     CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%d/%m/%Y')
                          WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d')
                          ELSE strftime(o_orderdate, '%m/31/%Y') END AS brut FROM orders) GROUP BY 1, 2""",
    "date_parse_multi": f"""
        SELECT brut, CASE WHEN substr(o_orderpriority, 1, 1) <= '3' THEN CAST(o_orderdate AS DATE) END AS date,
               count(*) AS n
        FROM (SELECT o_orderpriority, o_orderdate, {MIXED_SQL} AS brut FROM orders) GROUP BY 1, 2""",
    "date_year_regex": f"""
        SELECT brut, CASE WHEN brut <> 'inconnue' THEN CAST(year(o_orderdate) AS INTEGER) END AS annee, count(*) AS n
        FROM (SELECT o_orderdate, {MIXED_SQL} AS brut FROM orders) GROUP BY 1, 2""",
    "calendar_parts": f"""
        SELECT date, CAST(day(date) AS INTEGER) AS jour, CAST(month(date) AS INTEGER) AS mois,
               CAST(year(date) AS INTEGER) AS annee, CAST(quarter(date) AS INTEGER) AS trimestre,
               CAST(isodow(date) AS INTEGER) AS jour_semaine, dn.w AS nom_jour, mn.w AS nom_mois,
               isodow(date) >= 6 AS est_weekend,
               CASE WHEN month(date) IN (12, 1, 2) THEN 'Hiver' WHEN month(date) IN (3, 4, 5) THEN 'Printemps'
                    WHEN month(date) IN (6, 7, 8) THEN 'Ete' ELSE 'Automne' END AS saison, count(*) AS n
        FROM (SELECT CAST(o_orderdate AS DATE) AS date FROM orders)
        JOIN (VALUES {_words(codebooks.DAY_NAMES)}) AS dn(i, w) ON dn.i = isodow(date)
        JOIN (VALUES {_words(codebooks.MONTH_NAMES)}) AS mn(i, w) ON mn.i = month(date)
        GROUP BY ALL""",
    "weather_conditions": with_parts(WEATHER_PARTS, GAPPY_PARTS, query="SELECT * FROM labelled"),
    "weather_fill": with_parts(
        WEATHER_PARTS,
        GAPPY_PARTS,
        query="""SELECT id_pays, date, temp_min, temp_max, coalesce(precipitations, 0) AS precipitations,
                        coalesce(vent, (SELECT median(vent) FROM labelled), 0) AS vent, conditions FROM labelled""",
    ),
    "fact_measures": with_parts(
        FACT_PARTS,
        query="""SELECT id_accident, nb_tues, nb_blesses_graves, nb_blesses_legers, nb_victimes_total, indice_gravite
                 FROM fact_staging""",
    ),
    "severity_score": with_parts(
        FACT_PARTS,
        query="""SELECT id_accident, CAST(round(CAST(1 + 4 * (indice_gravite - lo) / (hi - lo) AS DECIMAL(38,10)), 2) AS DOUBLE) AS score
                 FROM fact, (SELECT min(indice_gravite) AS lo, max(indice_gravite) AS hi FROM fact)""",
    ),
}
