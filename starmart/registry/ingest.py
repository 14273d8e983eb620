"""Files written from the test tables and read back the way sources are read."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.functions.scalars import first_listed_year, title_kind, to_number
from starmart.functions.dates import last_year_in_name
from starmart.sources import sinks
from starmart.sources.delimited import (
    list_files,
    manifest,
    missing_sources,
    read_all,
    recent_files,
)
from starmart.sources.profile import profile_sources
from starmart.sources.scratch import scratch_path
from starmart.sources.testdata import star, table

FIELDS = ["cle", "date", "statut", "prix", "libelle"]


def _yearly_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumn("annee", F.year("o_orderdate"))


def _write_lines(orders, path, sep, encoding):
    """One headed text file per year: pending orders get a field too many, low ones lack two."""
    fields = [
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")),
        F.date_format("o_orderdate", "yyyyMMdd"),
        "o_orderstatus",
    ]
    full = [*fields, F.col("o_totalprice").cast("string"),
            F.concat(F.lit(f'"é{sep}'), "o_orderpriority", F.lit('"'))]
    line = (
        F.when(F.col("o_orderstatus") == "P", F.concat_ws(sep, *full, F.lit("x")))
        .when(F.col("o_orderpriority").startswith("5"), F.concat_ws(sep, *fields))
        .otherwise(F.concat_ws(sep, *full))
    )
    rows = orders.select("annee", line.alias(sep.join(FIELDS))).hint("rebalance", "annee")
    writer = rows.write.mode("append").partitionBy("annee")
    # Lines are ready made: no quoting, and a separator that never occurs.
    writer.options(
        header=True, sep="\u0001", quote="\u0000", escapeQuotes=False, encoding=encoding,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def _raw_folder(spark, sf_dir):
    """Years up to 1997 semicolon-separated UTF-8, later ones comma-separated Latin-1."""
    path = scratch_path(spark, "raw")
    orders = _yearly_orders(spark, sf_dir)
    _write_lines(orders.filter(F.col("annee") <= 1997), path, ";", "UTF-8")
    _write_lines(orders.filter(F.col("annee") > 1997), path, ",", "ISO-8859-1")
    return path


def _folder_year(path):
    return F.regexp_extract(path, r"annee=(\d{4})", 1).cast("int")


def ingest_csv_clean(spark, sf_dir):
    files = list_files(spark, _raw_folder(spark, sf_dir), "*.csv")
    rows = read_all(spark, manifest(files))
    return rows.select(_folder_year(F.col("src_file")).alias("annee"), *FIELDS)


def ingest_quoted_breaks(spark, sf_dir):
    """Orders in yearly files whose notes are quoted and run over two or three lines."""
    path = scratch_path(spark, "raw-breaks")
    orders = _yearly_orders(spark, sf_dir)
    note = F.concat(F.lit('"'), "o_orderpriority", F.lit(';""\n'), F.when(F.col("o_orderstatus") == "P", F.lit("\n")).otherwise(""), "o_orderstatus", F.lit('"'))
    body = orders.select("annee", "o_orderkey", F.concat_ws(";", F.col("o_orderkey").cast("string"), note, F.col("o_totalprice").cast("string")).alias("value"))
    heads = orders.select("annee").distinct().select("annee", F.lit(None).cast("bigint").alias("o_orderkey"), F.lit("cle;note;prix").alias("value"))
    lines = heads.unionByName(body).repartition("annee").sortWithinPartitions("annee", F.col("o_orderkey").asc_nulls_first())
    lines.select("annee", "value").write.partitionBy("annee").text(path)
    rows = read_all(spark, manifest(list_files(spark, path, "*.txt")))
    return rows.select(_folder_year(F.col("src_file")).alias("annee"), F.col("cle").cast("bigint").alias("cle"), "note", to_number(F.col("prix")).alias("prix"))


def ingest_detect_sep(spark, sf_dir):
    found = manifest(list_files(spark, _raw_folder(spark, sf_dir), "*.csv"))
    return found.select(
        _folder_year(F.col("path")).alias("annee"), "sep", "encoding", "n_sep", F.col("ligne").alias("entete")
    ).distinct()


def ingest_csv_gz(spark, sf_dir):
    """Gzipped files, unpacked by one task each and spread afterwards."""
    path = scratch_path(spark, "raw-gz")
    orders = _yearly_orders(spark, sf_dir).select(
        "annee", F.col("o_orderkey").alias("cle"), F.col("o_totalprice").alias("prix")
    )
    orders.hint("rebalance", "annee").write.partitionBy("annee").options(
        header=True, sep=";", compression="gzip"
    ).csv(path)
    tasks = spark.sparkContext.defaultParallelism
    rows = read_all(spark, manifest(list_files(spark, path, "*.csv.gz"), [";", ","], ";"), spread=tasks)
    return rows.select(
        _folder_year(F.col("src_file")).alias("annee"),
        F.col("cle").cast("bigint").alias("cle"),
        to_number(F.col("prix")).alias("prix"),
    )


SPLIT_YEARS = [1995, 1997, 1999, 2001, 2003]


def _per_year(df, *more):
    return df.groupBy("annee", *more).agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("premier"), F.max("o_orderkey").alias("dernier")
    )


def split_by_year(spark, sf_dir):
    path = scratch_path(spark, "split")
    orders = _yearly_orders(spark, sf_dir)
    sinks.write_by_year(orders, path, SPLIT_YEARS)
    return _per_year(spark.read.schema(orders.schema).parquet(path))


def split_by_year_missing_only(spark, sf_dir):
    """1995 is there already and stays; the other years are added."""
    path = scratch_path(spark, "split")
    orders = _yearly_orders(spark, sf_dir)
    sinks.write_by_year(orders.withColumn("etat", F.lit("ancien")), path, [1995])
    renewed = orders.withColumn("etat", F.lit("nouveau"))
    sinks.write_missing_years(renewed, path, SPLIT_YEARS)
    return _per_year(spark.read.schema(renewed.schema).parquet(path), "etat")


def prune_files_by_year(spark, sf_dir):
    """File names made from the orders' years."""
    year = F.year("o_orderdate")
    name = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("meteo_"), year - 1, F.lit("-"), year, F.lit(".csv.gz")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("horaire_"), year, F.lit(".csv")))
        .otherwise("meteo_ancienne.csv")
    )
    names = table(spark, sf_dir, "orders").groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return recent_files(names, 1998).withColumn("annee", last_year_in_name(F.col("name")))


LISTED_YEARS = [1995, 1997, 1999, 2001]


def classify_title(spark, sf_dir):
    year = F.year("o_orderdate").cast("string")
    digit = F.substring("o_orderpriority", 1, 1)
    title = (
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("Documentation "), year))
        .when(digit == "1", F.concat(F.lit("Carcteristiques_"), year))
        .when(digit == "2", F.concat(F.lit("LIEUX-"), year))
        .when(digit == "3", F.concat(F.lit("vehicules-immatricules-"), year))
        .when(digit == "4", F.concat(F.lit("Vehicules_"), year))
        .otherwise(F.concat(F.lit("usagers 2001 et "), year))
    )
    titles = table(spark, sf_dir, "orders").groupBy(title.alias("titre")).agg(F.count(F.lit(1)).alias("n"))
    return titles.select(
        "titre", "n", title_kind(F.col("titre")).alias("genre"),
        first_listed_year(F.col("titre"), LISTED_YEARS).alias("annee"),
    )


def missing_sources_report(spark, sf_dir):
    """Which (country, year) deliveries of 1990 to 2003 exist."""
    base = star(spark, sf_dir)
    present = base.fact_staging().select("id_pays", F.year("date").alias("annee"))
    wanted = base.country.select("id_pays", F.explode(F.sequence(F.lit(1990), F.lit(2003))).alias("annee"))
    return missing_sources(present, wanted, ["id_pays", "annee"])


def sink_roundtrip(spark, sf_dir):
    """Orders written to CSV status by status and read back."""
    path = scratch_path(spark, "csv")
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    for status in "FOP":
        sinks.write_csv(orders.filter(F.col("o_orderstatus") == status), path, ";")
    rows = read_all(spark, manifest(list_files(spark, path, "*.csv")))
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in orders.schema.fields])


PROFILED = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


def profile_tables(spark, sf_dir):
    """Every given table, and one that was announced and did not come."""
    sources = {name: table(spark, sf_dir, name) for name in PROFILED}
    return profile_sources({**sources, "retard": FileNotFoundError("no file")})


QUERIES = {
    "ingest_csv_clean": ingest_csv_clean,
    "ingest_quoted_breaks": ingest_quoted_breaks,
    "ingest_detect_sep": ingest_detect_sep,
    "ingest_csv_gz": ingest_csv_gz,
    "split_by_year": split_by_year,
    "split_by_year_missing_only": split_by_year_missing_only,
    "prune_files_by_year": prune_files_by_year,
    "classify_title": classify_title,
    "missing_sources_report": missing_sources_report,
    "sink_roundtrip": sink_roundtrip,
    "profile_sources": profile_tables,
}

YEAR = "CAST(year(o_orderdate) AS INTEGER)"

ORACLES = {
    "ingest_csv_clean": f"""
        SELECT {YEAR} AS annee, CAST(o_orderkey AS VARCHAR) AS cle, strftime(o_orderdate, '%Y%m%d') AS date,
               o_orderstatus AS statut,
               CASE WHEN o_orderpriority NOT LIKE '5%' THEN CAST(o_totalprice AS VARCHAR) END AS prix,
               CASE WHEN o_orderpriority NOT LIKE '5%' THEN 'é' || CASE WHEN year(o_orderdate) <= 1997 THEN ';' ELSE ',' END
                    || o_orderpriority END AS libelle
        FROM orders WHERE o_orderstatus <> 'P'""",
    "ingest_quoted_breaks": f"""
        SELECT {YEAR} AS annee, o_orderkey AS cle, o_totalprice AS prix,
               o_orderpriority || ';"' || chr(10) || CASE WHEN o_orderstatus = 'P' THEN chr(10) ELSE '' END || o_orderstatus AS note
        FROM orders""",
    "ingest_detect_sep": f"""
        SELECT annee, sep, CASE WHEN annee <= 1997 THEN 'UTF-8' ELSE 'ISO-8859-1' END AS encoding,
               CAST(4 AS INTEGER) AS n_sep, 'cle' || sep || 'date' || sep || 'statut' || sep || 'prix' || sep || 'libelle' AS entete
        FROM (SELECT DISTINCT {YEAR} AS annee, CASE WHEN year(o_orderdate) <= 1997 THEN ';' ELSE ',' END AS sep FROM orders)""",
    "ingest_csv_gz": f"SELECT {YEAR} AS annee, o_orderkey AS cle, o_totalprice AS prix FROM orders",
    "split_by_year": f"""
        SELECT {YEAR} AS annee, count(*) AS n, min(o_orderkey) AS premier, max(o_orderkey) AS dernier
        FROM orders WHERE year(o_orderdate) IN (1995, 1997, 1999, 2001, 2003) GROUP BY 1""",
    "split_by_year_missing_only": f"""
        SELECT {YEAR} AS annee, CASE WHEN year(o_orderdate) = 1995 THEN 'ancien' ELSE 'nouveau' END AS etat,
               count(*) AS n, min(o_orderkey) AS premier, max(o_orderkey) AS dernier
        FROM orders WHERE year(o_orderdate) IN (1995, 1997, 1999, 2001, 2003) GROUP BY 1, 2""",
    "prune_files_by_year": f"""
        SELECT CASE o_orderstatus WHEN 'F' THEN 'meteo_' || (y - 1) || '-' || y || '.csv.gz'
                    WHEN 'O' THEN 'horaire_' || y || '.csv' ELSE 'meteo_ancienne.csv' END AS name,
               count(*) AS n, CASE WHEN o_orderstatus <> 'P' THEN y END AS annee
        FROM (SELECT o_orderstatus, {YEAR} AS y FROM orders) WHERE o_orderstatus = 'P' OR y >= 1998 GROUP BY 1, 3""",
    "classify_title": f"""
        SELECT CASE WHEN s = 'P' THEN 'Documentation ' || y ELSE
                 CASE d WHEN '1' THEN 'Carcteristiques_' || y WHEN '2' THEN 'LIEUX-' || y
                   WHEN '3' THEN 'vehicules-immatricules-' || y WHEN '4' THEN 'Vehicules_' || y
                   ELSE 'usagers 2001 et ' || y END END AS titre, count(*) AS n,
               CASE WHEN s <> 'P' THEN list_extract(['caracteristiques', 'lieux', 'vehicules_immatricules', 'vehicules',
                 'usagers'], CAST(d AS INTEGER)) END AS genre,
               CASE WHEN y IN (1995, 1997, 1999, 2001) THEN y WHEN d = '5' AND s <> 'P' THEN 2001 END AS annee
        FROM (SELECT o_orderstatus AS s, substr(o_orderpriority, 1, 1) AS d, {YEAR} AS y FROM orders)
        GROUP BY 1, 3, 4""",
    "missing_sources_report": """
        SELECT r_regionkey AS id_pays, CAST(y AS INTEGER) AS annee,
               EXISTS (SELECT 1 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
                       WHERE n_regionkey = r_regionkey AND year(o_orderdate) = y) AS present
        FROM region, (SELECT unnest(range(1990, 2004)) AS y)""",
    "sink_roundtrip": "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders",
    "profile_sources": " UNION ALL ".join(
        [
            f"""SELECT '{t}' AS source, CAST({i} AS INTEGER) AS position, '{c}' AS colonne, count(*) AS lignes,
                       count(*) FILTER (WHERE {c} IS NULL) AS nuls,
                       {"NULL" if c == "embedding" else f"min(CAST({c} AS VARCHAR))"} AS minimum,
                       {"NULL" if c == "embedding" else f"max(CAST({c} AS VARCHAR))"} AS maximum,
                       CAST(NULL AS VARCHAR) AS erreur FROM {t}"""
            for t, columns in PROFILED.items()
            for i, c in enumerate(columns, 1)
        ]
        + ["SELECT 'retard', NULL, NULL, NULL, NULL, NULL, NULL, 'no file'"]
    ),
}
