"""Column functions on literal rows, and the file readers on odd files."""

import datetime
import gzip
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from starmart import codebooks
from starmart.functions import dates, geo, scalars
from starmart.plans.calendar import days_of_years, holidays, with_easter
from starmart.sources import columns, delimited, profile, sinks

NBSP = "\u00a0"


def apply(spark, expr, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "expr, given, want",
    [
        (
            scalars.clean_text,
            [f" a{NBSP}b ", "N/A", " nan ", f"{NBSP}None", "", None, "NULL", "  ", "\tx\n"],
            ["ab", None, None, None, None, None, None, "", "x"],
        ),
        (
            lambda c: scalars.decode(c, codebooks.FR_SEX),
            ["1", "2.9", "-1", "-1.5", "7", "x", "", None, "1d", "1e0", " 2 ", "inf", "99999999999"],
            ["Male", "Female", "Unknown", "Unknown", "Unknown", "Unknown", "Unknown", "Unknown", "Unknown",
             "Male", "Female", "Unknown", "Unknown"],
        ),
        (scalars.safe_int, ["3", "-0.5", "-1", "2.9", "x", None, "1e3", "7f"], [3, 0, None, 2, None, None, 1000, None]),
        (scalars.nonzero_code, ["0", "12", "2A4", None, "-3", "4.0"], [None, "12", None, None, None, "4"]),
        (scalars.decimal_comma, ["1,5", "-2.25", "1,2,3", "", None], [1.5, -2.25, None, None, None]),
        (scalars.to_number, ["NaN", "Infinity", "1.", ".5", "+2", "0x1"], [None, None, 1.0, 0.5, 2.0, None]),
        (scalars.bool_flag, ["1", "0", "1.0", None, "x"], [True, False, True, None, None]),
        (
            lambda c: scalars.age_from_birth_year(F.lit(2005), c),
            ["1970", "1970.0", "19x0", "", None, "-5", "--5", "1.2.3", "1e3"],
            [35, 35, None, None, None, 2010, None, None, None],
        ),
        (
            scalars.title_kind,
            ["Carcteristiques 2005", "caract_2019", "lieux-2021", "Vehicules-immatricules", "vehicules_2005",
             "vehicules-2017", "USAGERS", "autre", None],
            ["caracteristiques", "caracteristiques", "lieux", "vehicules_immatricules", "vehicules",
             "vehicules", "usagers", None, None],
        ),
        (
            dates.date_any,
            ["20050115", "2005-01-15", "2005-1-5", " 20051231 ", "20051331", "x", None],
            [datetime.date(2005, 1, 15), datetime.date(2005, 1, 15), datetime.date(2005, 1, 5),
             datetime.date(2005, 12, 31), None, None, None],
        ),
        (
            dates.date_day_first,
            ["05/01/2005", "5/1/2005", "2005-02-01", "31/02/2005", "01-02", None],
            [datetime.date(2005, 1, 5), datetime.date(2005, 1, 5), datetime.date(2005, 2, 1), None, None, None],
        ),
        (dates.year_in_text, ["20050115", "2005-01-15", "le 3 mai 2011", "12", "", None], [2005, 2005, 2011, None, None, None]),
        (
            dates.last_year_in_name,
            ["H_75_1990-1999.csv.gz", "meteo.csv", "caract_2005.csv", "x_20200101.csv"],
            [1999, None, 2005, 101],
        ),
        (
            scalars.severity_band,
            [0.0, 1.0, 3.0, 4.0, 9.0, 10.0, None],
            ["0", "1-3", "1-3", "4-9", "4-9", "10+", None],
        ),
        (scalars.round2, [1.005, -1.005, 2.675, 0.125, None], [1.01, -1.01, 2.68, 0.13, None]),
    ],
)
def test_scalars(spark, expr, given, want):
    kind = "double" if any(isinstance(g, float) for g in given) else "string"
    assert apply(spark, expr, given, kind) == want


def test_scores_and_speed(spark):
    flat = spark.range(2).select(scalars.scaled_score(F.lit(3.0), F.lit(3.0), F.lit(3.0)).alias("s"))
    assert {r[0] for r in flat.collect()} == {1.0}
    assert apply(spark, lambda c: scalars.scaled_score(c, F.lit(0.0), F.lit(8.0)), [0.0, 4.0, 8.0, None], "double") == [
        1.0, 3.0, 5.0, None,
    ]
    assert apply(spark, scalars.mph_to_kmh, [30, 70, None], "int") == [48, 113, None]


def test_coordinates(spark):
    df = spark.createDataFrame(
        [
            ("6600000", "700000"),
            ("6862275,25", "652381.5"),  # Paris
            ("48,85", "2,35"),
            ("x", "2"),
            (None, "2"),
            ("-90", "1"),
        ],
        "lat string, lon string",
    )
    lat, lon = geo.degrees_pair(F.col("lat"), F.col("lon"))
    got = [tuple(r) for r in df.select(lat, lon).collect()]
    assert got[0] == (46.5, 3.0)
    assert abs(got[1][0] - 48.858) < 0.01 and abs(got[1][1] - 2.351) < 0.01
    assert got[2:] == [(48.85, 2.35), (None, None), (None, None), (-90.0, 1.0)]


def test_easter_and_holidays(spark):
    known = {1961: "1961-04-02", 2000: "2000-04-23", 2005: "2005-03-27", 2008: "2008-03-23", 2011: "2011-04-24",
             2019: "2019-04-21", 2021: "2021-04-04", 2038: "2038-04-25"}
    years = spark.createDataFrame([(y,) for y in known], "annee int")
    assert {r["annee"]: r["paques"].isoformat() for r in with_easter(years).collect()} == known
    uk = holidays(spark.createDataFrame([(2021,), (2011,)], "annee int")).filter("country = 'UK'").orderBy("date")
    got = [r["date"].isoformat() for r in uk.collect()]
    assert got == [
        "2011-01-01", "2011-01-03", "2011-04-22", "2011-04-25", "2011-04-29", "2011-05-02", "2011-05-30",
        "2011-08-29", "2011-12-25", "2011-12-26", "2011-12-27",
        "2021-01-01", "2021-04-02", "2021-04-05", "2021-05-03", "2021-05-31", "2021-08-30",
        "2021-12-25", "2021-12-26", "2021-12-27", "2021-12-28",
    ]


def test_warehouse_years_have_3285_days(spark):
    assert days_of_years(spark, codebooks.WAREHOUSE_YEARS).count() == 3285


def test_finding_columns():
    names = ["Date_Obs", "T", "TINF_H", "wind_speed", "age_band_of_casualty", "age_of_casualty"]
    assert columns.find_column(names, ["t"]) == "T"
    assert columns.find_column(["date"], ["T"]) is None
    assert columns.find_column(names, ["wind"]) == "wind_speed"
    assert columns.find_by_words(names, ["age", "casualty"], ["band"]) == "age_of_casualty"
    assert columns.find_field(names, "date") == "Date_Obs"
    assert columns.find_field(["a", "Accident_Year"], "year") == "Accident_Year"
    assert columns.find_field(["x", "accident_index"], "index") == "accident_index"
    with pytest.raises(ValueError):
        columns.find_column(names, ["rain"], required=True)


@pytest.fixture(scope="module")
def folder():
    root = tempfile.mkdtemp(prefix="run-")

    def put(name, data, opener=open):
        with opener(os.path.join(root, name), "wb") as out:
            out.write(data)

    put("a_2005.csv", b'cle;nom\n1;"x;y"\n2;"a""b"\n3\n4;d;e\n5;f;\n6;\n')
    put("b_2007.csv", "cle,nom\n7,é\n".encode("latin-1"))
    put("c_2009.csv", "\ufeffcle\tnom\n8\tz\n".encode("utf-8"))
    put("d.csv", b"cle\n9\n")
    put("e_1990-1999.csv.gz", b"cle;nom\n10;k\n", gzip.open)
    return root


def test_reading_unlike_files(spark, folder):
    found = delimited.manifest(delimited.list_files(spark, folder))
    got = {r["name"]: (r["sep"], r["encoding"], r["annee"]) for r in found.collect()}
    assert got == {
        "a_2005.csv": (";", "UTF-8", 2005),
        "b_2007.csv": (",", "ISO-8859-1", 2007),
        "c_2009.csv": ("\t", "UTF-8", 2009),
        "d.csv": (",", "UTF-8", None),
        "e_1990-1999.csv.gz": (";", "UTF-8", 1999),
    }
    rows = delimited.read_all(spark, found).select("cle", "nom").collect()
    # Row 4 has a field too many and so has row 5, whose extra field is empty.
    assert sorted((tuple(r) for r in rows), key=lambda r: int(r[0])) == [
        ("1", "x;y"), ("2", 'a"b'), ("3", None), ("6", None), ("7", "é"), ("8", "z"), ("9", None), ("10", "k"),
    ]
    kept = delimited.recent_files(found, 2005)
    assert sorted(r["name"] for r in kept.collect()) == ["a_2005.csv", "b_2007.csv", "c_2009.csv", "d.csv"]


def test_positions_follow_the_file_over_several_splits(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="run-"), "long.csv")
    with open(path, "w") as out:
        out.write("n;t\n" + "".join(f"{i};{'x' * (i % 40)}\n" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = delimited.read_delimited(spark, [path], ["n", "t"], ";")
        assert df.rdd.getNumPartitions() > 3
        got = [int(r[0]) for r in df.orderBy(delimited.position()).select("n").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == list(range(20000))


def test_missing_source_raises_when_asked(spark):
    present = spark.createDataFrame([(1, 2005)], "id_pays int, annee int")
    wanted = spark.createDataFrame([(1, 2005), (2, 2005)], "id_pays int, annee int")
    report = delimited.missing_sources(present, wanted, ["id_pays", "annee"])
    assert {tuple(r) for r in report.collect()} == {(1, 2005, True), (2, 2005, False)}
    with pytest.raises(FileNotFoundError):
        delimited.missing_sources(present, wanted, ["id_pays", "annee"], "error")


def test_unreadable_source_is_reported(spark):
    good = spark.createDataFrame([(1, None), (2, "a")], "x int, y string")
    got = profile.profile_sources({"good": good, "bad": FileNotFoundError("gone")}).collect()
    assert {(r["source"], r["colonne"], r["nuls"], r["erreur"]) for r in got} == {
        ("good", "x", 0, None), ("good", "y", 1, None), ("bad", None, None, "gone"),
    }


def test_redoing_a_year_leaves_the_others(spark):
    path = tempfile.mkdtemp(prefix="run-") + "/out"
    df = spark.createDataFrame([(1, 2005), (2, 2007)], "v int, annee int")
    sinks.write_by_year(df, path, [2005, 2007, 2009])
    sinks.redo_years(df.withColumn("v", F.col("v") * 10), path, [2007])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("v", "annee").collect()) == [(1, 2005), (20, 2007)]
    assert not os.path.exists(path + "/annee=2009")
