"""Detection over whole files, on files written here."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from starmart.plans import cube
from starmart.sources.delimited import list_files, manifest, read_all
from starmart.sources.scratch import scratch_root


def write(folder, name, text, encoding="utf-8"):
    (folder / name).write_bytes(text.encode(encoding))


def test_wide_header_late_accent_and_blanks(spark, tmp_path):
    wide = [f"a_rather_long_column_name_{i}" for i in range(600)]
    write(tmp_path, "wide_2005.csv", ";".join(wide) + "\n" + ";".join(map(str, range(600))) + "\n")
    late = "".join(f"{i};ville{i}\n" for i in range(3000)) + "9999;Saône\n"
    write(tmp_path, "late_2006.csv", "num;commune\n" + late, "latin-1")
    write(tmp_path, "blank_2007.csv", "date de mesure;vent moyen du jour;pluie\n2007-01-01;3;4\n2007-01-02;5;6\n")
    described = manifest(list_files(spark, str(tmp_path)))
    found = {r["name"]: (r["sep"], r["encoding"], r["annee"], r["n_sep"]) for r in described.collect()}
    assert found == {
        "wide_2005.csv": (";", "UTF-8", 2005, 599),
        "late_2006.csv": (";", "ISO-8859-1", 2006, 1),
        "blank_2007.csv": (";", "UTF-8", 2007, 2),
    }
    rows = read_all(spark, described)
    assert rows.count() == 1 + 3001 + 2
    assert [r["commune"] for r in rows.where("num = '9999'").collect()] == ["Saône"]
    assert [r[wide[-1]] for r in rows.where(f"{wide[0]} = '0'").collect()] == ["599"]


def test_no_files(spark, tmp_path):
    write(tmp_path, "empty_2008.csv", "")
    assert manifest(list_files(spark, str(tmp_path))).collect() == []


def pieces(rng):
    """Fields that begin and end in a letter, so that cleaning leaves them alone."""
    return "a" + "".join(rng.choice(['"', ";", "\n", "b", "é", '""', "\n\n"]) for _ in range(rng.randrange(6))) + "z"


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_quoted_fields_over_line_ends_and_block_borders(spark, tmp_path, encoding):
    rng = random.Random(7)
    text = io.StringIO()
    written = [["cle", "note", "fin"]]
    written += [[str(i), pieces(rng), pieces(rng)] for i in range(300)]
    csv.writer(text, delimiter=";", lineterminator="\n").writerows(written)
    # a quote that does not begin a field is text, also beside quoted breaks; blank lines are no records
    loose = '300;5" pipe;"x\n\ny"\n\n301;a"b;c""d\n302;"";"q ""r""\ns"\n303;"one";too;"ma\nny"\n304;short\n'
    write(tmp_path, "broken_2005.csv", text.getvalue() + loose, encoding)
    write(tmp_path, "plain_2006.csv", 'cle;note;fin\n900;"a;b";5" pipe\n', encoding)
    sizes = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {k: spark.conf.get(k) for k in sizes}
    for k, v in zip(sizes, ("97", "1"), strict=True):
        spark.conf.set(k, v)
    try:
        described = manifest(list_files(spark, str(tmp_path)))
        assert {r["name"]: r["coupe"] for r in described.collect()} == {"broken_2005.csv": True, "plain_2006.csv": False}
        rows = read_all(spark, described).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    rows.sort(key=lambda r: (r["src_file"], r["src_block"], r["src_row"]))
    assert len({r["src_block"] for r in rows}) > 20
    expected = written[1:] + [["300", '5" pipe', "x\n\ny"], ["301", 'a"b', 'c""d'], ["302", None, 'q "r"\ns'], ["304", "short", None], ["900", "a;b", '5" pipe']]
    assert [[r["cle"], r["note"], r["fin"]] for r in rows] == expected
    assert [list(r) for r in csv.reader(io.StringIO(text.getvalue(), newline=""), delimiter=";")] == written


def test_quotes_that_are_never_closed_are_an_error(spark, tmp_path):
    write(tmp_path, "open_2005.csv", 'a;b\n1;"x\n2;y\n')
    with pytest.raises(ValueError, match="open_2005"):
        read_all(spark, manifest(list_files(spark, str(tmp_path))))


def test_a_refresh_replaces_all_levels(spark, tmp_path):
    path = str(tmp_path / "view")
    cube.write_cube(spark.createDataFrame([(0, 1), (3, 2), (7, 3)], "gid int, n int"), path)
    before = cube.read_cube(spark, path)
    cube.write_cube(spark.createDataFrame([(7, 9)], "gid int, n int"), path)
    assert [tuple(r) for r in cube.read_cube(spark, path).select("gid", "n").collect()] == [(7, 9)]
    # who opened the view earlier goes on reading what was opened, and a refresh that breaks changes nothing
    assert sorted(tuple(r) for r in before.select("gid", "n").collect()) == [(0, 1), (3, 2), (7, 3)]
    broken = spark.createDataFrame([(1, 1)], "gid int, n int").withColumn("n", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        cube.write_cube(broken, path)
    assert [tuple(r) for r in cube.read_cube(spark, path).select("gid", "n").collect()] == [(7, 9)]


def test_a_request_reads_one_level_of_the_stored_view(spark):
    from starmart.registry.cube import stored_view

    view = stored_view(spark, "/root/testdata/sf0.001")
    for question in (cube.weather_rank, cube.serious_cells, cube.smoothed_zones):
        plan = question(view)._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
        assert plan.count("FileScan") == 1 and "(gid#" in scan.split("PartitionFilters:")[1].split("]")[0]
        assert "lineitem" not in plan and "orders" not in plan


def test_scratch_is_shared(spark):
    class Cluster:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        scratch_root(Cluster)
    assert scratch_root(spark)
