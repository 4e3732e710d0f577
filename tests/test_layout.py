"""Places along the curve, workbooks, and a database that really runs."""

import random
import zipfile
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from waymark.runtime import new_folder
from waymark.sources import sinks, spatial, tables, workbook

PLACES = "id long, latitude double, longitude double"


def test_steps_of_the_curve_are_neighbours(spark):
    side = 16
    cells = [(x * side + y, (y + 0.5) / side * 180 - 90, (x + 0.5) / side * 360 - 180) for x in range(side) for y in range(side)]
    df = spark.createDataFrame(cells, PLACES)
    order = [r[0] for r in df.orderBy(spatial.hilbert(F.col("latitude"), F.col("longitude"), 4)).collect()]
    assert sorted(r[0] for r in df.select(spatial.hilbert(F.col("latitude"), F.col("longitude"), 4)).collect()) == list(range(side * side))
    points = [divmod(i, side) for i in order]
    assert all(abs(a - c) + abs(b - d) == 1 for (a, b), (c, d) in zip(points, points[1:]))
    odd = spark.createDataFrame([(1, None, 0.0), (2, 91.0, 0.0), (3, 90.0, 180.0), (4, -90.0, -180.0)], PLACES)
    assert [r[0] is None for r in odd.orderBy("id").select(spatial.hilbert(F.col("latitude"), F.col("longitude"))).collect()] == [True, True, False, False]


def test_a_box_reads_few_files(spark):
    rng = random.Random(2)
    table = [(i, 23.7 + rng.random() * 0.2, 90.3 + rng.random() * 0.2) for i in range(4000)] + [(9000, None, 90.4), (9001, 23.75, None)] + [(10_000 + i, 23.8, 90.4) for i in range(1500)]
    at = new_folder(spark)
    spatial.write_places(spark.createDataFrame(table, PLACES), at, 24)
    box = spatial.Box(23.71, 90.31, 23.74, 90.34)
    found = spatial.read_box(spark, at, box)
    assert sorted(r[0] for r in found.collect()) == sorted(i for i, a, b in table if a is not None and b is not None and box.south <= a <= box.north and box.west <= b <= box.east)
    whole = spark.read.parquet(f"{at}/data")
    assert whole.count() == len(table) and len(found.inputFiles()) * 4 <= len(whole.inputFiles())
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
    assert all(f"{f}({c}" in pushed for f in ("GreaterThanOrEqual", "LessThanOrEqual") for c in ("latitude", "longitude"))
    # Equal points fill several files, none of them much more than its share.
    sizes = [r[1] for r in whole.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert max(sizes) < 4 * len(table) / 24
    assert spatial.read_box(spark, at, spatial.Box(0, 0, 1, 1)).count() == 0 and spatial.read_box(spark, at, None).count() == 0
    assert spatial.box_of(spark.createDataFrame([], "south double, west double, north double, east double")) is None


# Workbooks --------------------------------------------------------------------------------------------------------


def sheet_of(path):
    """Rows of a workbook as lists of (place, value), read by its markup."""
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(path) as file:
        assert file.testzip() is None
        assert {"[Content_Types].xml", "_rels/.rels", "xl/workbook.xml", "xl/_rels/workbook.xml.rels", "xl/worksheets/sheet1.xml"} == set(file.namelist())
        for name in file.namelist():
            ElementTree.fromstring(file.read(name))
        rows = ElementTree.fromstring(file.read("xl/worksheets/sheet1.xml")).iter(f"{ns}row")
        read = lambda c: "".join(c.itertext()) if c.get("t") == "inlineStr" else bool(int(c[0].text)) if c.get("t") == "b" else float(c[0].text)
        return [(int(r.get("r")), {c.get("r"): read(c) for c in r}) for r in rows]


def test_workbook_reads_back(spark, tmp_path):
    df = spark.createDataFrame(
        [(2, "b <&> \"é\" \x01\n 😀", 1.5, True, None, ["x"]), (1, None, float("nan"), False, "2024-01-02", None), (3, "y" * 40_000, -0.25, None, "", [])],
        "id long, `a <b>` string, c double, d boolean, e string, f array<string>",
    )
    path = f"{tmp_path}/out.xlsx"
    workbook.write_workbook(df, path, [F.col("id")], "Places & more")
    rows = sheet_of(path)
    assert rows[0] == (1, {"A1": "id", "B1": "a <b>", "C1": "c", "D1": "d", "E1": "e", "F1": "f"})
    assert rows[1] == (2, {"A2": 1.0, "C2": "NaN", "D2": False, "E2": "2024-01-02"})
    assert rows[2] == (3, {"A3": 2.0, "B3": 'b <&> "é" \n 😀', "C3": 1.5, "D3": True, "F3": '["x"]'})
    assert rows[3] == (4, {"A4": 3.0, "B4": "y" * 32_767, "C4": -0.25, "E4": "", "F4": "[]"})


def test_workbook_of_many_partitions(spark, tmp_path):
    df = spark.range(30_000, numPartitions=9).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))
    sinks.write_excel(df, f"{tmp_path}/many.xlsx")
    rows = sheet_of(f"{tmp_path}/many.xlsx")
    assert [r[0] for r in rows] == list(range(1, 30_002)) and [r[1][f"A{i + 2}"] for i, r in enumerate(rows[1:])] == list(map(float, range(30_000)))
    workbook.write_workbook(df.limit(0), f"{tmp_path}/none.xlsx")
    assert len(sheet_of(f"{tmp_path}/none.xlsx")) == 1
    with pytest.raises(ValueError):
        workbook.write_workbook(spark.range(workbook.ROWS), f"{tmp_path}/x.xlsx")


def test_letters_of_columns():
    assert [workbook.letters(i) for i in (0, 25, 26, 51, 52, 701, 702, 16_383)] == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA", "XFD"]


# A database ------------------------------------------------------------------------------------------------------


def test_outlets_come_from_a_database(spark, tmp_path):
    """The database that Spark brings along: brand, range, filter and columns are its work."""
    url = "jdbc:derby:memory:outlets;create=true"
    names = ["Blue Door", "BLUE door 2", "100% Blue_Door", "Red Door", "blue'door", None]
    jvm = spark.sparkContext._jvm
    jvm.java.lang.System.setProperty("derby.stream.error.file", f"{tmp_path}/derby.log")
    shown = lambda n: "CAST(NULL AS VARCHAR(100))" if n is None else "'" + n.replace("'", "''") + "'"
    database = jvm.java.sql.DriverManager.getConnection(url)
    database.createStatement().execute("CREATE TABLE places (id INT, business_name VARCHAR(100), latitude DOUBLE)")
    database.createStatement().execute("INSERT INTO places VALUES " + ", ".join(f"({i}, {shown(names[i % 6])}, {i / 2})" for i in range(600)))
    read = lambda brand, **more: tables.read_outlets(spark, url, brand, table="places", ilike=False, **more).toDF("id", "business_name", "latitude")
    assert sorted({r[1] for r in read("blue door").collect()}) == ["BLUE door 2", "Blue Door"]
    assert {r[1] for r in read("blue_").collect()} == {"100% Blue_Door"} and {r[1] for r in read("0% b").collect()} == {"100% Blue_Door"}
    assert {r[1] for r in read("E'D").collect()} == {"blue'door"} and read("no such").count() == 0
    parted = read("blue door", parts=("ID", 100, 500, 4))
    assert parted.rdd.getNumPartitions() == 4 and parted.count() == 200
    some = tables.read_outlets(spark, url, "blue door", table="places", ilike=False).filter("id > 590").select("id")
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(some._jdf.queryExecution(), "formatted")
    assert "GreaterThan" in plan[plan.index("PushedFilters") :].split("\n")[0] and "business_name" not in plan[plan.index("ReadSchema") :].split("\n")[0].lower()
    assert sorted(r[0] for r in some.collect()) == [i for i in range(591, 600) if i % 6 < 2]
