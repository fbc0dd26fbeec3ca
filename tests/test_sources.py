"""Archives, spreadsheets, text and feature sinks, tables of units."""

from __future__ import annotations

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from cadastra.functions import shapes as sh
from cadastra.sources import archives as ar
from cadastra.sources import store

SHEET = """<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>
<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>area</t></is></c></row>
<row r="2"><c r="A2" t="s"><v>1</v></c><c r="C2"><v>2.5</v></c></row><row r="3"><c r="C3"><v>7</v></c></row></sheetData></worksheet>"""
STRINGS = """<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><si><t>id</t></si><si><r><t>P</t></r><r><t>1</t></r></si></sst>"""


def test_members_of_archives(spark, tmp_path):
    for k in range(2):
        with zipfile.ZipFile(tmp_path / f"a{k}.zip", "w") as z:
            z.writestr("roll/one.csv", f'id,note\n{k}1,"x, y"\n{k}2,\n')
            z.writestr("roll/readme.txt", "no table")
    rows = ar.with_header(ar.cells(spark, str(tmp_path), r".*\.csv")).orderBy("archive", "row").collect()
    assert [(r.archive, r.id, r.note) for r in rows] == [("a0.zip", "01", "x, y"), ("a0.zip", "02", None), ("a1.zip", "11", "x, y"), ("a1.zip", "12", None)]
    with pytest.raises(ValueError, match="no headers"):
        ar.with_header(ar.cells(spark, str(tmp_path), "nothing"))
    with pytest.raises(ValueError, match="different headers"):
        ar.with_header(ar.cells(spark, str(tmp_path), ".*"))


def test_sheets(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "t.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", STRINGS)
        z.writestr("xl/worksheets/sheet1.xml", SHEET)
    rows = ar.with_header(ar.cells(spark, f"{tmp_path}/t.xlsx", r"xl/worksheets/sheet1\.xml", sheets=True))
    assert rows.columns == ["archive", "member", "row", "id", "column1", "area"]
    assert [(r.id, r.column1, r.area) for r in rows.orderBy("row").collect()] == [("P1", None, "2.5"), (None, None, "7")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c', [1, 2]), (2, None, None)], "i int, s string, l array<int>")
    store.write_csv(df, f"{tmp_path}/csv", 1)
    back = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/csv").orderBy("i").collect()
    assert [(r.i, r.s, r.l) for r in back] == [("1", 'a "b", c', "[1,2]"), ("2", None, None)]
    shaped = df.select("i", F.when(F.col("i") == 1, sh.box(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(1.0))).alias("shape"))
    store.write_features(shaped, f"{tmp_path}/features")
    lines = sorted((json.loads(r.value) for r in spark.read.text(f"{tmp_path}/features").collect()), key=lambda x: x["properties"]["i"])
    assert lines[0]["geometry"]["coordinates"] == [[[0, 0], [2, 0], [2, 1], [0, 1], [0, 0]]] and lines[1]["geometry"] is None


def test_tables_of_units(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/US-A/t")
    spark.range(3).withColumn("more", F.lit(1)).write.parquet(f"{tmp_path}/US-B/t")
    got = store.read_units(spark, f"{tmp_path}/{{unit}}/t", ["US-A", "US-B", "US-C"], "skip")
    assert {r.unit: r["count"] for r in got.groupBy("unit").count().collect()} == {"US-A": 2, "US-B": 3}
    with pytest.raises(FileNotFoundError):
        store.read_units(spark, f"{tmp_path}/{{unit}}/x", ["US-A"], "skip")
