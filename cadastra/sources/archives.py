"""Tables inside zip archives, spreadsheets among them, read on executors: one task for each archive, member by member."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that travel at once.
ROWS = 10_000
_CELLS = "archive string, member string, row long, cells array<string>"


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    part: list[tuple] = []

    def made() -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), kinds, strict=True)], names=["archive", "member", "row", "cells"])

    for r in rows:
        part.append(r)
        if len(part) >= ROWS:
            yield made()
            part = []
    if part:
        yield made()


def _delimited(z: zipfile.ZipFile, name: str, sep: str, encoding: str) -> Iterator[list[str | None]]:
    with z.open(name) as f:
        for row in csv.reader(io.TextIOWrapper(f, encoding=encoding, newline=""), delimiter=sep):
            yield [x if x != "" else None for x in row]


def _column(ref: str) -> int:
    n = 0
    for x in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(x) - 64
    return n - 1


def _sheet(z: zipfile.ZipFile, name: str) -> Iterator[list[str | None]]:
    """Rows of a worksheet as text; shared strings are held, rows are read one by one."""
    space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    shared: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        with z.open("xl/sharedStrings.xml") as f:
            for _, e in ElementTree.iterparse(f):
                if e.tag == f"{space}si":
                    shared.append("".join(t.text or "" for t in e.iter(f"{space}t")))
                    e.clear()
    with z.open(name) as f:
        for _, e in ElementTree.iterparse(f):
            if e.tag != f"{space}row":
                continue
            row: list[str | None] = []
            for k, c in enumerate(e.iter(f"{space}c")):
                at = _column(c.get("r")) if c.get("r") else k
                row += [None] * (at + 1 - len(row))
                v = c.find(f"{space}v")
                if c.get("t") == "inlineStr":
                    row[at] = "".join(t.text or "" for t in c.iter(f"{space}t"))
                elif v is not None and v.text is not None:
                    row[at] = shared[int(v.text)] if c.get("t") == "s" else v.text
            yield row
            e.clear()


def cells(spark: SparkSession, path: str, members: str = ".*", sep: str = ",", encoding: str = "utf-8", sheets: bool = False) -> DataFrame:
    """(archive, member, row, cells) of the members whose name matches whole; row counts from 0; empty cells are null.

    path: an archive, a folder or a pattern of them.  With sheets, archives are spreadsheets and members their sheets
    ('xl/worksheets/sheet1.xml').  An archive must fit in a task's memory packed; its members are unpacked as they are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for at, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                        for name in sorted(n for n in z.namelist() if re.fullmatch(members, n)):
                            for k, row in enumerate(_sheet(z, name) if sheets else _delimited(z, name, sep, encoding)):
                                yield at.rsplit("/", 1)[-1], name, k, row

        return _batches(rows())

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _CELLS)


def with_header(rows: DataFrame, header: int = 0) -> DataFrame:
    """Rows of cells as a table of text columns named by the row `header`, which all members must state alike; rows before it go."""
    names = rows.where(F.col("row") == header).select("cells").distinct().limit(2).collect()
    if len(names) != 1:
        raise ValueError(f"members have {'no' if not names else 'different'} headers")
    columns = [(n or f"column{k}").strip() for k, n in enumerate(names[0].cells)]
    return rows.where(F.col("row") > header).select("archive", "member", "row", *(F.get("cells", F.lit(k)).alias(n) for k, n in enumerate(columns)))
