"""Readers for sheets, CSV and JSON exports with headers of varying wording."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Sequence
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from claimloom.functions.text import code_of
from claimloom.operators.ordered import first_by_key


def header_key(name: object) -> str:
    """A header for comparison: lower case, one blank between words."""
    return " ".join(str(name or "").lower().split())


def resolve_column(columns: Sequence[str], *parts: str, default: str | None = None) -> str | None:
    """The first column whose header contains all parts, else the default."""
    return next((c for c in columns if all(header_key(p) in header_key(c) for p in parts)), default)


def pick_column(columns: Sequence[str], wanted: Sequence[str]) -> str | None:
    """The first wanted header that occurs exactly, else the first that a column contains."""
    keys = {header_key(c): c for c in reversed(columns)}
    for w in wanted:
        if header_key(w) in keys:
            return keys[header_key(w)]
    return next((c for w in wanted for c in columns if header_key(w) in header_key(c)), None)


def find_header(rows: Sequence[Sequence[object]], wanted: Sequence[str], within: int = 10) -> int | None:
    """Number of the first of the leading rows in which a wanted header occurs."""
    return next((i for i, r in enumerate(rows[:within]) if pick_column([str(c or "") for c in r], wanted)), None)


def read_csv(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """CSV with a header, all columns as text; a byte order mark is dropped from the first header."""
    df = spark.read.option("header", True).option("sep", delimiter).option("multiLine", True).option("escape", '"').csv(path)
    return df.toDF(*[c.replace("﻿", "") for c in df.columns])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON array or lines of records; fields of the form {"name": ...} are unwrapped to their name."""
    df = spark.read.option("multiLine", True).json(path)
    for f in df.schema.fields:
        if isinstance(f.dataType, StructType) and "name" in f.dataType.names:
            df = df.withColumn(f.name, F.col(f"`{f.name}`.name"))
    return df


def pattern_rows(df: DataFrame, code_column: str, order: str) -> DataFrame:
    """Rows whose code column starts with a pattern code, the code alone, the last row of each code."""
    x = df.withColumn("code", code_of(F.col(code_column))).where("code is not null")
    return first_by_key(x, ["code"], [order], last=True)


def rules_of(df: DataFrame) -> DataFrame:
    """One row of the active rules of ``df(signal, descr, relevance, status)``: excluded words, text-only patterns."""
    a = df.where(F.lower(F.trim("status")).isin("aktiv", "active"))
    s = F.lower(F.col("signal"))
    words = F.split(F.lower("descr"), r"\s*[,;]\s*")
    return a.agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.contains(s, F.lit("ausschluss")) | F.contains(s, F.lit("exclude")), words))))).alias("excluded"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.contains(s, F.lit("text")), F.regexp_extract_all("descr", F.lit(r"\b(P\d+)\b"), 1)))))).alias("text_only"),
        F.count(F.lit(1)).alias("n_rules"),
    )


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def xlsx_rows(path: str, sheet: int = 1) -> list[list[str]]:
    """The cells of a sheet as text, row by row; empty cells are empty texts."""
    with zipfile.ZipFile(path) as z:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
        root = ElementTree.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml"))
    out = []
    for row in root.iter(f"{{{_NS['m']}}}row"):
        cells: dict[int, str] = {}
        for c in row.findall("m:c", _NS):
            letters = re.match("[A-Z]+", c.get("r", "A")).group(0)
            col = 0
            for ch in letters:
                col = col * 26 + ord(ch) - 64
            v = c.find("m:v", _NS)
            if c.get("t") == "s" and v is not None:
                text = shared[int(v.text)]
            elif c.get("t") == "inlineStr":
                text = "".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t"))
            else:
                text = v.text if v is not None and v.text else ""
            cells[col - 1] = text
        out.append([cells.get(i, "") for i in range(max(cells, default=-1) + 1)])
    return out


class XlsxSource(DataSource):
    """``spark.read.format("xlsx").option("path", file)``: the first sheet, its first row as header, all text."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def _rows(self) -> list[list[str]]:
        return xlsx_rows(self.options["path"], int(self.options.get("sheet", "1")))

    def schema(self) -> StructType:
        head = self._rows()[int(self.options.get("headerrow", "0"))]
        return StructType([StructField(h or f"c{i}", StringType()) for i, h in enumerate(head)])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _XlsxReader(self._rows()[int(self.options.get("headerrow", "0")) + 1 :], len(schema.fields))


class _XlsxReader(DataSourceReader):
    def __init__(self, rows: list[list[str]], width: int):
        self.rows, self.width = rows, width

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(0, max(len(self.rows), 1), 10_000)]

    def read(self, partition: InputPartition):
        for r in self.rows[partition.value : partition.value + 10_000]:
            yield tuple((r + [""] * self.width)[: self.width])


def image_groups(spark: SparkSession, folder: str) -> DataFrame:
    """``(class, org, n, first_paths)`` of images named class__organisation__number under a folder."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*__*__*").load(folder).select("path")
    p = F.split(F.element_at(F.split("path", "/"), -1), "__")
    x = f.select("path", F.get(p, F.lit(0)).alias("class"), F.get(p, F.lit(1)).alias("org"))
    return x.groupBy("class", "org").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("first_path"))
