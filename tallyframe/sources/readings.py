"""Readings, votes, census, chains and file trees from CSV, JSON lines and folders.

Rows get an ``ord`` that grows along each file, as "the last one wins" needs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.keys import normalize_key, parse_digits, parse_int, snapshot_time
from tallyframe.operators.sheets import keep_last
from tallyframe.schema import PLACE, TABLE

# The names under which a value may stand, by reader, the first one that is there counts.
COMPARE_VALUES = ("valor", "numero", "lectura", "valor_final")
CENSUS_VALUES = ("numero", "valor", "lectura", "texto", "valor_final")
CONFIDENCES = ("conf", "confianza")


def csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with lower-case headers; the delimiter is ; if the header has more of them than commas; a BOM is dropped."""
    head = spark.read.text(path).first()
    header = head[0] if head else ""
    rows = spark.read.csv(path, header=True, sep=";" if header.count(";") > header.count(",") else ",", multiLine=False)
    rows = rows.toDF(*[c.lstrip("﻿").strip().lower() for c in rows.columns])
    return rows.withColumn("ord", F.monotonically_increasing_id())


def first_of(df: DataFrame, names: tuple[str, ...]) -> str | None:
    return next((n for n in names if n in df.columns), None)


def readings(df: DataFrame, copy: str | None = None, names: tuple[str, ...] = COMPARE_VALUES, strict_digits: bool = False) -> DataFrame:
    """Long readings: normalised keys, upper-case labels, integer values; rows without one are skipped, the last of a box counts."""
    value, conf = first_of(df, names), first_of(df, CONFIDENCES)
    if value is None:
        raise ValueError(f"none of {names} is a column")
    parsed = parse_digits(value) if strict_digits else parse_int(value)
    rows = df.select(
        F.lit(copy).alias("ejemplar") if copy is not None else (F.col("ejemplar") if "ejemplar" in df.columns else F.lit("").alias("ejemplar")), *[normalize_key(c).alias(c) for c in TABLE],
        F.upper(F.trim("etiqueta")).alias("etiqueta"), parsed.alias("valor"), (F.col(conf).try_cast("double") if conf else F.lit(None).cast("double")).alias("conf"), "ord",
    ).where("valor IS NOT NULL")
    return keep_last(rows, ["ejemplar", *TABLE, "etiqueta"], "ord")


def votes(df: DataFrame, label: str = "TOTAL_E11", copy: str | None = None) -> DataFrame:
    """Votes of each table from one label, and one copy if asked; without a copy the last row counts."""
    value = first_of(df, CENSUS_VALUES)
    rows = df.where(F.upper(F.trim("etiqueta")) == label.upper()) if "etiqueta" in df.columns else df
    if copy is not None and "ejemplar" in df.columns:
        rows = rows.where(F.upper(F.trim("ejemplar")) == copy.upper())
    rows = rows.select(*[normalize_key(c).alias(c) for c in TABLE], parse_int(value).alias("votos"), "ord").where("votos IS NOT NULL")
    return keep_last(rows, TABLE, "ord").drop("ord")


def census(df: DataFrame, *kept: str) -> DataFrame:
    """Census rows with normalised place keys and an integer total."""
    rest = [c for c in ("departamento", "municipio", "nombre_puesto", "direccion") if c in df.columns]
    counts = [parse_int(c).alias(c) for c in ("mujeres", "hombres", "total", "mesas") if c in df.columns]
    return df.select(*[normalize_key(c).alias(c) for c in PLACE], *counts, *rest, *kept).where("total IS NOT NULL")


def _xlsx_rows(content: bytes) -> list[list[str | None]]:
    """Cells of a workbook's active sheet, as text, by row and column."""
    import io
    import re
    import zipfile
    from xml.etree import ElementTree

    book = zipfile.ZipFile(io.BytesIO(content))
    read = lambda name: ElementTree.fromstring(book.read(name))
    words = lambda e: "".join(t.text or "" for t in e.iterfind(".//{*}t"))
    shared = [words(e) for e in read("xl/sharedStrings.xml").iterfind("{*}si")] if "xl/sharedStrings.xml" in book.namelist() else []
    top = read("xl/workbook.xml")
    view, sheets = top.find(".//{*}workbookView"), top.findall(".//{*}sheet")
    sheet = sheets[int(view.get("activeTab", 0)) if view is not None else 0]
    part = next(v for k, v in sheet.attrib.items() if k.endswith("}id"))
    target = next(r.get("Target") for r in read("xl/_rels/workbook.xml.rels") if r.get("Id") == part)
    out = []
    for row in read(target.lstrip("/") if target.startswith("/") else f"xl/{target}").iterfind(".//{*}row"):
        cells: list[str | None] = []
        for c in row.iterfind("{*}c"):
            place = 0
            for letter in re.match("[A-Z]*", c.get("r", ""))[0]:
                place = place * 26 + ord(letter) - 64
            cells += [None] * ((place or len(cells) + 1) - len(cells))
            value = c.findtext("{*}v")
            cells[(place or len(cells)) - 1] = words(c) if c.get("t") == "inlineStr" else shared[int(value)] if c.get("t") == "s" and value is not None else value
        out.append(cells)
    return out


# The columns of the census sheet, by position.
CENSUS_SHEET = ("dep", "muni", "zona", "puesto", "departamento", "municipio", "nombre_puesto", "mujeres", "hombres", "total", "mesas", "", "direccion")


def census_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The census as published, XLSX or CSV: below the row that starts with ``dd`` and has a ``pp``; without place rows that aren't numbers.

    A workbook is one file of a country's places and is read in one task. Without a header there are no rows.
    """
    if path.lower().endswith(".xlsx"):

        def cells(batches):
            import pandas as pd

            for pdf in batches:
                for content in pdf["content"]:
                    rows = _xlsx_rows(bytes(content))
                    yield pd.DataFrame({"ord": range(len(rows)), "c": rows})

        found = spark.read.format("binaryFile").load(path).select("content").mapInPandas(cells, "ord long, c array<string>")
    else:
        kind = ", ".join(f"c{k} string" for k in range(len(CENSUS_SHEET)))
        found = spark.read.schema(kind).csv(path).select(F.monotonically_increasing_id().alias("ord"), F.array(*[f"c{k}" for k in range(len(CENSUS_SHEET))]).alias("c"))
    found = found.withColumn("c", F.transform("c", F.trim))
    header = found.where((F.get("c", F.lit(0)) == "dd") & F.array_contains("c", "pp")).agg(F.min("ord").alias("_header"))
    rows = found.join(F.broadcast(header)).where((F.col("ord") > F.col("_header")) & F.get("c", F.lit(0)).rlike("^[0-9]+$") & F.get("c", F.lit(3)).isNotNull())
    named = rows.select("ord", *[F.get("c", F.lit(k)).alias(n) for k, n in enumerate(CENSUS_SHEET) if n])
    return keep_last(census(named, "ord"), PLACE, "ord").drop("ord")


def reconciliation(spark: SparkSession, path: str) -> DataFrame:
    """The state of each table by its codes as they are written; the last row of a table counts."""
    rows = csv(spark, path)
    raw = [(F.coalesce(F.col(c), F.lit("")) if c in rows.columns else F.lit("")).alias(c) for c in (*TABLE, "estado")]
    return keep_last(rows.select("ord", *raw), TABLE, "ord").drop("ord")


def union_copies(copies: dict[str, DataFrame]) -> DataFrame:
    """Readings of at least two copies as one long table, each under its name in upper case."""
    if len(copies) < 2:
        raise ValueError("comparing needs at least two copies")
    parts = [readings(df, name.strip().upper()) for name, df in copies.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def chain_log(spark: SparkSession, path: str) -> DataFrame:
    """A chain of JSON lines with its order."""
    rows = spark.read.text(path).where("trim(value) <> ''").withColumn("seq", F.monotonically_increasing_id())
    kind = "ts string, sha_contenido string, eslabon string, eslabon_anterior string, n_actas long, snapshot string"
    return rows.select("seq", F.from_json("value", kind).alias("e")).select("seq", "e.*")


def monitor_log(spark: SparkSession, path: str) -> DataFrame:
    """The monitor's log: parsed times and counts, fetches without sheets left out."""
    df = csv(spark, path)
    return df.withColumn("timestamp", F.try_to_timestamp("timestamp").cast("timestamp_ntz")).withColumn("n_actas", parse_int("n_actas")).where("n_actas > 0")


def pdf_tree(spark: SparkSession, folder: str, contents: bool = False) -> DataFrame:
    """All PDFs below a folder, sorted by path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[pP][dD][fF]").load(folder)
    return files.select("path", "length", *(["content"] if contents else [])).orderBy("path")


def pending(tasks: DataFrame, done: DataFrame, key: str = "pdf") -> DataFrame:
    """Tasks that aren't done."""
    return tasks.join(done.select(key).distinct(), key, "left_anti")


def resolve_snapshot(names: list[str], wanted: str) -> str | None:
    """A snapshot by name, ``latest`` or a part of its date: the first that fits, .gz before plain."""
    ordered = sorted(names, key=lambda n: (n.endswith(".gz") is False, n))
    if wanted == "latest":
        return max(names, default=None)
    return wanted if wanted in names else next((n for n in ordered if wanted in n), None)


def snapshot_files(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshots of a folder with their times, in order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json*").load(folder)
    return files.select(F.col("_metadata.file_name").alias("file"), "length").withColumn("snap_ts", snapshot_time("file")).where("snap_ts IS NOT NULL").orderBy("snap_ts")
