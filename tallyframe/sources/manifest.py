"""Manifests, geography trees and snapshots from JSON of any nesting."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.keys import pad_code, pdf_name, snapshot_time
from tallyframe.operators.sheets import keep_first, keep_last

# The manifest's field for each column of a record.
FIELDS = {
    "expected_name": "expectedName", "id": "idTransmissionCode", "status": "idTransmissionCodeStatus", "dep": "idDepartmentCode",
    "muni": "municipalityCode", "zona": "idZoneCode", "puesto": "standCode", "mesa": "numberStand", "corporacion": "idCorporationCode", "stand": "idStand",
}
NODE = T.ArrayType(T.StructType([T.StructField("ord", T.LongType()), T.StructField("node", T.MapType(T.StringType(), T.StringType()))]))


def _walk(text: str | None) -> list[dict]:
    """Every object with an expectedName that stands in a list called nodes, at any depth, in document order."""
    import json

    out: list[dict] = []
    try:
        todo = [(json.loads(text or "null"), False)]
    except ValueError:
        return out
    while todo:
        value, listed = todo.pop()
        if isinstance(value, dict):
            if listed and "expectedName" in value:
                out.append({"ord": len(out), "node": {k: str(v) for k, v in value.items() if isinstance(v, (str, int, float)) and not isinstance(v, bool)}})
            todo += [(x, False) if not (k == "nodes" and isinstance(x, list)) else (("nodes", x), True) for k, x in reversed(value.items())]
        elif isinstance(value, tuple):
            todo += [(x, True) for x in reversed(value[1])]
        elif isinstance(value, list):
            todo += [(x, False) for x in reversed(value)]
    return out


def texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as ``file, text``; .gz is read through."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))


def nodes(files: DataFrame) -> DataFrame:
    """``file, ord, node`` for every node of each document; files are parsed side by side, one document in one task."""
    @F.pandas_udf(NODE)
    def walk(column: pd.Series) -> pd.Series:
        return column.map(_walk)

    return files.select("file", F.explode(walk("text")).alias("n")).select("file", "n.ord", "n.node")


def records(found: DataFrame) -> DataFrame:
    """Nodes as records: trimmed, padded, .pdf added, nameless ones dropped, corporation 001 by default."""
    raw = {c: F.trim(F.coalesce(F.col("node")[f], F.lit(""))) for c, f in FIELDS.items()}
    widths = {"dep": 2, "muni": 3, "zona": 3, "puesto": 2, "mesa": 3}
    named = found.where(raw["expected_name"] != "")
    return named.select(
        "file", "ord", pdf_name(raw["expected_name"]).alias("expected_name"), raw["id"].alias("id"), raw["status"].alias("status"), *[pad_code(raw[c], n).alias(c) for c, n in widths.items()],
        pad_code(F.when(raw["corporacion"] == "", "001").otherwise(raw["corporacion"]), 3).alias("corporacion"), raw["stand"].alias("stand"),
    )


def load_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Records of a manifest, the first of each name and place."""
    found = records(nodes(texts(spark, path)))
    return keep_first(found, ["dep", "muni", "zona", "puesto", "mesa", "expected_name"], "ord")


def index(found: DataFrame, places: bool = False) -> DataFrame:
    """``file, key, name, status``, the last of each key: the transmission id, or else the raw place; with ``places`` its unpadded codes too."""
    raw = lambda c: F.coalesce(F.col("node")[FIELDS[c]], F.lit(""))
    key = F.when(raw("id") != "", raw("id")).otherwise(F.concat_ws("|", *[raw(c) for c in ("dep", "muni", "zona", "puesto", "mesa")]))
    codes = [raw(c).alias(c) for c in ("dep", "muni", "zona", "puesto", "mesa")] if places else []
    rows = found.select("file", "ord", key.alias("key"), raw("expected_name").alias("name"), raw("status").alias("status"), *codes)
    return keep_last(rows, ["file", "key"], "ord").drop("ord")


def load_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """All snapshots of a folder as ``key, snap_ts, snap_ord, name, status``; the time is in the file name."""
    from tallyframe.operators.snapshots import numbered

    rows = index(nodes(texts(spark, f"{folder.rstrip('/')}/*.json*"))).withColumn("snap_ts", snapshot_time("file")).where("snap_ts IS NOT NULL")
    return numbered(rows.drop("file"))


TREE = """data struct<departmentsTree: struct<edges: array<struct<node: struct<idDepartmentCode: string, departmentName: string, municipalities: array<struct<municipalityCode: string,
municipalityName: string, zones: array<struct<idZoneCode: string, zoneName: string, stands: array<struct<standCode: string, standName: string, countTable: string>>>>>>>>>>>"""


def geography(spark: SparkSession, path: str) -> DataFrame:
    """The tree of departments, municipalities, zones and stands, one row a stand; missing lists are skipped."""
    d = texts(spark, path).select(F.explode(F.from_json("text", TREE)["data"]["departmentsTree"]["edges"]["node"]).alias("d"))
    m = d.select("d.idDepartmentCode", "d.departmentName", F.explode("d.municipalities").alias("m"))
    z = m.select("idDepartmentCode", "departmentName", "m.municipalityCode", "m.municipalityName", F.explode("m.zones").alias("z"))
    s = z.select("idDepartmentCode", "departmentName", "municipalityCode", "municipalityName", "z.idZoneCode", "z.zoneName", F.posexplode("z.stands").alias("ord", "s"))
    rows = s.select(
        pad_code("idDepartmentCode", 2).alias("dep"), pad_code("municipalityCode", 3).alias("muni"), pad_code("idZoneCode", 3).alias("zona"), pad_code("s.standCode", 2).alias("puesto"), "ord",
        F.col("departmentName").alias("departamento"), F.col("municipalityName").alias("municipio"), F.col("zoneName").alias("nombre_zona"), F.col("s.standName").alias("nombre_puesto"), F.col("s.countTable").try_cast("int").alias("mesas"),
    )
    return keep_last(rows, ["dep", "muni", "zona", "puesto"], "ord").drop("ord")


#: Up to this many stands the tree is broadcast.
BROADCAST_STANDS = 500_000


def enrich(manifest: DataFrame, tree: DataFrame) -> DataFrame:
    """Records with the names of their place, empty where the tree has none."""
    names = ["departamento", "municipio", "nombre_zona", "nombre_puesto"]
    small = tree.select("dep", "muni", "zona", "puesto", *names)
    if small.count() <= BROADCAST_STANDS:
        small = F.broadcast(small)
    return manifest.join(small, ["dep", "muni", "zona", "puesto"], "left").na.fill("", names)


def third_copy_index(files: DataFrame, route_class: str = "documentos") -> DataFrame:
    """``clave, archivo`` of an index that maps routes to files, for one class of routes."""
    from tallyframe.functions.keys import route_class as classify

    rows = files.select(F.explode(F.from_json("text", "map<string,string>")).alias("clave", "archivo"))
    return rows.where(classify("clave") == route_class)


def third_copy_tasks(files: DataFrame, base: str, digitised_only: bool = True) -> DataFrame:
    """One task per table of each place's list; tables without a file name or, if asked, not digitised are dropped."""
    from tallyframe.functions.keys import third_copy_codes

    kind = "array<struct<nombre_archivo: string, numero: string, digitalizado: int, escrutado: string>>"
    rows = files.select(F.explode(F.from_json("text", kind)).alias("r")).select("r.*").withColumn("nombre_archivo", F.trim(F.coalesce("nombre_archivo", F.lit(""))))
    rows = rows.where("nombre_archivo <> ''")
    if digitised_only:
        rows = rows.where("digitalizado = 1")
    bare = F.regexp_replace("nombre_archivo", "^/+", "")
    return rows.select(F.concat(F.lit(base.rstrip("/") + "/"), bare).alias("url"), third_copy_codes("nombre_archivo").alias("k"), F.trim("numero").alias("mesa"), "nombre_archivo", "digitalizado", "escrutado").select("url", "k.*", "mesa", "nombre_archivo", "digitalizado", "escrutado")


#: A JSON string and, if it is a key, the colon behind it.
QUOTED = '"(?:[^"\\\\]|\\\\.)*"(?:\\s*:)?'


def inspect(files: DataFrame, most: int = 20) -> DataFrame:
    """A look at unknown JSON: ``file, raiz, claves, n, textos``.

    The root's kind, the first keys of an object or the length of an array, and up to
    ``most`` string values, at any depth and in document order, that name a PDF or a sheet.
    """
    first = F.substring(F.ltrim("text"), 1, 1)
    kind = F.when(first == "{", "object").when(first == "[", "array").otherwise("value")
    found = F.filter(F.regexp_extract_all("text", F.lit(QUOTED), F.lit(0)), lambda x: ~x.endswith(":") & (F.lower(x).contains(".pdf") | x.contains("E14")))
    texts = F.from_json(F.concat(F.lit("["), F.array_join(F.slice(found, 1, most), ","), F.lit("]")), "array<string>")
    return files.select("file", kind.alias("raiz"), F.slice(F.json_object_keys("text"), 1, 30).alias("claves"), F.json_array_length("text").alias("n"), texts.alias("textos"))
