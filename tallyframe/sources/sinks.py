"""Sinks: fixed columns, error splits, append, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, columns: list[str], append: bool = False) -> None:
    """The given columns in their order, blanks for nulls; arrays are joined by ;."""
    kinds = dict(df.dtypes)
    flat = [F.coalesce(F.concat_ws(";", c) if kinds[c].startswith("array") else F.col(c).cast("string"), F.lit("")).alias(c) if c in kinds else F.lit("").alias(c) for c in columns]
    df.select(*flat).write.mode("append" if append else "overwrite").csv(path, header=True)


# The columns of the table of addresses.
URL_COLUMNS = [
    "url", "local_path", "id_transmission_code", "transmission_status", "corporation_code", "department_code", "department_name", "municipality_code",
    "municipality_name", "zone_code", "zone_name", "stand_code", "stand_name", "number_table", "expected_name",
]


def url_table(records: DataFrame, tree: DataFrame, url: Column, local: Column) -> DataFrame:
    """One row a record with its address, its local path and the names of its place; blank where a name is missing."""
    from tallyframe.sources.manifest import enrich

    sources = [url, local, *map(F.col, ["id", "status", "corporacion", "dep", "departamento", "muni", "municipio", "zona", "nombre_zona", "puesto", "nombre_puesto", "mesa", "expected_name"])]
    return enrich(records, tree).select(*[F.coalesce(c.cast("string"), F.lit("")).alias(n) for c, n in zip(sources, URL_COLUMNS, strict=True)])


def write_diff(found: DataFrame, path: str) -> None:
    """Differences of two snapshots, removals first, then changed hashes, changed states and additions, each by key."""
    blocks = F.array(*map(F.lit, ("eliminada", "hash_cambiado", "estado_cambiado", "anadida")))
    rows = found.select("tipo", F.col("key").alias("clave"), "antes", "ahora").orderBy(F.array_position(blocks, F.col("tipo")), "clave")
    write_csv(rows, path, ["tipo", "clave", "antes", "ahora"])


def write_results(df: DataFrame, path: str, errors: str, status: str = "status") -> None:
    """All results as JSON lines, and those in error once more."""
    df.write.mode("overwrite").json(path)
    df.where(F.col(status) == "error").write.mode("overwrite").json(errors)


def write_summary(row: DataFrame, path: str) -> None:
    """A one-row aggregate as one JSON file."""
    row.coalesce(1).write.mode("overwrite").json(path)


def markdown(row: DataFrame, title: str) -> str:
    """A one-row summary as a Markdown table; it says flags for review, never verdicts."""
    values = row.first().asDict()
    lines = [f"# {title}", "", "Flags for human review; none is a verdict.", "", "| measure | value |", "| --- | --- |"]
    return "\n".join(lines + [f"| {k} | {v} |" for k, v in values.items()]) + "\n"
