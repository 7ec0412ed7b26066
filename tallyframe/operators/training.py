"""Labelled digit boxes from sheets that reconcile, their packing, and what a reader gains over another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cell_type(label: Column | str) -> Column:
    """CAND for a candidate's box, AGREG for any other; by case, as labels of the second form are not cut like candidates'."""
    c = F.col(label) if isinstance(label, str) else label
    return F.when(c.startswith("cand"), "CAND").otherwise("AGREG")


def three_digits(value: Column) -> Column:
    """Text of up to three digits, filled up with zeros; empty for anything else."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.when(text.rlike("^[0-9]{1,3}$"), F.lpad(text, 3, "0")).otherwise("")


def export_boxes(readings: DataFrame, trusted: DataFrame, keys: list[str], label: str = "etiqueta", value: str = "numero", boxes: str = "cajas") -> DataFrame:
    """One row a digit box: ``caja, etiqueta_celda, pos, etiqueta_digito, sugerencia, confianza``.

    ``readings`` has one row a cell, with the names of its boxes in an array;
    ``trusted`` has the keys of sheets that reconcile. Only there is a cell's value,
    if it has up to three digits, the label; everywhere it is the suggestion. Trust
    is a semi join that keeps the other rows: one shuffle by sheet.
    """
    marked = trusted.select(*keys).distinct().withColumn("_trusted", F.lit(1))
    rows = readings.join(marked, keys, "left").withColumn("_sure", F.coalesce("_trusted", F.lit(0)))
    each = rows.select(*keys, label, value, "_sure", F.posexplode(boxes).alias("pos", "caja"))
    digit = F.substring(three_digits(F.col(value)), F.col("pos") + 1, F.lit(1))
    return each.select("caja", *keys, F.col(label).alias("etiqueta_celda"), "pos", F.when(F.col("_sure") == 1, digit).otherwise("").alias("etiqueta_digito"), digit.alias("sugerencia"), F.col("_sure").alias("confianza"))


def pack_boxes(labels: DataFrame, pixels: DataFrame, label: str = "etiqueta_digito") -> DataFrame:
    """``caja, x, y`` of the boxes that are labelled with one digit and have pixels; ink is 255 in ``x``, as the reader sees it."""
    sure = labels.where(F.trim(label).rlike("^[0-9]$")).select("caja", F.trim(label).cast("int").alias("y"))
    return sure.join(pixels, "caja").select("caja", F.transform("pixeles", lambda p: F.lit(255) - p).alias("x"), "y")


def newly_reconciled(now: DataFrame, before: DataFrame, keys: list[str], level: str = "alerta") -> DataFrame:
    """Keys of sheets that reconcile now and didn't before."""
    ok = lambda df: df.where(F.col(level) == "NINGUNA").select(*keys)
    return ok(now).distinct().join(ok(before), keys, "left_anti")


def evaluate(now: DataFrame, before: DataFrame, keys: list[str], level: str = "alerta") -> DataFrame:
    """``medida, n, pct`` of a reader's sheets: one row a level, and ``BASE`` and ``NUEVAS``, the sheets that reconciled before and those that only do now."""
    levels = now.groupBy(F.col(level).alias("medida")).agg(F.count(F.lit(1)).alias("n"))
    base = before.where(F.col(level) == "NINGUNA").select(F.lit("BASE").alias("medida")).groupBy("medida").agg(F.count(F.lit(1)).alias("n"))
    gained = newly_reconciled(now, before, keys, level).select(F.lit("NUEVAS").alias("medida")).groupBy("medida").agg(F.count(F.lit(1)).alias("n"))
    total = now.agg(F.count(F.lit(1)).alias("_all"))
    rows = levels.unionByName(base).unionByName(gained).join(F.broadcast(total))  # one row
    return rows.select("medida", "n", F.round(F.try_divide(100.0 * F.col("n"), F.col("_all")), 1).alias("pct"))


def versioned(spark, path: str) -> int:
    """The last version of a label table below a folder; 0 if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []
    return max((int(n.removeprefix("v")) for n in names if n.removeprefix("v").isdigit()), default=0)


def rewrite_labels(labels: DataFrame, path: str, least: float = 0.995) -> tuple[int, DataFrame]:
    """Writes the next version of a label table and returns its number and the review list: blank boxes, least sure first. No version is ever changed."""
    from tallyframe.operators.decode import review_queue

    version = versioned(labels.sparkSession, path) + 1
    labels.write.mode("errorifexists").parquet(f"{path}/v{version:06d}")
    return version, review_queue(labels.sparkSession.read.parquet(f"{path}/v{version:06d}"))
