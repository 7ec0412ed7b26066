"""Boxes of a sheet: matching detections to a template, completeness, template fall-backs, relative geometry."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.schema import FIRST_ROUND_AGGREGATES, FIRST_ROUND_MARGIN, FIRST_ROUND_X, SECOND_ROUND, SECOND_ROUND_X


def match_template(detected: DataFrame, template: DataFrame, sheet: str = "pdf", tolerance: float = 0.04) -> DataFrame:
    """Each template box takes the nearest free detection whose centre is within ``tolerance`` of the page height, else itself.

    ``detected(sheet, x, y, w, h, alto)`` and ``template(ord, etiqueta, x, y, w, h)`` in
    pixels of a page ``alto`` high. Boxes choose in the template's order and a
    detection is used once, so a sheet is matched in one task; sheets go side by side.
    The template is the form's, a few dozen boxes.
    """
    boxes = template.orderBy("ord").toPandas()

    def matched(pdf: pd.DataFrame) -> pd.DataFrame:
        free = {k: (r.y + r.h / 2) for k, r in enumerate(pdf.itertuples()) if pd.notna(r.y)}
        out = []
        for t in boxes.itertuples():
            centre = t.y + t.h / 2
            near = min(free, key=lambda k: (abs(free[k] - centre), k), default=None)
            if near is not None and abs(free[near] - centre) <= tolerance * pdf["alto"].iloc[0]:
                del free[near]
                r = pdf.iloc[near]
                out.append((pdf[sheet].iloc[0], t.etiqueta, int(r.x), int(r.y), int(r.w), int(r.h), False))
            else:
                out.append((pdf[sheet].iloc[0], t.etiqueta, int(t.x), int(t.y), int(t.w), int(t.h), True))
        return pd.DataFrame(out, columns=[sheet, "etiqueta", "x", "y", "w", "h", "plantilla"])

    kind = dict(detected.dtypes)[sheet]
    return detected.groupBy(sheet).applyInPandas(matched, f"{sheet} {kind}, etiqueta string, x int, y int, w int, h int, plantilla boolean")


def complete(boxes: DataFrame, sheet: str = "pdf", candidates: int = 13) -> DataFrame:
    """Sheets with their boxes counted: ``ok`` with all candidate boxes and one box of notes."""
    n = boxes.groupBy(sheet).agg(F.count_if(F.lower("etiqueta").startswith("cand")).alias("candidatos"), F.count_if(F.col("etiqueta") == "CONSTANCIAS").alias("constancias"))
    return n.withColumn("ok", (F.col("candidatos") == candidates) & (F.col("constancias") == 1))


def fell_back(sheets: DataFrame, least: float = 1.0) -> DataFrame:
    """Sheets whose boxes came from the template, by flag or notice, and whether their total is blank."""
    notice = F.lower(F.coalesce("aviso", F.lit("")))
    found = sheets.where((F.coalesce("uso_plantilla", F.lit(0)) == 1) | notice.contains("anclaje") | notice.contains("plantilla"))
    return found.withColumn("total_vacio", F.coalesce(F.col("tinta_SUMA_TOTAL") < least, F.lit(True)))


def fallback_aggregates(pages: DataFrame) -> DataFrame:
    """The first form's four aggregate boxes ``x, y, w, h`` from the template alone, for ``pages(pdf, ancho, alto)`` whose lines weren't found."""
    cut = lambda e: F.floor(e).cast("int")
    left, right = FIRST_ROUND_X
    rel = F.array(*[F.struct(F.lit(n).alias("etiqueta"), F.lit(a).alias("y0"), F.lit(b - a).alias("dy")) for n, a, b in FIRST_ROUND_AGGREGATES])
    rows = pages.select("pdf", "ancho", "alto", F.explode(rel).alias("r")).select("pdf", "ancho", "r.etiqueta", cut(F.col("alto") * F.col("r.y0")).alias("top"), cut(F.col("alto") * F.col("r.dy")).alias("full"))
    x = cut(F.col("ancho") * left) + cut(F.col("ancho") * 0.015)
    inset = cut(F.col("full") * 0.08)
    return rows.select("pdf", "etiqueta", x.alias("x"), (F.col("top") + inset).alias("y"), (cut(F.col("ancho") * right) - cut(F.col("ancho") * FIRST_ROUND_MARGIN) - x).alias("w"), (F.col("full") - 2 * inset).alias("h"))


def second_round_boxes(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The second round's nine boxes, in pixels, of ``pages(pdf, ancho, alto)``: geometry only, in generated code."""
    left, right = SECOND_ROUND_X
    rel = F.array(*[F.struct(F.lit(n).alias("etiqueta"), F.lit(c - h / 2).alias("y0"), F.lit(c + h / 2).alias("y1")) for n, c, h in SECOND_ROUND])
    rows = pages.select("pdf", "ancho", "alto", F.explode(rel).alias("r"))
    px = lambda e: F.floor(e + 1e-9).cast("int")
    return rows.select("pdf", "r.etiqueta", px(F.col("ancho") * left).alias("x0"), px(F.col("ancho") * right).alias("x1"), px(F.col("alto") * F.col("r.y0")).alias("y0"), px(F.col("alto") * F.col("r.y1")).alias("y1"))
