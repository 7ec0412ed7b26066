"""Sheets from page images: every page's boxes where it lies, then one flat row a sheet, or one crop a box.

``pages`` has ``pdf, pagina`` (from 1)``, alto`` and ``pixeles`` (grey bytes in row
order). A page is measured on its own, so nothing is shuffled before its boxes,
some dozen short rows, meet those of the sheet's other pages. So a task measures
the pages of its partition: hand them in over as many as keep all cores busy (of a
small file of keys that images are made from, deal out the keys). A page that can't
be measured gives one row with ``error``, which fails its sheet and no other.
Pages beyond the third have no boxes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallyframe.functions import checks, keys
from tallyframe.kernels import ink, shapes
from tallyframe.schema import AGGREGATES, CANDIDATES, FIRST_ROUND_AGGREGATES, FIRST_ROUND_CANDIDATES, FIRST_ROUND_LEVELLING, FIRST_ROUND_MARGIN, FIRST_ROUND_X, LABELS, LEVELLING, NOTES

#: Bytes of pages that a worker is handed at once; rows, or bytes of crops, from which on it hands over what it has found.
BATCH_BYTES = 64 << 20
FOUND_ROWS, FOUND_BYTES = 2048, 8 << 20
BOXES = "pdf string, pagina int, etiqueta string, x int, y int, w int, h int, tinta double, respaldo boolean, error string"
CROPS = "pdf string, pagina int, etiqueta string, tinta double, n_posiciones int, tipos_posicion string, n_digitos int, banderas string, alto int, pixeles binary, error string"
#: The labels of a page's rows, with its candidates' numbers and its table.
PAGES = {1: (CANDIDATES[:7], FIRST_ROUND_LEVELLING, ink.levelling_cells), 2: (CANDIDATES[7:], FIRST_ROUND_AGGREGATES, ink.aggregate_cells)}
# The notices of a sheet.
NOTICES = {"levelling": "nivelacion por respaldo (plantilla)", "aggregates": "agregados por respaldo (plantilla)", "none": "No se detectaron casillas; el formato puede diferir.", "error": "EXCEPCIÓN: "}


def _table(page: np.ndarray, template: list, cells) -> tuple[list, bool]:
    """The value cells of a table's rows, between its own lines if they are found, and whether they come from the template."""
    height, width = page.shape
    left, right = int(width * FIRST_ROUND_X[0]), int(width * FIRST_ROUND_X[1])
    rows = cells(page)
    if rows is None:
        x = left + int(width * 0.015)
        out = []
        for name, top, low in template:
            full = int((low - top) * height)
            inset = int(full * 0.08)
            out.append((name, (x, int(top * height) + inset, right - int(width * FIRST_ROUND_MARGIN) - x, full - 2 * inset)))
        return out, True
    top, low = rows[0][0], rows[-1][1]
    found = ink.vertical_separator(page[top:low])
    separator = left if found is None else found
    x, after = separator + int(width * 0.006), separator + int(width * 0.02)
    border = ink.right_border(page[top:low, after:])
    border = None if border is None or border + after <= x + int(width * 0.10) else border + after
    out = []
    for (name, _, _), (y0, y1) in zip(template, rows):
        end = right if border is None else ink.right_border(page[y0:y1], at=border) - int(width * 0.004)
        inset = int((y1 - y0) * 0.06)
        out.append((name, (x, y0 + inset, end - x, y1 - y0 - 2 * inset)))
    return out, False


def page_boxes(page: np.ndarray, number: int, dpi: int = 200) -> list[tuple[str, tuple[int, int, int, int], bool]]:
    """(label, (x, y, w, h), from the template) of a level page's boxes; none beyond the third page."""
    height, width = page.shape
    if number == 3:
        found = shapes.notes_box(page)
        return [(NOTES, found or (0, int(height * 0.24), width, int(height * 0.50)), found is None)]
    if number not in PAGES:
        return []
    names, template, cells = PAGES[number]
    found = [b for b in shapes.candidate_boxes(page, dpi) if number > 1 or b[1] > 0.30 * height]
    rows = [(0, int(a * height), width, int((b - a) * height)) for a, b in FIRST_ROUND_CANDIDATES[number]]
    boxes, own = shapes.nearest_boxes(found, rows, 0.04 * height)
    x0, x1 = int(width * FIRST_ROUND_X[0]), int(width * FIRST_ROUND_X[1]) - int(width * FIRST_ROUND_MARGIN)
    out = [(n, (x0, y + int(h * 0.10), x1 - x0, h - 2 * int(h * 0.10)), o) for n, (_, y, _, h), o in zip(names, boxes, own)]
    values, fell_back = _table(page, template, cells)
    out += [(n, b, fell_back) for n, b in values]
    inner = []
    for name, (x, y, w, h), o in out:
        a, b, c, d = ink.inner_box(page[y : y + h, x : x + w])
        inner.append((name, (x + c, y + a, d - c, b - a), o))
    return inner


def _measured(pixels, height, number, dpi):
    """(label, box, from the template, share of ink, crop) of a page's boxes."""
    page = shapes.levelled(np.frombuffer(bytes(pixels), np.uint8).reshape(int(height), -1))
    for name, (x, y, w, h), own in page_boxes(page, number, dpi):
        crop = page[y : y + h, x : x + w]
        yield name, (x, y, w, h), own, round((shapes.text_percent if name == NOTES else ink.ink_percent)(crop), 2), crop


def _by_page(pages: DataFrame, rows, schema: str) -> DataFrame:
    import pyarrow as pa

    kind = to_arrow_schema(StructType.fromDDL(schema))
    # read when the plan is made, so it stays set; a lower limit of the session's own is kept
    conf, limit = pages.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(limit).rstrip("b")) > BATCH_BYTES:
        conf.set(limit, str(BATCH_BYTES))

    def measured(batches):
        for batch in batches:
            found, size = [], 0
            for pdf, number, height, pixels in zip(*(c.to_pylist() for c in batch.columns)):
                try:
                    if pixels is None or height is None:
                        raise ValueError("page without pixels")
                    out = [{"pdf": pdf, "pagina": number, **r} for r in rows(pixels, height, number)]
                except Exception as e:  # a page that can't be measured is a row of its own
                    out = [{"pdf": pdf, "pagina": number, "etiqueta": "ERROR", "error": str(e)[:100]}]
                found += out
                size += sum(len(r.get("pixeles") or b"") for r in out)
                if len(found) >= FOUND_ROWS or size >= FOUND_BYTES:
                    yield pa.RecordBatch.from_pylist(found, kind)
                    found, size = [], 0
            yield pa.RecordBatch.from_pylist(found, kind)

    return pages.select(F.col("pdf").cast("string"), F.col("pagina").cast("int"), F.col("alto").cast("int"), F.col("pixeles").cast("binary")).mapInArrow(measured, schema)


def extract_boxes(pages: DataFrame, dpi: int = 200) -> DataFrame:
    """One row a box: its label, place and share of ink, and whether its place is the template's."""

    def rows(pixels, height, number):
        for name, (x, y, w, h), own, share, _ in _measured(pixels, height, number, dpi):
            yield {"etiqueta": name, "x": x, "y": y, "w": w, "h": h, "tinta": share, "respaldo": bool(own)}

    return _by_page(pages, rows, BOXES)


def export_crops(pages: DataFrame, dpi: int = 200) -> DataFrame:
    """One row a number's box: its clean crop and what its positions are; an empty box has a row but no pixels."""

    def rows(pixels, height, number):
        for name, _, _, share, crop in _measured(pixels, height, number, dpi):
            if name == NOTES:
                continue
            row = {"etiqueta": name, "tinta": share, "n_posiciones": 0, "tipos_posicion": "", "n_digitos": 0, "banderas": ";".join(["casilla_vacia", "espacio_sin_anular"])}
            if ink.has_content(crop):
                clean = shapes.without_frame_bars(crop)
                kinds = [shapes.kind_of(b) for b in ink.blocks(clean)]
                row |= {"n_posiciones": len(kinds), "tipos_posicion": "|".join(kinds), "n_digitos": kinds.count("digito"), "alto": clean.shape[0], "pixeles": clean.tobytes(), "banderas": None}
            yield row

    found = _by_page(pages, rows, CROPS)
    kinds = F.filter(F.split("tipos_posicion", "\\|"), lambda k: k != "")
    return found.withColumn("banderas", F.coalesce("banderas", F.when(F.col("error").isNull(), F.concat_ws(";", checks.box_flags(kinds)))))


def flat_rows(boxes: DataFrame) -> DataFrame:
    """One row a sheet: its place from its path, ``ok, n_casillas, uso_plantilla, aviso``, and for each label ``tinta_`` and ``tiene_``, with the flags of ink.

    One aggregation by sheet. A sheet with an error keeps its row, with nothing
    read and the error of its first such page as the notice.
    """
    wrong = F.min(F.when(F.col("error").isNotNull(), F.struct("pagina", "error")))["error"]
    fell = lambda names: F.coalesce(F.bool_or(F.col("respaldo") & F.col("etiqueta").isin(names)), F.lit(False))
    share = [F.max(F.when(F.col("etiqueta") == n, F.col("tinta"))).alias(f"tinta_{n}") for n in [*LABELS, NOTES]]
    votes = F.count_if(F.col("error").isNull() & (F.col("etiqueta") != NOTES))
    rows = boxes.groupBy("pdf").agg(wrong.alias("_wrong"), fell(LEVELLING).alias("_lev"), fell(AGGREGATES).alias("_agg"), votes.alias("_votes"), F.count_if(F.col("error").isNull()).cast("int").alias("_n"), *share)
    right = F.col("_wrong").isNull()
    notice = F.concat_ws(" | ", F.when(F.col("_lev"), NOTICES["levelling"]), F.when(F.col("_agg"), NOTICES["aggregates"]))
    notice = F.when(~right, F.concat(F.lit(NOTICES["error"]), "_wrong")).when(F.col("_votes") == 0, NOTICES["none"]).otherwise(notice)
    kept = lambda c: F.when(right, c)
    tinta: dict[str, Column] = {n: kept(F.col(f"tinta_{n}")) for n in [*LABELS, NOTES]}
    has = [(v > (0.3 if n == NOTES else 1.0)).cast("int").alias(f"tiene_{n}") for n, v in tinta.items()]
    flags = checks.ink_flags({n: tinta[n] for n in LABELS})
    return rows.select(
        "pdf", keys.parse_path("pdf").alias("_place"), (right & (F.col("_votes") > 0)).cast("int").alias("ok"), F.when(right, F.col("_n")).otherwise(0).alias("n_casillas"),
        kept((F.col("_lev") | F.col("_agg")).cast("int")).alias("uso_plantilla"), notice.alias("aviso"),
        *[v.alias(f"tinta_{n}") for n, v in tinta.items()], *has, *[kept(v).alias(n) for n, v in flags.items()],
    ).select("pdf", "_place.*", "*").drop("_place")


def extract_sheets(pages: DataFrame, dpi: int = 200) -> DataFrame:
    """``flat_rows`` of all pages' boxes: batch extraction."""
    return flat_rows(extract_boxes(pages, dpi))
