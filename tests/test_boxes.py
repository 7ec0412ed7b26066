import numpy as np

from tallyframe.kernels import ink
from tallyframe.operators import boxes


def test_match_template_uses_each_detection_once(spark):
    template = spark.createDataFrame([(1, "cand_01", 10, 100, 50, 20), (2, "cand_02", 10, 130, 50, 20), (3, "cand_03", 10, 700, 50, 20)], "ord int, etiqueta string, x int, y int, w int, h int")
    found = spark.createDataFrame([("p", 12, 110, 50, 20, 1000), ("p", 13, 118, 50, 20, 1000), ("q", 9, 705, 50, 20, 1000)], "pdf string, x int, y int, w int, h int, alto int")
    got = {(r.pdf, r.etiqueta): (r.y, r.plantilla) for r in boxes.match_template(found, template).collect()}
    assert got[("p", "cand_01")] == (110, False) and got[("p", "cand_02")] == (118, False) and got[("p", "cand_03")] == (700, True)
    assert got[("q", "cand_03")] == (705, False) and got[("q", "cand_01")] == (100, True)


def test_complete_and_fallback(spark):
    rows = [("a", f"cand_{k:02d}") for k in range(1, 14)] + [("a", "CONSTANCIAS"), ("b", "cand_01")]
    assert {r.pdf: r.ok for r in boxes.complete(spark.createDataFrame(rows, "pdf string, etiqueta string")).collect()} == {"a": True, "b": False}
    sheets = spark.createDataFrame([("a", 1, None, 0.2), ("b", 0, "uso de Plantilla", 3.0), ("c", 0, None, 0.0)], "pdf string, uso_plantilla int, aviso string, tinta_SUMA_TOTAL double")
    assert {r.pdf: r.total_vacio for r in boxes.fell_back(sheets).collect()} == {"a": True, "b": False}


def test_second_round_geometry(spark):
    rows = {r.etiqueta: (r.x0, r.x1, r.y0, r.y1) for r in boxes.second_round_boxes(spark, spark.createDataFrame([("p", 1000, 2000)], "pdf string, ancho int, alto int")).collect()}
    assert len(rows) == 9 and rows["CANDIDATO_01"] == (720, 975, 870, 970)


def test_page_blocks_and_borders():
    page = np.full((1000, 400), 255, np.uint8)
    for y in (220, 250, 280, 310):
        page[y, 20:380] = 0
    for y in (700, 740, 780, 820, 860):
        page[y, 20:380] = 0
    page[:, 260] = 0
    assert ink.levelling_cells(page) == [(220, 250), (250, 280), (280, 310)]
    assert [a for a, _ in ink.aggregate_cells(page)] == [700, 740, 780, 820]
    assert ink.vertical_separator(page) == 260 and ink.right_border(page) == 260 and ink.right_border(page, at=270) == 260
    assert ink.regular_block([0, 10, 50], 2, 5, 15) is None and ink.levelling_cells(np.full((1000, 400), 255, np.uint8)) is None
    crop = np.full((60, 90), 255, np.uint8)
    crop[0, :] = crop[:, 0] = crop[:, 1] = 0
    crop[20:40, 40:50] = 0
    assert ink.inner_crop(crop).shape == (55, 84) and ink.border_residue(ink.inner_crop(crop)) == 0
    clean = ink.without_bars(crop)
    assert (clean[5:, 0] == 255).all() and (clean[20:40, 40:50] == 0).all()
    digits = ink.right_digits(np.hstack([clean, clean[:, 30:60], clean[:, 30:60], clean[:, 30:60]])[2:])
    assert len(digits) == 3 and digits[0].shape == (28, 28) and digits[0].max() == 255
    notes = np.full((1000, 300), 255, np.uint8)
    notes[100:160] = 0
    assert ink.notes_percent(notes) == 0.0 and ink.notes_percent(page) is None
    notes[200:230, 100:200] = 0
    assert ink.notes_percent(notes) > 1
