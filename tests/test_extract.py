import numpy as np
import pytest

from tallyframe.functions import checks
from tallyframe.kernels import ink, shapes
from tallyframe.operators import extract
from tallyframe.plans import bindings
from pyspark.sql import functions as F


def flood(mask, corners):
    left, out = {tuple(p) for p in np.argwhere(mask)}, []
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (corners or not (a and b))]
    while left:
        todo, part = [left.pop()], []
        while todo:
            p = todo.pop()
            part.append(p)
            near = {(p[0] + a, p[1] + b) for a, b in steps} & left
            left -= near
            todo += near
        ys, xs = zip(*part)
        out.append((min(xs), min(ys), max(xs) - min(xs) + 1, max(ys) - min(ys) + 1, len(part)))
    return sorted(out)


@pytest.mark.parametrize("corners", [True, False])
@pytest.mark.parametrize("share", [0.0, 0.2, 0.45, 0.6, 1.0])
def test_components_against_flood_fill(corners, share):
    for seed, shape in enumerate([(1, 1), (1, 30), (30, 1), (25, 40), (40, 25)]):
        mask = np.random.default_rng(seed).random(shape) < share
        p = shapes.components(mask, corners)
        assert sorted(zip(p.x, p.y, p.w, p.h, p.area)) == flood(mask, corners)
        assert ((p.label >= 0) == mask).all() and all((p.label == k).sum() == n for k, n in enumerate(p.area))


def test_close_and_dilate_against_windows():
    mask = np.random.default_rng(1).random((20, 23)) < 0.1
    padded = np.pad(mask, ((2, 2), (1, 1)))
    want = np.array([[padded[y : y + 5, x : x + 3].any() for x in range(23)] for y in range(20)])
    assert (shapes.dilate(mask, 5, 3) == want).all()
    out = np.pad(want, ((2, 2), (1, 1)), constant_values=True)
    assert (shapes.close(mask, 5, 3) == np.array([[out[y : y + 5, x : x + 3].all() for x in range(23)] for y in range(20)])).all()


def crop(h=100, w=160):
    return np.full((h, w), 255, np.uint8)


def ring(g, y, x, h=50, w=24):
    g[y : y + h, x : x + w] = 0
    g[y + 6 : y + h - 6, x + 6 : x + w - 6] = 255


def test_only_the_number_stays():
    g = crop()
    ring(g, 25, 60)
    ring(g, 25, 100)
    g[2:98, 4:8] = 0  # a bar of the frame
    g[80:90, 140:150] = 0  # a printed dot
    clean = shapes.number_only(g)
    assert clean.shape == (70, 84) and (clean < 100).sum() == (g[15:85, 50:134] < 100).sum()
    assert shapes.number_only(crop()).shape == (100, 160) and shapes.number_only(crop(4, 4)).shape == (4, 4)
    assert [d.shape for d in shapes.split_digits(g)] == [(62, 36), (62, 36)] and shapes.split_digits(crop()) == []
    for x in (10, 130):
        ring(g, 25, x)
    assert len(shapes.split_digits(g)) == 3


def test_frame_bars_go_and_upright_digits_stay():
    g = crop()
    g[:, 3:6] = 0  # unbroken
    g[:40, 156:158] = g[50:, 156:158] = 0  # broken
    ring(g, 25, 60)
    g[10:80, 100:104] = 0  # a one
    clean = shapes.without_frame_bars(g)
    assert (clean[:, :10] == 255).all() and (clean[:, 150:] == 255).all() and (clean[:, 50:150] == g[:, 50:150]).all()
    assert shapes.without_frame_bars(crop(5, 5)).shape == (5, 5)


def test_reading_boxes_are_squares_of_28():
    g = crop()
    for x in (20, 70, 120):
        ring(g, 25, x)
    for kind in ("CAND", "AGREG"):
        boxes = shapes.reading_boxes(g, kind)
        assert [b.shape for b in boxes] == [(28, 28)] * 3 and all(b[4:24].max() == 255 and not b[:4].any() and not b[24:].any() for b in boxes)
        assert not any(b.any() for b in shapes.reading_boxes(crop(), kind))
    assert np.allclose(shapes._shares(7, 20).sum(1), 1) and np.allclose(shapes._shares(50, 20).sum(1), 1)
    g[:, :110] = 255
    assert [b.any() for b in shapes.reading_boxes(g, "CAND")] == [False, False, True]


def test_kinds_equal_the_columns(spark):
    rows = [(float(w), float(h), float(f)) for w in (0.05, 0.3, 1.0) for h in (0.1, 0.25, 0.35, 0.5) for f in (0.3, 0.48, 0.8)]
    df = spark.createDataFrame(rows, "w double, h double, f double").select("*", checks.block_type(F.col("w"), F.col("h"), F.col("f")).alias("t"))
    assert all(shapes.kind_of({"ancho": r.w, "alto": r.h, "relleno": r.f}) == r.t for r in df.collect())


@pytest.mark.parametrize("angle", [-2.0, 0.0, 1.5])
def test_pages_are_levelled(angle):
    g = np.full((600, 500), 255, np.uint8)
    for y0 in range(100, 500, 60):
        for x in range(50, 450):
            y = int(round(y0 + (x - 250) * np.tan(np.radians(angle))))
            g[y : y + 3, x] = 0
    assert abs(shapes.skew(g) - angle) <= 0.1 and abs(shapes.skew(shapes.levelled(g))) <= 0.1
    assert shapes.skew(np.full((50, 50), 255, np.uint8)) == 0.0


def page(h=2200, w=1700):
    return np.full((h, w), 255, np.uint8)


def frame(g, y, h, x=20, w=1660, t=5):
    g[y : y + h, x : x + w] = np.where(np.pad(np.zeros((h - 2 * t, w - 2 * t), bool), t, constant_values=True), 0, g[y : y + h, x : x + w])


def test_boxes_are_found_and_matched():
    g = page(6500, 1700)
    frame(g, 3000, 520)
    frame(g, 3600, 520)
    g[3000:4120, 20:25] = 0  # frames that hang together
    assert shapes.candidate_boxes(g) == [(24, 3004, 1652, 512), (24, 3604, 1652, 512)]  # so their insides are found
    g[3520:, 20:25] = 255
    frame(g, 3600, 520)
    assert shapes.candidate_boxes(g) == [(20, 3000, 1660, 520), (20, 3600, 1660, 520)]
    assert shapes.nearest_boxes([(0, 12, 9, 10)], [(0, 10, 9, 10), (0, 14, 9, 10)], 5) == ([(0, 12, 9, 10), (0, 14, 9, 10)], [False, True])


def test_notes_end_at_the_signatures():
    g = page(2000, 400)
    assert shapes.notes_box(g) is None and shapes.text_percent(g) == 0.0
    g[300:360] = 0
    assert shapes.notes_box(g) == (0, 364, 400, 1480 - 364)
    g[1400:1420] = 0
    assert shapes.notes_box(g) == (0, 364, 400, 1400 - 364)


def sheet():
    first, second, third = page(), page(), page()
    for p, names in ((first, 7), (second, 6)):
        boxes = extract.page_boxes(p, 1 if names == 7 else 2)
        for name, (x, y, w, h), _ in boxes:
            if name in ("cand_02", "cand_09", "SUMA_TOTAL", "TOTAL_E11"):
                p[y + h // 4 : y + 3 * h // 4, x + w // 3 : x + w // 2] = 0
    third[500:560] = 0
    third[700:900, 300:900] = 0
    return [first, second, third]


def test_sheets_from_pages(spark):
    rows = [("r/DELEGADOS/01/002/003/04/005/a.pdf", k + 1, 2200, bytearray(p.tobytes())) for k, p in enumerate(sheet())]
    rows += [("b.pdf", 1, 2200, bytearray(page().tobytes())), ("b.pdf", 2, 2201, bytearray(b"123")), ("c.pdf", 4, 2200, bytearray(page().tobytes())), ("d.pdf", 1, None, None), ("e.pdf", 3, 2200, bytearray(page().tobytes()))]
    pages = spark.createDataFrame(rows, "pdf string, pagina int, alto int, pixeles binary").repartition(3)
    boxes = extract.extract_boxes(pages)
    assert [r["count"] for r in boxes.where("pdf LIKE '%a.pdf'").groupBy("pagina").count().orderBy("pagina").collect()] == [10, 10, 1]
    got = {r.pdf: r for r in extract.flat_rows(boxes).collect()}
    a = got["r/DELEGADOS/01/002/003/04/005/a.pdf"]
    assert (a.ejemplar, a.mesa, a.ok, a.n_casillas, a.uso_plantilla) == ("DELEGADOS", "005", 1, 21, 1) and a.aviso == " | ".join([extract.NOTICES["levelling"], extract.NOTICES["aggregates"]])
    assert (a.tiene_cand_01, a.tiene_cand_02, a.tiene_cand_09, a.tiene_SUMA_TOTAL, a.tiene_TOTAL_E11, a.tiene_CONSTANCIAS) == (0, 1, 1, 1, 1, 1)
    assert (a.n_candidatos, a.n_banderas, a.prioridad) == (2, 0, "OK")
    assert (got["b.pdf"].ok, got["b.pdf"].n_casillas, got["b.pdf"].tinta_cand_01) == (0, 0, None) and got["b.pdf"].aviso.startswith(extract.NOTICES["error"])
    assert got["d.pdf"].aviso.endswith("page without pixels") and (got["e.pdf"].ok, got["e.pdf"].n_casillas, got["e.pdf"].aviso) == (0, 1, extract.NOTICES["none"])
    assert "c.pdf" not in got  # no page of the form

    crops = {(r.pdf, r.etiqueta): r for r in extract.export_crops(pages).collect()}
    full, empty = crops[(a.pdf, "cand_02")], crops[(a.pdf, "cand_01")]
    assert (full.n_posiciones, full.tipos_posicion, full.banderas) == (1, "digito", "") and len(full.pixeles) % full.alto == 0
    assert (empty.n_posiciones, empty.pixeles, empty.banderas) == (0, None, "casilla_vacia;espacio_sin_anular") and (a.pdf, "CONSTANCIAS") not in crops
    assert crops[("d.pdf", "ERROR")].error == "page without pixels"


def test_tables_are_read_between_their_lines():
    g = page()
    lines = [1600 + 70 * k for k in range(5)]
    for y in lines:
        g[y : y + 3, 100:1600] = 0
    for x in (1100, 1596):
        g[1600:1883, x : x + 4] = 0
    found, fell_back = extract._table(g, extract.FIRST_ROUND_AGGREGATES, ink.aggregate_cells)
    assert not fell_back and [n for n, _ in found] == ["BLANCO", "NULO", "NO_MARCADO", "SUMA_TOTAL"]
    assert all(1100 < x < 1115 and 1585 < x + w <= 1596 and abs(y - top - 5) <= 1 for (_, (x, y, w, _)), top in zip(found, lines))


def test_empty_pages(spark):
    pages = spark.createDataFrame([], "pdf string, pagina int, alto int, pixeles binary")
    assert extract.extract_sheets(pages).count() == 0 and extract.export_crops(pages).count() == 0


def sizes(rows):
    return [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]


def test_images_of_one_small_file_are_made_in_many_tasks(spark):
    pages, crops = bindings.pages(spark, "/root/testdata/sf0.1"), bindings.crops(spark, "/root/testdata/sf0.1")
    for rows, n, most in ((pages, 2000, 512), (crops, 20_000, 16_384)):
        dealt = sizes(rows)
        assert sum(dealt) == n and max(dealt) < most
    assert pages.select("pdf", "pagina").distinct().count() == 2000 and crops.select("p_partkey").distinct().count() == 20_000


def test_crops_are_cut_in_many_tasks(spark):
    crops = extract.export_crops(bindings.pages(spark, "/root/testdata/sf0.1")).persist()
    dealt = sizes(crops)
    assert sum(dealt) == 14_200 and max(dealt) < 4000
    assert crops.where("n_posiciones > 0 AND length(pixeles) % alto = 0").count() == 600 and crops.where("pixeles IS NOT NULL").count() == 600
    assert crops.where("etiqueta = 'ERROR'").count() == 200
    crops.unpersist()


@pytest.mark.parametrize("size", [1, 2, 3, 8, 15, 40])
def test_spread_against_windows(size):
    mask = np.random.default_rng(size).random((9, 31)) < 0.1
    padded, back = np.pad(mask, ((0, 0), (size, size))), size // 2
    want = np.stack([padded[:, size + x - back : 2 * size + x - back].any(1) for x in range(31)], 1)
    assert (shapes.spread(mask, size, 1) == want).all() and (shapes.spread(mask.T, size, 0) == want.T).all() and shapes.spread(mask[:0], size, 0).shape == (0, 31)


def test_lines_are_long_unbroken_rows():
    g = np.full((40, 100), 255, np.uint8)
    g[5, 60:] = g[20, :29] = g[20, 31:60] = g[30:32, 10:45] = 0
    assert ink.horizontal_lines(g, 0.3, 1) == [5, 30] and ink.horizontal_lines(g, 0.29, 1) == [5, 20, 30] and ink.horizontal_lines(g, 0.5, 1) == []
    row, first, last = ink.row_runs(g < 128)
    assert list(zip(row, first, last)) == [(5, 60, 99), (20, 0, 28), (20, 31, 59), (30, 10, 44), (31, 10, 44)]
