import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from tallyframe.operators import boxes, sheets, snapshots
from tallyframe.schema import FIRST_ROUND_AGGREGATES
from tallyframe.sources import manifest, readings, sinks
from tallyframe.streaming.monitor import Monitor, run_cycles
from test_sources import node, snapshot

HEADER = ["dd", "mm", "zz", "pp", "departamento", "municipio", "puesto", "mujeres", "hombres", "total", "mesas", "", "direccion"]
ROWS = [
    ["Censo"], HEADER, ["1", "2", "3", "4", "D", "M", "P", "5", "6", "11", "1", "", "calle"], ["Total", "", "", "", "", "", "", "5", "6", "11"],
    ["01", "002", "3", "4", "D", "M", "Q", "7", "8", "15", "2"], ["8", "2"],
]


def workbook(rows):
    shared = sorted({c for r in rows for c in r if c and not c.isdigit()})
    cell = lambda c, at: f'<c r="{at}" t="s"><v>{shared.index(c)}</v></c>' if not c.isdigit() else f'<c r="{at}"><v>{c}</v></c>'
    body = "".join(f'<row r="{k}">' + "".join(cell(c, f"{chr(65 + i)}{k}") for i, c in enumerate(r) if c) + "</row>" for k, r in enumerate(rows, 1))
    main, rel = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"', "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><bookViews><workbookView activeTab="1"/></bookViews><sheets><sheet name="a" r:id="r1"/><sheet name="b" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/no.xml"/><Relationship Id="r2" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>" + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/sheet2.xml", f"<worksheet {main}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


@pytest.mark.parametrize("kind", ["csv", "xlsx"])
def test_census_below_its_header(spark, tmp_path, kind):
    path = tmp_path / f"c.{kind}"
    path.write_bytes(workbook(ROWS) if kind == "xlsx" else "\n".join(",".join(r) for r in ROWS).encode())
    rows = readings.census_sheet(spark, str(path)).collect()
    assert [(r.dep, r.muni, r.zona, r.puesto, r.nombre_puesto, r.total, r.mesas, r.direccion) for r in rows] == [("1", "2", "3", "4", "Q", 15, 2, None)]


def test_census_without_a_header_is_empty(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a,b\n1,2\n")
    assert readings.census_sheet(spark, str(tmp_path / "c.csv")).count() == 0


def test_reconciliation_keeps_codes_as_written(spark, tmp_path):
    (tmp_path / "r.csv").write_text("dep,muni,zona,puesto,mesa,estado\n01,2,3,4,5,OK\n01,2,3,4,5,MAL\n1,2,3,4,5,\n")
    assert {(r.dep, r.estado) for r in readings.reconciliation(spark, str(tmp_path / "r.csv")).collect()} == {("01", "MAL"), ("1", "")}


def test_copies_are_united(spark):
    kind = "dep string, muni string, zona string, puesto string, mesa string, etiqueta string, valor string, ord long"
    one = spark.createDataFrame([("1", "2", "3", "4", "5", "blanco", "7", 0)], kind)
    assert {(r.ejemplar, r.valor) for r in readings.union_copies({" claveros": one, "delegados": one}).collect()} == {("CLAVEROS", 7), ("DELEGADOS", 7)}
    with pytest.raises(ValueError):
        readings.union_copies({"claveros": one})


def test_inspection(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"x.pdf": ["b.PDF", {"k": 'E14 "q"', "n": "no"}], "z": "a.pdf"}))
    (tmp_path / "l.json").write_text("[1, 2]")
    got = {r.file: (r.raiz, r.claves, r.n, r.textos) for r in manifest.inspect(manifest.texts(spark, str(tmp_path))).collect()}
    assert got == {"d.json": ("object", ["x.pdf", "z"], None, ["b.PDF", 'E14 "q"', "a.pdf"]), "l.json": ("array", None, 2, [])}


def test_index_with_places_and_urls(spark, tmp_path):
    (tmp_path / "m.json").write_text(json.dumps({"nodes": [node("a", "1")]}))
    found = manifest.nodes(manifest.texts(spark, str(tmp_path / "m.json")))
    row = manifest.index(found, places=True).first()
    assert (row.key, row.dep, row.muni, row.mesa) == ("1", "1", "2", "5")
    tree = spark.createDataFrame([("01", "002", "003", "04", "D", "M", "Z", None)], "dep string, muni string, zona string, puesto string, departamento string, municipio string, nombre_zona string, nombre_puesto string")
    table = sinks.url_table(manifest.records(found), tree, F.concat(F.lit("https://h/"), "expected_name"), F.lit(None))
    assert table.columns == sinks.URL_COLUMNS
    assert tuple(table.first()) == ("https://h/a.pdf", "", "1", "11", "001", "01", "D", "002", "M", "003", "Z", "04", "", "005", "a.pdf")


def test_differences_in_blocks(spark, tmp_path):
    kind = "key string, name string, status string"
    a = spark.createDataFrame([("1", "x", "s"), ("2", "x", "s"), ("3", "x", "s"), ("0", "x", "s")], kind)
    b = spark.createDataFrame([("2", "y", "s"), ("3", "x", "t"), ("4", "z", "s")], kind)
    sinks.write_diff(snapshots.diff(a, b), str(tmp_path / "d"))
    lines = [x for f in sorted((tmp_path / "d").glob("part-*")) for x in f.read_text().splitlines()[1:]]
    assert [x.replace('""', "") for x in lines] == ["eliminada,0,x,", "eliminada,1,x,", "hash_cambiado,2,x,y", "estado_cambiado,3,s,t", "anadida,4,,z"]


def test_split_takes_the_share_of_groups(spark):
    for groups in (0, 1, 4, 5, 99):
        rows = sheets.group_split(spark.range(groups * 3).select((F.col("id") % max(groups, 1)).alias("g")), "g").distinct().collect()
        assert len(rows) == groups and sum(r.validation for r in rows) == min(groups, max(1, groups // 5))


def test_template_aggregates(spark):
    for w, h in ((1000, 2000), (1654, 2339), (1, 1)):
        rows = boxes.fallback_aggregates(spark.createDataFrame([("p", w, h)], "pdf string, ancho int, alto int")).collect()
        expected = []
        for name, top, bottom in FIRST_ROUND_AGGREGATES:
            full, x = int((bottom - top) * h), int(w * 0.66) + int(w * 0.015)
            inset = int(full * 0.08)
            expected.append(("p", name, x, int(top * h) + inset, int(w * 0.985) - int(w * 0.04) - x, full - 2 * inset))
        assert [tuple(r) for r in rows] == expected


def test_cycles_are_bounded(spark, tmp_path):
    times = iter(["20260101_000000", None, "20260101_001000"])

    def fetch():
        stamp = next(times)
        if stamp is None:
            raise OSError("down")
        snapshot(tmp_path / "in", stamp, [node("a" + stamp, "1")])

    (tmp_path / "in").mkdir()
    monitor = Monitor(spark, str(tmp_path / "state"))
    assert run_cycles(monitor, str(tmp_path / "in"), 3, 0, fetch) == ["1: down"]
    assert [r.hash_cambiado for r in monitor.log().orderBy("batch").collect()] == [0, 1]
