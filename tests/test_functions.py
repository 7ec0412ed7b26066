import pytest
from pyspark.sql import functions as F

from tallyframe.functions import checks, keys
from tallyframe.schema import CANDIDATES, LABELS


def one(spark, column, *values):
    return [r[0] for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v string").orderBy("k").select(column).collect()]


def test_vocabulary():
    assert len(CANDIDATES) == 13 and len(LABELS) == 20


def test_keys(spark):
    assert one(spark, keys.normalize_key("v"), "007", "7", " 012 ", "A07", "000", None) == ["7", "7", "12", "A07", "0", None]
    assert one(spark, keys.pad_code("v", 3), "7", "1234", None, " 12 ") == ["007", "1234", "000", "012"]
    assert one(spark, keys.digits_only("v"), "1o7", None) == ["17", ""]
    assert one(spark, keys.parse_int("v"), " 07 ", "+5", "3.0", "x") == [7, 5, None, None]
    assert one(spark, keys.parse_digits("v"), "07", "+5", " 7", "12") == [7, None, None, 12]
    assert one(spark, keys.pdf_name("v"), "a", "b.PDF", " c.pdf ") == ["a.pdf", "b.PDF", "c.pdf"]


def test_paths(spark):
    rows = [r.asDict() for r in one(spark, keys.parse_path("v"), "x/DELEGADOS/03/004/002/04/007/h.pdf", "ruta/rara/acta.pdf")]
    assert rows[0] == {"ejemplar": "DELEGADOS", "dep": "03", "muni": "004", "zona": "002", "puesto": "04", "mesa": "007"}
    assert set(rows[1].values()) == {""}
    named, folders, bad = one(spark, keys.second_round_key("v"), "a/e14_pre_01_002_003_04_05_006_99.pdf", "x/PRE/01/002/003/04/007/hash.pdf", "x/y.pdf")
    assert (named.dep, named.mesa) == ("01", "006") and (folders.puesto, folders.mesa, folders.reason) == ("04", "007", None)
    assert bad.mesa is None and bad.reason
    assert one(spark, keys.route_class("v"), "x/actas-documentos/9/mesas/", "actas-publicadas/consolidado", "avance-actas", "z") == ["documentos", "consolidado", "avance", "otro"]
    assert [tuple(r) for r in one(spark, keys.third_copy_codes("v"), "/docs/E14/01/02/03/04/f.pdf", "short/f.pdf")] == [("01", "02", "03", "04"), ("", "", "", "")]
    assert one(spark, keys.percent_encoded("v"), "a b~*é/") == ["a%20b~%2A%C3%A9%2F"]
    assert str(one(spark, keys.snapshot_time("v"), "allTransmissionCodes_20260601_101500.json.gz")[0]) == "2026-06-01 10:15:00"


def test_content(spark):
    good = b"%PDF-1.7" + b"x" * 900
    df = spark.createDataFrame([(good,), (good[:700],), (b"x" * 900,), (None,)], "c binary")
    assert [r[0] for r in df.select(keys.is_pdf("c")).collect()] == [True, False, False, False]
    assert one(spark, keys.is_json("v"), '{"a": 1}', "{", None) == [True, False, False]
    assert one(spark, keys.is_json("v"), '"k": 1}', '1], [2', '1}, {"y":2', ' [1, "é"] ', "{} x") == [False, False, False, True, False]


SHEET = [69, 0, 3, 42, 0, 0, 0, 0, 0, 0, 7, 3, 0]


@pytest.mark.parametrize(
    "change, want",
    [
        ({}, (126, 0, 0, True, True, "NINGUNA")), ({"e11": 127}, (126, 0, -1, True, False, "MEDIA")), ({"sum": 125}, (126, 1, -1, False, False, "ALTA")),
        ({"e11": None}, (126, 0, None, True, None, "NINGUNA")), ({"c0": None}, (None, None, 0, None, True, "INCOMPLETO")), ({"c0": None, "e11": 9}, (None, None, 117, None, False, "INCOMPLETO")),
    ],
)
def test_arithmetic_check(spark, change, want):
    c = [F.lit(v).cast("int") for v in [change.get("c0", 69), *SHEET[1:]]]
    n = lambda k, v: F.lit(change.get(k, v)).cast("int")
    r = spark.range(1).select(checks.arithmetic_check(c, F.lit(2), F.lit(0), F.lit(0), n("sum", 126), n("e11", 126)).alias("r")).first().r
    assert (r.calculada, r.dif_suma, r.dif_e11, r.cuadra_suma, r.cuadra_e11, r.alerta) == want


def test_fill_policies(spark):
    df = spark.createDataFrame([(5, True), (None, True), (None, False)], "v int, p boolean")
    get = lambda policy: [r[0] for r in df.select(checks.filled(F.col("v"), F.col("p"), policy)).collect()]
    assert get("strict") == [5, None, None] and get("zero_all") == [5, 0, 0] and get("zero_absent") == [5, None, 0]


def test_ink(spark):
    ink = {c: F.lit(0.0) for c in [*CANDIDATES, "BLANCO", "NULO", "NO_MARCADO", "SUMA_TOTAL", "TOTAL_E11"]}
    row = lambda **over: spark.range(1).select(*[v.alias(k) for k, v in checks.ink_flags(ink | {k: F.lit(v) for k, v in over.items()}).items()]).first()
    r = row(cand_03=5.0)
    assert (r.suma_vacia_con_votos, r.e11_vacio_con_votos, r.prioridad, r.n_banderas) == (1, 1, "ALTA", 2)
    assert row(cand_03=1.0).n_candidatos == 0 and row(SUMA_TOTAL=2.0).suma_con_todo_vacio == 1
    assert row(BLANCO=2.0).prioridad == "MEDIA" and row(BLANCO=2.0, SUMA_TOTAL=2.0, TOTAL_E11=2.0).prioridad == "OK"


def test_block_types_and_box_flags(spark):
    cases = [(0.3, 0.10, 0.5, "guion"), (0.2, 0.2, 0.6, "punto"), (0.2, 0.2, 0.3, "digito"), (0.4, 0.5, 0.47, "digito"), (0.2, 0.2, 0.48, "marca"), (None, None, None, "vacio")]
    df = spark.createDataFrame([c[:3] for c in cases], "w double, h double, f double")
    assert [r[0] for r in df.select(checks.block_type(F.col("w"), F.col("h"), F.col("f"))).collect()] == [c[3] for c in cases]
    boxes = spark.createDataFrame([([],), (["guion", "guion", "digito", "digito"],), (["marca"],), (["digito"],)], "t array<string>")
    assert [r[0] for r in boxes.select(checks.box_flags(F.col("t"))).collect()] == [["casilla_vacia", "espacio_sin_anular"], ["mas_de_3_posiciones", "contiene_guion"], ["posicion_ambigua", "espacio_sin_anular"], []]


def test_participation(spark):
    df = spark.createDataFrame([(101, 100), (95, 100), (94, 100), (9, None), (3, 0)], "v int, t int")
    assert [tuple(r) for r in df.select(*checks.participation(F.col("v"), F.col("t"))).collect()] == [(1.01, "EXCEDE"), (0.95, "ALTO"), (0.94, ""), (None, "SIN_CENSO"), (0.0, "EXCEDE")]
