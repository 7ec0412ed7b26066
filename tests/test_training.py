from tallyframe.operators import training as t


def test_boxes_are_labelled_only_on_sheets_that_reconcile(spark):
    readings = [(1, "cand_01", "7", ["a0", "a1", "a2"]), (1, "BLANCO", "1234", ["b0"]), (2, "cand_01", "42", ["c0", "c1", "c2"]), (3, "cand_01", "x", ["d0"]), (3, "NULO", None, ["e0"]), (1, "NULO", "5", [])]
    rows = spark.createDataFrame(readings, "mesa int, etiqueta string, numero string, cajas array<string>")
    trusted = spark.createDataFrame([(1,), (1,), (3,)], "mesa int")
    got = {r.caja: (r.pos, r.etiqueta_digito, r.sugerencia, r.confianza) for r in t.export_boxes(rows, trusted, ["mesa"]).collect()}
    assert got == {
        "a0": (0, "0", "0", 1), "a1": (1, "0", "0", 1), "a2": (2, "7", "7", 1), "b0": (0, "", "", 1), "c0": (0, "", "0", 0), "c1": (1, "", "4", 0), "c2": (2, "", "2", 0), "d0": (0, "", "", 1), "e0": (0, "", "", 1),
    }
    pixels = spark.createDataFrame([("a0", [0, 255]), ("a2", [250, 5]), ("c2", [1, 1])], "caja string, pixeles array<int>")
    packed = {r.caja: (list(r.x), r.y) for r in t.pack_boxes(t.export_boxes(rows, trusted, ["mesa"]), pixels).collect()}
    assert packed == {"a0": ([255, 0], 0), "a2": ([5, 250], 7)}


def test_cell_types_go_by_case(spark):
    rows = spark.createDataFrame([("cand_01",), ("CANDIDATO_01",), ("BLANCO",)], "etiqueta string")
    assert [r.x for r in rows.select(t.cell_type("etiqueta").alias("x")).collect()] == ["CAND", "AGREG", "AGREG"]


def test_gain_over_a_baseline(spark):
    kind = "mesa int, alerta string"
    before = spark.createDataFrame([(1, "NINGUNA"), (2, "ALTA"), (3, "MEDIA"), (9, "NINGUNA")], kind)
    now = spark.createDataFrame([(1, "NINGUNA"), (2, "NINGUNA"), (3, "MEDIA"), (4, "NINGUNA")], kind)
    assert {r.mesa for r in t.newly_reconciled(now, before, ["mesa"]).collect()} == {2, 4}
    assert {r.medida: (r.n, r.pct) for r in t.evaluate(now, before, ["mesa"]).collect()} == {"NINGUNA": (3, 75.0), "MEDIA": (1, 25.0), "BASE": (2, 50.0), "NUEVAS": (2, 50.0)}
    assert t.evaluate(now.limit(0), before, ["mesa"]).collect()[0].medida == "BASE"


def test_label_tables_are_versions(spark, tmp_path):
    labels = spark.createDataFrame([("a", "", 0.4), ("b", "manual", 1.0), ("c", "", 0.1)], "caja string, fuente string, confianza double")
    path = f"file://{tmp_path}/labels"
    assert t.versioned(spark, path) == 0
    version, queue = t.rewrite_labels(labels, path)
    assert version == 1 and [r.caja for r in queue.collect()] == ["c", "a"]
    assert t.rewrite_labels(labels, path)[0] == 2 and spark.read.parquet(f"{path}/v000001").count() == 3
