import gzip
import json

from pyspark.sql import functions as F

from tallyframe.operators import chain
from tallyframe.sources import fetch, manifest, readings, sinks
from tallyframe.streaming.monitor import Monitor, changes_by_key


def node(name, code="", status="11", **more):
    return {"expectedName": name, "idTransmissionCode": code, "idTransmissionCodeStatus": status, "idDepartmentCode": "1", "municipalityCode": "2", "idZoneCode": "3", "standCode": "4", "numberStand": "5", **more}


def snapshot(folder, stamp, nodes):
    folder.mkdir(exist_ok=True)
    (folder / f"allTransmissionCodes_{stamp}.json.gz").write_bytes(gzip.compress(json.dumps({"data": {"a": [{"nodes": nodes}]}}).encode()))


def test_manifest_walk_and_records(spark, tmp_path):
    doc = {"data": {"x": {"nodes": [node("b", "2"), {"nodes": [node("a.PDF", "1", numberStand="1234")]}, node(" ", "3")]}, "skip": [node("no")], "nodes": {"expectedName": "no"}}}
    (tmp_path / "m.json").write_text(json.dumps(doc))
    found = manifest.nodes(manifest.texts(spark, str(tmp_path / "m.json")))
    assert [r.node["expectedName"] for r in found.orderBy("ord").collect()] == ["b", "a.PDF", " "]
    got = sorted(tuple(r) for r in manifest.load_manifest(spark, str(tmp_path / "m.json")).select("expected_name", "dep", "muni", "zona", "puesto", "mesa", "corporacion").collect())
    assert got == [("a.PDF", "01", "002", "003", "04", "1234", "001"), ("b.pdf", "01", "002", "003", "04", "005", "001")]
    rows = manifest.index(found).collect()
    assert {(r.key, r.name) for r in rows} == {("2", "b"), ("1", "a.PDF"), ("3", " ")}


def test_geography_and_enrichment(spark, tmp_path):
    tree = {"data": {"departmentsTree": {"edges": [{"node": {"idDepartmentCode": "1", "departmentName": "D", "municipalities": [{"municipalityCode": "2", "municipalityName": "M", "zones": [{"idZoneCode": "3", "zoneName": "Z", "stands": [{"standCode": "4", "standName": "S", "countTable": "7"}]}, {"idZoneCode": "9"}]}]}}, {"node": {"idDepartmentCode": "8"}}]}}}
    (tmp_path / "t.json").write_text(json.dumps(tree))
    rows = manifest.geography(spark, str(tmp_path / "t.json"))
    assert [tuple(r) for r in rows.select("dep", "muni", "zona", "puesto", "nombre_puesto", "mesas").collect()] == [("01", "002", "003", "04", "S", 7)]
    records = spark.createDataFrame([("01", "002", "003", "04"), ("01", "002", "003", "99")], "dep string, muni string, zona string, puesto string")
    assert sorted(r.nombre_puesto for r in manifest.enrich(records, rows).collect()) == ["", "S"]


def test_third_copy(spark, tmp_path):
    (tmp_path / "i.json").write_text(json.dumps({"a/actas-documentos/1/mesas": "f1", "avance-actas/x": "f2"}))
    assert [r.archivo for r in manifest.third_copy_index(manifest.texts(spark, str(tmp_path / "i.json"))).collect()] == ["f1"]
    (tmp_path / "p.json").write_text(json.dumps([{"nombre_archivo": "/docs/E14/01/02/03/04/f.pdf", "numero": "6", "digitalizado": 1}, {"nombre_archivo": "", "digitalizado": 1}, {"nombre_archivo": "g.pdf", "digitalizado": 0}]))
    files = manifest.texts(spark, str(tmp_path / "p.json"))
    assert [(r.url, r.dep, r.puesto, r.mesa) for r in manifest.third_copy_tasks(files, "https://h/").collect()] == [("https://h/docs/E14/01/02/03/04/f.pdf", "01", "04", "6")]
    assert manifest.third_copy_tasks(files, "https://h/", False).count() == 2
    assert manifest.inspect(files).first().textos == ["/docs/E14/01/02/03/04/f.pdf", "g.pdf"]


def test_csv_readers(spark, tmp_path):
    (tmp_path / "r.csv").write_text("﻿Dep;Muni;Zona;Puesto;Mesa;Etiqueta;Numero;Conf\n01;002;3;4;007;cand_01; 07 ;0.5\n1;2;3;4;7;cand_01;9;\n1;2;3;4;7;total_e11;x;1\n1;2;3;4;8;TOTAL_E11;30;1\n", encoding="utf-8")
    df = readings.csv(spark, str(tmp_path / "r.csv"))
    rows = readings.readings(df, copy="A").collect()
    assert sorted((r.mesa, r.etiqueta, r.valor, r.conf) for r in rows) == [("7", "CAND_01", 9, None), ("8", "TOTAL_E11", 30, 1.0)]
    assert [(r.mesa, r.votos) for r in readings.votes(df).collect()] == [("8", 30)]
    (tmp_path / "c.csv").write_text("dep,muni,zona,puesto,departamento,total,mesas\n01,2,3,4,D,100,2\nx,2,3,4,D,,\n")
    assert [(r.dep, r.total) for r in readings.census(readings.csv(spark, str(tmp_path / "c.csv"))).collect()] == [("1", 100)]
    assert readings.resolve_snapshot(["a_20260601.json", "a_20260602.json.gz"], "latest") == "a_20260602.json.gz" and readings.resolve_snapshot(["a_1.json", "a_1.json.gz"], "_1") == "a_1.json.gz"


def test_files_and_sinks(spark, tmp_path):
    (tmp_path / "t/a").mkdir(parents=True)
    for name in ("a/1.pdf", "a/2.PDF", "a/3.txt"):
        (tmp_path / "t" / name).write_bytes(b"%PDF")
    files = readings.pdf_tree(spark, str(tmp_path / "t"))
    assert files.count() == 2
    rows = spark.createDataFrame([(1, ["a", "b"], None, "error"), (2, [], "x", "ok")], "k int, l array<string>, t string, status string")
    assert readings.pending(rows, rows.where("k = 1"), "k").count() == 1
    sinks.write_csv(rows, str(tmp_path / "o"), ["k", "l", "t", "absent"])
    assert sorted(tuple(r) for r in spark.read.csv(str(tmp_path / "o"), header=True).na.fill("").collect()) == [("1", "a;b", "", ""), ("2", "", "x", "")]
    sinks.write_results(rows, str(tmp_path / "j"), str(tmp_path / "e"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2 and spark.read.json(str(tmp_path / "e")).count() == 1
    assert "| k | 2 |" in sinks.markdown(rows.agg(F.max("k").alias("k")), "T")
    assert fetch.waits(8)[-1] == 60.0 and fetch.ManifestSource.name() == "manifest"


def test_monitor_stream(spark, tmp_path):
    folder, state = tmp_path / "snaps", tmp_path / "state"
    snapshot(folder, "20260601_100000", [node("x", "a"), node("y", "b")])
    monitor = Monitor(spark, str(state))
    monitor.start(str(folder)).awaitTermination()
    snapshot(folder, "20260601_101000", [node("z", "a", "12"), node("w", "c")])
    monitor.start(str(folder)).awaitTermination()  # a restart goes on from the checkpoint
    log = monitor.log().orderBy("batch").collect()
    assert [(r.ts, r.n_actas, r.anadidas, r.eliminadas, r.hash_cambiado, r.estado_cambiado, r.alerta) for r in log] == [("20260601_100000", 2, 0, 0, 0, 0, False), ("20260601_101000", 2, 1, 1, 1, 1, True)]
    links = monitor.log().select(F.lit("m").alias("cadena"), F.col("batch").alias("seq"), "ts", "sha_contenido", "eslabon", "eslabon_anterior")
    assert all(r.ok for r in chain.verify(links, ["cadena"]).collect())
    assert sorted((r.tipo, r.key) for r in monitor.alerts().collect()) == [("eliminada", "b"), ("hash_cambiado", "a")]


def test_only_changes_survives_an_unchanged_fetch(spark, tmp_path):
    monitor = Monitor(spark, str(tmp_path / "state"), only_changes=True)
    text = json.dumps({"nodes": [node("x", "a")]})
    for batch, t in enumerate([text, text, json.dumps({"nodes": [node("q", "a")]})]):
        monitor.process(spark.createDataFrame([(f"allTransmissionCodes_20260601_10000{batch}.json", t)], "file string, text string"), batch)
    log = monitor.log().orderBy("batch").collect()
    assert [(r.guardado, r.anadidas, r.hash_cambiado, r.alerta) for r in log] == [(True, 0, 0, False), (False, 0, 0, False), (True, 0, 1, True)]


def test_changes_by_key(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2026-06-01 10:00:00", "x", "1"), ("a", "2026-06-01 10:10:00", "y", "1"), ("a", "2026-06-01 10:20:00", "y", "2"), ("b", "2026-06-01 10:00:00", "x", "1")], "key string, t string, name string, status string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")).select("key", F.col("t").cast("timestamp").alias("snap_ts"), "name", "status")
    query = changes_by_key(stream).writeStream.format("memory").queryName("changes").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.key, r.tipo, r.antes, r.ahora) for r in spark.table("changes").collect()) == [("a", "estado_cambiado", "1", "2"), ("a", "hash_cambiado", "x", "y")]
