import hashlib
import itertools
import random

from pyspark.sql import functions as F

from tallyframe.operators import census, chain, compare, decode, layout, sheets, snapshots


def test_transfer_and_what_is_none(spark):
    rows = [("1", "CAND_01", "A", 150, 0.9), ("1", "CAND_02", "A", 80, 0.9), ("1", "CAND_01", "B", 50, 0.9), ("1", "CAND_02", "B", 180, 0.2)]
    rows += [("2", "CAND_01", "A", 150, None), ("2", "CAND_02", "A", 80, None), ("2", "CAND_01", "B", 50, None), ("2", "CAND_02", "B", 170, None)]
    df = spark.createDataFrame(rows, "mesa string, etiqueta string, ejemplar string, valor int, conf double")
    found = compare.discrepancies(df, ["mesa"], conf="conf")
    assert sorted((r.mesa, r.dif, r.multiplo_100) for r in found.collect()) == [("1", -100, 1), ("1", 100, 1), ("2", -100, 1), ("2", 90, 0)]
    moved = compare.transfers(found, ["mesa"]).collect()
    assert [(r.mesa, r.monto, r.ganan, r.pierden, r.multiplo_100) for r in moved] == [("1", 100, "CAND_02(+100)", "CAND_01(-100)", 1)]
    sure = compare.discrepancies(df, ["mesa"], conf="conf", min_conf=0.5)
    assert sorted((r.mesa, r.dif) for r in sure.collect()) == [("1", -100), ("2", -100), ("2", 90)] and compare.transfers(sure, ["mesa"]).count() == 0
    s = compare.summary(df, found, compare.transfers(found, ["mesa"]), ["mesa"]).first()
    assert (s.mesas, s.con_discrepancia, s.con_traslado, s.pct_traslado) == (2, 2, 1, 50.0)


def test_sheets_last_wins_and_policies(spark):
    rows = [("m", "cand_01", 3, 1), ("m", "cand_01", 5, 2), ("m", "SUMA_TOTAL", 5, 3), ("m", "TOTAL_E11", 6, 4), ("n", "cand_01", None, 1), ("n", "SUMA_TOTAL", 1, 2)]
    wide = sheets.pivot_readings(spark.createDataFrame(rows, "mesa string, etiqueta string, valor int, ord int"), ["mesa"])
    by = {(p, r.mesa): (r.calculada, r.alerta) for p in ("zero_all", "strict", "zero_absent") for r in sheets.check_sheets(wide, p).collect()}
    assert by["zero_all", "m"] == (5, "MEDIA") and by["strict", "m"] == (None, "INCOMPLETO") and by["zero_absent", "m"] == (5, "MEDIA")
    assert by["zero_all", "n"] == (0, "ALTA") and by["zero_absent", "n"] == (None, "INCOMPLETO")
    both = spark.createDataFrame(rows, "mesa string, etiqueta string, valor int, ord int")
    assert sheets.keep_first(both, ["mesa", "etiqueta"], "ord").where("etiqueta = 'cand_01' AND mesa = 'm'").first().valor == 3
    split = sheets.group_split(spark.createDataFrame([(k // 5,) for k in range(500)], "g int"), "g", 0.2)
    assert split.groupBy("g").agg(F.count_distinct("validation").alias("n")).where("n > 1").count() == 0 and 20 < split.where("validation").count() < 200


def test_census(spark):
    votes = spark.createDataFrame([("1", "1", 60), ("1", "2", 41), ("2", "1", 95), ("3", "1", 7)], "puesto string, mesa string, votos int")
    rolls = spark.createDataFrame([("1", 100, 2), ("2", 100, 0), ("9", 50, 1)], "puesto string, total int, mesas int")
    got = {r.puesto: (r.votos, r.mesas, r.bandera) for r in census.check_places(votes, rolls, ["puesto"]).collect()}
    assert got == {"1": (101, 2, "EXCEDE"), "2": (95, 1, "ALTO"), "3": (7, 1, "SIN_CENSO")}
    assert [r.puesto for r in census.without_votes(votes, rolls, ["puesto"]).collect()] == ["9"]
    assert [r.votos for r in census.over_cap(votes, ["puesto", "mesa"], 50).collect()] == [60, 95]
    assert census.summary(rolls).first().max_media_por_mesa == 100.0


def test_snapshot_diff(spark):
    kind = "key string, name string, status string"
    found = snapshots.diff(spark.createDataFrame([("a", "x", "1"), ("b", "y", "1")], kind), spark.createDataFrame([("a", "z", "2"), ("c", "w", "1")], kind))
    assert sorted((r.tipo, r.key, r.antes, r.ahora) for r in found.collect()) == [("anadida", "c", None, "w"), ("eliminada", "b", "y", None), ("estado_cambiado", "a", "1", "2"), ("hash_cambiado", "a", "x", "z")]


def fold(series):
    """The history, one snapshot after another."""
    out, prev = {}, None
    for t, cur in enumerate(series):
        for k, (name, status) in cur.items():
            if prev is None or k not in prev:
                out[k] = {"first": t, "hash": [], "estado": [], "gone": None, "now": (name, status)}
            else:
                h = out[k]
                if prev[k][0] != name:
                    h["hash"].append((t, prev[k][0], name))
                if prev[k][1] != status:
                    h["estado"].append((t, prev[k][1], status))
                h["now"] = (name, status)
        for k in set(prev or {}) - set(cur):
            out[k]["gone"] = t
        prev = cur
    return out


def test_history_against_a_fold(spark):
    rng = random.Random(6)
    series = [{f"k{k}": (f"h{rng.randint(0, 2)}", str(rng.randint(1, 12))) for k in range(40) if rng.random() < 0.75} for _ in range(9)]
    rows = [(k, t + 1, f"2026-06-01 {8 + t:02d}:00:00", *v) for t, s in enumerate(series) for k, v in s.items()]
    df = spark.createDataFrame(rows, "key string, snap_ord int, ts string, name string, status string").withColumn("snap_ts", F.col("ts").cast("timestamp_ntz"))
    found = snapshots.history(df)
    hour = lambda ts: None if ts is None else ts.hour - 8
    got = {r.key: {"first": hour(r.first_seen), "hash": [(hour(c.ts), c.antes, c.ahora) for c in r.hash_changes], "estado": [(hour(c.ts), c.antes, c.ahora) for c in r.estado_changes], "gone": hour(r.eliminada_ts), "now": (r.name, r.status)} for r in found.collect()}
    want = fold(series)
    assert got == want
    audit = {r.key: r for r in snapshots.audited(found, 3).collect()}
    for k, h in want.items():
        assert audit[k].tardio == any(t - h["first"] >= 3 for t, _, _ in h["hash"])
        assert audit[k].regresion == any(int(b) < int(a) for _, a, b in h["estado"])
    assert {r.key for r in snapshots.audit_report(found).collect()} == {k for k, h in want.items() if h["hash"] or h["gone"] is not None}
    counts = {r.snap_ord: (r.n_actas, r.anadida, r.eliminada) for r in snapshots.counters(df).collect()}
    for t in range(1, 9):
        assert counts[t + 1] == (len(series[t]), len(set(series[t]) - set(series[t - 1])), len(set(series[t - 1]) - set(series[t])))


def test_chain(spark):
    entries = spark.createDataFrame([("c", k, f"t{k}", f"s{k}") for k in range(1, 4)], "cadena string, seq long, ts string, sha_contenido string")
    links = chain.build(entries, ["cadena"])
    last, want = "GENESIS", []
    for k in range(1, 4):
        last = hashlib.sha256(f"{last}s{k}t{k}".encode()).hexdigest()
        want.append(last)
    assert [r.eslabon for r in links.orderBy("seq").collect()] == want
    edited = links.withColumn("sha_contenido", F.when(F.col("seq") == 2, "x").otherwise(F.col("sha_contenido")))
    assert [r.ok for r in chain.verify(edited, ["cadena"]).orderBy("seq").collect()] == [True, False, True]


def enumerate_decode(boxes):
    """boxes: (ord, kind, base, [(value, cost)])."""
    def ok(values):
        parts = sum(v for (_, kind, _, _), v in zip(boxes, values) if kind == "parte")
        whole = [v for (_, kind, _, _), v in zip(boxes, values) if kind == "suma"][0]
        return parts == whole == [v for (_, kind, _, _), v in zip(boxes, values) if kind == "e11"][0]

    base = [b[2] for b in boxes]
    if ok(base):
        return "directo", 0.0, 0
    singles = []
    for k, (o, _, _, alts) in enumerate(boxes):
        for v, c in alts:
            if ok([*base[:k], v, *base[k + 1 :]]):
                singles.append((c, o))
    if singles:
        c = min(singles)[0]
        return ("corregido_minimo" if c < 0.7 else "corregido_forzado"), c, 1
    loose = sorted((min(c for _, c in b[3]), b[0], k) for k, b in enumerate(boxes) if b[3])[:8]
    pairs = []
    for (_, _, a), (_, _, b) in itertools.combinations(sorted(loose, key=lambda x: x[1]), 2):
        for (va, ca), (vb, cb) in itertools.product(boxes[a][3], boxes[b][3]):
            values = list(base)
            values[a], values[b] = va, vb
            if ok(values):
                pairs.append(ca + cb)
    return ("corregido_forzado", min(pairs), 2) if pairs else ("no_cuadra", 0.0, 0)


def test_decoder_against_enumeration(spark):
    rng, want, rows = random.Random(12), {}, []
    for m in range(400):
        parts = [rng.randint(0, 20) for _ in range(9)]
        whole = sum(parts)
        values = [*parts, whole, whole]
        for _ in range(rng.choice([0, 1, 1, 2, 2])):
            values[rng.randrange(11)] += rng.choice([-1, 1, 10])
        boxes = []
        for o, v in enumerate(values):
            kind = "parte" if o < 9 else "suma" if o == 9 else "e11"
            alts = sorted({(v + rng.choice([-10, -1, 1]), rng.randint(1, 25) / 10) for _ in range(rng.randint(0, 3))})
            boxes.append((o, kind, v, alts))
            rows.append((m, o, kind, v, 0.0))
            rows += [(m, o, kind, a, c) for a, c in alts]
        want[m] = enumerate_decode(boxes)
    df = spark.createDataFrame(rows, "mesa int, ord int, kind string, valor int, coste double")
    got = {r.mesa: (r.estado, round(r.coste, 9), r.n_cambios) for r in decode.decode(df).collect()}
    assert got == {m: (s, round(c, 9), n) for m, (s, c, n) in want.items()}


def test_values_top_k_and_pseudo_labels(spark):
    import math

    df = spark.createDataFrame([([0.0, math.log(3), 0.0, math.log(6)],)], "l array<double>")
    r = df.select(decode.top_k(decode.softmax(F.col("l"))).alias("t")).first().t
    assert [x.d for x in r] == [3, 1] and abs(r[0].p / r[1].p - 2) < 1e-9
    digits = [[(1, 0.9), (7, 0.1)], [(0, 0.5), (6, 0.5)], [(5, 0.999), (3, 0.001)]]
    df = spark.createDataFrame([(digits,)], "p array<array<struct<d:int,p:double>>>")
    got = {c.valor: round(c.coste, 3) for c in df.select(decode.value_candidates(F.col("p")).alias("c")).first().c}
    assert got == {105: 0.0, 705: 2.197, 165: 0.0}
    labels = spark.createDataFrame([(1, 1, "4", "auto"), (2, 1, "5", ""), (3, 2, "6", "manual"), (4, 2, "", ""), (5, 2, "1", "pseudo"), (6, 3, "1", None)], "caja int, mesa int, etiqueta string, fuente string")
    guesses = spark.createDataFrame([(1, 9, 0.9, True), (2, 8, 0.2, True), (3, 7, 0.999, False), (4, 2, 0.996, False), (5, 3, 0.9, False)], "caja int, digito int, confianza double, cuadra boolean")
    out = {r.caja: (r.etiqueta, r.fuente) for r in decode.pseudo_labels(labels, guesses).collect()}
    assert out == {1: ("4", "auto"), 2: ("8", "validado"), 3: ("6", "manual"), 4: ("2", "pseudo"), 5: ("", ""), 6: ("", "")}
    weights = {r.clase: (r.n, r.peso) for r in decode.class_weights(spark.createDataFrame([(0,), (0,), (3,)], "y int")).collect()}
    assert weights[0] == (2, 0.15) and weights[3] == (1, 0.3) and weights[9] == (0, 0.3) and len(weights) == 10


def test_layout(spark):
    df = spark.createDataFrame([("a", x) for x in (1, 2, 10, 11, 12, 40)], "k string, x int")
    assert sorted((r.inicio, r.fin, r.n) for r in layout.runs(df, "k", "x", 3).collect()) == [(1, 2, 2), (10, 12, 3), (40, 40, 1)]
    lines = spark.createDataFrame([("a", x) for x in (0, 9, 20, 30, 40, 50, 99)], "k string, x int")
    best = layout.regular_lines(lines, "k", "x", 3, 5, 15).first()
    assert (best.inicio, best.dispersion) == (20, 0)
    boxes = spark.createDataFrame([("a", 0, 5), ("a", 50, 9), ("a", 100, 3), ("a", 300, 1)], "k string, y int, area int")
    assert sorted((r.y, r.area) for r in layout.nearest_kept(boxes, "k", "y", "area", 120).collect()) == [(50, 9), (300, 1)]


def test_runs_of_odd_positions_equal_their_sql(spark, tmp_path):
    import duckdb

    from tallyframe.plans import catalogue

    rows = [(k, x) for k in (1, 2, None) for x in (None, 5, 5, 8, 12, None, -1, 1 << 40)] + [(3, None), (4, 7)] + [(5, x * x // 7) for x in range(60)]
    spark.createDataFrame(rows, "l_suppkey long, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    for name in ("run_length_groups", "regular_lines"):
        df = catalogue.queries()[name](spark, str(tmp_path))
        want = db.sql(f"SELECT {', '.join(df.columns)} FROM ({catalogue.oracle_sql()[name]})").fetchall()
        assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_tasks_of_positions_do_not_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(layout, "TASK_POSITIONS", 1000, raising=False)
    for n in (5000, 20_000):
        rows = spark.range(n).selectExpr("id % 500 AS k", "id div 500 * 3 AS x")
        found = layout.runs(rows.union(rows), "k", "x", 2)
        dealt = [r.n for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.countDistinct("k")).collect()]
        assert sum(dealt) == n and max(dealt) < 2500
        assert "HashAggregate(keys=[k" not in found._jdf.queryExecution().executedPlan().toString().split("Window")[0]  # no map of all runs
