"""The named queries over the driver's tables and their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyframe import schema
from tallyframe.functions import checks, keys
from tallyframe.kernels import ink
from tallyframe.operators import boxes as box_ops
from tallyframe.operators import census, chain, compare, decode, extract, layout, sheets, snapshots, training
from tallyframe.plans import bindings as b
from tallyframe.plans.bindings import table
from tallyframe.sources import manifest, readings

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)


CHECK_COLUMNS = ["mesa", *b.LINES, "NO_MARCADO", "SUMA_TOTAL", "TOTAL_E11", "calculada", "dif_suma", "dif_e11", "cuadra_suma", "cuadra_e11", "incompleta", "alerta"]


def _checked(spark, d, policy="zero_all"):
    return sheets.check_sheets(b.sheets(spark, d), policy, b.LINES[:5])


# sheets


@query(f"WITH {b.checked_sql('zero_all')} SELECT {', '.join(CHECK_COLUMNS)} FROM checked")
def arithmetic_check(spark, d):
    return _checked(spark, d).select(*CHECK_COLUMNS)


@query(f"WITH {b.checked_sql('strict')} SELECT {', '.join(CHECK_COLUMNS)} FROM checked")
def arithmetic_check_strict(spark, d):
    return _checked(spark, d, "strict").select(*CHECK_COLUMNS)


@query(f"WITH {b.checked_sql('zero_all')} SELECT alerta, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM checked GROUP BY alerta")
def alert_histogram(spark, d):
    return sheets.histogram(_checked(spark, d), "alerta")


@query(f"WITH {b.checked_sql('strict')} SELECT mesa, alerta, CASE alerta WHEN 'ALTA' THEN 0 WHEN 'MEDIA' THEN 1 WHEN 'INCOMPLETO' THEN 2 WHEN 'NINGUNA' THEN 3 ELSE 9 END AS orden FROM checked")
def alert_ranked(spark, d):
    return sheets.ranked(_checked(spark, d, "strict"), "mesa").select("mesa", "alerta", checks.alert_rank(F.col("alerta")).alias("orden"))


_PIVOT = ", ".join(f"max_by(valor, ord) FILTER (WHERE etiqueta = '{x}') AS {x}" for x in b.LINES)


@query(f"WITH {b.READINGS} SELECT mesa, {_PIVOT} FROM readings GROUP BY mesa")
def pivot_readings(spark, d):
    return sheets.pivot_readings(b.readings(spark, d), ["mesa"], b.LINES).select("mesa", *b.LINES)


@query(f"WITH {b.READINGS} SELECT mesa, etiqueta, ord, valor FROM (SELECT *, row_number() OVER (PARTITION BY mesa, etiqueta ORDER BY ord DESC, valor DESC) AS n FROM readings) WHERE n = 1")
def dedupe_keep_last(spark, d):
    return sheets.keep_last(b.readings(spark, d), ["mesa", "etiqueta"], "ord")


@query(f"WITH {b.READINGS} SELECT mesa, etiqueta, ord, valor FROM (SELECT *, row_number() OVER (PARTITION BY mesa, etiqueta ORDER BY ord, valor) AS n FROM readings) WHERE n = 1")
def dedupe_keep_first(spark, d):
    return sheets.keep_first(b.readings(spark, d), ["mesa", "etiqueta"], "ord")


@query(r"""SELECT strategy, count(*) AS actas, count(*) FILTER (WHERE ok) AS cuadran, round(100.0 * count(*) FILTER (WHERE ok) / count(*), 2) AS pct FROM (
  SELECT 'cero' AS strategy, cuadra_suma AND cuadra_e11 AS ok FROM (WITH """ + b.checked_sql("zero_all") + """ SELECT * FROM checked)
  UNION ALL SELECT 'estricta', coalesce(cuadra_suma AND cuadra_e11, FALSE) FROM (WITH """ + b.checked_sql("strict") + """ SELECT * FROM checked)) GROUP BY strategy""")  # fmt: skip
def strategy_compare(spark, d):
    ok = F.coalesce(F.col("cuadra_suma") & F.col("cuadra_e11"), F.lit(False)).alias("ok")
    rows = _checked(spark, d).select(F.lit("cero").alias("strategy"), ok).unionByName(_checked(spark, d, "strict").select(F.lit("estricta").alias("strategy"), ok))
    n = F.count(F.lit(1))
    return rows.groupBy("strategy").agg(n.alias("actas"), F.count_if("ok").alias("cuadran"), F.round(100.0 * F.count_if("ok") / n, 2).alias("pct"))


# codes, names and paths

_RAW = "(CASE WHEN c_custkey % 3 = 0 THEN '00' ELSE '' END || c_custkey::VARCHAR || CASE WHEN c_custkey % 7 = 0 THEN 'A' ELSE '' END || ' ')"


@query(f"SELECT c_custkey, CASE WHEN regexp_matches(trim({_RAW}), '^[0-9]+$') THEN coalesce(nullif(ltrim(trim({_RAW}), '0'), ''), '0') ELSE trim({_RAW}) END AS clave FROM customer")
def key_normalize(spark, d):
    c = table(spark, d, "customer")
    raw = F.concat(F.when(F.col("c_custkey") % 3 == 0, "00").otherwise(""), F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 7 == 0, "A").otherwise(""), F.lit(" "))
    return c.select("c_custkey", keys.normalize_key(raw).alias("clave"))


@query("SELECT s_suppkey, CASE WHEN length(s_nationkey::VARCHAR) >= 2 THEN s_nationkey::VARCHAR ELSE lpad(s_nationkey::VARCHAR, 2, '0') END AS dep, CASE WHEN length(s_suppkey::VARCHAR) >= 3 THEN s_suppkey::VARCHAR ELSE lpad(s_suppkey::VARCHAR, 3, '0') END AS mesa FROM supplier")
def code_pad(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", keys.pad_code("s_nationkey", 2).alias("dep"), keys.pad_code("s_suppkey", 3).alias("mesa"))


@query("SELECT doc_id, regexp_replace(coalesce(text, ''), '[^0-9]', '', 'g') AS digitos FROM documents")
def digits_only(spark, d):
    return table(spark, d, "documents").select("doc_id", keys.digits_only("text").alias("digitos"))


@query("""SELECT page_id, CASE WHEN len(p) >= 7 THEN p[-7] ELSE '' END AS ejemplar, CASE WHEN len(p) >= 7 THEN p[-6] ELSE '' END AS dep, CASE WHEN len(p) >= 7 THEN p[-2] ELSE '' END AS mesa, p[-1] AS archivo
FROM (SELECT page_id, string_split(CASE WHEN page_id % 4 = 0 THEN url ELSE 'x/DELEGADOS/' || replace(url, '//', '/a/b/') || '/h.pdf' END, '/') AS p FROM pages)""")
def url_path_parse(spark, d):
    path = F.when(F.col("page_id") % 4 == 0, F.col("url")).otherwise(F.concat(F.lit("x/DELEGADOS/"), F.replace("url", F.lit("//"), F.lit("/a/b/")), F.lit("/h.pdf")))
    rows = table(spark, d, "pages").select("page_id", path.alias("path"))
    return rows.withColumn("k", keys.parse_path("path")).select("page_id", "k.ejemplar", "k.dep", "k.mesa", F.element_at(F.split("path", "/"), -1).alias("archivo"))


_ROUTE = "CASE page_id % 4 WHEN 0 THEN url || '/actas-documentos/mesas/' WHEN 1 THEN url || '/actas-publicadas/consolidado' WHEN 2 THEN url || 'avance-actas' ELSE url END"


@query(f"SELECT page_id, CASE WHEN r LIKE '%actas-documentos%' AND rtrim(r, '/') LIKE '%mesas' THEN 'documentos' WHEN r LIKE '%actas-publicadas/consolidado%' THEN 'consolidado' WHEN r LIKE '%avance-actas%' THEN 'avance' ELSE 'otro' END AS clase FROM (SELECT page_id, {_ROUTE} AS r FROM pages)")
def route_classify(spark, d):
    return table(spark, d, "pages").select("page_id", keys.route_class(F.expr(_ROUTE.replace("url || ", "url || "))).alias("clase"))


@query("SELECT p_partkey, CASE WHEN lower(n) LIKE '%.pdf' THEN n ELSE n || '.pdf' END AS archivo FROM (SELECT p_partkey, trim(p_name || CASE WHEN p_partkey % 3 = 0 THEN '.PDF' ELSE ' ' END) AS n FROM part)")
def pdf_suffix_fix(spark, d):
    name = F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, ".PDF").otherwise(" "))
    return table(spark, d, "part").select("p_partkey", keys.pdf_name(name).alias("archivo"))


@query("SELECT p_partkey, 'https://h/assets/temis/pdf/01/001/' || lpad(p_size::VARCHAR, 3, '0') || '/01/001/PRE/' || replace(replace(p_name, ' ', '%20'), '#', '%23') || '.pdf' AS url, 'out/PRE/01/001/' || lpad(p_size::VARCHAR, 3, '0') || '/01/001/' || p_name || '.pdf' AS path FROM part")
def url_build(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.lit("01").alias("dep"), F.lit("001").alias("muni"), keys.pad_code("p_size", 3).alias("zona"), F.lit("01").alias("puesto"), F.lit("001").alias("mesa"), keys.pdf_name("p_name").alias("expected_name"))
    return p.select("p_partkey", keys.record_url("https://h/").alias("url"), keys.record_path("out").alias("path"))


@query("SELECT doc_id, octet_length(encode(text)) + 5 >= 800 AND lang = 'en' AS valido, sha256(CASE WHEN lang = 'en' THEN '%PDF-' ELSE '<html' END || text) AS sha FROM documents")
def content_valid(spark, d):
    fetched = F.concat(F.when(F.col("lang") == "en", "%PDF-").otherwise("<html"), "text").cast("binary")  # English texts stand for pages that are PDFs, others for error pages
    return table(spark, d, "documents").select("doc_id", keys.is_pdf(fetched).alias("valido"), F.sha2(fetched, 256).alias("sha"))


@query("SELECT event_id, json_valid(CASE WHEN event_type = 'error' THEN substr(props, 2) ELSE props END) AS valido FROM events")
def json_valid(spark, d):
    fetched = F.when(F.col("event_type") == "error", F.expr("substring(props, 2)")).otherwise(F.col("props"))  # answers of failed requests are cut off
    return table(spark, d, "events").select("event_id", keys.is_json(fetched).alias("valido"))


# copies


def _pairs(spark, d):
    return compare.discrepancies(b.copies(spark, d), ["mesa"])


@query(f"WITH {b.COPIES}, {b.PAIRS} SELECT * FROM pairs")
def copy_discrepancies(spark, d):
    return compare.review_order(_pairs(spark, d), "abs_dif", "mesa", "etiqueta", "ej_a", "ej_b")


_TRANSFERS = """moved AS (SELECT mesa, ej_a, ej_b, sum(CASE WHEN dif > 0 THEN dif ELSE 0 END)::BIGINT AS monto, coalesce(string_agg(CASE WHEN dif > 0 THEN etiqueta || '(+' || dif || ')' END, ';' ORDER BY etiqueta), '') AS ganan,
  coalesce(string_agg(CASE WHEN dif < 0 THEN etiqueta || '(' || dif || ')' END, ';' ORDER BY etiqueta), '') AS pierden FROM pairs WHERE etiqueta LIKE 'CAND%' GROUP BY ALL HAVING sum(dif) = 0),
transfers AS (SELECT *, CASE WHEN monto % 100 = 0 THEN 1 ELSE 0 END AS multiplo_100 FROM moved)"""


@query(f"WITH {b.COPIES}, {b.PAIRS}, {_TRANSFERS} SELECT * FROM transfers")
def copy_transfers(spark, d):
    return compare.review_order(compare.transfers(_pairs(spark, d), ["mesa"]), "monto", "mesa", "ej_a", "ej_b")


@query(f"""WITH {b.COPIES}, {b.PAIRS}, {_TRANSFERS}, n AS (SELECT (SELECT count(DISTINCT mesa) FROM copies) AS mesas, (SELECT count(DISTINCT mesa) FROM pairs) AS con_discrepancia, (SELECT count(DISTINCT mesa) FROM transfers) AS con_traslado,
  (SELECT coalesce(sum(multiplo_100), 0)::BIGINT FROM transfers) AS traslados_100) SELECT *, round(100.0 * con_discrepancia / greatest(mesas, 1), 2) AS pct_discrepancia, round(100.0 * con_traslado / greatest(mesas, 1), 2) AS pct_traslado FROM n""")
def copy_summary(spark, d):
    pairs = _pairs(spark, d)
    return compare.summary(b.copies(spark, d), pairs, compare.transfers(pairs, ["mesa"]), ["mesa"])


@query("SELECT l_orderkey AS mesa, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS ejemplares FROM lineitem GROUP BY l_orderkey")
def copy_presence(spark, d):
    found = compare.presence(table(spark, d, "lineitem").withColumn("mesa", F.col("l_orderkey")), ["mesa"], "l_returnflag")
    return found.select("mesa", F.concat_ws(",", "ejemplares").alias("ejemplares"))


# census


def _places(spark, d):
    return census.check_places(b.votes(spark, d), b.census(spark, d), ["dep", "muni"])


@query(f"WITH {b.VOTES} SELECT dep, muni, votos, mesas, habilitados, participacion, bandera FROM flagged")
def census_participation(spark, d):
    return census.review_order(_places(spark, d), "dep", "muni")


@query(f"WITH {b.VOTES} SELECT dep, muni, mesa, votos, votos - 14 AS exceso FROM votes WHERE votos > 14")
def census_cap_tables(spark, d):
    return census.over_cap(b.votes(spark, d), ["dep", "muni", "mesa"], 14)


@query(f"WITH {b.VOTES} SELECT count(*) AS puestos, sum(total)::BIGINT AS habilitados, sum(mesas)::BIGINT AS mesas, round(sum(total) / greatest(sum(mesas), 1), 2) AS media_por_mesa, round(max(total / greatest(mesas, 1)), 2) AS max_media_por_mesa FROM census")
def census_summary(spark, d):
    return census.summary(b.census(spark, d))


@query(f"WITH {b.VOTES}, placed AS (SELECT DISTINCT dep, muni FROM votes) SELECT c.* FROM census c ANTI JOIN placed s ON c.dep = s.dep AND c.muni = s.muni")
def places_without_votes(spark, d):
    return census.without_votes(b.votes(spark, d), b.census(spark, d), ["dep", "muni"])


# snapshots


def _ends(spark, d):
    rows = b.snapshots(spark, d)
    last = rows.agg(F.max("snap_ord").alias("last"))
    both = rows.join(F.broadcast(last))
    return both.where("snap_ord = last - 1").drop("last"), both.where("snap_ord = last").drop("last")


@query(f"""WITH {b.SNAPSHOTS}, {b.STEPS}, s AS (SELECT n.*, a.name AS na, c.name AS nc FROM steps n JOIN last ON n.snap_ord = last.last LEFT JOIN snaps a ON a.key = n.key AND a.snap_ord = n.snap_ord - 1 LEFT JOIN snaps c ON c.key = n.key AND c.snap_ord = n.snap_ord)
SELECT key, 'anadida' AS tipo, NULL AS antes, nc AS ahora FROM s WHERE anadida UNION ALL SELECT key, 'eliminada', na, NULL FROM s WHERE eliminada UNION ALL SELECT key, 'hash_cambiado', na, nc FROM s WHERE hash_cambiado UNION ALL SELECT key, 'estado_cambiado', antes, ahora FROM s WHERE estado_cambiado""")
def snapshot_diff(spark, d):
    return snapshots.diff(*_ends(spark, d)).orderBy("tipo", "key")


_COUNTERS = "counters AS (SELECT snap_ord, count(*) FILTER (WHERE aqui) AS n_actas, count(*) FILTER (WHERE anadida) AS anadida, count(*) FILTER (WHERE eliminada) AS eliminada, count(*) FILTER (WHERE hash_cambiado) AS hash_cambiado, count(*) FILTER (WHERE estado_cambiado) AS estado_cambiado, count(*) FILTER (WHERE eliminada) > 0 OR count(*) FILTER (WHERE hash_cambiado) > 0 AS alerta FROM steps GROUP BY snap_ord)"


@query(f"WITH {b.SNAPSHOTS}, {b.STEPS}, {_COUNTERS} SELECT * FROM counters")
def snapshot_counters(spark, d):
    return snapshots.counters(b.snapshots(spark, d))


@query(f"WITH {b.SNAPSHOTS}, {b.STEPS}, {_COUNTERS} SELECT snap_ord, eliminada, hash_cambiado FROM counters WHERE alerta")
def snapshot_alerts(spark, d):
    return snapshots.counters(b.snapshots(spark, d)).where("alerta").select("snap_ord", "eliminada", "hash_cambiado")


@query(f"WITH {b.SNAPSHOTS} SELECT status, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM snaps GROUP BY status")
def status_distribution(spark, d):
    return sheets.histogram(b.snapshots(spark, d), "status").orderBy(F.desc("n"), "status")


@query(f"""WITH {b.SNAPSHOTS} SELECT p.status AS antes, {", ".join(f"count(*) FILTER (WHERE n.status = '{k}') AS a{k}" for k in range(1, 6))} FROM snaps p JOIN snaps n ON p.key = n.key AND n.snap_ord = p.snap_ord + 1, last WHERE n.snap_ord = last AND p.status <> n.status GROUP BY p.status""")
def status_transitions(spark, d):
    found = snapshots.transitions(*_ends(spark, d), [str(k) for k in range(1, 6)])
    return found.select("antes", *[F.col(str(k)).alias(f"a{k}") for k in range(1, 6)])


@query(f"WITH {b.SNAPSHOTS} SELECT snap_ord, snap_ts, count(*) AS n_actas, count(*) - lag(count(*)) OVER (ORDER BY snap_ord) AS cambio FROM snaps GROUP BY snap_ord, snap_ts")
def growth_curve(spark, d):
    return snapshots.growth(b.snapshots(spark, d))


_HIST = f"WITH {b.SNAPSHOTS}, {b.HISTORY} "


@query(_HIST + "SELECT key, first_seen, name, status, n_cambios, n_estados, eliminada_ts FROM hist")
def sheet_history(spark, d):
    h = snapshots.history(b.snapshots(spark, d))
    return h.select("key", "first_seen", "name", "status", F.size("hash_changes").cast("bigint").alias("n_cambios"), F.size("estado_changes").cast("bigint").alias("n_estados"), "eliminada_ts")


@query(_HIST + "SELECT key, first_seen, n_cambios, tardio, eliminada, regresion, substr(CASE WHEN n_cambios > 0 THEN before0 ELSE name END, 1, 16) AS hash_inicial, substr(name, 1, 16) AS hash_actual FROM hist WHERE n_cambios > 0 OR eliminada")
def audit_report(spark, d):
    report = snapshots.audit_order(snapshots.audit_report(snapshots.history(b.snapshots(spark, d)), 240))
    return report.select("key", "first_seen", "n_cambios", "tardio", "eliminada", "regresion", "hash_inicial", "hash_actual")


@query(_HIST + "SELECT count(*) AS actas, count(*) FILTER (WHERE n_cambios > 0) AS con_cambio, count(*) FILTER (WHERE tardio) AS tardias, count(*) FILTER (WHERE eliminada) AS eliminadas, count(*) FILTER (WHERE (n_cambios > 0 OR eliminada) AND regresion) AS regresiones, round(100.0 * count(*) FILTER (WHERE n_cambios > 0) / greatest(count(*), 1), 2) AS tasa_base FROM hist")
def audit_base_rate(spark, d):
    return snapshots.base_rate(snapshots.history(b.snapshots(spark, d)), 240)


@query(_HIST + "SELECT key, first_seen FROM hist WHERE tardio")
def late_changes(spark, d):
    return snapshots.audited(snapshots.history(b.snapshots(spark, d)), 240).where("tardio").select("key", "first_seen")


@query(_HIST + "SELECT key, status FROM hist WHERE regresion")
def status_regressions(spark, d):
    return snapshots.audited(snapshots.history(b.snapshots(spark, d))).where("regresion").select("key", "status")


@query(_HIST + "SELECT key, name, eliminada_ts FROM hist WHERE eliminada")
def removed_keys(spark, d):
    return snapshots.history(b.snapshots(spark, d)).where("eliminada_ts IS NOT NULL").select("key", "name", "eliminada_ts")


@query(f"""WITH {b.SNAPSHOTS}, {b.HISTORY}, {b.checked_sql('zero_all')} SELECT h2.key, h2.n_cambios, h2.eliminada, coalesce(k.alerta, '') AS estado FROM hist h2 LEFT JOIN checked k ON k.mesa = h2.key WHERE h2.n_cambios > 0 OR h2.eliminada""")
def audit_with_state(spark, d):
    report = snapshots.audit_report(snapshots.history(b.snapshots(spark, d)), 240)
    state = _checked(spark, d).select(F.col("mesa").alias("key"), "alerta")
    return report.join(state, "key", "left").select("key", "n_cambios", "eliminada", F.coalesce("alerta", F.lit("")).alias("estado"))


# chain


@query(f"WITH RECURSIVE {b.CHAIN} SELECT * FROM chain")
def chain_build(spark, d):
    return chain.build(b.chain_entries(spark, d), ["user_id"])


@query(f"""WITH RECURSIVE {b.CHAIN}, tampered AS (SELECT user_id, seq, ts, CASE WHEN seq % 11 = 5 THEN sha256(sha_contenido) ELSE sha_contenido END AS sha_contenido, eslabon, eslabon_anterior FROM chain),
p AS (SELECT *, coalesce(lag(eslabon) OVER (PARTITION BY user_id ORDER BY seq), 'GENESIS') AS prev FROM tampered) SELECT user_id, seq, eslabon_anterior = prev AND sha256(prev || sha_contenido || ts) = eslabon AS ok FROM p""")
def chain_verify(spark, d):
    links = chain.build(b.chain_entries(spark, d), ["user_id"])
    tampered = links.withColumn("sha_contenido", F.when(F.col("seq") % 11 == 5, F.sha2(F.col("sha_contenido").cast("binary"), 256)).otherwise(F.col("sha_contenido")))
    return chain.verify(tampered, ["user_id"]).select("user_id", "seq", "ok")


# manifest


@query("""SELECT s.s_suppkey, lpad(n.n_regionkey::VARCHAR, 2, '0') AS dep, lpad(s.s_nationkey::VARCHAR, 3, '0') AS muni, CASE WHEN c.n > 0 THEN r.r_name ELSE '' END AS departamento, CASE WHEN c.n > 0 THEN n.n_name ELSE '' END AS municipio
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1) c ON c.c_nationkey = s.s_nationkey""")
def geo_enrichment(spark, d):
    s, n, r, c = (table(spark, d, t) for t in ("supplier", "nation", "region", "customer"))
    place = [keys.pad_code("n_regionkey", 2).alias("dep"), keys.pad_code("n_nationkey", 3).alias("muni"), F.lit("000").alias("zona"), F.lit("00").alias("puesto")]
    known = n.join(c.where("c_mktsegment = 'BUILDING'"), F.col("n_nationkey") == F.col("c_nationkey"), "left_semi").join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))  # 5 regions
    tree = known.select(*place, F.col("r_name").alias("departamento"), F.col("n_name").alias("municipio"), F.lit("").alias("nombre_zona"), F.lit("").alias("nombre_puesto"))
    rows = s.join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", *place)  # 25 nations
    return manifest.enrich(rows, tree).select("s_suppkey", "dep", "muni", "departamento", "municipio")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_custkey % 100 IN (1, 7) ORDER BY o_orderkey LIMIT 50")
def record_filter_limit(spark, d):
    o = table(spark, d, "orders").withColumn("dep", (F.col("o_custkey") % 100).cast("string"))
    return o.where(keys.copy_filter("F,P", "o_orderstatus") & keys.copy_filter("1, 7", "dep")).orderBy("o_orderkey").limit(50).select("o_orderkey", "o_orderstatus")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def resume_anti_join(spark, d):
    done = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return readings.pending(table(spark, d, "orders").select("o_orderkey"), done, "o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')")
def key_intersection(spark, d):
    li = table(spark, d, "lineitem")
    both = li.where("l_returnflag = 'R'").select("l_orderkey").intersect(li.where("l_returnflag = 'A'").select("l_orderkey"))
    return table(spark, d, "orders").join(both, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("SELECT 'A' AS fuente, o_orderstatus AS estado, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'B', l_linestatus, count(*) FROM lineitem GROUP BY ALL")
def tagged_union(spark, d):
    n = F.count(F.lit(1)).alias("n")
    one = table(spark, d, "orders").groupBy(F.lit("A").alias("fuente"), F.col("o_orderstatus").alias("estado")).agg(n)
    return one.unionByName(table(spark, d, "lineitem").groupBy(F.lit("B").alias("fuente"), F.col("l_linestatus").alias("estado")).agg(n))


# ink and layout

_FLAGS = ["suma_vacia_con_votos", "sin_ningun_voto", "suma_con_todo_vacio", "todos_candidatos_llenos", "agregados_sin_suma", "e11_vacio_con_votos"]


def _ink(spark, d):
    rows = b.ink(spark, d)
    return rows.select("mesa", *[v.alias(k) for k, v in checks.ink_flags({c: F.col(c) for c in rows.columns if c != "mesa"}).items()])


@query(f"WITH {b.INK} SELECT mesa, {', '.join(_FLAGS)}, n_banderas, n_candidatos, prioridad FROM flags")
def ink_flags(spark, d):
    return _ink(spark, d).select("mesa", *_FLAGS, "n_banderas", "n_candidatos", "prioridad")


@query(f"WITH {b.INK} SELECT mesa, prioridad, n_banderas FROM flags WHERE prioridad <> 'OK'")
def review_list(spark, d):
    rows = _ink(spark, d).where("prioridad <> 'OK'")
    return rows.orderBy(F.when(F.col("prioridad") == "ALTA", 0).otherwise(1), F.desc("n_banderas"), "mesa").select("mesa", "prioridad", "n_banderas")


@query(f"WITH {b.INK} SELECT prioridad, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM flags GROUP BY prioridad")
def review_counts(spark, d):
    return sheets.histogram(_ink(spark, d), "prioridad")


_W, _H, _FILL = "l_quantity / 50", "l_discount * 6", "l_tax * 10"
_TYPE = f"CASE WHEN {_H} < 0.18 AND {_W} > 2.2 * ({_H}) THEN 'guion' WHEN {_FILL} > 0.5 AND {_H} < 0.30 THEN 'punto' WHEN {_FILL} <= 0.45 OR {_H} >= 0.40 THEN 'digito' ELSE 'marca' END"


def _blocks(spark, d):
    return table(spark, d, "lineitem").withColumn("tipo", checks.block_type(F.expr(_W), F.expr(_H), F.expr(_FILL)))


@query(f"SELECT l_returnflag, {_TYPE} AS tipo, count(*) AS n FROM lineitem GROUP BY ALL")
def position_classify(spark, d):
    return _blocks(spark, d).groupBy("l_returnflag", "tipo").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH t AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE {_TYPE} = 'digito') AS dig, count(*) FILTER (WHERE {_TYPE} = 'guion') AS gui, count(*) FILTER (WHERE {_TYPE} = 'marca') AS mar FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, n AS n_posiciones, array_to_string(list_filter([CASE WHEN n > 3 THEN 'mas_de_3_posiciones' END, CASE WHEN mar > 0 THEN 'posicion_ambigua' END, CASE WHEN gui > 0 THEN 'contiene_guion' END, CASE WHEN dig = 0 AND gui = 0 THEN 'espacio_sin_anular' END], lambda x: x IS NOT NULL), ';') AS banderas FROM t""")
def box_flags(spark, d):
    boxes = _blocks(spark, d).groupBy("l_orderkey").agg(F.collect_list("tipo").alias("tipos"))
    return boxes.select("l_orderkey", F.size("tipos").cast("bigint").alias("n_posiciones"), F.concat_ws(";", checks.box_flags(F.col("tipos"))).alias("banderas"))


_LINES = "SELECT DISTINCT l_suppkey, l_partkey FROM lineitem"


@query(f"""WITH g AS (SELECT *, CASE WHEN l_partkey - lag(l_partkey) OVER (PARTITION BY l_suppkey ORDER BY l_partkey) <= 3 THEN 0 ELSE 1 END AS new FROM ({_LINES})),
r AS (SELECT *, sum(new) OVER (PARTITION BY l_suppkey ORDER BY l_partkey)::BIGINT AS run FROM g) SELECT l_suppkey, run, min(l_partkey) AS inicio, max(l_partkey) AS fin, count(*) AS n FROM r GROUP BY ALL""")
def run_length_groups(spark, d):
    return layout.runs(table(spark, d, "lineitem"), "l_suppkey", "l_partkey", 3)


@query(f"""WITH g AS (SELECT *, lead(l_partkey, 1) OVER w - l_partkey AS g0, lead(l_partkey, 2) OVER w - lead(l_partkey, 1) OVER w AS g1, lead(l_partkey, 3) OVER w - lead(l_partkey, 2) OVER w AS g2 FROM ({_LINES}) WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_partkey)),
s AS (SELECT l_suppkey, l_partkey, greatest(g0, g1, g2) - least(g0, g1, g2) AS dispersion FROM g WHERE g0 > 1 AND g0 < 20 AND g1 > 1 AND g1 < 20 AND g2 > 1 AND g2 < 20)
SELECT l_suppkey, l_partkey AS inicio, dispersion FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY dispersion, l_partkey) AS n FROM s) WHERE n = 1""")
def regular_lines(spark, d):
    lines = layout.distinct_positions(table(spark, d, "lineitem"), "l_suppkey", "l_partkey")
    return layout.regular_lines(lines, "l_suppkey", "l_partkey", 3, 1, 20)


@query("""WITH c AS (SELECT p_partkey, (p_size % 9)::INT AS a, (p_partkey % 10 + 1)::INT AS b FROM part) SELECT p_partkey, round(100.0::DOUBLE * a * b / 396, 4) AS tinta,
CASE WHEN a = 0 THEN 'vacio' WHEN a / 20.0 < 0.18 AND b / 20.0 > 2.2 * (a / 20.0) THEN 'guion' WHEN a < 6 THEN 'punto' WHEN a >= 8 THEN 'digito' ELSE 'marca' END AS tipo FROM c""")
def crop_types(spark, d):
    rows = b.crops(spark, d).select("p_partkey", F.round(ink.ink_column("pixeles", "alto"), 4).alias("tinta"), F.explode_outer(ink.blocks_column("pixeles", "alto")).alias("x"))
    return rows.select("p_partkey", "tinta", checks.block_type(F.col("x.ancho"), F.col("x.alto"), F.col("x.relleno")).alias("tipo"))


_SHEETS = """s AS (SELECT s_suppkey::VARCHAR AS mesa, s_suppkey % 5 AS k, s_suppkey % 4 AS a FROM supplier)"""


@query(f"""WITH {_SHEETS} SELECT mesa, (k > 0)::INT AS ok, CASE k WHEN 0 THEN 0 WHEN 1 THEN 10 WHEN 2 THEN 20 ELSE 21 END AS n_casillas, CASE WHEN k > 0 THEN 1 END AS uso_plantilla,
CASE k WHEN 0 THEN 'EXCEPCIÓN: page without pixels' WHEN 1 THEN 'nivelacion por respaldo (plantilla)' ELSE 'nivelacion por respaldo (plantilla) | agregados por respaldo (plantilla)' END AS aviso,
CASE WHEN k > 0 THEN round(100.0::DOUBLE * 30 * a / 1909, 2) END AS tinta_cand_03, CASE WHEN k > 0 THEN (a > 0)::INT END AS tiene_cand_03, CASE WHEN k > 1 THEN 0.0 END AS tinta_SUMA_TOTAL, CASE WHEN k > 2 THEN 0.0 END AS tinta_CONSTANCIAS,
CASE WHEN k > 0 THEN CASE WHEN a > 0 THEN 2 ELSE 1 END END AS n_banderas, CASE WHEN k > 0 THEN 'ALTA' END AS prioridad FROM s""")
def batch_extraction(spark, d):
    columns = ["mesa", "ok", "n_casillas", "uso_plantilla", "aviso", "tinta_cand_03", "tiene_cand_03", "tinta_SUMA_TOTAL", "tinta_CONSTANCIAS", "n_banderas", "prioridad"]
    return extract.extract_sheets(b.pages(spark, d)).select(*columns)


@query(f"""WITH {_SHEETS}, l AS (SELECT unnest(range(1, 14)) AS n), t AS (SELECT unnest(['TOTAL_E11', 'TOTAL_URNA', 'TOTAL_INCINERADOS', 'BLANCO', 'NULO', 'NO_MARCADO', 'SUMA_TOTAL']) AS etiqueta, unnest([1, 1, 1, 2, 2, 2, 2]) AS pagina),
x AS (SELECT 'cand_' || lpad(n::VARCHAR, 2, '0') AS etiqueta, CASE WHEN n < 8 THEN 1 ELSE 2 END AS pagina FROM l UNION ALL SELECT * FROM t)
SELECT mesa, etiqueta, CASE WHEN etiqueta = 'cand_03' AND a > 0 THEN 1 ELSE 0 END AS n_posiciones, CASE WHEN etiqueta <> 'cand_03' OR a = 0 THEN '' ELSE 'guion' END AS tipos_posicion,
CASE WHEN etiqueta <> 'cand_03' OR a = 0 THEN 'casilla_vacia;espacio_sin_anular' ELSE 'contiene_guion' END AS banderas FROM s, x WHERE k > 0 AND x.pagina <= least(k, 2) UNION ALL SELECT mesa, 'ERROR', NULL, NULL, NULL FROM s WHERE k = 0""")
def crop_export(spark, d):
    found = extract.export_crops(b.pages(spark, d)).select(keys.parse_path("pdf")["mesa"].alias("mesa"), "etiqueta", "n_posiciones", "tipos_posicion", "banderas")
    return found


def _rows(values) -> str:
    """A SQL list of rows; numbers as doubles."""
    return "(VALUES " + ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v!r}::DOUBLE" for v in row) + ")" for row in values) + ")"


_SIZES = "SELECT p_partkey::VARCHAR AS pdf, 1000 + p_size * 13 AS ancho, (2000 + p_partkey % 97)::INT AS alto FROM part"


def _sizes(spark, d):
    return table(spark, d, "part").selectExpr("string(p_partkey) AS pdf", "1000 + p_size * 13 AS ancho", "int(2000 + p_partkey % 97) AS alto")


@query(f"""SELECT pdf, etiqueta, floor(ancho * {schema.SECOND_ROUND_X[0]!r}::DOUBLE + 1e-9)::INT AS x0, floor(ancho * {schema.SECOND_ROUND_X[1]!r}::DOUBLE + 1e-9)::INT AS x1, floor(alto * y0 + 1e-9)::INT AS y0, floor(alto * y1 + 1e-9)::INT AS y1
FROM ({_SIZES}), {_rows([(n, c - h / 2, c + h / 2) for n, c, h in schema.SECOND_ROUND])} r(etiqueta, y0, y1)""")
def second_round_geometry(spark, d):
    return box_ops.second_round_boxes(spark, _sizes(spark, d))


@query(f"""WITH c AS (SELECT pdf, etiqueta, ancho, floor(ancho * {schema.FIRST_ROUND_X[0]!r}::DOUBLE)::INT + floor(ancho * 0.015::DOUBLE)::INT AS x, floor(alto * y0)::INT AS top, floor(alto * dy)::INT AS alto1
FROM ({_SIZES}), {_rows([(n, a, e - a) for n, a, e in schema.FIRST_ROUND_AGGREGATES])} r(etiqueta, y0, dy)), i AS (SELECT *, floor(alto1 * 0.08::DOUBLE)::INT AS inset FROM c)
SELECT pdf, etiqueta, x, top + inset AS y, floor(ancho * {schema.FIRST_ROUND_X[1]!r}::DOUBLE)::INT - floor(ancho * {schema.FIRST_ROUND_MARGIN!r}::DOUBLE)::INT - x AS w, alto1 - 2 * inset AS h FROM i""")
def fallback_geometry(spark, d):
    return box_ops.fallback_aggregates(_sizes(spark, d))


@query("""SELECT l_orderkey AS pdf, count(*) FILTER (WHERE l_linenumber < 6) AS candidatos, count(*) FILTER (WHERE l_linenumber = 7) AS constancias,
count(*) FILTER (WHERE l_linenumber < 6) = 5 AND count(*) FILTER (WHERE l_linenumber = 7) = 1 AS ok FROM lineitem GROUP BY l_orderkey""")
def sheet_completeness(spark, d):
    label = F.when(F.col("l_linenumber") < 6, F.concat(F.lit("cand_0"), F.col("l_linenumber"))).when(F.col("l_linenumber") == 7, schema.NOTES).otherwise("BLANCO")
    return box_ops.complete(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("pdf"), label.alias("etiqueta")), candidates=5)


@query("""SELECT o_orderkey AS pdf, coalesce(t < 1, TRUE) AS total_vacio FROM (SELECT *, CASE WHEN o_orderkey % 11 <> 0 THEN (o_orderkey % 5) * 0.5 END AS t FROM orders) WHERE o_orderkey % 7 = 0 OR o_orderkey % 9 IN (0, 1)""")
def template_fallbacks(spark, d):
    k = F.col("o_orderkey")
    notice = F.when(k % 9 == 0, "Nivelacion por respaldo (PLANTILLA)").when(k % 9 == 1, "sin anclaje").when(k % 2 == 0, "otra cosa")
    rows = table(spark, d, "orders").select(k.alias("pdf"), (k % 7 == 0).cast("int").alias("uso_plantilla"), notice.alias("aviso"), F.when(k % 11 != 0, k % 5 * 0.5).alias("tinta_SUMA_TOTAL"))
    return box_ops.fell_back(rows).select("pdf", "total_vacio")


# readers

_NOW = f"(WITH {b.checked_sql('zero_all')} SELECT mesa, alerta FROM checked)"
_BEFORE = f"(WITH {b.checked_sql('strict')} SELECT mesa, alerta FROM checked)"


@query(f"SELECT mesa FROM {_NOW} n WHERE alerta = 'NINGUNA' AND mesa NOT IN (SELECT mesa FROM {_BEFORE} v WHERE alerta = 'NINGUNA')")
def newly_reconciled(spark, d):
    return training.newly_reconciled(_checked(spark, d), _checked(spark, d, "strict"), ["mesa"])


@query(f"""WITH now AS {_NOW}, before AS {_BEFORE}, m AS (SELECT alerta AS medida, count(*) AS n FROM now GROUP BY 1 UNION ALL SELECT 'BASE', count(*) FROM before WHERE alerta = 'NINGUNA' HAVING count(*) > 0
UNION ALL SELECT 'NUEVAS', count(*) FROM now WHERE alerta = 'NINGUNA' AND mesa NOT IN (SELECT mesa FROM before WHERE alerta = 'NINGUNA') HAVING count(*) > 0) SELECT medida, n, round(100.0::DOUBLE * n / (SELECT count(*) FROM now), 1) AS pct FROM m""")
def reader_evaluation(spark, d):
    return training.evaluate(_checked(spark, d), _checked(spark, d, "strict"), ["mesa"])


@query("""WITH r AS (SELECT p_partkey, p_partkey % 50 AS mesa, CASE WHEN p_size < 25 THEN 'cand_01' ELSE 'CANDIDATO_01' END AS etiqueta_celda, (p_size * (p_partkey % 41))::VARCHAR AS v, unnest(range(3)) AS pos FROM part),
x AS (SELECT *, CASE WHEN length(v) < 4 THEN substr(lpad(v, 3, '0'), pos + 1, 1) ELSE '' END AS sugerencia, (mesa IN (SELECT s_suppkey FROM supplier WHERE s_nationkey % 2 = 0))::INT AS confianza FROM r)
SELECT p_partkey || '-' || pos AS caja, mesa, etiqueta_celda, CASE WHEN starts_with(etiqueta_celda, 'cand') THEN 'CAND' ELSE 'AGREG' END AS tipo, pos::INT AS pos, CASE WHEN confianza = 1 THEN sugerencia ELSE '' END AS etiqueta_digito, sugerencia, confianza FROM x""")
def training_boxes(spark, d):
    k = F.col("p_partkey")
    names = F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda p: F.concat_ws("-", k.cast("string"), p.cast("string")))
    rows = table(spark, d, "part").select((k % 50).alias("mesa"), F.when(F.col("p_size") < 25, "cand_01").otherwise("CANDIDATO_01").alias("etiqueta"), (F.col("p_size") * (k % 41)).alias("numero"), names.alias("cajas"))
    trusted = table(spark, d, "supplier").where("s_nationkey % 2 = 0").select(F.col("s_suppkey").alias("mesa"))
    return training.export_boxes(rows, trusted, ["mesa"]).withColumn("tipo", training.cell_type("etiqueta_celda"))


# digits


@query(f"WITH {b.DIGITS} SELECT vec_id, k::INT AS pos, d1::INT AS d1, round(p1, 4) AS p1, d2::INT AS d2, round(p2, 4) AS p2 FROM top")
def digit_topk(spark, d):
    rows = b.digits(spark, d).select("vec_id", F.posexplode("posiciones").alias("pos", "t"))
    return rows.select("vec_id", "pos", F.col("t")[0]["d"].alias("d1"), F.round(F.col("t")[0]["p"], 4).alias("p1"), F.col("t")[1]["d"].alias("d2"), F.round(F.col("t")[1]["p"], 4).alias("p2"))


_VALUES = """base AS (SELECT vec_id, sum(d1 * power(10, 2 - k))::INT AS v FROM top GROUP BY vec_id),
vals AS (SELECT vec_id, v AS valor, 0.0::DOUBLE AS coste FROM base UNION ALL SELECT t.vec_id, (v + (d2 - d1) * power(10, 2 - k))::INT, ln(greatest(p1, 1e-9) / greatest(p2, 1e-9)) FROM top t JOIN base USING (vec_id) WHERE ln(greatest(p1, 1e-9) / greatest(p2, 1e-9)) <= 2.5)"""


@query(f"WITH {b.DIGITS}, {_VALUES} SELECT vec_id, valor, round(coste, 4) AS coste FROM vals")
def value_candidates(spark, d):
    rows = b.digits(spark, d).select("vec_id", F.explode(decode.value_candidates(F.col("posiciones"))).alias("c"))
    return rows.select("vec_id", F.col("c.valor").cast("int").alias("valor"), F.round("c.coste", 4).alias("coste"))


def _decoded(spark, d):
    found = decode.decode(b.swaps(spark, d))
    return found.withColumn("coste", F.round("coste", 6)).withColumn("cajas", F.concat_ws(",", F.col("cajas").cast("array<string>")))


@query(f"WITH {b.SWAPS} SELECT * FROM decoded")
def decode_sheets(spark, d):
    return _decoded(spark, d).select("mesa", "estado", "n_cambios", "coste", "cajas")


@query(f"WITH {b.SWAPS} SELECT estado, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM decoded GROUP BY estado")
def decode_histogram(spark, d):
    return sheets.histogram(_decoded(spark, d), "estado")


_PSEUDO = """lab AS (SELECT t.vec_id AS caja, t.vec_id // 10 AS mesa, CASE WHEN t.vec_id % 10 = 3 THEN 'auto' WHEN t.vec_id % 10 = 6 THEN 'manual' ELSE '' END AS f, (t.vec_id % 10)::VARCHAR AS e, d1, p1, (t.vec_id // 10) % 3 = 0 AS cuadra FROM top t WHERE k = 0),
pl AS (SELECT caja, mesa, CASE WHEN f <> '' THEN e WHEN cuadra OR p1 >= 0.5 THEN d1::VARCHAR ELSE '' END AS etiqueta, CASE WHEN f <> '' THEN f WHEN cuadra THEN 'validado' WHEN p1 >= 0.5 THEN 'pseudo' ELSE '' END AS fuente, round(p1, 4) AS confianza FROM lab)"""


def _pseudo(spark, d):
    rows = b.digits(spark, d).select(F.col("vec_id").alias("caja"), F.expr("vec_id div 10").alias("mesa"), F.col("posiciones")[0][0].alias("t"))
    source = F.when(F.col("caja") % 10 == 3, "auto").when(F.col("caja") % 10 == 6, "manual").otherwise("")
    labels = rows.select("caja", "mesa", (F.col("caja") % 10).cast("string").alias("etiqueta"), source.alias("fuente"))
    guesses = rows.select("caja", F.col("t.d").alias("digito"), F.col("t.p").alias("confianza"), (F.col("mesa") % 3 == 0).alias("cuadra"))
    return decode.pseudo_labels(labels, guesses, 0.5)


@query(f"WITH {b.DIGITS}, {_PSEUDO} SELECT * FROM pl")
def pseudo_labels(spark, d):
    return _pseudo(spark, d).withColumn("confianza", F.round("confianza", 4))


@query(f"WITH {b.DIGITS}, {_PSEUDO} SELECT caja, confianza FROM pl WHERE fuente = ''")
def review_queue(spark, d):
    return decode.review_queue(_pseudo(spark, d)).select("caja", F.round("confianza", 4).alias("confianza"))


@query(f"WITH {b.DIGITS}, {_PSEUDO} SELECT fuente, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct FROM pl GROUP BY fuente")
def label_sources(spark, d):
    return sheets.histogram(_pseudo(spark, d), "fuente")


@query("WITH n AS (SELECT label AS clase, count(*) AS n FROM embeddings GROUP BY label), c AS (SELECT unnest(range(10))::INT AS clase) SELECT c.clase, coalesce(n.n, 0) AS n, round((SELECT count(*) FROM embeddings) / (10 * greatest(coalesce(n.n, 0), 1)), 6) AS peso FROM c LEFT JOIN n USING (clase)")
def class_weights(spark, d):
    return decode.class_weights(table(spark, d, "embeddings"), "label")


@query(f"WITH {b.DIGITS} SELECT label AS clase, count(*) AS n, count(*) FILTER (WHERE d1 = label) AS aciertos, round(avg(p1), 4) AS confianza FROM top WHERE k = 0 GROUP BY label")
def digit_accuracy(spark, d):
    rows = b.digits(spark, d).select(F.col("label").alias("clase"), F.col("posiciones")[0][0].alias("t"))
    return rows.groupBy("clase").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("t.d") == F.col("clase")).alias("aciertos"), F.round(F.avg("t.p"), 4).alias("confianza"))


# samples, groups, duplicates

_MARK = "md5('0:' || l_orderkey::VARCHAR)"


@query(f"""WITH g AS (SELECT m, row_number() OVER (ORDER BY m) AS r, count(*) OVER () AS c FROM (SELECT DISTINCT {_MARK} AS m FROM lineitem))
SELECT l_orderkey, l_linenumber, count(*) AS n, bool_and(r <= greatest(1, floor(c * 0.2))) AS validation FROM lineitem JOIN g ON m = {_MARK} GROUP BY l_orderkey, l_linenumber""")
def group_split(spark, d):
    rows = sheets.group_split(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey")
    return rows.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.bool_and("validation").alias("validation"))


@query("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY md5('42:' || o_orderkey::VARCHAR), o_orderkey LIMIT 100")
def seeded_sample(spark, d):
    return sheets.seeded_sample(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 100)


@query("SELECT split_part(url, '/', 3) AS host, min(url) AS url FROM pages GROUP BY ALL")
def one_per_group(spark, d):
    return sheets.one_per_group(table(spark, d, "pages").withColumn("host", F.get(F.split("url", "/"), F.lit(2))), "host", "url")


@query("SELECT sha256(text) AS sha, count(*) AS n, min(doc_id) AS primero FROM documents GROUP BY ALL HAVING count(*) > 1")
def duplicate_hashes(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    return rows.groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("primero")).where("n > 1")


@query("SELECT quality, toxic, count(*) AS n, sum(n_chars)::BIGINT AS caracteres FROM labels JOIN documents USING (doc_id) GROUP BY ALL")
def label_review(spark, d):
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return rows.groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("caracteres"))


@query("SELECT o_orderstatus AS estado, count(*) AS n, round(count(*) / 60.0, 4) AS por_segundo FROM orders GROUP BY ALL")
def download_status(spark, d):
    n = F.count(F.lit(1))
    return table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("estado")).agg(n.alias("n"), F.round(n / 60.0, 4).alias("por_segundo"))


@query("SELECT page_id % 8 AS intento, min(least(60.0, 1.0 * power(2.0, page_id % 8 - 1))) AS espera FROM pages GROUP BY ALL")
def backoff_schedule(spark, d):
    rows = table(spark, d, "pages").select((F.col("page_id") % 8).alias("intento"))
    return rows.groupBy("intento").agg(F.min(checks.backoff(F.col("intento"))).alias("espera"))
