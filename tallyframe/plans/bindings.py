"""The library's inputs, as they are found in the driver's tables; each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Labels of the line numbers 1 to 7.
LINES = ["cand_01", "cand_02", "cand_03", "cand_04", "cand_05", "BLANCO", "NULO"]
_LABEL = "CASE l_linenumber " + " ".join(f"WHEN {k + 1} THEN '{x}'" for k, x in enumerate(LINES)) + " END"


def copies(spark, sf_dir):
    """Three copies (return flags) of a box (line number) of a table (supplier)."""
    value = (F.sum("l_quantity").cast("bigint") % 5 * 50).alias("valor")
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("mesa"), F.upper(F.expr(_LABEL)).alias("etiqueta"), F.col("l_returnflag").alias("ejemplar")).agg(value)


COPIES = f"copies AS (SELECT l_suppkey AS mesa, upper({_LABEL}) AS etiqueta, l_returnflag AS ejemplar, CAST(sum(l_quantity) AS BIGINT) % 5 * 50 AS valor FROM lineitem GROUP BY ALL)"
PAIRS = """pairs AS (SELECT a.mesa, a.etiqueta, a.ejemplar AS ej_a, a.valor AS valor_a, b.ejemplar AS ej_b, b.valor AS valor_b, b.valor - a.valor AS dif, abs(b.valor - a.valor) AS abs_dif,
  CASE WHEN abs(b.valor - a.valor) % 100 = 0 THEN 1 ELSE 0 END AS multiplo_100 FROM copies a JOIN copies b ON a.mesa = b.mesa AND a.etiqueta = b.etiqueta AND a.ejemplar < b.ejemplar AND a.valor <> b.valor)"""


def readings(spark, sf_dir):
    """Readings with repeats: table (order), box (line number), value and an input order."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("mesa"), F.expr(_LABEL).alias("etiqueta"), F.col("l_quantity").cast("int").alias("valor"),
        (F.col("l_partkey") * 10_000_000 + F.col("l_suppkey") * 100 + F.col("l_quantity").cast("bigint")).alias("ord"),
    )


READINGS = f"readings AS (SELECT l_orderkey AS mesa, {_LABEL} AS etiqueta, CAST(l_quantity AS INT) AS valor, l_partkey * 10000000 + l_suppkey * 100 + CAST(l_quantity AS BIGINT) AS ord FROM lineitem)"


def sheets(spark, sf_dir):
    """Sheets: votes of each box summed; the written and the registered total are off by one for some."""
    votes = F.col("l_quantity").cast("bigint")
    parts = [F.sum(F.when(F.expr(_LABEL) == x, votes)).alias(x) for x in LINES]
    has = [F.coalesce(F.bool_or(F.expr(_LABEL) == x), F.lit(False)).alias(f"has_{x}") for x in LINES]
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("mesa")).agg(*parts, *has, F.sum(votes).alias("_all"), F.sum("l_partkey").alias("_p"))
    off = lambda n: F.col("_all") + (F.col("_p") % n == 0).cast("int")
    rows = rows.withColumn("SUMA_TOTAL", off(5)).withColumn("TOTAL_E11", off(7)).withColumn("has_SUMA_TOTAL", F.lit(True)).withColumn("has_TOTAL_E11", F.lit(True))
    return rows.withColumn("NO_MARCADO", F.lit(0).cast("bigint")).withColumn("has_NO_MARCADO", F.lit(True)).drop("_all", "_p")


SHEETS = (
    "sheets AS (SELECT l_orderkey AS mesa, "
    + ", ".join(f"sum(CASE WHEN l_linenumber = {k + 1} THEN CAST(l_quantity AS BIGINT) END)::BIGINT AS {x}" for k, x in enumerate(LINES))
    + ", (sum(CAST(l_quantity AS BIGINT)) + CASE WHEN sum(l_partkey) % 5 = 0 THEN 1 ELSE 0 END)::BIGINT AS SUMA_TOTAL, (sum(CAST(l_quantity AS BIGINT)) + CASE WHEN sum(l_partkey) % 7 = 0 THEN 1 ELSE 0 END)::BIGINT AS TOTAL_E11 FROM lineitem GROUP BY l_orderkey)"
)


def checked_sql(policy: str) -> str:
    """CTEs up to ``checked``: sheets with the arithmetic check."""
    value = (lambda x: f"coalesce({x}, 0)") if policy == "zero_all" else (lambda x: x)
    names = LINES[:5], LINES[5:]
    cols = ", ".join(f"{value(x)} AS {x}" for x in [*names[0], *names[1], "SUMA_TOTAL", "TOTAL_E11"])
    parts = " + ".join(LINES)
    return f"""{SHEETS}, f AS (SELECT mesa, 0::BIGINT AS NO_MARCADO, {cols} FROM sheets), g AS (SELECT *, {parts} + NO_MARCADO AS calculada FROM f),
h AS (SELECT *, calculada - SUMA_TOTAL AS dif_suma, SUMA_TOTAL - TOTAL_E11 AS dif_e11, calculada = SUMA_TOTAL AS cuadra_suma, SUMA_TOTAL = TOTAL_E11 AS cuadra_e11, calculada IS NULL AS incompleta FROM g),
checked AS (SELECT *, CASE WHEN incompleta THEN 'INCOMPLETO' WHEN (cuadra_suma IS FALSE)::INT + (cuadra_e11 IS FALSE)::INT = 2 THEN 'ALTA' WHEN (cuadra_suma IS FALSE)::INT + (cuadra_e11 IS FALSE)::INT = 1 THEN 'MEDIA' ELSE 'NINGUNA' END AS alerta FROM h)"""


def votes(spark, sf_dir):
    """Votes (orders) of each table (customer), with the place (region, nation)."""
    c, o, n = (table(spark, sf_dir, t) for t in ("customer", "orders", "nation"))
    per = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("votos"))
    placed = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)  # 25 nations, at any scale
    return placed.join(per, "c_custkey").select(F.col("n_regionkey").alias("dep"), F.col("n_nationkey").alias("muni"), F.col("c_custkey").alias("mesa"), "votos")


def census(spark, sf_dir):
    """Eligible voters of each place."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    per = c.groupBy("c_nationkey").agg((F.count(F.lit(1)) * 10).alias("total"), F.count(F.lit(1)).alias("mesas"))
    return per.join(F.broadcast(n), per.c_nationkey == n.n_nationkey).select(F.col("n_regionkey").alias("dep"), F.col("n_nationkey").alias("muni"), "total", "mesas")


VOTES = """votes AS (SELECT n.n_regionkey AS dep, n.n_nationkey AS muni, c.c_custkey AS mesa, count(*) AS votos FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY ALL),
census AS (SELECT n.n_regionkey AS dep, n.n_nationkey AS muni, count(*) * 10 AS total, count(*) AS mesas FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY ALL),
places AS (SELECT v.*, c.total AS habilitados FROM (SELECT dep, muni, sum(votos)::BIGINT AS votos, count(*) AS mesas FROM votes GROUP BY ALL) v LEFT JOIN census c ON v.dep = c.dep AND v.muni = c.muni),
flagged AS (SELECT *, round_even(CASE WHEN habilitados IS NULL THEN NULL WHEN habilitados = 0 THEN 0 ELSE votos / habilitados END, 4) AS participacion,
  CASE WHEN habilitados IS NULL THEN 'SIN_CENSO' WHEN votos > habilitados THEN 'EXCEDE' WHEN votos / habilitados >= 0.95 THEN 'ALTO' ELSE '' END AS bandera FROM places)"""

_STATUS = "CASE event_type WHEN 'view' THEN '1' WHEN 'signup' THEN '2' WHEN 'click' THEN '3' WHEN 'error' THEN '4' ELSE '5' END"


def snapshots(spark, sf_dir):
    """Daily snapshots: a user's last event of the day is the key's name (k) and status (type)."""
    from tallyframe.operators.snapshots import numbered

    e = table(spark, sf_dir, "events").withColumn("snap_ts", F.date_trunc("day", "ts"))
    last = e.groupBy(F.col("user_id").alias("key"), "snap_ts").agg(F.max(F.struct("ts", "event_id", "props", "event_type")).alias("e"))
    rows = last.select("key", "snap_ts", F.get_json_object("e.props", "$.k").alias("name"), F.expr(_STATUS.replace("event_type", "e.event_type")).alias("status"))
    return numbered(rows)


SNAPSHOTS = f"""days AS (SELECT user_id AS key, date_trunc('day', ts)::TIMESTAMP AS snap_ts, arg_max(struct_pack(n := json_extract_string(props, '$.k'), s := {_STATUS}), struct_pack(t := ts, i := event_id)) AS e FROM events GROUP BY ALL),
cal AS (SELECT snap_ts, row_number() OVER (ORDER BY snap_ts)::INT AS snap_ord FROM (SELECT DISTINCT snap_ts FROM days)),
snaps AS (SELECT d.key, d.snap_ts, c.snap_ord, d.e.n AS name, d.e.s AS status FROM days d JOIN cal c USING (snap_ts)),
last AS (SELECT max(snap_ord) AS last FROM snaps)"""
STEPS = """steps AS (SELECT coalesce(n.key, p.key) AS key, coalesce(n.snap_ord, p.snap_ord + 1) AS snap_ord, n.key IS NOT NULL AS aqui, p.key IS NULL AND n.snap_ord > 1 AS anadida, n.key IS NULL AS eliminada,
  n.key IS NOT NULL AND p.key IS NOT NULL AND n.name IS DISTINCT FROM p.name AS hash_cambiado, n.key IS NOT NULL AND p.key IS NOT NULL AND n.status IS DISTINCT FROM p.status AS estado_cambiado, p.status AS antes, n.status AS ahora
  FROM snaps n FULL JOIN (SELECT s.* FROM snaps s, last WHERE snap_ord < last) p ON n.key = p.key AND n.snap_ord = p.snap_ord + 1)"""
HISTORY = """runs0 AS (SELECT *, CASE WHEN snap_ord - coalesce(lag(snap_ord) OVER w, -1) > 1 THEN 1 ELSE 0 END AS new FROM snaps WINDOW w AS (PARTITION BY key ORDER BY snap_ord)),
runs1 AS (SELECT *, sum(new) OVER (PARTITION BY key ORDER BY snap_ord) AS run, sum(new) OVER (PARTITION BY key) AS lastrun FROM runs0),
runs2 AS (SELECT *, lag(name) OVER w AS pn, lag(status) OVER w AS ps, lag(snap_ord) OVER w AS po, min(snap_ts) OVER (PARTITION BY key) AS first_seen FROM runs1 WHERE run = lastrun WINDOW w AS (PARTITION BY key ORDER BY snap_ord)),
runs3 AS (SELECT *, po IS NOT NULL AND pn IS DISTINCT FROM name AS hc, po IS NOT NULL AND ps IS DISTINCT FROM status AS sc FROM runs2),
hist0 AS (SELECT key, min(snap_ts) AS first_seen, max(snap_ord) AS last_ord, arg_max(name, snap_ord) AS name, arg_max(status, snap_ord) AS status, count(*) FILTER (WHERE hc) AS n_cambios, count(*) FILTER (WHERE sc) AS n_estados,
  coalesce(bool_or(hc AND epoch(snap_ts - first_seen) / 3600.0 >= 240), FALSE) AS tardio, coalesce(bool_or(sc AND status::INT < ps::INT), FALSE) AS regresion, arg_min(pn, snap_ord) FILTER (WHERE hc) AS before0 FROM runs3 GROUP BY key),
hist AS (SELECT h.*, c.snap_ts AS eliminada_ts, c.snap_ts IS NOT NULL AS eliminada FROM hist0 h LEFT JOIN cal c ON c.snap_ord = h.last_ord + 1)"""


def chain_entries(spark, sf_dir):
    """A chain for each user: events in order, with the hash of their props as content."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events")
    return e.select("user_id", F.row_number().over(w).cast("bigint").alias("seq"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.sha2(F.col("props").cast("binary"), 256).alias("sha_contenido"))


CHAIN = """entries AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, sha256(props) AS sha_contenido FROM events),
chain AS (SELECT user_id, seq, ts, sha_contenido, sha256('GENESIS' || sha_contenido || ts) AS eslabon, 'GENESIS' AS eslabon_anterior FROM entries WHERE seq = 1
  UNION ALL SELECT e.user_id, e.seq, e.ts, e.sha_contenido, sha256(c.eslabon || e.sha_contenido || e.ts), c.eslabon FROM chain c JOIN entries e ON e.user_id = c.user_id AND e.seq = c.seq + 1)"""


def digits(spark, sf_dir):
    """Three digit positions of a box from thirty of an embedding's dimensions: the two likeliest digits of each."""
    from tallyframe.operators.decode import softmax, top_k

    e = table(spark, sf_dir, "embeddings")
    logits = lambda k: F.transform(F.slice("embedding", 10 * k + 1, 10), lambda x: x.cast("double") * 10)
    return e.select("vec_id", "label", F.array(*[top_k(softmax(logits(k))) for k in range(3)]).alias("posiciones"))


DIGITS = """dig0 AS (SELECT vec_id, label, k, unnest(range(10)) AS d, unnest([exp(x::DOUBLE * 10 - list_max(z)) FOR x IN l]) AS e FROM (SELECT vec_id, label, k, embedding[10 * k + 1:10 * k + 10] AS l, [y::DOUBLE * 10 FOR y IN embedding[10 * k + 1:10 * k + 10]] AS z FROM embeddings, range(3) r(k))),
dig1 AS (SELECT *, e / sum(e) OVER (PARTITION BY vec_id, k) AS p FROM dig0),
dig AS (SELECT *, row_number() OVER (PARTITION BY vec_id, k ORDER BY p DESC, d) AS nth FROM dig1),
top AS (SELECT vec_id, label, k, max(d) FILTER (WHERE nth = 1) AS d1, max(p) FILTER (WHERE nth = 1) AS p1, max(d) FILTER (WHERE nth = 2) AS d2, max(p) FILTER (WHERE nth = 2) AS p2 FROM dig GROUP BY ALL)"""


def swaps(spark, sf_dir):
    """Boxes of a sheet with alternative readings and their costs."""
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy(F.col("l_orderkey").alias("mesa"), F.col("l_linenumber").alias("ord")).agg(F.sum("l_quantity").cast("bigint").alias("v"), F.sum("l_partkey").alias("p"), F.sum("l_suppkey").alias("s"))
    off = F.sum("v"), F.sum("p")
    t = g.groupBy("mesa").agg(off[0].alias("v"), off[1].alias("p"), F.sum("s").alias("s"))
    rows = g.select("mesa", "ord", F.lit("parte").alias("kind"), "v", "p", "s")
    rows = rows.unionByName(t.select("mesa", F.lit(8).alias("ord"), F.lit("suma").alias("kind"), (F.col("v") + (F.col("p") % 3 == 0).cast("int")).alias("v"), "p", "s"))
    rows = rows.unionByName(t.select("mesa", F.lit(9).alias("ord"), F.lit("e11").alias("kind"), (F.col("v") + (F.col("p") % 4 == 0).cast("int")).alias("v"), "p", "s"))
    base = rows.select("mesa", "ord", "kind", F.col("v").alias("valor"), F.lit(0.0).alias("coste"))
    alt = rows.where("(p + ord) % 3 = 0").select("mesa", "ord", "kind", (F.col("v") + F.when(F.col("s") % 2 == 0, 1).otherwise(-1)).alias("valor"), ((F.col("s") % 24 + 1) / 10.0).cast("double").alias("coste"))
    return base.unionByName(alt)


SWAPS = """g AS (SELECT l_orderkey AS mesa, l_linenumber AS ord, CAST(sum(l_quantity) AS BIGINT) AS v, sum(l_partkey)::BIGINT AS p, sum(l_suppkey)::BIGINT AS s FROM lineitem GROUP BY ALL),
t AS (SELECT mesa, sum(v)::BIGINT AS v, sum(p)::BIGINT AS p, sum(s)::BIGINT AS s FROM g GROUP BY mesa),
rws AS (SELECT mesa, ord, 'parte' AS kind, v, p, s FROM g UNION ALL SELECT mesa, 8, 'suma', v + (p % 3 = 0)::INT, p, s FROM t UNION ALL SELECT mesa, 9, 'e11', v + (p % 4 = 0)::INT, p, s FROM t),
alt AS (SELECT mesa, ord, CASE WHEN s % 2 = 0 THEN 1 ELSE -1 END AS d, kind, (s % 24 + 1) / 10.0::DOUBLE AS coste, v + CASE WHEN s % 2 = 0 THEN 1 ELSE -1 END AS valor FROM rws WHERE (p + ord) % 3 = 0),
res AS (SELECT mesa, (sum(CASE kind WHEN 'parte' THEN v WHEN 'suma' THEN -v ELSE 0 END))::BIGINT AS r1, (sum(CASE kind WHEN 'suma' THEN v WHEN 'e11' THEN -v ELSE 0 END))::BIGINT AS r2 FROM rws GROUP BY mesa),
mv AS (SELECT a.*, CASE kind WHEN 'parte' THEN d WHEN 'suma' THEN -d ELSE 0 END AS v1, CASE kind WHEN 'parte' THEN 0 WHEN 'suma' THEN d ELSE -d END AS v2, r1, r2, dense_rank() OVER (PARTITION BY mesa ORDER BY coste, ord) AS place FROM alt a JOIN res USING (mesa)),
one AS (SELECT mesa, arg_min(struct_pack(c := coste, o := [ord]), struct_pack(c := coste, o := ord)) AS b FROM mv WHERE (r1 <> 0 OR r2 <> 0) AND r1 + v1 = 0 AND r2 + v2 = 0 GROUP BY mesa),
two AS (SELECT a.mesa, arg_min(struct_pack(c := a.coste + b.coste, o := [a.ord, b.ord]), struct_pack(c := a.coste + b.coste, o := a.ord, p := b.ord)) AS b FROM mv a JOIN mv b ON a.mesa = b.mesa AND a.ord < b.ord AND a.place <= 8 AND b.place <= 8
  WHERE (a.r1 <> 0 OR a.r2 <> 0) AND a.r1 + a.v1 + b.v1 = 0 AND a.r2 + a.v2 + b.v2 = 0 AND a.mesa NOT IN (SELECT mesa FROM one) GROUP BY a.mesa),
decoded AS (SELECT res.mesa, CASE WHEN r1 = 0 AND r2 = 0 THEN 'directo' WHEN one.mesa IS NOT NULL AND one.b.c < 0.7 THEN 'corregido_minimo' WHEN one.mesa IS NOT NULL OR two.mesa IS NOT NULL THEN 'corregido_forzado' ELSE 'no_cuadra' END AS estado,
  CASE WHEN one.mesa IS NOT NULL THEN 1 WHEN two.mesa IS NOT NULL THEN 2 ELSE 0 END AS n_cambios, round(coalesce(one.b.c, two.b.c, 0.0), 6)::DOUBLE AS coste, array_to_string(coalesce(one.b.o, two.b.o, []), ',') AS cajas FROM res LEFT JOIN one USING (mesa) LEFT JOIN two USING (mesa))"""


def ink(spark, sf_dir):
    """Shares of ink in each box of a sheet: five candidates and the aggregates."""
    li = table(spark, sf_dir, "lineitem")
    share = lambda k, c: F.round(F.sum(F.when(F.col("l_linenumber") == k, F.col(c))) * 100, 4)
    names = [*LINES, "NO_MARCADO", "SUMA_TOTAL", "TOTAL_E11"]
    cols = [share(k + 1, "l_discount").alias(x) for k, x in enumerate(LINES)] + [share(1, "l_tax").alias("NO_MARCADO"), share(3, "l_tax").alias("SUMA_TOTAL"), share(2, "l_tax").alias("TOTAL_E11")]
    return li.groupBy(F.col("l_orderkey").alias("mesa")).agg(*cols).select("mesa", *names)


INK = (
    "ink AS (SELECT l_orderkey AS mesa, " + ", ".join(f"coalesce(round(sum(CASE WHEN l_linenumber = {k + 1} THEN l_discount END) * 100, 4) > 1, FALSE) AS {x}" for k, x in enumerate(LINES))
    + ", coalesce(round(sum(CASE WHEN l_linenumber = 1 THEN l_tax END) * 100, 4) > 1, FALSE) AS NO_MARCADO, coalesce(round(sum(CASE WHEN l_linenumber = 3 THEN l_tax END) * 100, 4) > 1, FALSE) AS SUMA_TOTAL, coalesce(round(sum(CASE WHEN l_linenumber = 2 THEN l_tax END) * 100, 4) > 1, FALSE) AS TOTAL_E11 FROM lineitem GROUP BY l_orderkey),"
    + """ink1 AS (SELECT mesa, cand_01::INT + cand_02::INT + cand_03::INT + cand_04::INT + cand_05::INT AS n, BLANCO OR NULO OR NO_MARCADO AS agg, SUMA_TOTAL AS s, TOTAL_E11 AS e FROM ink),
ink2 AS (SELECT mesa, n AS n_candidatos, (NOT s AND n > 0)::INT AS suma_vacia_con_votos, (n = 0 AND NOT agg)::INT AS sin_ningun_voto, (s AND n = 0 AND NOT agg)::INT AS suma_con_todo_vacio, (n = 5)::INT AS todos_candidatos_llenos, (agg AND NOT s)::INT AS agregados_sin_suma, (NOT e AND n > 0)::INT AS e11_vacio_con_votos FROM ink1),
flags AS (SELECT *, suma_vacia_con_votos + sin_ningun_voto + suma_con_todo_vacio + todos_candidatos_llenos + agregados_sin_suma + e11_vacio_con_votos AS n_banderas,
  CASE WHEN suma_vacia_con_votos + sin_ningun_voto + suma_con_todo_vacio > 0 THEN 'ALTA' WHEN todos_candidatos_llenos + agregados_sin_suma + e11_vacio_con_votos > 0 THEN 'MEDIA' ELSE 'OK' END AS prioridad FROM ink2)"""
)


def _grey(high, wide, rows):
    """Grey bytes of an image that is white but for the hex of some ``rows`` (how many, their hex), given from top to bottom with the white ones between."""
    white = F.repeat(F.lit("FF"), F.lit(wide))
    parts = [F.repeat(white if line is None else line, n if not isinstance(n, int) else F.lit(n)) for n, line in rows]
    return F.unhex(F.concat(*parts))


def _line(left, dark, wide):
    return F.concat(F.repeat(F.lit("FF"), F.lit(left)), F.repeat(F.lit("00"), dark), F.repeat(F.lit("FF"), F.lit(wide - left) - dark))


#: Images of which one task makes and measures about so many.
TASK_CROPS, TASK_PAGES = 16_384, 256


def _dealt(rows, each, *by):
    """Short rows in tasks of about ``each``, so that the images made of them are measured on all cores, however few files the rows lie in."""
    return rows.repartition(max(1, -(-rows.count() // each)), *by)


def crops(spark, sf_dir):
    """Crops of 20 x 24 pixels with one dark rectangle, by a part's size (its rows, 0 to 8) and key (its columns, 1 to 10)."""
    high, wide = (F.col("p_size") % 9).cast("int"), (F.col("p_partkey") % 10 + 1).cast("int")
    return _dealt(table(spark, sf_dir, "part").select("p_partkey", "p_size"), TASK_CROPS, "p_partkey").select("p_partkey", F.lit(20).alias("alto"), _grey(20, 24, [(5, None), (high, _line(5, wide, 24)), (F.lit(15) - high, None)]).alias("pixeles"))


def pages(spark, sf_dir):
    """A supplier's sheet of one to three pages of 400 x 300 pixels; every fifth has a page without pixels. The first has up to three dark lines in the third candidate's box."""
    k, dark = F.col("s_suppkey"), (F.col("s_suppkey") % 4).cast("int")
    first = _grey(400, 300, [(225, None), (dark, _line(220, F.lit(30), 300)), (F.lit(175) - dark, None)])
    white = _grey(400, 300, [(400, None)])
    rows = table(spark, sf_dir, "supplier").select(k, F.concat(F.lit("r/D/01/002/003/04/"), k.cast("string"), F.lit("/a.pdf")).alias("pdf"), F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(3), (k % 5).cast("int"))))).alias("pagina"))
    return _dealt(rows, TASK_PAGES, "s_suppkey", "pagina").select("pdf", "pagina", F.lit(400).alias("alto"), F.when(k % 5 == 0, None).when(F.col("pagina") == 1, first).otherwise(white).alias("pixeles"))
