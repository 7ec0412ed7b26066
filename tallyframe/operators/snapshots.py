"""Manifest snapshots: differences, alerts, counters and each sheet's history.

Rows are (key, snap_ord, snap_ts, name, status); ``snap_ord`` numbers the
snapshots without gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered(rows: DataFrame, time: str = "snap_ts") -> DataFrame:
    """Adds ``snap_ord``; the calendar of snapshots is small and has one row a snapshot."""
    calendar = rows.select(time).distinct().withColumn("snap_ord", F.row_number().over(Window.orderBy(time)))
    return rows.join(F.broadcast(calendar), time)


def diff(prev: DataFrame, now: DataFrame) -> DataFrame:
    """``key, tipo, antes, ahora``: anadida, eliminada, hash_cambiado, estado_cambiado (a key can have both changes)."""
    a, b = prev.select("key", F.struct("name", "status").alias("a")), now.select("key", F.struct("name", "status").alias("b"))
    both = a.join(b, "key", "full_outer")
    kinds = [
        (F.col("a").isNull(), "anadida", F.lit(None), F.col("b.name")),
        (F.col("b").isNull(), "eliminada", F.col("a.name"), F.lit(None)),
        (F.col("a").isNotNull() & F.col("b").isNotNull() & ~F.col("a.name").eqNullSafe(F.col("b.name")), "hash_cambiado", F.col("a.name"), F.col("b.name")),
        (F.col("a").isNotNull() & F.col("b").isNotNull() & ~F.col("a.status").eqNullSafe(F.col("b.status")), "estado_cambiado", F.col("a.status"), F.col("b.status")),
    ]
    found = F.filter(F.array(*[F.when(p, F.struct(F.lit(k).alias("tipo"), x.cast("string").alias("antes"), y.cast("string").alias("ahora"))) for p, k, x, y in kinds]), lambda x: x.isNotNull())
    return both.select("key", F.explode(found).alias("d")).select("key", "d.*")


def steps(rows: DataFrame) -> DataFrame:
    """Every key at every step to a next snapshot, by one full outer join on (key, snapshot): flags for the four changes."""
    last = rows.agg(F.max("snap_ord").alias("last"))
    now = rows.select("key", "snap_ord", F.struct("name", "status").alias("b"))
    before = rows.join(F.broadcast(last)).where("snap_ord < last").select("key", (F.col("snap_ord") + 1).alias("snap_ord"), F.struct("name", "status").alias("a"))
    both = now.join(before, ["key", "snap_ord"], "full_outer")
    pair = F.col("a").isNotNull() & F.col("b").isNotNull()
    return both.select(
        "key", "snap_ord", F.col("b").isNotNull().alias("aqui"), (F.col("a").isNull() & (F.col("snap_ord") > 1)).alias("anadida"), F.col("b").isNull().alias("eliminada"),
        (pair & ~F.col("a.name").eqNullSafe(F.col("b.name"))).alias("hash_cambiado"), (pair & ~F.col("a.status").eqNullSafe(F.col("b.status"))).alias("estado_cambiado"),
        F.col("a.status").alias("antes"), F.col("b.status").alias("ahora"),
    )


def counters(rows: DataFrame) -> DataFrame:
    """What each snapshot added, removed and changed, and whether that raises an alert."""
    n = lambda c: F.count_if(F.col(c)).alias(c)
    found = steps(rows).groupBy("snap_ord").agg(n("aqui"), n("anadida"), n("eliminada"), n("hash_cambiado"), n("estado_cambiado")).withColumnRenamed("aqui", "n_actas")
    return found.withColumn("alerta", (F.col("eliminada") > 0) | (F.col("hash_cambiado") > 0))


def growth(rows: DataFrame) -> DataFrame:
    """Keys in each snapshot and the change to the one before."""
    n = rows.groupBy("snap_ord", "snap_ts").agg(F.count(F.lit(1)).alias("n_actas"))
    return n.withColumn("cambio", F.col("n_actas") - F.lag("n_actas").over(Window.orderBy("snap_ord")))  # one row a snapshot


def transitions(prev: DataFrame, now: DataFrame, values: list[str]) -> DataFrame:
    """How many keys went from each status to each other one."""
    a, b = prev.select("key", F.col("status").alias("antes")), now.select("key", F.col("status").alias("ahora"))
    return a.join(b, "key").where("antes <> ahora").groupBy("antes").pivot("ahora", values).agg(F.count(F.lit(1))).na.fill(0)


def history(rows: DataFrame) -> DataFrame:
    """Each key's record since it last (re)appeared.

    A key that was away and came back starts anew, so only its last run of
    consecutive snapshots counts. One shuffle by key serves all windows.
    """
    w = Window.partitionBy("key").orderBy("snap_ord")
    runs = rows.withColumn("new", (F.col("snap_ord") - F.coalesce(F.lag("snap_ord").over(w), F.lit(-1)) > 1).cast("int"))
    runs = runs.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("last_run", F.sum("new").over(Window.partitionBy("key"))).where("run = last_run")
    change = lambda c: F.when((F.lag("snap_ord").over(w).isNotNull()) & ~F.lag(c).over(w).eqNullSafe(F.col(c)), F.struct(F.col("snap_ts").alias("ts"), F.lag(c).over(w).alias("antes"), F.col(c).alias("ahora")))
    runs = runs.withColumn("hash", change("name")).withColumn("estado", change("status"))
    calendar = rows.select("snap_ord", "snap_ts").distinct()
    after = calendar.select((F.col("snap_ord") - 1).alias("last_ord"), F.col("snap_ts").alias("eliminada_ts"))
    listed = lambda c: F.array_sort(F.collect_list(c)).alias(f"{c}_changes")
    out = runs.groupBy("key").agg(F.min("snap_ts").alias("first_seen"), F.max("snap_ord").alias("last_ord"), F.max_by("name", "snap_ord").alias("name"), F.max_by("status", "snap_ord").alias("status"), listed("hash"), listed("estado"))
    return out.join(F.broadcast(after), "last_ord", "left").drop("last_ord")


def hours(later, earlier):
    return F.timestamp_diff("SECOND", earlier, later) / 3600.0


def audited(found: DataFrame, late_hours: float = 6.0) -> DataFrame:
    """History with its flags: changed late, removed, fell back in status."""
    number = lambda c: F.when(c.rlike("^[0-9]+$"), c.try_cast("long"))
    late = F.exists("hash_changes", lambda x: hours(x["ts"], F.col("first_seen")) >= late_hours)
    back = F.exists("estado_changes", lambda x: F.coalesce(number(x["ahora"].cast("string")) < number(x["antes"].cast("string")), F.lit(False)))
    flags = found.withColumn("n_cambios", F.size("hash_changes").cast("bigint")).withColumn("tardio", late).withColumn("eliminada", F.col("eliminada_ts").isNotNull()).withColumn("regresion", back)
    first = F.when(F.col("n_cambios") > 0, F.col("hash_changes")[0]["antes"]).otherwise(F.col("name"))
    return flags.withColumn("hash_inicial", F.substring(first, 1, 16)).withColumn("hash_actual", F.substring("name", 1, 16))


def audit_report(found: DataFrame, late_hours: float = 6.0) -> DataFrame:
    """Only sheets whose hash changed or that are gone; a fallen status alone doesn't list a sheet."""
    return audited(found, late_hours).where("n_cambios > 0 OR eliminada")


def audit_order(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc("eliminada"), F.desc("tardio"), F.desc("regresion"), F.desc("n_cambios"), "key")


def base_rate(found: DataFrame, late_hours: float = 6.0) -> DataFrame:
    """Metrics over all keys ever seen; falls in status count among listed sheets only."""
    listed = (F.col("n_cambios") > 0) | F.col("eliminada")
    row = audited(found, late_hours).agg(
        F.count(F.lit(1)).alias("actas"), F.count_if(F.col("n_cambios") > 0).alias("con_cambio"), F.count_if("tardio").alias("tardias"),
        F.count_if("eliminada").alias("eliminadas"), F.count_if(listed & F.col("regresion")).alias("regresiones"),
    )
    return row.withColumn("tasa_base", F.round(100.0 * F.col("con_cambio") / F.greatest("actas", F.lit(1)), 2))
