"""Copies of one sheet against each other: discrepancies, total-preserving transfers, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.checks import multiple_of_100


def discrepancies(readings: DataFrame, table: list[str], copy: str = "ejemplar", label: str = "etiqueta", value: str = "valor", conf: str | None = None, min_conf: float = 0.0) -> DataFrame:
    """Every pair of copies that differ in a box; one row a pair, copies in alphabetical order.

    The copies of a box are gathered once (there are a handful) and paired in
    place, so there is one shuffle and no self-join. A pair is dropped for low
    confidence only if both copies have one.
    """
    c = F.col(conf) if conf else F.lit(None).cast("double")
    cells = readings.groupBy(*table, label).agg(F.array_sort(F.collect_list(F.struct(F.col(copy).alias("ej"), F.col(value).alias("v"), c.alias("conf")))).alias("copies"))
    pairs = cells.select(*table, label, F.explode(F.expr("flatten(transform(copies, a -> transform(filter(copies, b -> b.ej > a.ej), b -> struct(a, b))))")).alias("p"))
    pairs = pairs.select(*table, label, F.col("p.a.ej").alias("ej_a"), F.col("p.a.v").alias("valor_a"), F.col("p.b.ej").alias("ej_b"), F.col("p.b.v").alias("valor_b"), F.col("p.a.conf").alias("conf_a"), F.col("p.b.conf").alias("conf_b"))
    pairs = pairs.where("valor_a <> valor_b")
    if min_conf:
        pairs = pairs.where(F.coalesce((F.col("conf_a") >= min_conf) & (F.col("conf_b") >= min_conf), F.lit(True)) | F.col("conf_a").isNull() | F.col("conf_b").isNull())
    diff = F.col("valor_b") - F.col("valor_a")
    pairs = pairs.withColumn("dif", diff).withColumn("abs_dif", F.abs(diff)).withColumn("multiplo_100", multiple_of_100(diff).cast("int"))
    return pairs if conf else pairs.drop("conf_a", "conf_b")


def transfers(found: DataFrame, table: list[str], prefix: str = "CAND", label: str = "etiqueta") -> DataFrame:
    """Pairs of copies whose candidates' differences cancel out: who gains, who loses, how much."""
    moves = found.where(F.upper(F.col(label).cast("string")).startswith(prefix.upper()))
    said = lambda sign: F.concat_ws(";", F.transform(F.array_sort(F.collect_list(F.when(F.col("dif") * sign > 0, F.struct(F.col(label).cast("string").alias("l"), "dif")))), lambda x: F.concat(x["l"], F.lit("(+" if sign > 0 else "("), x["dif"].cast("string"), F.lit(")"))))
    amount = F.sum(F.when(F.col("dif") > 0, F.col("dif")).otherwise(0))
    groups = moves.groupBy(*table, "ej_a", "ej_b").agg(F.sum("dif").alias("neto"), amount.alias("monto"), said(1).alias("ganan"), said(-1).alias("pierden"))
    return groups.where("neto = 0").drop("neto").withColumn("multiplo_100", (F.pmod(F.col("monto"), F.lit(100)) == 0).cast("int"))


def review_order(df: DataFrame, amount: str, *tiebreak: str) -> DataFrame:
    return df.orderBy(F.desc("multiplo_100"), F.desc(amount), *tiebreak)


def presence(readings: DataFrame, table: list[str], copy: str = "ejemplar") -> DataFrame:
    """Which copies each table has."""
    return readings.groupBy(*table).agg(F.array_sort(F.collect_set(copy)).alias("ejemplares"))


def summary(readings: DataFrame, found: DataFrame, moved: DataFrame, table: list[str]) -> DataFrame:
    """Tables in all, with a discrepancy, with a transfer; shares are of all tables."""
    n = lambda df, name: df.select(*table).distinct().agg(F.count(F.lit(1)).alias(name))
    hundred = moved.agg(F.coalesce(F.sum("multiplo_100"), F.lit(0)).alias("traslados_100"))
    row = n(readings, "mesas").join(n(found, "con_discrepancia")).join(n(moved, "con_traslado")).join(hundred)
    pct = lambda c: F.round(100.0 * F.col(c) / F.greatest("mesas", F.lit(1)), 2)
    return row.withColumn("pct_discrepancia", pct("con_discrepancia")).withColumn("pct_traslado", pct("con_traslado"))
