"""Digit readings to sheets that reconcile: candidate values, the arithmetic decoder, pseudo-labels.

With r1 = parts - SUMA_TOTAL and r2 = SUMA_TOTAL - TOTAL_E11, exchanging a value
for one that is greater by d moves (r1, r2) by (d, 0) for a part, (-d, d) for
SUMA_TOTAL and (0, -d) for TOTAL_E11. One exchange solves a sheet if its move is
(-r1, -r2); two solve it if their moves add up to that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def softmax(logits: Column) -> Column:
    top = F.array_max(logits)
    powers = F.transform(logits, lambda x: F.exp(x - top))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def top_k(probabilities: Column, k: int = 2) -> Column:
    """The k likeliest digits as (p, d), ties by digit."""
    coded = F.transform(probabilities, lambda p, d: F.struct((-p).alias("neg"), d.alias("d")))
    return F.transform(F.slice(F.array_sort(coded), 1, k), lambda x: F.struct(x["d"].alias("d"), (-x["neg"]).alias("p")))


def value_candidates(positions: Column, most: float = 2.5) -> Column:
    """Values of a box from three arrays of (d, p): the likeliest digits, and each single exchange for the second likeliest with its cost."""
    first = F.transform(positions, lambda p: p[0]["d"])
    number = lambda digits: F.aggregate(digits, F.lit(0), lambda a, d: a * 10 + d)
    base = F.struct(number(first).alias("valor"), F.lit(0.0).alias("coste"))

    def exchanged(p, k):
        cost = F.log(F.greatest(p[0]["p"], F.lit(1e-9)) / F.greatest(p[1]["p"], F.lit(1e-9)))
        return F.struct(number(F.transform(first, lambda d, j: F.when(j == k, p[1]["d"]).otherwise(d))).alias("valor"), cost.alias("coste"))

    return F.concat(F.array(base), F.filter(F.transform(positions, exchanged), lambda x: x["coste"] <= most))


def decode(candidates: DataFrame, sheet: str = "mesa", uncertain: int = 8, small: float = 0.7) -> DataFrame:
    """``candidates(sheet, ord, kind, valor, coste)`` to one state a sheet.

    ``kind`` is parte, suma or e11. Costs of 0 are the base reading. States: directo,
    corregido_minimo (one exchange below ``small``), corregido_forzado, no_cuadra.
    The cheapest exchange wins, ties by box order. Pairs are only looked for among
    the ``uncertain`` boxes of least cost, in sheets that no single exchange solves.
    A sheet has a few dozen values: they are gathered once, by one shuffle, and all
    the rest happens in place.
    """
    dealt = candidates.select(sheet, "ord", "kind", F.col("valor").cast("bigint").alias("valor"), F.col("coste").cast("double").alias("coste")).repartition(sheet)
    others = F.collect_list(F.when(F.col("coste") > 0, F.struct("coste", "valor")))
    boxes = dealt.groupBy(sheet, "ord", "kind").agg(F.min(F.when(F.col("coste") == 0, F.col("valor"))).alias("base"), others.alias("alts")).where("base IS NOT NULL")
    rows = boxes.groupBy(sheet).agg(F.collect_list(F.struct("ord", "kind", "base", "alts")).alias("cs"))
    total = lambda plus, minus: f"aggregate(cs, 0L, (n, c) -> n + CASE c.kind WHEN '{plus}' THEN c.base WHEN '{minus}' THEN -c.base ELSE 0L END)"
    rows = rows.withColumns({"r1": F.expr(total("parte", "suma")), "r2": F.expr(total("suma", "e11"))})
    moved = """transform(c.alts, x -> named_struct('coste', x.coste, 'ord', c.ord, 'valor', x.valor,
        'v1', CASE c.kind WHEN 'parte' THEN x.valor - c.base WHEN 'suma' THEN c.base - x.valor ELSE 0L END,
        'v2', CASE c.kind WHEN 'suma' THEN x.valor - c.base WHEN 'e11' THEN c.base - x.valor ELSE 0L END))"""
    rows = rows.withColumn("swaps", F.expr(f"CASE WHEN r1 <> 0 OR r2 <> 0 THEN flatten(transform(cs, c -> {moved})) END"))
    rows = rows.withColumn("single", F.expr("array_min(transform(filter(swaps, a -> a.v1 = -r1 AND a.v2 = -r2), a -> named_struct('c', a.coste, 'o', a.ord)))"))
    least = "array_sort(transform(filter(cs, c -> size(c.alts) > 0), c -> named_struct('c', array_min(c.alts).coste, 'o', c.ord)))"
    rows = rows.withColumn("near", F.expr(f"transform(slice({least}, 1, {uncertain}), x -> x.o)"))
    rows = rows.withColumn("loose", F.expr("CASE WHEN single IS NULL THEN filter(swaps, a -> array_contains(near, a.ord)) END"))
    fit = "filter(loose, b -> b.ord > a.ord AND a.v1 + b.v1 = -r1 AND a.v2 + b.v2 = -r2)"
    rows = rows.withColumn("double", F.expr(f"array_min(flatten(transform(loose, a -> transform({fit}, b -> named_struct('c', a.coste + b.coste, 'o', a.ord, 'p', b.ord)))))"))
    state = F.when((F.col("r1") == 0) & (F.col("r2") == 0), "directo").when(F.col("single.c") < small, "corregido_minimo")
    state = state.when(F.col("single").isNotNull() | F.col("double").isNotNull(), "corregido_forzado").otherwise("no_cuadra")
    n = F.when(F.col("single").isNotNull(), 1).when(F.col("double").isNotNull(), 2).otherwise(0)
    where = F.when(n == 1, F.array("single.o")).when(n == 2, F.array("double.o", "double.p")).otherwise(F.array().cast("array<int>"))
    return rows.select(sheet, state.alias("estado"), n.alias("n_cambios"), F.coalesce("single.c", "double.c", F.lit(0.0)).alias("coste"), where.alias("cajas"))


def pseudo_labels(labels: DataFrame, predictions: DataFrame, least: float = 0.995) -> DataFrame:
    """``labels(caja, mesa, etiqueta, fuente)`` refreshed from ``predictions(caja, digito, confianza, cuadra)``.

    auto and manual rows stay. Boxes of sheets that reconcile are validado, sure ones
    pseudo, all others become blank.
    """
    own = F.coalesce(F.col("fuente").isin("auto", "manual"), F.lit(False))
    source = F.when(own, F.col("fuente")).when(F.coalesce("cuadra", F.lit(False)), "validado").when(F.coalesce(F.col("confianza") >= least, F.lit(False)), "pseudo").otherwise("")
    out = labels.join(predictions, "caja", "left").withColumn("fuente_nueva", source)
    label = F.when(own, F.col("etiqueta")).when(F.col("fuente_nueva") != "", F.col("digito").cast("string")).otherwise("")
    return out.select("caja", "mesa", label.alias("etiqueta"), F.col("fuente_nueva").alias("fuente"), F.coalesce("confianza", F.lit(0.0)).alias("confianza"))


def review_queue(labels: DataFrame) -> DataFrame:
    """Blank boxes, least sure first; a missing confidence is 0."""
    return labels.where("fuente = ''").orderBy("confianza", "caja")


def class_weights(labels: DataFrame, label: str = "y", classes: int = 10) -> DataFrame:
    """N / (classes * n) for every class, present or not."""
    n = labels.groupBy(F.col(label).cast("int").alias("clase")).agg(F.count(F.lit(1)).alias("n"))
    every = labels.sparkSession.range(classes).select(F.col("id").cast("int").alias("clase"))
    total = labels.agg(F.count(F.lit(1)).alias("total"))
    out = every.join(F.broadcast(n), "clase", "left").join(F.broadcast(total)).withColumn("n", F.coalesce("n", F.lit(0)))
    return out.select("clase", "n", F.round(F.col("total") / (classes * F.greatest("n", F.lit(1))), 6).alias("peso"))
