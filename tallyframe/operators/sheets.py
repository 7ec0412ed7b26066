"""Readings to sheets: last reading wins, pivot on the fixed labels, arithmetic check, ranked review."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions import checks
from tallyframe.schema import CANDIDATES, LABELS


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the greatest ``order`` for each key, by partial aggregation."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(order, *[c for c in rest if c != order])).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(order, *[c for c in rest if c != order])).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def pivot_readings(readings: DataFrame, keys: list[str], labels: list[str] = LABELS, label: str = "etiqueta", value: str = "valor", order: str = "ord") -> DataFrame:
    """One row a sheet: each label's last value, and ``has_<label>`` for labels that occur at all.

    One aggregation with a conditional per label; the labels are given, so no pass looks for them.
    """
    aggs = []
    for x in labels:
        here = F.col(label) == x
        aggs += [F.max_by(F.when(here, F.col(value)), F.when(here, F.col(order))).alias(x), F.coalesce(F.bool_or(here), F.lit(False)).alias(f"has_{x}")]
    return readings.groupBy(*keys).agg(*aggs)


def check_sheets(sheets: DataFrame, policy: str = "zero_all", candidates: list[str] = CANDIDATES) -> DataFrame:
    """Pivoted sheets with the arithmetic check under a fill policy; the filled values replace the read ones."""
    names = [*candidates, "BLANCO", "NULO", "NO_MARCADO", "SUMA_TOTAL", "TOTAL_E11"]
    value = {n: checks.filled(F.col(n), F.col(f"has_{n}"), policy) if n in sheets.columns else F.lit(0 if policy != "strict" else None).cast("int") for n in names}
    keys = [c for c in sheets.columns if c not in LABELS and not c.startswith("has_") and c not in names]
    rows = sheets.select(*keys, *[v.alias(n) for n, v in value.items()])
    tested = checks.arithmetic_check([F.col(c) for c in candidates], *[F.col(n) for n in names[len(candidates) :]])
    return rows.withColumn("c", tested).select(*keys, *names, "c.*")


def ranked(sheets: DataFrame, *tiebreak: str) -> DataFrame:
    """For review: ALTA, MEDIA, INCOMPLETO, NINGUNA, then the tiebreak."""
    return sheets.orderBy(checks.alert_rank(F.col("alerta")), *tiebreak)


def histogram(df: DataFrame, column: str, *by: str) -> DataFrame:
    """Counts and shares of a column's values."""
    n = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(*by)), 2))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """The n rows whose hashed keys are least: the same ones every time, on any cluster."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), key).limit(n)


def one_per_group(df: DataFrame, group: str, path: str) -> DataFrame:
    """The first path of each group."""
    return df.groupBy(group).agg(F.min(path).alias(path))


def group_split(df: DataFrame, group: str, share: float = 0.2, seed: int = 0) -> DataFrame:
    """``validation`` true for the first ``share`` of the groups in the order of their hashes, one group at least, so no group is on both sides.

    Groups are counted by the first digits of their hashes; only those of the one cell
    in which the share ends are ranked. Rows are told apart by the last hash taken, so
    none is shuffled but for the groups' names.
    """
    mark = lambda: F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(group).cast("string")).cast("binary"))
    groups = df.select(mark().alias("_mark")).distinct().withColumn("_cell", F.substring("_mark", 1, 4))
    before = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = groups.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))  # 65,536 at most
    cells = cells.select("_cell", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.greatest(F.lit(1), F.floor(F.sum("_n").over(Window.partitionBy()) * share)).alias("_take"))
    last = cells.where((F.col("_before") < F.col("_take")) & (F.col("_take") <= F.col("_before") + F.col("_n")))
    ranked_marks = groups.join(F.broadcast(last), "_cell").withColumn("_rank", F.col("_before") + F.row_number().over(Window.partitionBy("_cell").orderBy("_mark")))
    cut = ranked_marks.where("_rank = _take").select(F.col("_mark").alias("_cut"))  # one row, none without groups
    return df.join(F.broadcast(cut)).withColumn("validation", mark() <= F.col("_cut")).drop("_cut")
