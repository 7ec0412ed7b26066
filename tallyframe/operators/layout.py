"""Runs of positions and regular lines on a page."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Positions of which one task takes about so many.
TASK_POSITIONS = 1 << 19


def distinct_positions(positions: DataFrame, key: str, at: str) -> DataFrame:
    """Each position of a key once, all of a key in one task; tasks take about ``TASK_POSITIONS`` rows, so their memory doesn't grow with the table.

    Copies of a position meet before those of its key do, so that only different
    positions count towards a key's task.
    """
    rows = positions.select(key, at)
    n = max(-(-rows.count() // TASK_POSITIONS), rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(n, key, at).distinct().repartition(n, key)


def runs(positions: DataFrame, key: str, at: str, gap: float) -> DataFrame:
    """Positions that follow each other within ``gap``: start, end and number of each run; a null position is a run of its own, the last.

    A run's row is its last position's, with what its first one was: windows over
    one sort, as an aggregation would hold nearly as many runs as positions.
    """
    w = Window.partitionBy(key).orderBy(F.col(at).asc_nulls_last())
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    new = F.coalesce((F.col(at) - F.lag(at).over(w) > gap).cast("int"), F.lit(1))
    rows = distinct_positions(positions, key, at).select(key, at, new.alias("_new"), F.row_number().over(w).cast("bigint").alias("_k"))
    first = F.last(F.when(F.col("_new") == 1, F.struct(F.col(at).alias("at"), F.col("_k").alias("k"))), ignorenulls=True).over(so_far)
    rows = rows.select(key, at, "_k", F.sum("_new").over(so_far).alias("run"), first.alias("_first"), F.lead("_new", 1, 1).over(w).alias("_end"))
    return rows.where("_end = 1").select(key, "run", F.col("_first.at").alias("inicio"), F.col(at).alias("fin"), (F.col("_k") - F.col("_first.k") + 1).alias("n"))


def regular_lines(lines: DataFrame, key: str, at: str, rows: int, low: float, high: float) -> DataFrame:
    """The first of the most regular ``rows + 1`` lines in a row whose gaps all lie strictly between ``low`` and ``high``."""
    w = Window.partitionBy(key).orderBy(at)
    found = lines
    for k in range(rows):
        ahead = F.lead(at, k + 1).over(w) - (F.lead(at, k).over(w) if k else F.col(at))
        found = found.withColumn(f"_g{k}", ahead)
    gaps = [F.col(f"_g{k}") for k in range(rows)]
    found = found.where(" AND ".join(f"_g{k} > {low} AND _g{k} < {high}" for k in range(rows)))
    spread = (F.greatest(*gaps) - F.least(*gaps)) if rows > 1 else F.lit(0)
    best = found.groupBy(key).agg(F.min(F.struct(spread.alias("dispersion"), F.col(at).alias("inicio"))).alias("b"))
    return best.select(key, "b.inicio", "b.dispersion")


def nearest_kept(positions: DataFrame, key: str, at: str, size: str, apart: float) -> DataFrame:
    """Left to right, a position closer than ``apart`` to the last kept one replaces it only if larger."""
    listed = positions.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(at).alias("p"), F.col(size).alias("s")))).alias("xs"))

    def step(acc, x):
        last = F.element_at(acc, -1)
        near = (F.size(acc) > 0) & (x["p"] - last["p"] < apart)
        return F.when(~near, F.concat(acc, F.array(x))).when(x["s"] > last["s"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(x))).otherwise(acc)

    kept = F.aggregate("xs", F.slice(F.col("xs"), 1, 1), step)
    return listed.select(key, F.explode(kept).alias("_kept")).select(key, F.col("_kept.p").alias(at), F.col("_kept.s").alias(size))
