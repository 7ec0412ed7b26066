"""Shards of nearly equal bytes: a minimax contiguous partition.

Rows are ordered by the hash of their text, then by id. Equal texts are one
atomic group, which never is cut. The order is dealt to range-partitioned
blocks, each with running sums, so no task sees more than its block, however
large one group is. The smallest feasible shard capacity is found by binary
search, with a greedy check, over the ends of the groups in that order. The
driver never holds the ends: it has a histogram of at most ``CELLS`` cells and
asks for finer ones only around ends that the search could not tell apart.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.shared import documents, partitions, stored, text_of

#: Cells of the driver's first histogram, and those that a finer look splits one into.
CELLS, FINER = 4096, 64


class Ends:
    """Group ends in cells of (first end, last end, number); cells of one or two ends are exact."""

    def __init__(self, cells: list[tuple[int, int, int]]):
        self.cells = sorted(cells)
        self.firsts, self.lasts = [c[0] for c in self.cells], [c[1] for c in self.cells]
        self.vague: set[int] = set()

    def at_most(self, x: int) -> int:
        """The last end that is at most x, or 0; in a vague cell, one that is not later."""
        k = bisect_right(self.firsts, x) - 1
        if k < 0:
            return 0
        first, last, n = self.cells[k]
        if last <= x:
            return last
        if n > 2:
            self.vague.add(k)
        return first

    def at_least(self, x: int) -> int:
        """The first end that is at least x, or 0 for x <= 0."""
        if x <= 0:
            return 0
        k = bisect_left(self.lasts, x)
        first, last, n = self.cells[k]
        if first >= x:
            return first
        if n > 2:
            self.vague.add(k)
        return last


def minimax_cuts(ends: Ends, total: int, shards: int) -> tuple[int, list[int]]:
    """The least capacity with which the groups fit in order, and the end of each shard.

    Among the cuts that keep to that capacity, those are taken that leave what
    remains most even, so a group larger than an even share doesn't empty the
    shards after it.
    """

    def fits(capacity: int) -> bool:
        at = 0
        for _ in range(shards):
            to = ends.at_most(at + capacity)
            if to >= total:
                return True
            if to == at:
                return False
            at = to
        return False

    low, high = -(-total // shards), total
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    must = [total]  # from the right: the least place at which each shard may end
    for _ in range(shards - 1):
        must.append(ends.at_least(must[-1] - low))
    must.reverse()
    cuts, at = [], 0
    for k in range(shards):
        most, even = ends.at_most(at + low), at + -(-(total - at) // (shards - k))
        under, over = ends.at_most(min(even, most)), ends.at_least(min(even, most))
        cut = over if over <= most and (under <= at or over - even < even - under) else under
        at = min(max(cut, must[k], at), max(most, at))
        cuts.append(at)
    return low, cuts


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot`` for every row.

    A row's size is the UTF-8 length of its text plus 1; a null text has size 1
    and is equal to the empty one. Equal texts, and so all repeated rows, go to one
    shard; texts whose 64-bit hashes agree are kept together too. Rows of a group
    stand by id (null first). Fewer groups than shards leave shards empty; an empty
    table gives an empty result. Other columns are ignored.
    """
    spark, text = docs.sparkSession, text_of(text_col)
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("key")), "shard-rows")
    dealt = stored(rows.repartitionByRange(partitions(spark), "key", "doc_id").withColumn("block", F.spark_partition_id()), "shard-blocks")

    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    blocks = dealt.groupBy("block").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    blocks = blocks.select("block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    inside = Window.partitionBy("block").orderBy("key", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("end", F.sum("size").over(inside)).withColumn("nth", F.count(F.lit(1)).over(inside))
    placed = placed.join(F.broadcast(blocks), "block")  # as many rows as shuffle partitions
    placed = stored(placed.select("doc_id", "size", "text_crc32", "key", (F.col("end") + F.col("bytes0")).alias("end"), (F.col("nth") + F.col("n0")).alias("nth")), "shard-places")

    ends = stored(placed.groupBy("key").agg(F.max("end").alias("end")).select("end"), "shard-ends")
    total = ends.agg(F.max("end")).first()[0] or 0
    wide = max(1, -(-total // CELLS))
    summary = [F.min("end").alias("a"), F.max("end").alias("b"), F.count(F.lit(1)).alias("n")]
    cell = F.expr(f"(end - 1) div {wide}")
    known = Ends([(r.a, r.b, r.n) for r in ends.groupBy(cell.alias("cell")).agg(*summary).collect()])
    cuts = [0] * shards
    while total:
        _, cuts = minimax_cuts(known, total, shards)
        if not known.vague:
            break
        vague = [known.cells[k] for k in known.vague]
        values = ", ".join(f"({(a - 1) // wide}L, {a}L, {b}L, {max(1, -(-(b - a + 1) // FINER))}L)" for a, b, _ in vague)
        finer = ends.withColumn("cell", cell).join(F.broadcast(spark.sql(f"SELECT * FROM VALUES {values} AS v(cell, a0, b0, w)")), "cell")
        finer = finer.where("end BETWEEN a0 AND b0").groupBy("a0", F.expr("(end - a0) div w").alias("part")).agg(*summary)
        known = Ends([c for k, c in enumerate(known.cells) if k not in known.vague] + [(r.a, r.b, r.n) for r in finer.collect()])

    number = sum(((F.col("end") > F.lit(c)).cast("int") for c in cuts[:-1]), F.lit(0))
    numbered = placed.withColumn("shard", number)
    first = {r["shard"]: r["first"] for r in numbered.groupBy("shard").agg(F.min("nth").alias("first")).collect()}
    start = F.lit(0).cast("long")
    for k, v in first.items():
        start = F.when(F.col("shard") == k, F.lit(v)).otherwise(start)
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("nth") - start).alias("slot"))


def op7_sharding(spark, sf_dir):
    law = [F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")]
    return shard(documents(spark, sf_dir)).select("doc_id", "size", "text_crc32", *law)
