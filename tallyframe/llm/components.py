"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.shared import stored


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (the least id that can be reached) for every id in ``links(a, b)``.

    Each round takes the least label among an id's neighbours and then that
    label's own label, so long chains halve; rounds go on until no label changes.
    Every round is written, which cuts the lineage. A hub with a large share of the
    links meets partial aggregation and joins whose hot keys are split.
    """
    edges = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least")).select("id", F.least("id", "least").alias("component")), "labels")
    while True:
        near = edges.join(labels, F.col("b") == F.col("id")).groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        mine = labels.join(near, "id").select("id", F.col("component").alias("was"), F.least("component", "near").alias("to"))
        jump = labels.select(F.col("id").alias("to"), F.col("component").alias("further"))
        new = stored(mine.join(jump, "to", "left").select("id", F.least("to", F.coalesce("further", "to")).alias("component"), "was"), "labels")
        if new.where("component <> was").isEmpty():
            return new.select("id", "component")
        labels = new.select("id", "component")
