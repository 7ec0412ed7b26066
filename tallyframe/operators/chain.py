"""Hash chains over fetched snapshots: each link is sha256(previous link, content hash, time)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

GENESIS = "GENESIS"


def link(previous: Column, content: Column, time: Column) -> Column:
    return F.sha2(F.concat(previous, content, time).cast("binary"), 256)


def build(entries: DataFrame, chain: list[str], seq: str = "seq") -> DataFrame:
    """``entries(seq, ts, sha_contenido)`` with ``eslabon`` and ``eslabon_anterior``.

    A chain is sequential: it is sorted into one partition and folded there, row after
    row, with only the last link held; chains run side by side. After a null content
    or time the chain's links are null.
    """
    ordered = entries.repartition(*chain).sortWithinPartitions(*chain, seq)
    schema = StructType([*entries.schema.fields, StructField("eslabon", StringType()), StructField("eslabon_anterior", StringType())])
    genesis = GENESIS

    def fold(batches):
        import hashlib

        import pyarrow as pa

        at, last = None, genesis
        for batch in batches:
            made, before = [], []
            columns = [batch.column(c).to_pylist() for c in (*chain, "sha_contenido", "ts")]
            for *key, content, time in zip(*columns):
                if key != at:
                    at, last = key, genesis
                before.append(last)
                last = None if None in (last, content, time) else hashlib.sha256(f"{last}{content}{time}".encode()).hexdigest()
                made.append(last)
            arrays = [*batch.columns, pa.array(made, pa.string()), pa.array(before, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return ordered.mapInArrow(fold, schema)


def verify(links: DataFrame, chain: list[str], seq: str = "seq") -> DataFrame:
    """Adds ``ok``: the link names the stored one before it and is its own hash. No recursion: links are stored."""
    before = F.coalesce(F.lag("eslabon").over(Window.partitionBy(*chain).orderBy(seq)), F.lit(GENESIS))
    return links.withColumn("_before", before).withColumn("ok", (F.col("eslabon_anterior") == F.col("_before")) & (link(F.col("_before"), F.col("sha_contenido"), F.col("ts")) == F.col("eslabon"))).drop("_before")
