"""The manifest monitor as a stream of snapshot files.

Every file is one micro-batch: its index is compared with the last one, counters
and alerts are logged and a chain link is added. State lives in a folder as
Parquet, one sub-folder a batch, so a batch that is run again after a failure
replaces what it wrote. Restarting goes on from the stream's checkpoint.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.operators import chain, snapshots
from tallyframe.sources.manifest import index, nodes

LOG = "batch long, file string, ts string, sha_contenido string, n_actas long, anadidas long, eliminadas long, hash_cambiado long, estado_cambiado long, alerta boolean, guardado boolean, eslabon string, eslabon_anterior string"


class Monitor:
    """``only_changes`` keeps an index only if its content differs from the last; the chain has every fetch."""

    def __init__(self, spark: SparkSession, state: str, only_changes: bool = False):
        self.spark, self.state, self.only_changes = spark, state.rstrip("/"), only_changes

    def _exists(self, name: str) -> bool:
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{self.state}/{name}")
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def log(self) -> DataFrame:
        if not self._exists("log"):
            return self.spark.sql("SELECT 1").select(*[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in LOG.split(", ")]).limit(0)
        return self.spark.read.option("recursiveFileLookup", "true").schema(LOG).parquet(f"{self.state}/log")

    def alerts(self) -> DataFrame:
        """What was removed or replaced, and when."""
        return self.spark.read.option("recursiveFileLookup", "true").json(f"{self.state}/alerts", schema="batch long, ts string, tipo string, key string, antes string, ahora string")

    def process(self, files: DataFrame, batch: int) -> None:
        """One fetched file (``file, text``): diff to the last kept index, alert, link, log."""
        spark = self.spark
        head = files.select("file", F.sha2(F.col("text").cast("binary"), 256).alias("sha")).first()
        if head is None:
            return
        ts = F.regexp_extract(F.lit(head["file"]), "([0-9]{8}_[0-9]{6})", 1)
        past = self.log().where(F.col("batch") < batch)
        last = past.orderBy(F.desc("batch")).first()
        kept = past.where("guardado").orderBy(F.desc("batch")).first()
        now = index(nodes(files)).drop("file").withColumn("ts", ts)
        changed = last is None or last["sha_contenido"] != head["sha"]
        save = changed or not self.only_changes
        if save:
            now.write.mode("overwrite").parquet(f"{self.state}/index/batch={batch}")
        found = None
        if kept is not None:
            found = snapshots.diff(spark.read.parquet(f"{self.state}/index/batch={kept['batch']}"), now)
        counts = {k: 0 for k in ("anadida", "eliminada", "hash_cambiado", "estado_cambiado")}
        if found is not None:
            counts |= {r["tipo"]: r["count"] for r in found.groupBy("tipo").count().collect()}
        alert = counts["eliminada"] > 0 or counts["hash_cambiado"] > 0
        if alert:
            found.where("tipo IN ('eliminada', 'hash_cambiado')").select(F.lit(batch).cast("long").alias("batch"), ts.alias("ts"), "tipo", "key", "antes", "ahora").write.mode("overwrite").json(f"{self.state}/alerts/batch={batch}")
        previous = last["eslabon"] if last is not None else chain.GENESIS
        row = now.agg(F.count(F.lit(1)).alias("n_actas")).select(
            F.lit(batch).cast("long").alias("batch"), F.lit(head["file"]).alias("file"), ts.alias("ts"), F.lit(head["sha"]).alias("sha_contenido"), "n_actas",
            *[F.lit(counts[k]).cast("long").alias(n) for k, n in (("anadida", "anadidas"), ("eliminada", "eliminadas"), ("hash_cambiado", "hash_cambiado"), ("estado_cambiado", "estado_cambiado"))],
            F.lit(alert).alias("alerta"), F.lit(save).alias("guardado"), chain.link(F.lit(previous), F.lit(head["sha"]), ts).alias("eslabon"), F.lit(previous).alias("eslabon_anterior"),
        )
        row.write.mode("overwrite").parquet(f"{self.state}/log/batch={batch}")

    def start(self, folder: str, once: bool = True, interval: str = "600 seconds"):
        """Follows a folder of snapshots; ``once`` takes what is there and ends."""
        files = self.spark.readStream.format("text").option("wholetext", "true").option("maxFilesPerTrigger", 1).load(folder)
        rows = files.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
        trigger = {"availableNow": True} if once else {"processingTime": interval}
        return rows.writeStream.foreachBatch(self.process).option("checkpointLocation", f"{self.state}/checkpoint").trigger(**trigger).start()


def run_cycles(monitor: Monitor, folder: str, cycles: int, interval: float = 300.0, fetch: Callable[[], object] | None = None) -> list[str]:
    """A given number of cycles: ``fetch`` adds to the folder, the monitor takes what is there; errors of fetching end no cycle and are returned."""
    errors = []
    for cycle in range(cycles):
        try:
            if fetch is not None:
                fetch()
        except (OSError, ValueError) as e:
            errors.append(f"{cycle}: {e}")
        monitor.start(folder).awaitTermination()
        if cycle < cycles - 1:
            time.sleep(interval)
    return errors


def changes_by_key(rows: DataFrame) -> DataFrame:
    """A stream of ``key, snap_ts, name, status`` to its changes, with the last name and status of each key as state."""

    def step(key, batches, state):
        import pandas as pd

        last = state.get if state.exists else None
        for pdf in batches:
            out = []
            for r in pdf.sort_values("snap_ts").itertuples():
                if last is not None:
                    for kind, a, b in (("hash_cambiado", last[0], r.name), ("estado_cambiado", last[1], r.status)):
                        if a != b:
                            out.append((key[0], r.snap_ts, kind, a, b))
                last = (r.name, r.status)
            yield pd.DataFrame(out, columns=["key", "snap_ts", "tipo", "antes", "ahora"])
        state.update(last)

    return rows.groupBy("key").applyInPandasWithState(step, "key string, snap_ts timestamp, tipo string, antes string, ahora string", "name string, status string", "append", "NoTimeout")
