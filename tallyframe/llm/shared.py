"""Folders and tables that all executors share.

Intermediate tables are written as Parquet below ``spark.checkpoint.dir``: that
cuts the lineage, and a lost executor never takes the only copy of a result
with it. Only a session that runs in one process (``local[...]``: tests,
notebooks) may leave the folder unnamed and gets a private temporary one; on a
cluster that is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as ``spark.checkpoint.dir`` names it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="tallyframe-")
    return _own[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tallyframe/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``stored`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: A key with a share of 1 / HOT of the rows is hot; there can't be more than HOT of them.
HOT = 4096


def spread_join(rows: DataFrame, table: DataFrame, by: list[str], count: str, total: int) -> DataFrame:
    """``rows`` joined with ``table``, which has one row for each value of ``by`` and in ``count`` at least its number of ``rows``, ``total`` in all.

    Rows of hot keys stay where they are and meet a broadcast of those keys, at
    most ``HOT`` of them as their counts add up to ``total``; the others are shuffled.
    """
    hot, cold = table.where(F.col(count) * HOT >= total), table.where(F.col(count) * HOT < total)
    rest = rows.join(F.broadcast(hot.select(*by)), by, "left_anti")
    return rows.join(F.broadcast(hot), by).unionByName(rest.join(cold, by))


#: Marks are bits of 2**25, in bitmaps of 2**15: 4 MB, whatever the input.
MARK_BITS, BITMAP_BITS = 25, 15


def marked(rows: DataFrame, marks: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with ``maybe``: false only if ``marks`` doesn't hold their ``by``. Nothing is shuffled by it but the marks' own bits.

    The bits are broadcast. The more keys are marked, the more rows without a mark
    are true, too: what follows has to look at ``by`` itself.
    """
    place = F.pmod(F.xxhash64(*by), F.lit(1 << MARK_BITS))
    at, bit = F.shiftright(place, BITMAP_BITS).alias("marks_at"), F.pmod(place, F.lit(1 << BITMAP_BITS))
    bits = marks.select(at, bit.alias("bit")).groupBy("marks_at").agg(F.bitmap_construct_agg("bit").alias("marks_set"))
    found = rows.withColumn("marks_at", F.shiftright(place, BITMAP_BITS)).join(F.broadcast(bits), "marks_at", "left")
    byte = F.conv(F.hex(F.substring("marks_set", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1
    return found.withColumn("maybe", F.coalesce(held, F.lit(False))).drop("marks_at", "marks_set")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str = "text"):
    """A text column in which null counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def importable(spark: SparkSession) -> None:
    """Lets Python workers find this package where the driver found it, beside what is shipped to them."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


_tables: dict[str, object] = {}


def worker_table(name: str, make):
    """A worker process's table of what it has learned, one at a time: another operator's makes room for it."""
    if name not in _tables:
        _tables.clear()
        _tables[name] = make()
    return _tables[name]


def _give_back() -> None:
    """Returns memory that a worker process holds but doesn't use, as workers outlive their tasks beside the executor's heap."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def lean(function, every: int = 8):
    """``function`` of record batches, giving unused memory back after ``every`` results and in the end."""

    def run(batches):
        for n, out in enumerate(function(batches), 1):
            yield out
            if n % every == 0:
                _give_back()
        _give_back()

    return run


#: Bytes of an Arrow batch, whatever its number of rows.
BATCH_BYTES = 16 << 20


def arrow_map(df: DataFrame, function, schema, rows: int = 500) -> DataFrame:
    """``df.mapInArrow`` in record batches of ``rows`` rows or ``BATCH_BYTES`` at most, so that long texts don't fill a worker; stored."""
    wanted, spark = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}, df.sparkSession
    before = {k: spark.conf.get(k) for k in wanted}
    importable(spark)
    try:
        for k, v in wanted.items():
            spark.conf.set(k, str(v))
        return stored(df.mapInArrow(lean(function), schema), "rows")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
