"""Token totals by source, language and tokenizer version, kept up by signed deltas.

Inserts add a document's count, deletes take it away, revisions do both. A
batch's deltas are summed per cell, written aside and then moved to the batch's
name in one step, which fails if that name is there already: commits may be
repeated, and of two writers of one batch one wins. Totals are sums over the
committed batches; a numbered snapshot holds the sums of all batches before it
and a table of their ids, so any number of batches can be folded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.shared import arrow_map, documents, new_path, stored, text_of
from tallyframe.llm.tokens import portions, token_counts

KEYS = ("source", "lang", "tokenizer")
#: Tokenizer versions and their vocabulary files, beside the installed public vocabularies.
TOKENIZERS = {"word_bpe_49k": "word_bpe_49k.json", "byte_bpe_50k": "byte_bpe_50k.tiktoken"}
SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"


def counted(docs: DataFrame, vocabularies: dict[str, str]) -> DataFrame:
    """``doc_id, source, lang, counts`` of ``docs(doc_id, source, lang, text)``; ``counts`` has the tokens by version. Stored."""
    paths = list(vocabularies.values())

    def count(batches):
        import pyarrow as pa

        for batch in batches:
            sums = [[n for texts in portions(batch.column(3)) for n in token_counts(p, texts)] for p in paths]
            rows = pa.array([list(x) for x in zip(*sums)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], rows], names=["doc_id", "source", "lang", "counts"])

    keyed = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("source", "lang")]
    return arrow_map(docs.select(F.col("doc_id").cast("long"), *keyed, text_of()), count, "doc_id long, source string, lang string, counts array<long>", 2000)


def signed(rows: DataFrame, sign: int, vocabularies: dict[str, str]) -> DataFrame:
    """Deltas of ``rows(source, lang, counts)``, summed: every row once for each tokenizer version."""
    sums = [F.sum(F.get("counts", F.lit(k))).alias(f"n{k}") for k in range(len(vocabularies))]
    cells = rows.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"), *sums)
    each = F.explode(F.array(*[F.struct(F.lit(v).alias("tokenizer"), F.col(f"n{k}").alias("tokens")) for k, v in enumerate(vocabularies)])).alias("c")
    found = cells.select("source", "lang", each, "n")
    return found.select("source", "lang", "c.tokenizer", (sign * F.col("n")).alias("documents"), (sign * F.col("c.tokens")).alias("tokens"))


class Rollup:
    """A rollup in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _names(self, kind: str) -> list[str]:
        system, place = self._folder(f"{self.path}/{kind}")
        return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []

    def _moved(self, made: str, name: str) -> bool:
        """Moves a finished folder to its name at once; False, and nothing is left of it, if the name is taken."""
        from py4j.protocol import Py4JJavaError

        jvm, (system, place) = self.spark._jvm, self._folder(made)
        target = self._folder(name)[1]
        system.mkdirs(target.getParent())
        if not system.exists(target):
            options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            try:
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self.spark._jsc.hadoopConfiguration()).rename(place, target, options)
                return True
            except Py4JJavaError:
                if not system.exists(target):
                    raise
        system.delete(place, True)
        return False

    def _snapshot(self) -> tuple[str | None, set[str]]:
        """The last snapshot and the batches that it holds."""
        names = self._names("snapshots")
        if not names:
            return None, set()
        return names[-1], {r["batch"] for r in self.spark.read.schema("batch string").parquet(f"{self.path}/snapshots/{names[-1]}/held").collect()}

    def committed(self) -> list[str]:
        """Ids of the batches that count."""
        return sorted(self._snapshot()[1] | set(self._names("batches")))

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Writes a batch's deltas unless they are there; False if they were."""
        if not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError("a batch id has letters, digits, - and _ only")
        if batch in self.committed():
            return False
        made = new_path(self.spark, "token-batch")
        deltas.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")).write.parquet(made)
        return self._moved(made, f"{self.path}/batches/{batch}")

    def _sums(self, snapshot: str | None, batches: list[str]) -> DataFrame:
        paths = [f"{self.path}/batches/{b}" for b in batches] + ([f"{self.path}/snapshots/{snapshot}/sums"] if snapshot else [])
        rows = self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)
        summed = rows.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return summed.where("documents <> 0 OR tokens <> 0")

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, documents, tokens`` over all committed batches; cells that came to nothing are left out."""
        snapshot, held = self._snapshot()
        return self._sums(snapshot, [b for b in self._names("batches") if b not in held])

    def compact(self) -> bool:
        """Folds what is committed into the next snapshot; False if another writer made that one, or nothing is new."""
        snapshot, held = self._snapshot()
        new = [b for b in self._names("batches") if b not in held]
        if not new:
            return False
        made = new_path(self.spark, "token-snapshot")
        self._sums(snapshot, new).write.parquet(f"{made}/sums")
        self.spark.createDataFrame([(b,) for b in sorted(held.union(new))], "batch string").coalesce(1).write.parquet(f"{made}/held")
        return self._moved(made, f"{self.path}/snapshots/{int(snapshot or 0) + 1:012d}")


def token_rollup(docs: DataFrame, removed: DataFrame, revised: DataFrame, path: str | None = None, vocabularies: dict[str, str] | None = None) -> DataFrame:
    """Totals after three batches: all of ``docs`` in, ``removed(doc_id)`` out, ``revised(doc_id, text)`` counted anew.

    Null sources, languages and texts count as empty strings; an empty text is a
    document of 0 tokens. Repeated rows of ``docs`` are documents of their own and go
    together; ids that ``docs`` doesn't have change nothing, nor do null ids. Of
    several revisions of an id the one with the greatest text holds. Each batch is
    committed twice, as after a lost answer, which changes nothing. Other columns
    are ignored; empty tables give empty totals.
    """
    spark, versions = docs.sparkSession, vocabularies or TOKENIZERS
    rollup = Rollup(spark, path or new_path(spark, "token-rollup"))
    state = counted(docs, versions)
    gone = removed.select("doc_id").where("doc_id IS NOT NULL").distinct()
    out = state.join(gone, "doc_id", "left_semi")
    new = revised.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(text_of("text")).alias("text"))
    old = stored(state.join(new.select("doc_id"), "doc_id", "left_semi").join(gone, "doc_id", "left_anti"), "token-old")
    now = counted(old.select("doc_id", "source", "lang").join(new, "doc_id"), versions)
    for _ in range(2):
        rollup.commit("insert-0", signed(state, 1, versions))
        rollup.commit("delete-1", signed(out, -1, versions))
        rollup.commit("revise-2", signed(old, -1, versions).unionByName(signed(now, 1, versions)))
    return rollup.totals()


def op9_token_counts(spark, sf_dir):
    """All documents come in, whole; as the tables have no feed of changes, one is made up: toxic documents are taken down, those of low quality are revised to their first line."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    low = labels.where("quality = 0").select("doc_id").distinct()
    revised = docs.select("doc_id", F.substring_index("text", "\n", 1).alias("text")).join(low, "doc_id", "left_semi")
    return token_rollup(docs, labels.where("toxic = 1"), revised)
