"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet below the cluster's shared folder and hands what it reads again to
the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.line_dedup import line_dedup
from tallyframe.llm.mixing import mix
from tallyframe.llm.near_dedup import NO_ID, near_dedup
from tallyframe.llm.packing import pack
from tallyframe.llm.quality import keep_good
from tallyframe.llm.shared import documents, marked, stored, text_of

#: Ids that several texts have are only broadcast up to this number.
BROADCAST_IDS = 20_000
#: The lines stage deletes later copies of runs of this many words: passages, not single lines that many documents share.
PASSAGE_WORDS = 50
#: Ids from here on are given to rows that have none of their own.
OWN_IDS = 1 << 62


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.7 or more."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _beside(docs: DataFrame, *needed: str) -> DataFrame:
    """The columns that an operator needs, and all of ``docs`` as one, so that no name clashes with the operator's own."""
    return docs.select(*needed, F.struct(*docs.columns).alias("whole_row"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs of ``PASSAGE_WORDS`` words; documents of which nothing is left go."""
    found, changed = line_dedup(_beside(docs, "doc_id", "text"), PASSAGE_WORDS), F.col("n_removed") > 0
    emptied = changed & ~F.col("clean_text").rlike("[^\\x20\\x09-\\x0D]")
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    old = {c: F.col(f"whole_row.`{c}`") for c in docs.columns}
    return found.where(~emptied).select(*[(F.when(changed, new[c]).otherwise(old[c]) if c in new else old[c]).alias(c) for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    Rows without an id, and rows whose id another text has too, are documents by id
    and text, so that unrelated texts don't go together; they rank behind all others.
    Rows that stay are left where they lie; those that may go meet the ids that do.
    """
    mark = F.xxhash64(text_of("text"))
    shared = docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("shared_id")).agg(F.min(mark).alias("low"), F.max(mark).alias("high"))
    shared = stored(shared.where("low < high").select("shared_id"), "near-shared-ids")
    shared = F.broadcast(shared) if shared.count() <= BROADCAST_IDS else shared.hint("merge")
    rows = _beside(docs, "doc_id", "text").join(shared, F.col("doc_id") == F.col("shared_id"), "left")
    own = F.xxhash64("doc_id", text_of("text")).bitwiseAND(F.lit(OWN_IDS - 1)).bitwiseOR(F.lit(OWN_IDS))
    rows = rows.select(F.when(F.col("doc_id").isNull() | F.col("shared_id").isNotNull(), own).otherwise(F.col("doc_id")).alias("near_id"), "text", "whole_row")
    found = near_dedup(rows, id_col="near_id").groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("near_id")).agg(F.max("kept").alias("kept"))
    gone = stored(found.where("NOT kept").select("near_id"), "near-gone")
    rows = marked(rows.drop("text"), gone, ["near_id"])
    rest = rows.where("maybe").join(gone.hint("merge"), "near_id", "left_anti")  # by sort and merge at every size
    return rows.where("NOT maybe").select("whole_row.*").unionByName(rest.select("whole_row.*"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The largest sample that has the target weights of sources, languages and topics."""
    return mix(_beside(docs, "doc_id", "text", "source", "lang")).where("sampled").select("whole_row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: The classifier, the near-duplicate stage and the tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None
