"""Exact duplicates by an extendible-hash index on shared files.

Keys are 64-bit hashes of the normalised text. A directory of ``2**depth``
slots (the top bits of a key) points to buckets; a bucket with more than
``capacity`` different keys is split on its next bit, and the directory doubles
when that bit is new. Each bucket covers one range of keys, and runs of buckets
with about equal numbers of keys belong to one owner.

A key that one row has needs no text: its entry is written as it is. Texts of
the other keys are combined on the map side, in ``PIECES`` parts each, so a text
with a third of all rows travels a few times only; their parts go to the
owner of the key's bucket, which compares them byte for byte, chains the
different texts of a key and writes the bucket's page. Which row stays, and how
many are equal, stands in the chain. Rows look their entry up by the directory's
bucket, key and SHA-256 (two texts of one key with equal digests would stop the
job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.shared import discard, documents, marked, partitions, spread_join, stored, text_of

#: A run of these characters counts as one space.
WHITE = "[\\x20\\x09-\\x0D]+"
#: Parts in which the rows of one text reach its owner.
PIECES = 8


def grown_directory(counts: dict[int, int], max_depth: int, capacity: int) -> tuple[int, list[int]]:
    """Global depth, and the local depth of the bucket behind each slot.

    ``counts`` has the number of different keys for each slot at ``max_depth``.
    Begins with one bucket and doubles until no bucket is overfull; buckets that
    still are at ``max_depth`` keep their surplus in chained pages.
    """
    levels = [counts]
    for _ in range(max_depth):
        up: dict[int, int] = {}
        for slot, n in levels[0].items():
            up[slot >> 1] = up.get(slot >> 1, 0) + n
        levels.insert(0, up)
    depth, local = 0, [0]
    while depth < max_depth:
        over = [local[s] == depth and levels[depth].get(s, 0) > capacity for s in range(1 << depth)]
        if not any(over):
            break
        local = [depth + 1 if o else d for d, o in zip(local, over) for _ in (0, 1)]
        depth += 1
    return depth, local


class Directory:
    """Where each key belongs: ``depth`` bits choose a slot, ``local[slot]`` of them name its bucket, ``owner[slot]`` the task that keeps it."""

    def __init__(self, counts: dict[int, int], max_depth: int, capacity: int, owners: int):
        self.depth, self.local = grown_directory(counts, max_depth, capacity)
        whole, held, self.owner = sum(counts.values()), 0, []
        each = [0] * (1 << self.depth)
        for slot, n in counts.items():
            each[slot >> (max_depth - self.depth)] += n
        for slot, bits in enumerate(self.local):
            first = slot >> (self.depth - bits) << (self.depth - bits)
            self.owner.append(min(owners - 1, held * owners // max(whole, 1)) if slot == first else self.owner[first])
            held += each[slot]

    def _slot(self, key: str):
        return F.shiftrightunsigned(key, 64 - self.depth).cast("int") if self.depth else F.lit(0)

    def bucket(self, key: str = "key"):
        """The bucket's first slot."""
        firsts = [slot >> (self.depth - bits) << (self.depth - bits) for slot, bits in enumerate(self.local)]
        return F.element_at(F.from_json(F.lit(str(firsts)), "array<int>"), self._slot(key) + 1)

    def owned_by(self, key: str = "key"):
        return F.element_at(F.from_json(F.lit(str(self.owner)), "array<int>"), self._slot(key) + 1)


def built_index(rows: DataFrame, keys: DataFrame, directory: Directory) -> DataFrame:
    """The pages: ``bucket, key, sha, chain, keep_id, group_size`` for every different text of ``rows(doc_id, key, norm)``; ``keys`` has ``n``, and for single rows id and digest."""
    owners = partitions(rows.sparkSession)
    texts = marked(rows, keys.where("n > 1"), ["key"]).where("maybe")  # and few others
    parts = texts.groupBy("key", "norm", F.pmod(F.xxhash64("doc_id"), F.lit(PIECES)).alias("piece")).agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    parts = parts.withColumn("owner", directory.owned_by()).withColumn("bucket", directory.bucket()).repartition(owners, "owner")
    page = ["owner", "bucket", "key"]
    chained = parts.groupBy(*page, "norm").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    chained = chained.withColumn("sha", F.unhex(F.sha2("norm", 256))).withColumn("all", F.sum("group_size").over(Window.partitionBy(*page))).where("all > 1")
    chained = chained.withColumn("chain", F.row_number().over(Window.partitionBy(*page).orderBy("norm"))).withColumn("n_same", F.count(F.lit(1)).over(Window.partitionBy(*page, "sha")))
    clash = F.when(F.col("n_same") > 1, F.raise_error(F.lit("different texts with one digest"))).otherwise(F.col("chain"))
    several = chained.select("bucket", "key", "sha", clash.alias("chain"), "keep_id", "group_size")
    single = keys.where("n = 1").select(directory.bucket().alias("bucket"), "key", "sha", F.lit(1).alias("chain"), "keep_id", F.lit(1).cast("long").alias("group_size"))
    return stored(several.unionByName(single), "dedup-index")


def looked_up(entries: DataFrame, index: DataFrame, directory: Directory, total: int) -> DataFrame:
    """``entries(doc_id, key, sha)`` with what the page of their bucket says."""
    return spread_join(entries.withColumn("bucket", directory.bucket()), index, ["bucket", "key", "sha"], "group_size", total)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, max_depth: int = 16) -> DataFrame:
    """One row per input row: which row of its group of equal texts stays.

    Columns: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``
    and, of the index, ``bucket`` and ``chain`` (the text's place among the
    texts with its key).

    Null texts count as empty and are equal to each other. Of repeated rows with
    one ``doc_id`` each counts in ``group_size``; as they are one document, all
    are marked as it is. A null ``doc_id`` never stays if another row of its group
    has an id. An empty table gives an empty result. Other columns are ignored.
    The directory holds at most ``2**max_depth`` slots, whatever the input;
    buckets that are overfull even so keep all their keys.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.regexp_replace(text_of(text_col), WHITE, " ").alias("norm")).withColumn("key", F.xxhash64("norm"))
    entries = stored(rows.select("doc_id", "key", F.unhex(F.sha2("norm", 256)).alias("sha")), "dedup-entries")
    keys = stored(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("keep_id"), F.min("sha").alias("sha")), "dedup-keys")
    slots = keys.groupBy(F.shiftrightunsigned("key", 64 - max_depth).cast("int").alias("slot")).count()
    directory = Directory({r["slot"]: r["count"] for r in slots.collect()}, max_depth, capacity, partitions(docs.sparkSession))
    index = built_index(rows, keys, directory)
    discard(keys)
    found = looked_up(entries, index, directory, entries.count())
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "bucket", "chain",
    )


def op10_exact_dedup(spark, sf_dir):
    found = exact_dedup(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP10_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""
