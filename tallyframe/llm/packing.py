"""Vector best-fit packing of documents into fixed-size training sequences.

A piece has a size in three dimensions: tokens, documents (1) and attention
cost (its length squared); a sequence has a capacity in each. Pieces of equal
length are interchangeable, so the packing is done on their counts, longest
first: all of a length at once go to the class of open sequences whose weighted
residual fits best and under every constraint. The driver sees one count for
each length (at most ``max_tokens`` of them) and classes of sequences as ranges
of numbers, whatever the number of documents; the executors then look up each
piece by its length and its rank among the pieces of that length.

Limits of documents and attention that aren't given are made as tight as they
can be without a further sequence: first documents, then attention, step by
step, while the number of sequences stays what the token limit alone gives. A
sequence of one piece is always allowed.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.shared import arrow_map, documents, partitions, stored, text_of
from tallyframe.llm.tokens import WORD_BPE, chunk_ids, portions

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, max_tokens: int, tokenizer: str, id_col: str, text_col: str) -> DataFrame:
    """Each document's ids, then id 0, cut every ``max_tokens``."""

    def pieces(batches):
        import pyarrow as pa

        table, zero = chunk_ids(tokenizer), bytes(4)
        for batch in batches:
            out, ids = [], iter(batch.column(0).to_pylist())
            for texts in portions(batch.column(1)):
                flat, ends = table.column(texts)
                ends = ends.tolist()
                for a, b in zip(ends, ends[1:]):
                    doc, n = next(ids), b - a + 1
                    for k, at in enumerate(range(0, n, max_tokens)):
                        length = min(max_tokens, n - at)
                        last = at + length == n  # ends with id 0, which isn't in the table
                        crc = zlib.crc32(flat[a + at : a + at + length - last])
                        out.append((doc, k, at, length, zlib.crc32(zero, crc) if last else crc))
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return arrow_map(docs.select(F.col(id_col).cast("long"), text_of(text_col)), pieces, PIECES, 3000)


def best_fit(counts: dict[int, int], capacity: tuple[int, int, int], weights: tuple[float, float, float] = (1.0, 1e-4, 1e-4), rule: str = "norm") -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first rank, number, first sequence, offset).

    Piece ``first rank + k`` goes to sequence ``first sequence + k``. ``norm``
    takes the sequences of least weighted residual after the piece, ``dot`` those
    with the largest weighted product of residual and size.
    """
    import numpy as np

    cap, w = np.array(capacity, float), np.array(weights, float)
    classes: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
    out, sequences = [], 0

    def taken(left, size):
        return tuple(a - b for a, b in zip(left, size))

    for length in sorted(counts, reverse=True):
        size, n, rank = (length, 1, length * length), counts[length], 0
        if length > capacity[0]:
            raise ValueError(f"no sequence can hold a piece of {length} tokens")
        while n:
            keys = [k for k in classes if k[0] >= length and k[1] >= 1 and k[2] >= size[2]]
            if not keys:
                break
            left = np.array(keys, float)
            if rule == "dot":
                best = keys[int(np.argmax((left / cap * (np.array(size) / cap) * w).sum(1)))]
            else:
                best = keys[int(np.argmin((((left - size) / cap) ** 2 * w).sum(1)))]
            ranges, moved = classes[best], []
            while n and ranges:
                first, m = ranges.pop()
                put = min(m, n)
                if put < m:
                    ranges.append((first + put, m - put))
                out.append((length, rank, put, first, capacity[0] - best[0]))
                moved.append((first, put))
                n, rank = n - put, rank + put
            if not ranges:
                del classes[best]
            rest = taken(best, size)
            if min(rest) > 0:
                classes.setdefault(rest, []).extend(moved)
        if n:
            each = max(1, min(c // s for c, s in zip(capacity, size)))  # one piece is always allowed
            for bins, inside in ((n // each, each), (1, n % each)):  # full new sequences, then one with the rest
                if bins and inside:
                    rest = capacity
                    for k in range(inside):
                        out.append((length, rank, bins, sequences, k * length))
                        rank, rest = rank + bins, taken(rest, size)
                    if min(rest) > 0:
                        classes.setdefault(rest, []).append((sequences, bins))
                    sequences += bins
    return out


def sequences_of(places) -> int:
    return max((first + n for _, _, n, first, _ in places), default=0)


def tightest(counts: dict[int, int], max_tokens: int, max_documents: int | None, max_attention: int | None, rule: str):
    """The capacity and the places of its best fit; limits that aren't given are tightened while they cost no sequence."""
    capacity = [max_tokens, max_documents or max_tokens, max_attention or max_tokens * max_tokens]
    places = best_fit(counts, tuple(capacity), rule=rule)
    for dimension, given, steps in ((1, max_documents, [int(max_tokens * 0.7**k) for k in range(1, 22)]), (2, max_attention, [max_tokens * max_tokens * k // 16 for k in range(15, 0, -1)])):
        for step in [] if given else steps:
            tried = [*capacity[:dimension], step, *capacity[dimension + 1 :]]
            found = best_fit(counts, tuple(tried), rule=rule) if step else []
            if not step or sequences_of(found) > sequences_of(places):
                break
            capacity, places = tried, found
    return tuple(capacity), places


#: Places are broadcast up to this number of rows of five numbers (8 MB); beyond it they are shuffled.
BROADCAST_PLACES = 200_000


def pack(docs: DataFrame, max_tokens: int = 2048, max_documents: int | None = None, max_attention: int | None = None, tokenizer: str = WORD_BPE, rule: str = "norm", id_col: str = "doc_id", text_col: str = "text", broadcast_places: int = BROADCAST_PLACES) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``tokenizer`` is a vocabulary file: a path that every executor has, or the
    name of one beside the installed public vocabularies. Limits that aren't given
    are the tightest that cost no further sequence (``tightest``).

    Null and empty texts are one piece of one id. Repeated rows are pieces of their
    own. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    pieces = cut_pieces(docs, max_tokens, tokenizer, id_col, text_col)

    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(max(16, partitions(spark)))))
    groups = stored(salted.groupBy("length", "salt").count(), "pack-counts")  # at most lengths x salts
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    groups = groups.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    _, places = tightest(counts, max_tokens, max_documents, max_attention, rule)
    found = spark.createDataFrame(places, "length long, first long, number long, sequence long, offset long")
    found = F.broadcast(found) if len(places) <= broadcast_places else found.hint("shuffle_hash")

    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("nth", F.row_number().over(inside) - 1).join(groups.hint("merge"), ["length", "salt"])  # dealt and sorted for the ranks already
    ranked = ranked.withColumn("rank", F.col("nth") + F.col("before")).alias("p")
    found = ranked.join(found.alias("b"), F.expr("p.length = b.length AND p.rank >= b.first AND p.rank < b.first + b.number"))
    return found.select("doc_id", "piece", "start", F.col("p.length").alias("length"), "ids_crc32", F.expr("b.sequence + p.rank - b.first").alias("sequence_id"), "offset")


def op8_packing(spark, sf_dir):
    return pack(documents(spark, sf_dir))
