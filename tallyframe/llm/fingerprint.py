"""Improbable-feature digests of documents, and their likeness.

A feature is a window of ``WINDOW`` bytes. Each window gets the entropy of its
bytes; how common that entropy is in text is modelled by a bell curve, and the
rarest window (the first, of equals) of every ``WINDOW`` neighbours in a row
scores a point. Windows with ``POINTS`` points are the document's improbable
features. They are hashed into a chain of Bloom filters of ``BITS`` bits, each
closed at ``FULL`` features. Two filters are compared by the bits they share,
normalised between what chance gives and what the emptier one has; two digests
by the mean of the best match of each filter of the shorter chain, weighted by
its bits.
"""

from __future__ import annotations

import base64
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.shared import documents, importable, new_path, partitions, text_of

WINDOW, POINTS = 16, 4
BITS, HASHES, FULL = 1024, 3, 160
#: The entropy, in bits, that is most common for a window of text, its spread, and the share of the way up from chance at which likeness begins.
COMMON, SPREAD, CUT = 3.0, 0.35, 0.15


def _tables():
    import numpy as np

    n = np.arange(WINDOW + 1, dtype=float)
    terms = np.round(np.where(n > 0, n * np.log2(np.maximum(n, 1)), 0) * 4096).astype(np.int64)
    return terms


def ranks(data):
    """For every window of the byte array, how common its entropy is: 0 is the rarest."""
    import numpy as np

    n, w = len(data), WINDOW
    terms = _tables()
    m = n - w + 1
    order = np.argsort(data, kind="stable")  # positions by byte, ascending
    keyed = data[order].astype(np.int64) * (2 * n + w) + order
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    base = data.astype(np.int64) * (2 * n + w)
    at = np.arange(n)
    upto = np.empty(n, np.int64)  # of equal bytes, how many stand before position i + w
    upto[order] = np.searchsorted(keyed, (base + at + w)[order])
    down = upto[: m - 1] - place[: m - 1]  # occurrences of the byte that leaves, in its window
    since = np.empty(n, np.int64)
    since[order] = np.searchsorted(keyed, (base + at - w)[order])
    up = (place - since)[w:]  # occurrences of the byte that comes, in the window before it
    same = data[: m - 1] == data[w:]
    change = terms[down - 1] - terms[down] + terms[up + 1] - terms[up]
    change[same] = 0
    total = np.empty(m, np.int64)
    total[0] = terms[np.bincount(data[:w])].sum()
    np.cumsum(change, out=total[1:])
    total[1:] += total[0]
    entropy = np.log2(w) - total / (4096 * w)
    return np.round(1000 * np.exp(-(((entropy - COMMON) / SPREAD) ** 2) / 2)).astype(np.int64)


def features(data, rank=None):
    """Hashes of the improbable windows, in order of their place."""
    import numpy as np

    if not len(data):
        return np.empty(0, np.uint64)
    if len(data) < WINDOW:
        data = np.concatenate([data, np.zeros(WINDOW - len(data), np.uint8)])
        rank = None
    rank = ranks(data) if rank is None else rank
    m = len(rank)
    key = rank * (1 << 40) + np.arange(m)
    least, width = key, 1
    while width < min(WINDOW, m):  # the least of each run of WINDOW neighbours, by doubling
        step = min(width, min(WINDOW, m) - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    points = np.bincount(least & ((1 << 40) - 1), minlength=m)
    chosen = np.flatnonzero(points >= min(POINTS, points.max()))
    words = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[chosen].copy().view("<u8")
    mixed = np.zeros(len(chosen), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(words.shape[1]):
            mixed = (mixed ^ words[:, k]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
    return mixed


def chained(hashes):
    """The chain of filters, one row of bytes each; different features only, ``FULL`` to a filter."""
    import numpy as np

    if not len(hashes):
        return np.empty((0, BITS // 8), np.uint8)
    _, first = np.unique(hashes, return_index=True)
    hashes = hashes[np.sort(first)]
    bits = np.zeros((-(-len(hashes) // FULL), BITS), np.uint8)
    row = np.arange(len(hashes)) // FULL
    for k in range(HASHES):
        bits[row, (hashes >> np.uint64(11 * k)) & np.uint64(BITS - 1)] = 1
    return np.packbits(bits, axis=1)


def likeness(a, b) -> float:
    """0 to 1. Digests of empty texts are alike to each other only."""
    import numpy as np

    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return float(not len(b))
    ones_a, ones_b = (np.bitwise_count(x).sum(1, dtype=np.int64) for x in (a, b))
    best = np.zeros(len(a))
    for k in range(len(a)):
        both = np.bitwise_count(a[k] & b).sum(1, dtype=np.int64)
        most = np.minimum(ones_a[k], ones_b)
        chance = ones_a[k] * ones_b / BITS
        least = chance + CUT * (most - chance)
        best[k] = np.clip((both - least) / np.maximum(most - least, 1e-9), 0, 1).max()
    return float(np.average(best, weights=ones_a))


def digest(text: str):
    import numpy as np

    return chained(features(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)))


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next document."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


class _Document:
    """A text with what its digest and its edited text's digest are made of."""

    def __init__(self, doc_id, text: str):
        import numpy as np

        self.doc_id, self.text = doc_id, text
        self.data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        self.rank = ranks(self.data) if len(self.data) >= WINDOW else None
        self.filters = chained(features(self.data, self.rank))

    def row(self, after: "_Document") -> tuple:
        import numpy as np

        text = edited(self.text, after.text)
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        kept = len(self.text[: len(self.text) - len(self.text) // 4].encode("utf-8", "surrogatepass")) - WINDOW + 1
        rank = None
        if len(data) >= WINDOW and self.rank is not None and kept > 0:  # windows before the edit keep their rank
            tail = data[kept:]
            rank = self.rank[:kept] if len(tail) < WINDOW else np.concatenate([self.rank[:kept], ranks(tail)])
        filters = chained(features(data, rank))
        coded = lambda x: base64.b64encode(x.tobytes()).decode()
        return (self.doc_id, len(self.text), hashlib.sha256(data.tobytes()).hexdigest(), coded(self.filters), coded(filters), likeness(self.filters, filters), likeness(self.filters, after.filters))


COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
#: With ``part`` 0, a finished row; 1, the first document of a partition; 2, its last, whose next one is in another.
WALKED = COLUMNS + ", part int, block int, text string"


def _batch(rows, schema):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _opened(data: bytes) -> str:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data, max_output_size=1 << 31).decode("utf-8", "surrogatepass")


def _walk(batches):
    """Pairs each document of a sorted partition with the next."""
    from pyspark import TaskContext

    block, last = TaskContext.get().partitionId(), None
    for batch in batches:
        out = []
        for doc_id, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            now = _Document(doc_id, _opened(packed))
            out.append((doc_id, *[None] * 6, 1, block, now.text) if last is None else (*last.row(now), 0, block, None))
            last = now
        yield _batch(out, WALKED)
    if last is not None:
        yield _batch([(last.doc_id, *[None] * 6, 2, block, last.text)], WALKED)


def _joined(batches):
    for batch in batches:
        rows = zip(*(batch.column(k).to_pylist() for k in range(3)))
        yield _batch([_Document(i, t).row(_Document(None, after)) for i, t, after in rows], COLUMNS)


def _packed(batches):
    import pyarrow as pa
    import zstandard

    for batch in batches:
        level = zstandard.ZstdCompressor(level=3)
        packed = [level.compress(t.encode("utf-8", "surrogatepass")) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["doc_id", "packed"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's digest, that of its edited text, and its likeness to that and to the next document.

    The next document is the one with the next larger id (null ids come first);
    after the last comes the first. Rows with equal ids stand by their text.
    Null texts count as empty: no features, an empty digest. Texts below one window
    are one feature, filled up with zeros. A table of one row is its own next; an
    empty table gives an empty result. Other columns are ignored.

    Texts are range-partitioned by id in compressed form (they are compressed once
    more for the ranges, which costs less than to store them), and each partition is
    walked in order; only its first and last texts are looked at again, to close
    the gaps between partitions.
    """
    spark = docs.sparkSession
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    importable(spark)
    spark.conf.set(key, "500")
    try:
        texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(_packed, "doc_id long, packed binary")
        ordered = texts.repartitionByRange(partitions(spark), "doc_id", F.length("packed")).sortWithinPartitions("doc_id", F.length("packed"), "packed")
        walked_path = new_path(spark, "fingerprint-rows")
        ordered.mapInArrow(_walk, WALKED).write.option("compression", "zstd").parquet(walked_path)
        walked = spark.read.schema(WALKED).parquet(walked_path)

        firsts = {r["block"] for r in walked.where("part = 1").select("block").collect()}  # one row a partition
        order = sorted(firsts)
        follows = spark.createDataFrame(list(zip(order, order[1:] + order[:1])), "block int, at int")
        done_path = new_path(spark, "fingerprint-edges")
        ends = walked.where("part = 2").select("doc_id", "text", "block").join(F.broadcast(follows), "block")  # a row a partition
        starts = walked.where("part = 1").select(F.col("block").alias("at"), F.col("text").alias("after"))
        ends.join(starts, "at").select("doc_id", "text", "after").mapInArrow(_joined, COLUMNS).write.parquet(done_path)
    finally:
        spark.conf.set(key, before)
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    return walked.where("part = 0").select(*names).unionByName(spark.read.schema(COLUMNS).parquet(done_path))


def op4_fingerprints(spark, sf_dir):
    return fingerprints(documents(spark, sf_dir))
