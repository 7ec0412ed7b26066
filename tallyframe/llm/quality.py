"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal.

A word is hashed twice: as it is (in lower case, without marks at its ends) and
as a shape (runs of capitals, small letters and digits as one sign each, marks
as they are). Features are hashed 1- and 2-grams of words, 1- to 3-grams of
shapes, and whether a word repeats the one before; each family's counts are
divided by their sum, so a score doesn't depend on a text's length. A score is
the sparse dot product of those with the weights.

Weights are learned by the follow-the-regularised-leader update, one document
at a time, in ``SHARDS`` independent runs whose weights are averaged: only a
model, never a text, reaches the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.shared import arrow_map, documents, importable, text_of, worker_table

#: Weights, and what a family's share is multiplied by: words, word pairs, shapes, shape pairs, shape triples, repeats.
DIMENSION = 1 << 17
SCALES = (2.0, 2.0, 4.0, 4.0, 4.0, 4.0)
#: At most this many labelled documents are learned from, in so many runs.
SAMPLE, SHARDS, EPOCHS = 4000, 4, 3
ALPHA, BETA, L1, L2 = 1.0, 0.5, 1e-4, 1e-5
_RUNS = re.compile(r"([A-ZÀ-ÖØ-Þ]+)|([a-zß-öø-ÿ]+)|([0-9]+)")
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


class _Words(dict):
    """Words to 64 bits: the word's hash in the upper half, its shape's in the lower."""

    def __missing__(self, word: str) -> int:
        import xxhash

        shape = _RUNS.sub(lambda m: "A" if m[1] else "a" if m[2] else "0", word)
        plain = word.lower().strip(_MARKS)
        self[word] = value = xxhash.xxh32_intdigest(plain.encode("utf-8", "surrogatepass")) << 32 | xxhash.xxh32_intdigest(shape.encode("utf-8", "surrogatepass"))
        return value


def _known() -> _Words:
    return worker_table("words", _Words)


def _mixed(x, seed: int):
    import numpy as np

    x = (x + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(40)).astype(np.int64) & (DIMENSION - 1)


def families(text: str) -> list:
    """For each family, the weights' indexes of its features; repeats count once each."""
    import numpy as np

    words, known = text.split(), _known()
    if len(known) > 400_000:
        known.clear()
    both = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    word, shape = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    three = np.uint64(0x1000193)
    pairs = shape[:-1] * three ^ shape[1:]
    again = (word[:-1] == word[1:]).astype(np.uint64)
    return [
        _mixed(word, 1), _mixed(word[:-1] * three ^ word[1:], 2), _mixed(shape, 3),
        _mixed(pairs, 4), _mixed(pairs[:-1] * three ^ shape[2:], 5), _mixed(again, 6),
    ]


def margin(text: str, weights) -> float:
    """The dot product of a text's features and the weights; ``weights[DIMENSION]`` is the constant."""
    total = float(weights[DIMENSION])
    for scale, index in zip(SCALES, families(text)):
        if len(index):
            total += scale * float(weights[index].mean(dtype="float64"))
    return total


def sparse(text: str):
    """The same features as (indexes, values), for learning."""
    import numpy as np

    at, values = [np.array([DIMENSION])], [np.ones(1)]
    for scale, index in zip(SCALES, families(text)):
        if len(index):
            at.append(index)
            values.append(np.full(len(index), scale / len(index)))
    found, inverse = np.unique(np.concatenate(at), return_inverse=True)
    return found, np.bincount(inverse, np.concatenate(values))


def ftrl(examples, epochs: int = EPOCHS):
    """Weights after ``epochs`` passes over (indexes, values, label)."""
    import numpy as np

    z, n = np.zeros(DIMENSION + 1), np.zeros(DIMENSION + 1)

    def current(at):
        zi, ni = z[at], n[at]
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    for _ in range(epochs):
        for at, x, label in examples:
            w = current(at)
            error = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label
            g = error * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    return current(np.arange(DIMENSION + 1)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"):
    """Weights from a bounded sample of the labelled rows: those whose hashed ids are least.

    Rows whose crc32 of the id, as text, leaves 2 when divided by 4 are held out.
    Null ids, labels and texts are not learned from, nor are ids whose labels
    disagree. Without any labels all weights are 0 and every score 0.5.
    """
    import numpy as np

    importable(docs.sparkSession)
    chosen = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    chosen = chosen.where("doc_id IS NOT NULL AND label IN (0, 1) AND crc32(cast(doc_id AS string)) % 4 <> 2")
    chosen = chosen.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    chosen = chosen.withColumn("place", F.xxhash64("doc_id")).orderBy("place").limit(sample)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    rows = texts.join(F.broadcast(chosen), "doc_id").withColumn("shard", F.pmod("place", F.lit(SHARDS)))

    def learned(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["place", "text"])
        return pd.DataFrame({"weights": [ftrl([(*sparse(t), y) for t, y in zip(pdf["text"], pdf["label"])]).tobytes()]})

    models = [np.frombuffer(r["weights"], np.float32) for r in rows.groupBy("shard").applyInPandas(learned, "weights binary").collect()]
    return np.mean(models, axis=0) if models else np.zeros(DIMENSION + 1, np.float32)


def score(docs: DataFrame, weights, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` (0 to 1) of every whole text; null texts count as empty, empty ones get the constant's score."""
    data = weights.astype("float32").tobytes()

    def scored(batches):
        import numpy as np
        import pyarrow as pa

        weights = np.frombuffer(data, np.float32)
        for batch in batches:
            margins = np.array([margin(t, weights) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(margins, -30, 30))), pa.float64())], names=["doc_id", "score"])

    return arrow_map(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col)), scored, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Repeated rows get equal scores; a null id isn't held out. An empty table gives
    an empty result. Other columns are ignored.
    """
    found = score(docs, train(docs, labels, sample))
    held_out = F.coalesce(F.expr("crc32(cast(doc_id AS string)) % 4 = 2"), F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op2_quality(spark, sf_dir):
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, where they lie: nothing is shuffled."""
    data, place = train(docs, labels, sample).astype("float32").tobytes(), docs.columns.index("text")

    def kept(batches):
        import numpy as np
        import pyarrow as pa

        weights, least = np.frombuffer(data, np.float32), float(np.log(threshold / (1 - threshold)))
        for batch in batches:
            yield batch.filter(pa.array([margin(t or "", weights) >= least for t in batch.column(place).to_pylist()], pa.bool_()))

    return arrow_map(docs, kept, docs.schema)
