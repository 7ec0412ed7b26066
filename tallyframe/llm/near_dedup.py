"""Near duplicates by circulant MinHash, banding and exact verification.

Two fixed permutations of the 32-bit numbers make all coordinates of a
signature: the first scatters a document's shingles, the second is applied to
them shifted by 0, 1, 2, ... places around the circle, and coordinate k is the
least value at shift k. ``ROWS`` coordinates are a band; documents that agree in
a band are candidates. With 32 bands of 4, a pair of similarity 0.75 is missed
with a probability of 5e-6.

Documents with one shingle set are one class from the start. Within a band's
bucket, members are not paired with each other but with the first of them, and
similarity is computed on the full shingle sets of both. Only where a bucket
still holds several components, its members outside the largest one are held
against the members of the other components. Pairs whose distances to the
bucket's first member differ by more than a link's distance can't be linked, as
Jaccard distance is a metric; a sketch (two bits of each of 1024 coordinates)
drops pairs that agree in fewer coordinates than a linked pair does but for one
in ten million; what is left is verified on full sets, each pair once.
So no bucket is expanded into all its pairs, and links within a component,
which change nothing, are not looked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.components import components
from tallyframe.llm.shared import arrow_map, discard, documents, marked, spread_join, stored, text_of, worker_table

BANDS, ROWS, WORDS = 32, 4, 5
#: Coordinates of a candidate's sketch, and how many bits of each it has.
COORDINATES, PLANES = 1024, 2
#: Most permutation values that are computed at once.
CHUNK = 1 << 18
NO_ID = (1 << 63) - 1


class _Hashes(dict):
    """Words to 64-bit hashes."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def _hashes() -> _Hashes:
    return worker_table("hashes", _Hashes)


def shingles(text: str, width: int = WORDS):
    """The distinct hashes of a text's word shingles, sorted."""
    import numpy as np

    words, known = text.encode("utf-8", "surrogatepass").lower().split(), _hashes()
    if len(known) > 400_000:
        known.clear()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - width + 1)
    out = np.full(n, min(len(w), width), np.uint64)
    for k in range(min(len(w), width)):
        out = (out ^ w[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def signature(found, coordinates: int = BANDS * ROWS):
    """The coordinates of a set of hashes that isn't empty."""
    import numpy as np

    scattered = (found ^ (found >> np.uint64(29))).astype(np.uint32)
    shifts = np.arange(coordinates, dtype=np.uint32)[:, None]
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(scattered), CHUNK // coordinates):
        y = scattered[None, at : at + CHUNK // coordinates] + shifts
        y ^= y >> np.uint32(16)
        y *= np.uint32(0x85EBCA6B)
        y ^= y >> np.uint32(13)
        y *= np.uint32(0xC2B2AE35)
        y ^= y >> np.uint32(16)
        np.minimum(least, y.min(1), out=least)
    return least


def band_keys(least):
    import numpy as np

    rows, out = least.reshape(BANDS, ROWS), np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    for k in range(ROWS):
        out = (out ^ rows[:, k]) * np.uint64(0x94D049BB133111EB)
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def sketch(least):
    """``PLANES`` times ``COORDINATES / 64`` numbers: one bit of every coordinate after another."""
    import numpy as np

    return np.concatenate([np.packbits(((least >> np.uint32(p)) & np.uint32(1)).astype(np.uint8)).view(np.int64) for p in range(PLANES)])


def fewest_agreeing(percent: int) -> int:
    """Agreeing sketch coordinates, of a pair at the threshold, that fewer than one pair in ten million doesn't reach."""
    p = percent / 100 + (1 - percent / 100) / 2**PLANES
    return int(COORDINATES * p - 5.2 * (COORDINATES * p * (1 - p)) ** 0.5)


def _agreeing(a: str, b: str) -> str:
    step = COORDINATES // 64
    differ = ["bit_count(" + " | ".join(f"({a}[{p * step + k}] ^ {b}[{p * step + k}])" for p in range(PLANES)) + ")" for k in range(step)]
    return f"{COORDINATES} - ({' + '.join(differ)})"


def _profiles(batches):
    import pyarrow as pa
    import xxhash

    for batch in batches:
        ids, sizes, sets, bands = batch.column(0).to_pylist(), [], [], []
        for text in batch.column(1).to_pylist():
            found = shingles(text)
            sizes.append(len(found))
            sets.append(xxhash.xxh3_128_digest(found.tobytes()))
            bands.append(band_keys(signature(found)) if len(found) else None)
        arrays = [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["id", "n", "set_key", "bands"])


def _sets(batches):
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        sets = [shingles(t) for t in batch.column(1).to_pylist()]
        sketches = [sketch(signature(s, COORDINATES)) for s in sets]
        arrays = [batch.column(0), *[pa.array(x, pa.list_(pa.int64())) for x in ([s.view(np.int64) for s in sets], sketches)]]
        yield pa.RecordBatch.from_arrays(arrays, names=["id", "shingles", "sketch"])


def similarities(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs(a, b)`` with their similarity on full sets, and whether it links them."""
    left, right = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", F.size("x").alias("nx"), F.size("y").alias("ny"), F.size(F.array_intersect("x", "y")).alias("common"))
    union = F.col("nx") + F.col("ny") - F.col("common")
    return both.select("a", "b", (F.col("common") / union).alias("similarity"), (100 * F.col("common") >= percent * union).alias("linked"))


def near_dedup(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Rows with one id are one document; null ids are one document that never is the
    smallest of its component if another id is there. Null and empty texts and
    those without words have no shingles and are linked with nothing. Repeated rows
    give repeated results; an empty table gives an empty one; other columns are
    ignored.
    """
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), text_of(text_col).alias("text"))
    rows = arrow_map(texts, _profiles, "id long, n long, set_key binary, bands array<long>")
    # what a join looks up has counts, so that hot keys stay where they are
    classes = stored(rows.where("n > 0").groupBy("set_key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size")), "near-classes")
    total = rows.count()
    members = spread_join(rows.where("n > 0"), classes, ["set_key"], "size", total)
    members = stored(members.select("id", "n", "rep", "size", F.when(F.col("id") == F.col("rep"), F.col("bands")).alias("bands")), "near-members")

    banded = members.where("bands IS NOT NULL").select("id", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("high"), F.count(F.lit(1)).alias("held")).where("pivot < high")
    shared = stored(shared.select("key", "pivot", "held"), "near-shared")
    buckets = stored(spread_join(banded, shared, ["key"], "held", BANDS * total).drop("held"), "near-buckets")
    candidates = stored(buckets.select("id").distinct(), "near-candidates")
    read = marked(texts, candidates, ["id"]).where("maybe").select("id", "text")  # other texts don't travel
    sets = arrow_map(read.join(candidates.hint("merge"), "id", "left_semi"), _sets, "id long, shingles array<long>, sketch array<long>")
    stars = buckets.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    stars = stored(similarities(stars, sets, percent), "near-stars")
    labels = components(stars.where("linked"))

    named = buckets.join(labels, "id", "left").select("key", "id", "pivot", F.coalesce("component", "id").alias("component"))
    parts = named.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"))
    parts = parts.groupBy("key").agg(F.max(F.struct("m", "component"))["component"].alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    parts = stored(parts.select("key", "main"), "near-parts")
    to_pivot = stars.select(F.col("a").alias("pivot"), F.col("b").alias("id"), "similarity")
    rest = named.join(parts, "key").join(to_pivot, ["pivot", "id"])  # without the pivots, which have been held against all
    traits = sets.select("id", "sketch").join(members.where("bands IS NOT NULL").select("id", "bands"), "id")
    rest = stored(rest.join(traits, "id").select("key", "id", "component", "main", "similarity", "sketch", "bands"), "near-rest")
    other = rest.select("key", *[F.col(c).alias(f"{c}2") for c in ("id", "component", "similarity", "sketch", "bands")])
    pairs = rest.where("component <> main").join(other, "key").where("component <> component2 AND (component2 = main OR id < id2)")
    pairs = pairs.where(f"abs(similarity - similarity2) <= {1 - percent / 100 + 1e-9}")  # the triangle inequality, by way of the pivot
    pairs = pairs.where(f"{_agreeing('sketch', 'sketch2')} >= {fewest_agreeing(percent)}")
    pairs = pairs.where("array_intersect(bands, bands2)[0] = key")  # each pair in the first of its buckets only
    pairs = pairs.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b"))
    more = stored(similarities(pairs, sets, percent).where("linked"), "near-links")
    if not more.isEmpty():
        to = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}"))
        across = more.join(to("a"), "a", "left").join(to("b"), "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
        joined = components(across).select(F.col("id").alias("component"), F.col("component").alias("least"))
        singles = joined.join(labels, "component", "left_anti").select(F.col("component").alias("id"), F.col("least").alias("component"))
        labels = labels.join(joined, "component", "left").select("id", F.coalesce("least", "component").alias("component")).unionByName(singles)
    discard(shared, buckets, candidates, sets, stars, parts, rest, more)

    named = classes.select("rep", "size").join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("rep", "size", F.coalesce("component", "rep").alias("component"))
    named = named.groupBy("rep", "component").agg(F.sum("size").alias("size"))  # rows of one id may be of several classes
    found = spread_join(members.select("id", "n", "rep"), named, ["rep"], "size", total).select("id", "n", "component")
    found = found.unionByName(rows.where("n = 0").select("id", "n", F.col("id").alias("component")))
    shown = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return found.select(shown("id").alias("doc_id"), F.col("n").alias("n_shingles"), shown("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def op6_near_dedup(spark, sf_dir):
    return near_dedup(documents(spark, sf_dir))
