import hashlib
import re

from pyspark.sql import functions as F

from tallyframe.llm.exact_dedup import Directory, built_index, exact_dedup, grown_directory, looked_up


def brute(rows):
    norm = {i: re.sub("[\x20\x09-\x0d]+", " ", t or "") for i, t in rows}
    groups = {}
    for i, _ in rows:
        groups.setdefault(norm[i], []).append(i)
    return {(i, min(groups[norm[i]]), len(groups[norm[i]]), i == min(groups[norm[i]]), hashlib.sha256(norm[i].encode()).hexdigest()) for i, _ in rows}


def found(df):
    return {(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


def test_matches_brute_force_with_hot_group_nulls_and_long_texts(spark):
    rows = [(i, "same\t\n text") for i in range(300)] + [(300 + i, f"own {i % 40}") for i in range(300)]
    rows += [(700, None), (701, ""), (702, " "), (703, "x " * 200_000), (704, "x  " * 200_000), (705, "é e")]
    docs = spark.createDataFrame([(i, t, 1, "b", 2) for i, t in rows], "doc_id long, text string, key int, bucket string, norm int").repartition(7)
    got = exact_dedup(docs, capacity=4, max_depth=6)
    assert found(got) == brute(rows)
    assert got.count() == len(rows)
    assert got.select("bucket").distinct().count() > 4


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(5, "a"), (5, "a"), (None, "a"), (None, "b")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs).collect()), key=str)
    assert got == sorted([(5, 5, 3, True), (5, 5, 3, True), (None, 5, 3, False), (None, None, 1, True)], key=str)
    assert exact_dedup(docs.limit(0)).count() == 0


def test_directory_doubles_and_splits_only_overfull_buckets():
    assert grown_directory({}, 3, 1) == (0, [0])
    depth, local = grown_directory({0: 3, 1: 1, 4: 1}, 3, 2)
    assert (depth, local) == (3, [3, 3, 2, 2, 1, 1, 1, 1])
    assert grown_directory({0: 9}, 2, 1) == (2, [2, 2, 1, 1])


def test_rows_are_found_by_the_directory_and_the_chain_decides(spark):
    rows = [(i, ("same", "other", f"own {i}")[min(2, i % 9)]) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, norm string").withColumn("key", F.when(F.col("norm").isin("same", "other"), F.lit(-5).cast("long")).otherwise(F.xxhash64("norm")))
    entries = table.select("doc_id", "key", F.unhex(F.sha2("norm", 256)).alias("sha"))
    keys = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("keep_id"), F.min("sha").alias("sha"))
    counts = {}
    for r in keys.collect():
        slot = (r.key % 2**64) >> 60
        counts[slot] = counts.get(slot, 0) + 1
    directory = Directory(counts, 4, 8, 4)
    index = built_index(table, keys, directory)
    got = {(r.doc_id, r.keep_id, r.group_size) for r in looked_up(entries, index, directory, 200).collect()}
    size = {"same": 23, "other": 23}
    assert got == {(i, {"same": 0, "other": 1}.get(t, i), size.get(t, 1)) for i, t in rows}
    assert sorted(r.chain for r in index.where("key = -5").collect()) == [1, 2]  # two texts of one key, told apart by their bytes
    assert sorted(set(directory.owner)) == list(range(4)) and directory.owner == sorted(directory.owner)
    broken = Directory(counts, 4, 8, 4)
    broken.local = [0] * len(broken.local)  # all slots point to the first bucket
    assert {r.bucket for r in looked_up(entries, index, broken, 200).collect()} <= {0} and looked_up(entries, index, broken, 200).count() < 200
