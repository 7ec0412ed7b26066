import random
import zlib

from tallyframe.llm.sharding import Ends, minimax_cuts, shard


def least_capacity(sizes, k):
    c = max(max(sizes), -(-sum(sizes) // k))
    while True:
        n, at = 1, 0
        for s in sizes:
            n, at = (n, at + s) if at + s <= c else (n + 1, s)
        if n <= k:
            return c
        c += 1


def test_cuts_are_minimax_against_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        sizes = [rng.choice([1, 2, 5, 9, 60]) for _ in range(rng.randint(1, 40))]
        k, ends, at = rng.randint(1, 8), [], 0
        for s in sizes:
            at += s
            ends.append(at)
        low, cuts = minimax_cuts(Ends([(e, e, 1) for e in ends]), at, k)
        parts = [b - a for a, b in zip([0, *cuts], cuts)]
        assert low == least_capacity(sizes, k) and max(parts) == low or max(parts) <= low
        assert cuts[-1] == at and all(c == 0 or c in ends for c in cuts) and min(parts) >= 0


def check(spark, rows, k=16):
    docs = spark.createDataFrame([(i, t, 0, 1) for i, t in rows], "doc_id long, text string, size int, block int").repartition(5)
    got = shard(docs, k).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got) == sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    where, slots, size = {}, {}, {}
    text = dict(rows)
    for r in got:
        where.setdefault(text[r.doc_id] or "", set()).add(r.shard)
        slots.setdefault(r.shard, []).append(r.slot)
        size[r.shard] = size.get(r.shard, 0) + r.size
    assert all(len(s) == 1 for s in where.values()) and set(slots) <= set(range(k))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return size


def test_even_shards_with_nulls_and_empty_texts(spark):
    rng = random.Random(1)
    size = check(spark, [(i, rng.choice([None, "", "é", "x" * rng.randint(1, 300) + str(i)])) for i in range(3000)])
    assert len(size) == 16 and max(size.values()) < 1.25 * sum(size.values()) / 16


def test_hot_group_stays_whole_and_the_rest_stays_even(spark):
    size = check(spark, [(i, "copy" * 10 if i % 3 == 0 else f"{i:040d}") for i in range(3000)])
    hot = max(size.values())
    rest = sorted(size.values())[:-1]
    assert len(size) == 16 and hot < 1.2 * 1000 * 41 and max(rest) < 2 * min(rest)


def test_vague_cells_are_refined_until_exact(spark, monkeypatch):
    import tallyframe.llm.sharding as s

    rows = [(i, "y" * (i * 7 % 50)) for i in range(400)] + [(1000 + i, str(i)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fine = sorted(map(tuple, shard(docs, 5).collect()))
    monkeypatch.setattr(s, "CELLS", 3)
    monkeypatch.setattr(s, "FINER", 2)
    assert sorted(map(tuple, shard(docs, 5).collect())) == fine


def test_empty_table_and_one_row(spark):
    docs = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in shard(docs).collect()] == [(1, 1, 0, 0, 0)] or shard(docs).first().slot == 0
    assert shard(docs.limit(0)).count() == 0
