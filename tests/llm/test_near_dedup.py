import random
from pathlib import Path

import numpy as np

from tallyframe.llm import near_dedup as n
from tallyframe.llm.components import components
from tallyframe.llm.shared import shared_dir


def plain_shingles(text):
    words = text.encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def brute(rows):
    sets = {}
    for i, t in rows:
        sets[i] = plain_shingles(t or "")
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edits(rng, words, rate):
    return [rng.choice(["new", "other", "word"]) + str(rng.randint(0, 99)) if rng.random() < rate else w for w in words]


def family(rng, size, length, rate):
    base = [f"w{rng.randint(0, 5000)}" for _ in range(length)]
    return [" ".join(base)] * 2 + [" ".join(edits(rng, base, rng.uniform(0, rate))) for _ in range(size)]


def test_matches_brute_force(spark):
    rng = random.Random(11)
    texts = [t for size, length, rate in ((60, 80, 0.06), (30, 300, 0.05), (5, 12, 0.1), (8, 40, 0.04)) for t in family(rng, size, length, rate)]
    texts += [" ".join(f"u{rng.randint(0, 9999)}" for _ in range(rng.randint(0, 60))) for _ in range(120)]
    texts += [None, "", " \t\n", "one two", "ONE  Two", "one two three", "É É É É É", "é é é é é", "x " * 20_000, "copy of this text here now"] + ["copy of this text here now"] * 40
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, id int, n int").repartition(5)
    got = n.near_dedup(docs).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len(got) == len(rows) and all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len({c for _, c in want.values()}) < len(rows) - 60


def test_links_that_no_pivot_has_are_found(spark):
    """Loose families, in which many members are linked to others than the first of their buckets."""
    rng = random.Random(5)
    rows = list(enumerate(t for _ in range(4) for t in family(rng, 40, 60, 0.08)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in n.near_dedup(docs).collect()} == brute(rows)


def test_sketch_counts_agreeing_coordinates(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 32, (2, n.COORDINATES), dtype=np.uint64).astype(np.uint32)
    x[1, ::3] = x[0, ::3]
    a, b = (n.sketch(r).tolist() for r in x)
    low = 2**n.PLANES - 1
    want = int(((x[0] & low) == (x[1] & low)).sum())
    assert spark.createDataFrame([(a, b)], "a array<long>, b array<long>").selectExpr(n._agreeing("a", "b") + " AS k").first().k == want
    assert n.fewest_agreeing(75) < 0.75 * n.COORDINATES


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(3, "a b c"), (3, "a b c"), (None, "a b c"), (None, "z")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in n.near_dedup(docs).collect()), key=str)
    assert got[:2] == [(3, 3, True), (3, 3, True)] and len(got) == 4
    assert n.near_dedup(docs.limit(0)).count() == 0


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(3)
    x = np.unique(rng.integers(0, 1 << 62, 4000).astype(np.uint64))
    agree = [np.mean(n.signature(x[k * 500 : k * 500 + 2000]) == n.signature(x[k * 500 + 200 : k * 500 + 2200])) for k in range(4)]
    assert abs(np.mean(agree) - 1800 / 2200) < 0.06


def test_components_of_chains_and_hubs(spark):
    links = [(k, k + 1) for k in range(60)] + [(1000, 1001 + k) for k in range(50)] + [(2001, 2000)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(61)) and all(got[1001 + k] == 1000 for k in range(50)) and got[2001] == 2000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def shuffled(spark):
    """Bytes that the session has written for shuffles so far."""
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty()
    found = context.statusStore().executorList(True)
    return sum(found.apply(k).totalShuffleWrite() for k in range(found.size()))


def long_texts(rng, size):
    """Texts of their own that don't compress well, and a near copy of the first as the last."""
    texts = [" ".join(rng.randbytes(4).hex() for _ in range(2000)) for _ in range(size)]
    return list(enumerate([*texts, texts[0] + " end"]))


def test_texts_without_candidates_are_not_shuffled_and_unread_tables_go(spark):
    rows = long_texts(random.Random(2), 300)
    docs, folder = spark.createDataFrame(rows, "doc_id long, text string"), Path(shared_dir(spark).removeprefix("file://")) / "tallyframe"
    names, limit = set(folder.glob("*")), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are too large for it
    try:
        before = shuffled(spark)
        got = n.near_dedup(docs).collect()
        assert shuffled(spark) - before < sum(len(t) for _, t in rows) / 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert {r.doc_id: r.component_id for r in got} == {i: i % 300 for i, _ in rows}
    assert {p.name.rpartition("-")[0] for p in set(folder.glob("*")) - names} == {"rows", "near-classes", "near-members", "edges", "labels"}
