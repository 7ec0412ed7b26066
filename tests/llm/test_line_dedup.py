import hashlib
import random

from pyspark.sql import functions as F

from tallyframe.llm.line_dedup import doubled, first_level, line_dedup, line_table, repeated_runs, suffix_ranks
from tallyframe.llm.shared import marked, spread_join, stored


def prefix(x, y):
    n = 0
    while n < min(len(x), len(y)) and x[n] == y[n]:
        n += 1
    return n


def brute(rows, least):
    """rows: (id, text) in order; the maximal-run rule, by comparing every pair of suffixes."""
    docs = [(t or "").split("\n") for _, t in rows]
    full = [[p for p, x in enumerate(d) if x.split()] for d in docs]
    places = [(d, k) for d, ps in enumerate(full) for k in range(len(ps))]
    gone = [set() for _ in docs]
    for d, k in places:
        for d0, k0 in places:
            if (d0, k0) >= (d, k):
                break
            n = prefix([docs[d][p] for p in full[d][k:]], [docs[d0][p] for p in full[d0][k0:]])
            if n and sum(len(docs[d][full[d][k + j]].split()) for j in range(n)) >= least:
                gone[d].update(range(full[d][k], full[d][k + n - 1] + 1))
    for x, ps, g in zip(docs, full, gone):
        for p in set(range(len(x))) - set(ps):
            before, after = [q for q in ps if q < p], [q for q in ps if q > p]
            if before and after and before[-1] in g and after[0] in g:
                g.add(p)
    return {i: (len(x), len(g), "\n".join(y for p, y in enumerate(x) if p not in g)) for (i, _), x, g in zip(rows, docs, gone)}


def result(df):
    return {r.doc_id: (r.n_lines, r.n_removed, r.clean_text) for r in df.collect()}


def random_rows(rng, n=40, most=14):
    lines = [" ".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 1, 2, 3, 6]))) for _ in range(14)] + ["", "  "]
    return [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, most)))) for i in range(n)]


def test_matches_brute_force_at_several_minima(spark):
    rng = random.Random(9)
    for least in (1, 5, 12, 30):
        rows = random_rows(rng)
        rows += [(100 + i, rows[i][1] + "\nend " + str(i)) for i in range(10)] + [(200, None), (201, "")] + [(300 + i, "\n".join(t or "" for _, t in rows[i : i + 3])) for i in range(8)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
        assert result(line_dedup(docs, least)) == brute(rows, least)


def test_ranks_are_those_of_the_suffix_array_and_runs_have_their_longest_common_prefix(spark):
    rows = random_rows(random.Random(4), 25, 10)
    rows += [(50 + i, rows[i][1] + "\n" + rows[i + 1][1]) for i in range(12)] + [(80, rows[3][1]), (81, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seqs = {i: [hashlib.sha256(x.encode()).digest() for x in t.split("\n") if x.split()] for i, t in rows}
    suffixes = {(i, k + 1): s[k:] for i, s in seqs.items() for k in range(len(s))}
    ordered = sorted(suffixes.values())
    base = first_level(stored(line_table(docs), "lines"))
    got = {(r.doc, r.i): r["rank"] for r in suffix_ranks(doubled(base)).collect()}
    first = {}
    for k, s in enumerate(ordered):
        first.setdefault(tuple(s), k + 1)
    assert got == {p: first[tuple(suffixes[p])] for p in got} and len(got) > 100
    longest = {p: max([prefix(s, o) for q, o in suffixes.items() if q < p], default=0) for p, s in suffixes.items()}
    want = {p: n for p, n in longest.items() if n and longest.get((p[0], p[1] - 1), 0) != n + 1}
    runs = repeated_runs(docs).collect()
    assert {(r.doc, r.i): r.l for r in runs} == want and max(want.values()) > 4
    words = {i: [len(x.split()) for x in t.split("\n") if x.split()] for i, t in rows}
    assert all(r.words == sum(words[r.doc][r.i - 1 : r.i - 1 + r.l]) for r in runs)
    for r in runs:  # the first place of the run's lines
        k = [p for p, x in enumerate(dict(rows)[r.g.doc].split("\n")) if x.split()].index(r.g.pos)
        run = seqs[r.doc][r.i - 1 : r.i - 1 + r.l]
        assert (r.g.doc, k + 1) == min(q for q, o in suffixes.items() if o[: r.l] == run)


def test_a_floor_keeps_short_repeats(spark):
    passage = "\n".join(" ".join(f"p{k}{j}" for j in range(13)) for k in range(4))
    rows = [(i, f"own start {i}\n{passage}\nown end {i}\nshort shared line") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(line_dedup(docs, 50))
    assert got[0] == (7, 0, rows[0][1])
    assert all(got[i] == (7, 4, f"own start {i}\nown end {i}\nshort shared line") for i in range(1, 30))
    assert result(line_dedup(docs))[29] == (7, 5, "own start 29\nown end 29")


def test_hot_line_very_long_text_other_columns_and_odd_rows(spark):
    hot = " ".join(f"h{k}" for k in range(60))
    long = "\n".join(f"x{k}" for k in range(20_000))
    rows = [(i, hot, "n") for i in range(500)] + [(1000, long, "n"), (1000, "other text", "n"), (1001, f"{long}\nx0", "n"), (None, hot, "n"), (3, hot, "n"), (None, hot, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, clean_text string").withColumn("h", F.lit(1)).withColumn("pos", F.lit(2)).repartition(5)
    got = line_dedup(docs)
    assert got.columns == ["doc_id", "text", "h", "pos", "n_lines", "n_removed", "clean_text"]
    back = got.collect()
    assert len(back) == len(rows)
    assert sum(r.clean_text == hot for r in back) == 2 and all(r.doc_id is None for r in back if r.clean_text == hot)
    assert {r.n_removed for r in back if r.doc_id == 1000} == {0} and [(r.n_removed, r.clean_text) for r in back if r.doc_id == 1001] == [(20_001, "")]
    assert line_dedup(docs.limit(0)).count() == 0


def test_one_join_for_hot_and_other_keys_and_marks_without_misses(spark):
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    assert spread_join(rows, table, ["k"], "n", 30_000).where("(k = 0) = (n = 10000)").count() == 30_000
    held = marked(rows, rows.where("id % 7 = 0").select("k"), ["k"])
    assert held.columns == ["id", "k", "maybe"]
    assert held.where("(id % 7 = 0 OR k = 0) AND NOT maybe").count() == 0 and held.where("id % 7 <> 0 AND k <> 0 AND maybe").count() < 200
    assert marked(rows, rows.limit(0), ["k"]).where("maybe").count() == 0
