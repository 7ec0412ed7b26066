import random
import zlib

import numpy as np
import pytest

from tallyframe.llm.packing import best_fit, pack, sequences_of, tightest
from tallyframe.llm.tokens import WORD_BPE, ChunkIds

P = pytest.importorskip("public_tokenizers")


def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path(WORD_BPE))
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_chunked_ids_equal_the_tokenizers():
    rng, one, table = random.Random(4), plain(), ChunkIds(WORD_BPE, limit=300)
    signs = "aAbZé \n\t\x0b\x1c  é'sS0١9!?_-.,İſKßΣς​한글ก็👍🏽̀\x00<|>"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["Word, word. WORD.. it's we'll. É. éa, don't.", "<|endoftext|> x", "one <|endoftext|> two", "a<|startoftext|>b. <|EndOfText|>\n<|endoftext", "<|endoftext|><|endoftext|>.", "", " "]
    for at in range(0, len(texts), 50):
        got = table.ids(texts[at : at + 50])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [one(t) for t in texts[at : at + 50]]


def filled(places, counts, capacity):
    bins = {}
    for length, rank, n, first, offset in places:
        for k in range(n):
            bins.setdefault(first + k, []).append((offset, length, rank + k))
    seen = sorted((length, rank) for b in bins.values() for _, length, rank in b)
    assert seen == sorted((length, r) for length, n in counts.items() for r in range(n))
    for b in bins.values():
        at = 0
        for offset, length, _ in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity[0] and len(b) <= capacity[1] and (len(b) == 1 or sum(x * x for _, x, _ in b) <= capacity[2])
    assert set(bins) == set(range(len(bins)))
    return len(bins)


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("capacity", [(100, 100, 10_000), (100, 7, 10_000), (100, 100, 10_001), (100, 5, 10_000)])
def test_every_constraint_holds_and_sequences_are_few(rule, capacity):
    rng = random.Random(7)
    counts = {}
    for _ in range(4000):
        n = min(100, int(rng.expovariate(1 / 25)) + 1)
        counts[n] = counts.get(n, 0) + 1
    n = filled(best_fit(counts, capacity, rule=rule), counts, capacity)
    least = max(-(-sum(k * v for k, v in counts.items()) // 100), -(-4000 // capacity[1]))
    assert n <= 1.05 * least + 1 or capacity[1] < 100 and n <= 1.3 * least


def test_attention_cost_binds_but_one_piece_is_allowed():
    for cap in (4000, 2000):
        assert filled(best_fit({50: 4}, (100, 100, cap)), {50: 4}, (100, 100, cap)) == 4
    with pytest.raises(ValueError):
        best_fit({101: 1}, (100, 100, 20_000))


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_limits_that_are_not_given_are_tightened_without_a_further_sequence(rule):
    rng, counts = random.Random(3), {100: 40}
    for _ in range(3000):
        n = min(100, int(rng.expovariate(1 / 20)) + 1)
        counts[n] = counts.get(n, 0) + 1
    capacity, places = tightest(counts, 100, None, None, rule)
    least = sequences_of(best_fit(counts, (100, 100, 10_000), rule=rule))
    assert filled(places, counts, capacity) <= least
    assert capacity[1] < 100 and capacity[2] < 10_000  # both bind
    assert any(sequences_of(best_fit(counts, (100, d, 10_000), rule=rule)) > least for d in (capacity[1] // 2, 1))
    assert tightest(counts, 100, 7, 9000, rule)[0] == (100, 7, 9000) and tightest({}, 100, None, None, rule)[1] == []


def test_pack_round_trip(spark):
    rng, one = random.Random(2), plain()
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randint(0, 120)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "word " * 5000)] + [(600 + i, "same text") for i in range(200)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, length int, piece int").repartition(6)
    got = pack(docs, max_tokens=128).collect()
    ids = {i: one(t or "") + [0] for i, t in rows}
    bins = {}
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.start == 128 * r.piece and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in got) == sum(map(len, ids.values()))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 128
    assert len(bins) <= 1.02 * sum(map(len, ids.values())) / 128 + 2


def test_pack_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b")] * 3 + [(None, "c")], "doc_id long, text string")
    got = pack(docs).collect()
    assert len(got) == 4 and sorted(r.offset for r in got) == sorted({r.offset for r in got})
    assert pack(docs.limit(0)).count() == 0


def test_places_are_shuffled_beyond_the_broadcast_bound_with_the_same_result(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 70)) for i in range(300)], "doc_id long, text string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(pack(docs, 64)) == rows(pack(docs, 64, broadcast_places=0))
