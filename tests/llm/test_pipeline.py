import random
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline as p
from tallyframe.llm import quality as q
from tallyframe.llm.mixing import OP5_SQL
from tallyframe.llm.shared import stored

from test_line_dedup import brute as line_brute
from test_near_dedup import brute as near_brute
from test_near_dedup import long_texts, shuffled

SF = "/root/testdata/sf0.001"
P = pytest.importorskip("public_tokenizers")


def test_every_stage_against_brute_force(spark):
    from tokenizers import Tokenizer

    docs, columns = spark.read.parquet(f"{SF}/documents.parquet"), ["doc_id", "text", "lang", "source", "n_chars"]
    seen = {r.doc_id: r.text for r in docs.collect()}

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    weights = q.train(docs, labels)
    docs = stored(p.quality(spark, docs, SF), "t")
    good = {i: t for i, t in seen.items() if 1 / (1 + np.exp(-q.margin(t, weights))) >= 0.7}
    assert docs.columns == columns and {r.doc_id: r.text for r in docs.collect()} == good
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(i in good for i, y in truth.items() if y == 1) or np.mean([i in good for i, y in truth.items() if y == 1]) > 0.97

    docs = stored(p.lines(spark, docs, SF), "t")
    clean = {i: t for i, (_, gone, t) in line_brute(sorted(good.items()), 50).items() if not gone or t.split()}
    got = docs.collect()
    assert docs.columns == columns and {r.doc_id: r.text for r in got} == clean and all(r.n_chars == len(r.text) for r in got)

    docs = stored(p.near(spark, docs, SF), "t")
    single = {i for i, (_, c) in near_brute(sorted(clean.items())).items() if i == c}
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == single

    base = docs.toPandas()
    docs = stored(p.mixing(spark, docs, SF), "t")
    db = duckdb.connect()
    db.register("documents", base)
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == {r[0] for r in db.sql(f"SELECT doc_id FROM ({OP5_SQL}) WHERE sampled").fetchall()}

    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ids = {r.doc_id: tokenizer.encode(r.text, add_special_tokens=False).ids + [0] for r in docs.collect()}
    bins = {}
    for r in p.packing(spark, docs, SF).collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = sum(map(len, ids.values()))
    assert sum(n for b in bins.values() for _, n in b) == total and -(-total // 2048) <= len(bins) <= total / 2048 * 1.05 + 2


def test_columns_with_the_operators_names_pass_through(spark):
    extra = ["whole_row", "clean_text", "n_removed", "topic", "sampled", "weight", "key", "near_id", "kept"]
    rows = [(i, f"Own words of document {i} here.", "en", "a", 1, *[f"{c}{i}" for c in extra]) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra))
    for _, stage in p.STAGES[:4]:
        docs = stored(stage(spark, docs, SF), "t")
        got = {tuple(r) for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *extra] and got and got <= set(rows)


def test_stages_survive_nulls_and_an_empty_table(spark):
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (None, "Some plain words here.", "en", "a", None), (2, "", "en", "a", 0)]
    for docs in (spark.createDataFrame(rows, kind), spark.createDataFrame([], kind)):
        for _, stage in p.STAGES[1:]:
            docs = stored(stage(spark, docs, SF), "t")
        assert docs.count() <= 3


@pytest.mark.parametrize("most", [20_000, 0])
def test_rows_without_an_id_of_their_own_go_one_by_one(spark, monkeypatch, most):
    monkeypatch.setattr(p, "BROADCAST_IDS", most)
    base, other, third = (" ".join(f"{w}{k}" for k in range(60)) for w in ("a", "b", "c"))
    rows = [(1, base), (None, base + " end"), (None, other), (7, third), (7, base + " close"), (8, "some words of its own"), (9, third + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(p.near(spark, docs, SF).collect(), key=str) == sorted([rows[0], rows[2], rows[5], rows[6]], key=str)


def test_near_shuffles_only_rows_that_may_go(spark):
    last = (1 << 63) - 1  # the largest id, which stands for null in near_dedup
    rows = [*long_texts(random.Random(3), 300), (last, "words that nothing else has here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = shuffled(spark)
    got = p.near(spark, docs, SF).collect()
    assert shuffled(spark) - before < sum(len(t) for _, t in rows) / 4
    assert sorted(map(tuple, got)) == [r for r in rows if r[0] != 300]
