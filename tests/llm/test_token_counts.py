import base64

import pytest

from tallyframe.llm.shared import new_path
from tallyframe.llm.token_counts import TOKENIZERS, Rollup, token_rollup


P = pytest.importorskip("public_tokenizers")


def lengths():
    import tiktoken
    from tokenizers import Tokenizer

    word = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    byte = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return {"word_bpe_49k": lambda t: len(word.encode(t, add_special_tokens=False).ids), "byte_bpe_50k": lambda t: len(byte.encode_ordinary(t))}


def brute(docs, removed, revised):
    by = lengths()
    assert set(by) == set(TOKENIZERS)
    total = {}
    for i, source, lang, text in docs:
        if i is not None and i in removed:
            continue
        text = revised.get(i, text) if i is not None else text
        for name, length in by.items():
            key = (source or "", lang or "", name)
            n, t = total.get(key, (0, 0))
            total[key] = (n + 1, t + length(text or ""))
    return total


def found(df):
    return {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in df.collect()}


def test_totals_after_deletes_and_revisions(spark):
    docs = [(i, "hot" if i % 3 else f"s{i % 5}", "en" if i % 2 else None, f"text {i}, with (marks) é 漢 " * (i % 7)) for i in range(400)] + [(500, None, "de", None), (501, "a", "de", ""), (None, "a", "de", "x y"), (7, "hot", "en", "again here")]
    removed, revised = {3, 9, 500, 10_000}, {3: "never", 5: "new text", 6: "", 7: "both", 20_000: "x"}
    table = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, source string, lang string, text string, tokens int").repartition(5)
    gone = spark.createDataFrame([(i,) for i in [*removed, 3, None]], "doc_id long")
    new = spark.createDataFrame([*revised.items(), (None, "n")], "doc_id long, text string")
    assert found(token_rollup(table, gone, new)) == brute(docs, removed, revised)


def test_commits_are_idempotent_and_snapshots_keep_totals(spark):
    rollup = Rollup(spark, new_path(spark, "rollup-test"))
    deltas = lambda *rows: spark.createDataFrame(rows, "source string, lang string, tokenizer string, documents long, tokens long")
    assert rollup.totals().count() == 0
    assert rollup.commit("a", deltas(("s", "en", "t", 1, 10), ("s", "en", "t", 1, 5)))
    assert not rollup.commit("a", deltas(("s", "en", "t", 1, 99)))
    assert rollup.commit("b", deltas(("s", "en", "t", -1, -5), ("s", "de", "t", 1, 1)))
    want = {("s", "en", "t"): (1, 10), ("s", "de", "t"): (1, 1)}
    assert found(rollup.totals()) == want
    rollup.compact()
    assert found(rollup.totals()) == want and not rollup.commit("b", deltas(("s", "en", "t", 5, 5)))
    assert rollup.commit("c", deltas(("s", "de", "t", -1, -1)))
    rollup.compact()
    assert found(rollup.totals()) == {("s", "en", "t"): (1, 10)} and not rollup.commit("a", deltas(("s", "en", "t", 1, 1)))


def test_an_unfinished_batch_is_not_counted_and_of_two_writers_one_wins(spark):
    rollup = Rollup(spark, new_path(spark, "rollup-test"))
    row = spark.createDataFrame([("s", "en", "t", 1, 10)], "source string, lang string, tokenizer string, documents long, tokens long")
    made = new_path(spark, "token-batch")
    row.write.parquet(made)  # a commit that was lost before its last step
    assert rollup.totals().count() == 0 and rollup.commit("a", row)
    assert not rollup._moved(made, f"{rollup.path}/batches/a") and not rollup._folder(made)[0].exists(rollup._folder(made)[1])
    assert found(rollup.totals()) == {("s", "en", "t"): (1, 10)}


def test_hundreds_of_batches_and_snapshots(spark):
    rollup, schema = Rollup(spark, new_path(spark, "rollup-test")), "source string, lang string, tokenizer string, documents long, tokens long"
    one = new_path(spark, "token-batch")
    spark.createDataFrame([("s", "en", "t", 1, 10)], schema).coalesce(1).write.parquet(one)
    system, place = rollup._folder(one)
    copy = spark._jvm.org.apache.hadoop.fs.FileUtil.copy
    for k in range(300):
        copy(system, place, system, rollup._folder(f"{rollup.path}/batches/a-batch-with-a-long-name-{k:06d}")[1], False, spark._jsc.hadoopConfiguration())
        if k in (150, 299):
            assert rollup.compact()
    assert not rollup.compact() and len(rollup.committed()) == 300 and found(rollup.totals()) == {("s", "en", "t"): (300, 3000)}
    assert not rollup.commit("a-batch-with-a-long-name-000007", spark.createDataFrame([("s", "en", "t", 1, 10)], schema))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, lang string, text string")
    assert token_rollup(docs, docs.select("doc_id"), docs.select("doc_id", "text")).count() == 0
