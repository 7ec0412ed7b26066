import random

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import mixing
from tallyframe.llm.mixing import MARGINS, mix, probabilities, rake, rake_until_met, realised, residual


def table(spark, n=3000):
    rng = random.Random(8)
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{rng.randint(0, 5)}"
        rows.append((i, " ".join(["word"] * rng.randint(1, 60)), rng.choice(["en", "en", "de", None]), source, "x"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, weight string").repartition(6)


def test_raked_margins_meet_their_targets(spark):
    cells = spark.createDataFrame([("a", "x", "p", 100), ("a", "y", "p", 300), ("b", "x", "q", 50), ("b", "y", "p", 10), ("b", "y", "q", 40)], "source string, lang string, topic string, tokens long")
    goals = {"source": {"a": 250.0, "b": 250.0}, "lang": {"x": 200.0, "y": 300.0}, "topic": {"p": 400.0, "q": 100.0}}
    targets = {m: spark.createDataFrame(list(g.items()), f"{m} string, target double") for m, g in goals.items()}
    fitted = rake(cells, targets, 30)
    for m, g in goals.items():
        got = {r[m]: r.n for r in fitted.groupBy(m).agg(F.sum("fitted").alias("n")).collect()}
        assert got == pytest.approx(g, rel=1e-2)
    # odds ratios within a margin are those of the input
    by = {(r.source, r.lang, r.topic): r.fitted / r.tokens for r in fitted.collect()}
    assert by["a", "x", "p"] / by["a", "y", "p"] == pytest.approx(by["b", "x", "q"] / by["b", "y", "q"], rel=1e-6)


def test_probabilities_meet_the_budget_and_never_exceed_one(spark):
    fitted = spark.createDataFrame([("a", "x", "p", 100, 400.0), ("b", "x", "p", 100, 100.0), ("c", "x", "p", 300, 60.0), ("d", "x", "p", 0, 0.0)], "source string, lang string, topic string, tokens long, fitted double")
    for share in (0.1, 0.5, 0.8, 1.0):
        rows = probabilities(fitted, share).collect()
        assert sum(r.tokens * r.probability for r in rows) == pytest.approx(500 * share, rel=1e-6)
        assert all(0 <= r.probability <= 1 for r in rows)


def test_sample_follows_the_probabilities(spark):
    docs = table(spark)
    got = mix(docs, share=0.6).collect()
    assert len(got) == 3000 and len(docs.columns) - 1 + 5 == len(got[0])
    total, kept = sum(r.n_tokens for r in got), sum(r.n_tokens for r in got if r.sampled)
    assert kept / total == pytest.approx(0.6, abs=0.04)
    hot = [r for r in got if r.source == "hot"]
    assert len({(r.lang, r.topic, r.probability) for r in hot}) == len({(r.lang, r.topic) for r in hot})
    assert max(r.weight for r in hot) < max(r.weight for r in got)
    again = {r.doc_id: r.sampled for r in mix(docs, share=0.6).collect()}
    assert again == {r.doc_id: r.sampled for r in got}


def test_given_targets_nulls_empty_texts_and_empty_table(spark):
    rows = [(1, None, None, None), (1, None, None, None), (2, "", "en", "a"), (None, "some words", "en", "a"), (3, "w " * 100_000, "en", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mix(docs).collect()
    assert len(got) == 5 and all(r.probability is not None and r.sampled is not None for r in got)
    assert mix(docs.limit(0)).count() == 0
    goal = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "v string, t double")
    assert {m for m in MARGINS} == {"source", "lang", "topic"} and mix(docs.where("source IS NOT NULL"), targets={"source": goal}, topic=F.lit("t")).count() == 3


def test_without_a_share_the_sample_has_its_target_weights(spark):
    docs = table(spark)
    goal = spark.createDataFrame([("en", 1.0), ("de", 6.0), ("", 1.0)], "v string, t double")
    far = lambda share: max(abs(r.expected - r.target) for r in realised(mix(docs, share=share, targets={"lang": goal})).collect())
    assert far(0.8) > 0.05 and far(None) < 1e-6
    rows = {r.value: r for r in realised(mix(docs, share=None, targets={"lang": goal})).where("margin = 'lang'").collect()}
    assert [rows[v].target for v in ("en", "de", "")] == pytest.approx([0.125, 0.75, 0.125], abs=1e-3)
    assert all(r.sampled == pytest.approx(r.target, abs=0.05) for r in rows.values()) and max(r.probability for r in mix(docs, share=None).collect()) == 1


def test_cells_beyond_one_task_and_rare_cells_give_the_same(spark, monkeypatch):
    docs = table(spark).withColumn("source", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("rare"), "doc_id")).otherwise("most"))
    rows = lambda: {(r.doc_id, r.topic, round(r.weight, 9), round(r.probability, 6)) for r in mix(docs, rounds=4).collect()}
    want = rows()
    monkeypatch.setattr(mixing, "ONE_TASK", 0)
    monkeypatch.setattr("tallyframe.llm.shared.HOT", 4)
    assert rows() == want and len(want) == 3000


def test_the_lexicon_names_topics(spark):
    texts = {"plain words 12 34": "general", "© All rights reserved": "rights", 'x token = "abc"': "credentials", "a.b@c.de": "contacts", "see www.x.org": "links", "Licensed, secret": "rights", "": "general"}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"source": F.lit("s"), "lang": F.lit("en")})
    assert {r.text: r.topic for r in mix(docs).collect()} == texts


def test_raking_goes_on_until_its_margins_are_met_and_warns_where_they_cannot_be(spark, monkeypatch):
    cells = spark.createDataFrame([("a", "x", "p", 1), ("b", "x", "p", 1000), ("b", "y", "p", 10)], "source string, lang string, topic string, tokens long")
    goals = {"source": {"a": 100.0, "b": 100.0}, "lang": {"x": 110.0, "y": 90.0}}
    targets = {m: spark.createDataFrame(list(g.items()), f"{m} string, target double") for m, g in goals.items()}
    assert residual(rake(cells, targets, 9), targets) > 1e-3 and residual(rake_until_met(cells, targets, 9), targets) <= 1e-3
    missing = {"source": spark.createDataFrame([("a", 1.0), ("b", 1.0), ("nowhere", 2.0)], "source string, target double")}
    monkeypatch.setattr(mixing, "MOST_ROUNDS", 3)
    with pytest.warns(UserWarning, match="after 3 rounds of raking a margin's share is still 0.5000"):
        rake_until_met(cells, missing, 1)
