"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling.

Documents are summed to cells of source, language and topic, with their tokens
as weight; where no topic is given, a lexicon names one. Raking multiplies the cells' weights, one margin after another, so
that each margin's totals meet their targets; that is repeated. A cell's ratio
of fitted to present weight, times a common factor that meets the token budget,
is the probability with which each of its documents is kept. It is cut at 1:
where that happens the budget wants more than a cell holds, the rest goes to
the other cells and the sample misses its targets (``realised`` tells by how
much); without a given share the budget is the largest that cuts no cell. Only cells are raked, so no hot source is ever gathered:
it is summed on the map side and its documents are read where they lie.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.shared import documents, spread_join, stored, text_of

MARGINS = ("source", "lang", "topic")
WORD = "[^\\x20\\x09-\\x0D]+"
#: Up to this number of cells they are raked in one task; beyond it each margin of each round is a shuffle of cells.
ONE_TASK = 1 << 20
#: Documents draw one of so many numbers.
DRAWS = 1 << 48
#: Raking goes on after the given rounds, up to so many, while a margin's shares are further than this from their targets.
TOLERANCE, MOST_ROUNDS = 1e-3, 99


#: Expressions that tell a topic, first match first; plain strings, as a search for them costs a tenth of a pattern's.
LEXICON = {
    "rights": ["icense", "icence", "opyright", "ights reserved"],
    "credentials": ["password", "passwd", "secret", "token", "api_key", "apikey", "AKIA"],
    "contacts": ["@"],
    "links": ["http://", "https://", "www."],
}


def topic_of(text: Column) -> Column:
    """The first topic of ``LEXICON`` that the text has an expression of, else "general"."""
    found = F.lit("general")
    for topic, expressions in reversed(LEXICON.items()):
        found = F.when(reduce(Column.__or__, [text.contains(x) for x in expressions]), topic).otherwise(found)
    return found


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Targets for a margin: shares in proportion to a power of its tokens."""
    totals = cells.groupBy(margin).agg(F.sum("tokens").alias("n"))
    whole = totals.agg(F.sum("n").alias("all"), F.sum(F.pow(F.col("n").cast("double"), F.lit(power))).alias("tempered"))
    share = F.pow(F.col("n").cast("double"), F.lit(power)) / F.col("tempered")
    return totals.join(F.broadcast(whole)).select(margin, (share * F.col("all")).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int) -> DataFrame:
    """``cells`` with ``fitted``: weights whose margins meet ``targets`` (the last one given exactly)."""
    fitted = cells.withColumn("fitted", F.col("tokens").cast("double"))
    for margin, target in targets.items():
        fitted = fitted.join(target.withColumnRenamed("target", f"to_{margin}"), margin, "left")
    fitted = stored(fitted, "mix-fitted")
    few = fitted.count() <= ONE_TASK
    for k in range(rounds):
        fitted = fitted.coalesce(1) if few else fitted  # in one partition no window shuffles
        for margin in targets:
            now = F.sum("fitted").over(Window.partitionBy(margin))
            fitted = fitted.withColumn("fitted", F.when(now > 0, F.col("fitted") * F.coalesce(F.col(f"to_{margin}"), F.lit(0.0)) / now).otherwise(F.col("fitted")))
        if k % (9 if few else 3) == 2 or k == rounds - 1:
            fitted = stored(fitted, "mix-fitted")
    return fitted.select(*MARGINS, "tokens", "fitted")


def residual(fitted: DataFrame, targets: dict[str, DataFrame]) -> float:
    """The largest difference between a margin value's share of ``fitted`` and its share of the targets."""
    worst = 0.0
    for margin, target in targets.items():
        goal = target.groupBy(F.col(margin).alias("value")).agg(F.sum("target").alias("goal"))
        now = fitted.groupBy(F.col(margin).alias("value")).agg(F.sum("fitted").alias("now"))
        both = goal.join(now, "value", "full").select(*[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("goal", "now")])
        off = F.abs(F.try_divide("now", F.col("all_now")) - F.try_divide("goal", F.col("all_goal")))
        whole = both.agg(F.sum("now").alias("all_now"), F.sum("goal").alias("all_goal"))
        worst = max(worst, both.join(F.broadcast(whole)).agg(F.max(off)).first()[0] or 0.0)
    return worst


def rake_until_met(cells: DataFrame, targets: dict[str, DataFrame], rounds: int) -> DataFrame:
    """``rake`` for ``rounds`` and, while the margins are off by more than ``TOLERANCE``, for more; warns of what is left."""
    while True:
        fitted = rake(cells, targets, rounds)
        off = residual(fitted, targets)
        if off <= TOLERANCE or rounds >= MOST_ROUNDS:
            break
        rounds = min(MOST_ROUNDS, 3 * max(rounds, 1))
    if off > TOLERANCE:
        warnings.warn(f"after {rounds} rounds of raking a margin's share is still {off:.4f} from its target", stacklevel=2)
    return fitted


def probabilities(fitted: DataFrame, share: float | None) -> DataFrame:
    """Cells with ``ratio`` and ``probability``; the expected tokens are ``share`` of all (None: the largest share that cuts no probability)."""
    cells = stored(fitted.withColumn("ratio", F.when(F.col("tokens") > 0, F.col("fitted") / F.col("tokens")).otherwise(1.0)), "mix-ratios")
    if share is None:
        most = cells.where("tokens > 0").agg(F.max("ratio")).first()[0]
        return cells.withColumn("probability", F.round(F.least(F.lit(1.0), F.col("ratio") / F.lit(most or 1.0)), 9))
    budget, factor = (cells.agg(F.sum("tokens")).first()[0] or 0) * share, 0.0
    while True:  # cells that reach probability 1 leave the rest of the budget to the others
        full = F.col("ratio") * F.lit(factor) >= 1
        sums = cells.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("sure"), F.sum(F.when(full, 0.0).otherwise(F.col("fitted"))).alias("rest")).first()
        if not sums["rest"]:
            break
        new = (budget - sums["sure"]) / sums["rest"]
        if new <= factor * (1 + 1e-12):
            break
        factor = new
    return cells.withColumn("probability", F.round(F.least(F.lit(1.0), F.col("ratio") * F.lit(factor)), 9))


def mix(docs: DataFrame, share: float | None = None, power: float = 0.9, rounds: int = 9, seed: int = 0, targets: dict[str, DataFrame] | None = None, topic: Column | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``, ``topic``, ``weight``, ``probability`` and ``sampled``.

    ``targets`` gives for any margin a table of (value, target tokens); the others
    are tempered by ``power``. A value that a given margin leaves out
    gets no weight, so none of its documents is sampled.
    ``weight`` is the cell's ratio of fitted to present tokens. ``share=None`` keeps as
    many tokens as meet all targets; with a given ``share`` probabilities may be cut
    at 1, and the sample's margins then miss their targets. Null sources,
    languages and texts count as empty strings; a text without words weighs 0 tokens
    and is sampled like its cell. A document is drawn by the hash of its id (null:
    empty), so rows with one id are sampled alike. An empty table gives an empty
    result; of other columns those with the five names above are replaced.
    """
    text = text_of("text")
    kept = docs.drop("n_tokens", "topic", "weight", "probability", "sampled")
    whole = kept.withColumn("topic", F.coalesce(topic, F.lit("")) if topic is not None else topic_of(text))
    keyed = [F.coalesce(F.col(m), F.lit("")).alias(m) for m in MARGINS]
    counted = whole.select(*keyed, F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"))
    cells = stored(counted.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n")), "mix-cells")
    wanted = {}
    for margin in MARGINS:
        target = (targets or {}).get(margin)
        wanted[margin] = stored(tempered(cells, margin, power) if target is None else target.toDF(margin, "target"), "mix-target")
    found = probabilities(rake_until_met(cells.drop("n"), wanted, rounds), share)
    found = found.join(cells.select(*MARGINS, "n"), [*MARGINS])
    found = found.select(*[F.col(m).alias(f"mix_cell_{m}") for m in MARGINS], F.col("ratio").alias("weight"), "probability", F.col("n").alias("mix_cell_n"))
    found = stored(found, "mix-found")
    total = cells.agg(F.sum("n")).first()[0] or 0
    draw = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary")), 1, 12), 16, 10).cast("long") / F.lit(float(DRAWS))
    out = spread_join(whole.withColumns({f"mix_cell_{m}": k for m, k in zip(MARGINS, keyed)}), found, [f"mix_cell_{m}" for m in MARGINS], "mix_cell_n", total)
    out = out.withColumn("n_tokens", F.regexp_count(text, F.lit(WORD)).cast("long"))
    return out.select(*kept.columns, "n_tokens", "topic", "weight", "probability", (draw < F.col("probability")).alias("sampled"))


def realised(mixed: DataFrame) -> DataFrame:
    """``margin, value`` and shares of tokens, of a result of ``mix``: ``present``, ``target`` (as raked), ``expected`` and ``sampled``."""
    n = F.col("n_tokens")
    sums = {"present": n, "target": n * F.col("weight"), "expected": n * F.col("probability"), "sampled": F.when(F.col("sampled"), n).otherwise(0)}
    cells = mixed.groupBy(*MARGINS).agg(*[F.sum(v).cast("double").alias(k) for k, v in sums.items()])
    cells = stored(cells.select(*[F.coalesce(m, F.lit("")).alias(m) for m in MARGINS], *sums), "mix-realised")
    whole = cells.agg(*[F.sum(k).alias(f"all_{k}") for k in sums])
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("margin"), F.col(m).alias("value")) for m in MARGINS]))
    found = cells.select(values.alias("v"), *sums).groupBy("v.margin", "v.value").agg(*[F.sum(k).alias(k) for k in sums])
    return found.join(F.broadcast(whole)).select("margin", "value", *[F.try_divide(F.col(k), F.col(f"all_{k}")).alias(k) for k in sums])


def op5_mixing(spark, sf_dir):
    found = mix(documents(spark, sf_dir))
    return found.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("weight", 4).alias("weight"), F.round("probability", 4).alias("probability"), "sampled")


def _op5_sql(rounds: int = 9, power: float = 0.9) -> str:
    steps, last = [], "f0"
    for k in range(rounds):
        for m in MARGINS:
            name = f"{m[0]}{k + 1}"
            steps.append(f"{name} AS MATERIALIZED (SELECT x.source, x.lang, x.topic, x.tokens, x.fitted * t.target / sum(x.fitted) OVER (PARTITION BY x.{m}) AS fitted FROM {last} x JOIN t_{m} t ON x.{m} = t.{m})")
            last = name
    goals = ", ".join(f"t_{m} AS (SELECT {m}, pow(sum(tokens), {power}) / sum(pow(sum(tokens), {power})) OVER () * sum(sum(tokens)) OVER () AS target FROM cells GROUP BY {m})" for m in MARGINS)
    topics = " ".join("WHEN " + " OR ".join(f"contains(text, '{x}')" for x in expressions) + f" THEN '{topic}'" for topic, expressions in LEXICON.items())
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, source, lang FROM documents),
w AS (SELECT doc_id, source, lang, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_tokens, CASE {topics} ELSE 'general' END AS topic FROM d),
cells AS (SELECT coalesce(source, '') AS source, coalesce(lang, '') AS lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM w GROUP BY ALL),
{goals}, f0 AS (SELECT *, tokens AS fitted FROM cells), {", ".join(steps)},
r AS (SELECT *, CASE WHEN tokens > 0 THEN fitted / tokens ELSE 1 END AS ratio FROM {last}),
p AS (SELECT *, round(least(1.0, ratio / max(ratio) FILTER (WHERE tokens > 0) OVER ()), 9) AS probability FROM r)
SELECT w.doc_id, w.source, w.lang, w.topic, w.n_tokens, round(p.ratio, 4) AS weight, round(p.probability, 4) AS probability,
  ('0x' || substr(md5(coalesce(w.doc_id::VARCHAR, '') || ':0'), 1, 12))::BIGINT / {float(DRAWS)} < p.probability AS sampled
FROM w JOIN p ON coalesce(w.source, '') = p.source AND coalesce(w.lang, '') = p.lang AND w.topic = p.topic
"""


OP5_SQL = _op5_sql()
