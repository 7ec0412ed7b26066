"""Repeated line runs, by a suffix array over sequences of line ids.

The suffixes of all documents' line sequences are ranked by prefix doubling.
At level ``k`` a suffix's rank tells its first ``2**k`` lines: it is one more
than the number of suffixes that are less in them. A level's ranks come from
those of the level below, at a suffix and ``2**k`` lines further on; within a
rank only the distinct pairs are ordered, so no line, however common, is sorted
with its rows. Suffixes whose rank is their own, or that end, are settled;
doubling goes on until all are. At each level a rank is an interval of the
suffix array whose longest common prefix is ``2**k`` or more.

From the top level down the intervals are then narrowed to any length, line by
line of its binary digits: an interval of a common prefix of ``l`` lines splits
by the ranks that its suffixes have ``l`` lines further on. A suffix stays with
those that agree; the first of each part also stands for it among those that
don't. What a suffix has reached in the end is the longest common prefix that it
has with any suffix before it in the corpus. Where that doesn't just continue
the line before, a maximal repeated run begins: it can't be longer on either
side. Runs with ``min_words`` words or more are later copies and are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.shared import discard, documents, marked, spread_join, stored, text_of

NO_ID = -(1 << 63)
#: What a word is made of: anything but these characters.
WORD = "[^\\x20\\x09-\\x0D]+"
PLACE = ["doc", "twin", "pos"]
BEFORE = (Window.unboundedPreceding, -1)


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, twin, pos, line, words``: lines that have words, by document and position; ``line`` is the SHA-256 of the line."""
    text = text_of(text_col)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("twin"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    counted = rows.select("doc", "twin", "pos", "line", F.regexp_count("line", F.lit(WORD)).alias("words")).where("words > 0")
    return counted.withColumn("line", F.unhex(F.sha2("line", 256)))


def ordered_counts(cells: DataFrame, within: list[str], order: str, slot) -> DataFrame:
    """``cells`` (one a value of ``order``) with ``before``: the sum of ``count`` over those of less ``order``.

    ``slot`` rises with ``order``. Only slots and the cells of one slot are sorted
    together, each about the square root of all lines.
    """
    cells = cells.withColumn("slot", slot)
    slots = cells.groupBy(*within, "slot").agg(F.sum("count").alias("all"))
    slots = slots.withColumn("base", F.coalesce(F.sum("all").over(Window.partitionBy(*within).orderBy("slot").rowsBetween(*BEFORE)), F.lit(0))).drop("all")
    inner = F.coalesce(F.sum("count").over(Window.partitionBy(*within, "slot").orderBy(order).rowsBetween(*BEFORE)), F.lit(0))
    return cells.withColumn("inner", inner).join(slots, [*within, "slot"]).withColumn("before", F.col("base") + F.col("inner")).drop("slot", "base", "inner")


def first_level(lines: DataFrame) -> DataFrame:
    """Repeated lines and the lines after them.

    Columns: place, ``i`` (number of the line), ``left`` (lines from here to the end of the text), ``b`` and ``e`` (words before and after the line, among these rows),
    ``r`` (rank of the line), ``n`` (lines with that rank) and ``f`` (the first of them, if there are several).
    """
    total = lines.count()
    half = (total.bit_length() + 1) // 2
    cells = lines.groupBy("line").agg(F.count(F.lit(1)).alias("count"), F.min(F.struct(*PLACE)).alias("first"))
    slot = F.shiftright(F.conv(F.hex(F.substring("line", 1, 4)), 16, 10).cast("long"), 32 - half)
    ranked = stored(ordered_counts(cells, [], "line", slot), "lines-ranked")
    rows = spread_join(lines, ranked, ["line"], "count", total)
    rows = rows.select(*PLACE, "words", (F.col("before") + 1).alias("r"), F.col("count").alias("n"), F.when(F.col("count") > 1, F.col("first")).alias("f"))
    each = Window.partitionBy("doc", "twin")
    down = each.orderBy("pos")
    rows = rows.withColumn("i", F.dense_rank().over(down)).withColumn("again", F.coalesce(F.lag("pos").over(down) == F.col("pos"), F.lit(False))).where("NOT again")  # repeated rows
    rows = rows.withColumn("follows", F.coalesce(F.lag("n").over(down) > 1, F.lit(False))).withColumn("left", F.max("i").over(each) - F.col("i") + 1)
    rows = rows.where("n > 1 OR follows").withColumn("e", F.sum("words").over(each.orderBy("i").rowsBetween(Window.unboundedPreceding, 0)))
    found = stored(rows.select(*PLACE, "i", "left", (F.col("e") - F.col("words")).alias("b"), "e", "r", "n", "f"), "lines-first")
    discard(ranked)
    return found


def doubled(base: DataFrame) -> list[DataFrame]:
    """The levels of the suffix array.

    Level ``k`` has place, ``i``, ``left``, ``r`` (rank by the first ``2**k`` lines), ``n`` (suffixes with that rank), ``f`` (the first of them, if there are several and they have that many
    lines), ``r0`` and ``f0`` (the same of the level below, where it was refined) and ``r2`` (the rank ``2**k`` lines further on; 0 at the end).
    """
    total = base.count()
    half = (total.bit_length() + 1) // 2
    none = F.lit(None).cast(base.schema["f"].dataType)
    now = base.drop("b", "e").withColumn("r0", F.lit(None).cast("long")).withColumn("f0", none)
    levels, used = [], []
    while True:
        step = 1 << len(levels)
        down = Window.partitionBy("doc", "twin").orderBy("i")
        level = now.withColumn("active", (F.col("n") > 1) & (2 * F.col("left") > step))  # a suffix that ends within the step is told from longer ones once
        level = level.withColumn("r2", F.coalesce(F.first("r").over(down.rangeBetween(step, step)), F.lit(0)))
        level = level.withColumn("asked", F.coalesce(F.max(F.col("active").cast("int")).over(down.rangeBetween(-step, -step)), F.lit(0)))
        level = stored(level, "lines-level")
        levels.append(level)
        discard(*used)
        active = level.where("active")
        if active.isEmpty():
            return levels
        pairs = active.groupBy("r", "r2").agg(F.count(F.lit(1)).alias("count"), F.min(F.struct(*PLACE)).alias("first"))
        used = [stored(ordered_counts(pairs, ["r"], "r2", F.shiftright("r2", half)), "lines-ranked")]
        refined = spread_join(active.drop("n"), *used, ["r", "r2"], "count", total)
        first = F.when((F.col("count") > 1) & (F.col("left") >= 2 * step), F.col("first"))
        refined = refined.select(*PLACE, "i", "left", (F.col("r") + F.col("before")).alias("r"), F.col("count").alias("n"), first.alias("f"), F.col("r").alias("r0"), F.col("f").alias("f0"))
        settled = level.where("NOT active AND asked = 1").select(*PLACE, "i", "left", "r", "n", none.alias("f"), F.lit(None).cast("long").alias("r0"), none.alias("f0"))
        now = refined.unionByName(settled)


def suffix_ranks(levels: list[DataFrame]) -> DataFrame:
    """``doc, twin, i, rank``: the places in the suffix array of all suffixes that begin with a repeated line or follow one; equal suffixes share theirs."""
    every = [x.select("doc", "twin", "i", "r") for x in levels]
    rows = every[0]
    for x in every[1:]:
        rows = rows.unionByName(x)
    return rows.groupBy("doc", "twin", "i").agg(F.max("r").alias("rank"))  # ranks only rise


def previous_copies(levels: list[DataFrame]) -> DataFrame:
    """place, ``i``, ``l``, ``g``: the longest common prefix, in lines, that a suffix has with one before it, and the first place of that prefix."""
    place, total, held, state = F.struct(*PLACE), levels[0].count(), [], None
    for k in reversed(range(len(levels) - 1)):
        step, level, parts = 1 << k, levels[k], []
        if state is not None:
            names = level.where("f IS NOT NULL").select("doc", "twin", F.col("i").alias("at"), F.col("r").alias("x"))
            tested = stored(state.withColumn("at", (F.col("i") + F.col("l")).cast("int")).join(names, ["doc", "twin", "at"], "left").drop("at"), "lines-tested")
            agree = tested.where("x IS NOT NULL")
            split = agree.groupBy("l", "g", "x").agg(F.count(F.lit(1)).alias("count"), F.min(place).alias("first"))
            joined = spread_join(agree, split, ["l", "g", "x"], "count", total)
            stays = F.when(place == F.col("first"), F.struct("l", "g"))
            goes = F.when(F.col("count") > 1, F.struct((F.col("l") + step).cast("int").alias("l"), F.col("first").alias("g")))
            both = joined.select(*PLACE, "i", F.explode(F.array_compact(F.array(stays, goes))).alias("to"))
            parts = [tested.where("x IS NULL").select(*PLACE, "i", "l", "g"), both.select(*PLACE, "i", "to.l", "to.g")]
            discard(*held)
            held = [tested]
        # of each interval of the level above, which has longer prefixes, only the first is still to be told from others
        enter = levels[k + 1].where("f0 IS NOT NULL").where(F.col("f").isNull() | (F.col("f") == place))
        parts.append(enter.select(*PLACE, "i", F.lit(step).alias("l"), F.col("f0").alias("g")))
        state = parts[0]
        for x in parts[1:]:
            state = state.unionByName(x)
    if state is None:
        state = levels[0].select(*PLACE, "i", F.lit(0).alias("l"), F.col("f").alias("g")).where("g IS NOT NULL")
    best = state.where(place != F.col("g")).groupBy(*PLACE, "i").agg(F.max(F.struct("l", "g")).alias("m"))
    found = stored(best.select(*PLACE, "i", "m.l", "m.g"), "lines-previous")
    discard(*held)
    return found


def maximal_runs(base: DataFrame, previous: DataFrame) -> DataFrame:
    """``doc, twin, i, l, s, t, words, g``: runs that occur before, too, and can't be longer: line number, lines, first and last position, words, and where they occur first."""
    down = Window.partitionBy("doc", "twin").orderBy("i")
    inner = (F.lag("i").over(down) == F.col("i") - 1) & (F.lag("l").over(down) > F.col("l"))  # continues the run of the line before
    runs = previous.withColumn("inner", F.coalesce(inner, F.lit(False))).where("NOT inner").drop("inner")
    starts, ends = base.select(*PLACE, "b"), base.select("doc", "twin", F.col("i").alias("z"), F.col("pos").alias("t"), "e")
    runs = runs.join(starts, PLACE).withColumn("z", (F.col("i") + F.col("l") - 1).cast("int")).join(ends, ["doc", "twin", "z"])
    return runs.select("doc", "twin", "i", "l", F.col("pos").alias("s"), "t", (F.col("e") - F.col("b")).alias("words"), "g")


def repeated_runs(docs: DataFrame, min_words: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The later copies of repeated line runs that ``line_dedup`` deletes, as ``maximal_runs`` gives them."""
    lines = stored(line_table(docs, id_col, text_col), "lines")
    base = first_level(lines)
    levels = doubled(base)
    previous = previous_copies(levels)
    runs = stored(maximal_runs(base, previous).where(F.col("words") >= min_words), "lines-runs")
    discard(lines, base, previous, *levels)
    return runs


def line_dedup(docs: DataFrame, min_words: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_lines``, ``n_removed`` and ``clean_text``, the text without later copies of repeated line runs.

    A run counts from ``min_words`` words on (1: every line that has words); it may
    lie in one document or in several and copies may overlap. "Earlier" goes by id
    (null first), then by position. Lines are equal if their SHA-256 is: no two
    different texts with one are known. Lines without words neither count nor
    part a run, and go if the next lines with words on both sides go. Null texts
    count as empty.
    Rows with one id and one text (by a 64-bit hash) are one document: each gets the
    same clean text, and they are no copies of each other; of rows with one id and
    different texts, the order is that of the texts' hashes. An empty table gives
    an empty result. Columns other than id and text pass through; three names,
    ``n_lines``, ``n_removed`` and ``clean_text``, are replaced.
    """
    runs = repeated_runs(docs, min_words, id_col, text_col)
    order = Window.partitionBy("doc", "twin").orderBy("i")
    reach = F.max(F.col("i") + F.col("l")).over(order.rowsBetween(*BEFORE))
    islands = runs.withColumn("new", F.coalesce((F.col("i") > reach).cast("int"), F.lit(1)))
    islands = islands.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ranges = islands.groupBy("doc", "twin", "island").agg(F.min("s").alias("s"), F.max("t").alias("t"))
    ranges = stored(ranges.groupBy("doc", "twin").agg(F.collect_list(F.struct("s", "t")).alias("gone")), "lines-gone")
    discard(runs)

    text = text_of(text_col)
    kept = docs.drop("n_lines", "n_removed", "clean_text")
    keyed = kept.select(F.struct(*kept.columns).alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("twin"), text.alias("whole"))
    keyed = marked(keyed, ranges, ["doc", "twin"])
    n_lines = (F.octet_length("whole") - F.octet_length(F.replace("whole", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines")
    same = keyed.where("NOT maybe").select("row.*", n_lines, F.lit(0).cast("long").alias("n_removed"), F.col("whole").alias("clean_text"))  # where they lie
    cleaned = F.expr("array_join(filter(split(whole, '\\n'), (x, p) -> NOT exists(gone, g -> p BETWEEN g.s AND g.t)), '\\n')")
    # a sort-merge join at every size: broadcast, the ranges would only fit while the input is small
    out = keyed.where("maybe").join(ranges.hint("merge"), ["doc", "twin"], "left").withColumn("clean", F.when(F.col("gone").isNull(), F.col("whole")).otherwise(cleaned))
    removed = F.coalesce(F.expr("aggregate(gone, 0L, (n, g) -> n + g.t - g.s + 1)"), F.lit(0).cast("long"))
    return same.unionByName(out.select("row.*", n_lines, removed.alias("n_removed"), F.col("clean").alias("clean_text")))


def op1_line_dedup(spark, sf_dir):
    return line_dedup(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_lines", "n_removed", "clean_text")


#: At one word a line goes if the same line is there before; lines without words go if the next ones with words on both sides go.
OP1_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos FROM documents),
w AS (SELECT *, regexp_matches(line, '[^\x20\x09-\x0D]') AS wordy FROM l),
n AS (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS nth FROM w WHERE wordy),
flag AS (SELECT w.doc_id, w.pos, (n.nth > 1)::INT AS f FROM w LEFT JOIN n ON w.doc_id = n.doc_id AND w.pos = n.pos),
gone AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, last_value(f IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p,
  first_value(f IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS q FROM flag) WHERE p = 1 AND q = 1)
SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed, coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS clean_text
FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id
"""
