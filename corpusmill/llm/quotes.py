"""Quotation linking: conversations in reply order, without quotes.

A message's lines are cut into runs of equal quote level, the number of ``>``
before the text. A run of level 1 or more is a quoted passage. Passages and
their lines are normalised and hashed; so are the runs of level 0, which are a
message's own words. An equality join finds, for each quoted passage, the
messages of its conversation that said it first. Of several the one with most
matching lines is the original, then the earliest. A message replies to the
original of its least nested linked passage; where no quotation tells, to the
message before it.

Messages from one that replies by quotation to the next such one form a branch.
Reply order is by the depth of branches, then by branch, then by turn, so that
every message stands after the one it replies to.

Everything on this path is made of DataFrame functions. Originals are
pre-aggregated to the first turn by hash, so nothing pairs up within a hot
conversation or passage. Running values are taken within cells of turns and
then over the cells, places within ranges of the reply order and then over the
ranges, so a very long conversation isn't one task's work.

Defined cases: a null or empty text has no lines; its text is empty. Null
conv_ids are one conversation. A message with a null turn comes first, quotes
nothing and replies to nothing. Messages that share a turn are each returned;
they reply to an earlier turn, never to each other. A quotation of something
that nobody said before, or that is empty, is removed and links nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.llm.common import table
from corpusmill.session import checkpoint, stored

#: Turns to a cell of the running values.
CELL = 1024
MARKS = r"^[ \t]*((?:>[ \t]*)*)"


def _normal(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def lines_of(messages: DataFrame) -> DataFrame:
    """messages with `lines`: structs (level, text, norm) of each line."""
    cut = F.split(F.coalesce("text", F.lit("")), "\r?\n")

    def line(x: Column) -> Column:
        marks = F.regexp_extract(x, MARKS, 1)
        own = F.regexp_replace(x, MARKS, "")
        level = F.length(F.regexp_replace(marks, r"[^>]", ""))
        return F.struct(level.alias("level"), F.when(level > 0, own).otherwise(x).alias("text"), _normal(own).alias("norm"))

    return messages.withColumn("lines", F.transform(cut, line))


def passages(lines: DataFrame) -> DataFrame:
    """(conv, turn, row, run, level, h, weight) for each passage and each of its lines that has words.

    A run ends where the level changes; blank lines are in no run and end none.
    """
    flat = lines.select("conv", "turn", "row", F.posexplode(F.filter("lines", lambda x: x["norm"] != "")).alias("pos", "line"))
    flat = flat.select("conv", "turn", "row", "pos", "line.level", "line.norm")
    w = Window.partitionBy("row").orderBy("pos")
    flat = flat.withColumn("new", (F.col("level") != F.lag("level", 1, -1).over(w)).cast("int"))
    flat = flat.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    single = flat.select("conv", "turn", "row", "run", "level", F.xxhash64("norm").alias("h"), F.lit(1).alias("weight"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "norm"))), lambda x: x["norm"]), "\n")
    whole = flat.groupBy("conv", "turn", "row", "run", "level").agg(F.xxhash64(joined).alias("h"), (F.count(F.lit(1)) + 1).cast("int").alias("weight"))
    return single.union(whole)


def links(lines: DataFrame) -> DataFrame:
    """(row, original, n_linked): the turn that each quoting message replies to, and how many of its passages are linked."""
    units = stored(passages(lines), "quote-passages")
    said = units.filter("level = 0 AND turn IS NOT NULL").groupBy("conv", "h").agg(F.min("turn").alias("original"))
    quoted = units.filter("level > 0 AND turn IS NOT NULL")
    on = quoted["conv"].eqNullSafe(said["conv"]) & (quoted["h"] == said["h"]) & (said["original"] < quoted["turn"])
    votes = quoted.join(said, on).select("row", "run", "level", "original", "weight")
    votes = votes.groupBy("row", "run", "level", "original").agg(F.sum("weight").alias("weight"))
    # of a passage's originals the heaviest, then the earliest
    best = votes.groupBy("row", "run", "level").agg(F.min(F.struct(-F.col("weight"), "original")).alias("b"))
    best = best.select("row", "run", "level", F.col("b.original").alias("original"))
    return best.groupBy("row").agg(F.min(F.struct("level", "run", "original"))["original"].alias("original"), F.count(F.lit(1)).alias("n_linked"))


def _running_max(df: DataFrame, value: Column, name: str, inclusive: bool) -> DataFrame:
    """df(conv, turn, ...) with the largest value of the conversation's earlier turns, or up to the own turn."""
    cells = df.withColumns({"_cell": F.floor(F.col("turn") / CELL), "_value": value})
    tops = cells.groupBy("conv", "_cell").agg(F.max("_value").alias("_top"))
    before = Window.partitionBy("conv").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select(F.col("conv").alias("_conv"), F.col("_cell").alias("_c"), F.max("_top").over(before).alias("_top"))
    inner = Window.partitionBy("conv", "_cell").orderBy("turn").rangeBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    joined = cells.withColumn("_own", F.max("_value").over(inner))
    on = joined["conv"].eqNullSafe(tops["_conv"]) & joined["_cell"].eqNullSafe(tops["_c"])
    return joined.join(tops, on, "left").withColumn(name, F.greatest("_own", "_top")).drop("_cell", "_value", "_own", "_top", "_conv", "_c")


def _depths(heads: DataFrame) -> DataFrame:
    """heads(conv, branch, parent) with depth: the number of branches above, by pointer doubling."""
    at = heads.select("conv", "branch", F.col("parent").alias("up"), F.lit(1).alias("depth"))
    while True:
        up = at.select(F.col("conv").alias("_conv"), F.col("branch").alias("_branch"), F.col("up").alias("_up"), F.col("depth").alias("_depth"))
        on = at["conv"].eqNullSafe(up["_conv"]) & (at["up"] == up["_branch"])
        at = checkpoint(at.join(up, on, "left").select("conv", "branch", F.col("_up").alias("up"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"), F.col("_branch").isNotNull().alias("moved")))
        moved = at.filter("moved AND up IS NOT NULL").limit(1).count()
        at = at.drop("moved")
        if not moved:
            return at.select("conv", "branch", "depth")


def reply_order(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message, without its quotes:

    (conv, turn, role, text, reply_to, by_quote, branch, depth, place, n_quoted_lines, n_linked)

    place counts a conversation's messages from 1 in reply order; branch is the
    turn at which the message's branch begins, null for the one that the
    conversation begins with.
    """
    named = messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).cast("string").alias("text"))
    rows = stored(named.withColumn("row", F.monotonically_increasing_id()), "quote-messages")
    lines = lines_of(rows)
    own = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["text"]), "\n")
    texts = lines.select("conv", "turn", "role", "row", F.trim(own).alias("text"), F.size(F.filter("lines", lambda x: x["level"] > 0)).alias("n_quoted_lines"))
    linked = stored(links(lines), "quote-links")
    texts = texts.join(linked, "row", "left").withColumn("n_linked", F.coalesce("n_linked", F.lit(0)).cast("long"))
    texts = _running_max(texts, F.col("turn"), "previous", False)
    texts = texts.withColumn("reply_to", F.coalesce("original", "previous"))
    # a branch begins with a message that replies by quotation
    texts = stored(_running_max(texts, F.when(F.col("original").isNotNull(), F.col("turn")), "branch", True), "quote-replies")
    heads = texts.filter("original IS NOT NULL").groupBy("conv", "turn").agg(F.min("original").alias("original"))
    depths = None
    if heads.limit(1).count():
        spots = texts.filter("turn IS NOT NULL").groupBy("conv", "turn").agg(F.max("branch").alias("parent"))
        spots = spots.select(F.col("conv").alias("_conv"), F.col("turn").alias("_turn"), "parent")
        on = heads["conv"].eqNullSafe(spots["_conv"]) & (heads["original"] == spots["_turn"])
        depths = _depths(heads.join(spots, on, "left").select("conv", F.col("turn").alias("branch"), "parent"))
        d = depths.select(F.col("conv").alias("_conv"), F.col("branch").alias("_branch"), "depth")
        texts = texts.join(d, texts["conv"].eqNullSafe(d["_conv"]) & (texts["branch"] == d["_branch"]), "left").drop("_conv", "_branch")
        texts = texts.withColumn("depth", F.coalesce("depth", F.lit(0)))
    else:
        texts = texts.withColumn("depth", F.lit(0))
    return _placed(texts).select(
        "conv", "turn", "role", "text", "reply_to", F.col("original").isNotNull().alias("by_quote"), "branch", "depth", "place", F.col("n_quoted_lines").cast("long").alias("n_quoted_lines"), "n_linked"
    )


def _placed(texts: DataFrame) -> DataFrame:
    """texts with place: its number in its conversation by (depth, branch, turn).

    Counted within ranges of that order and added up over the ranges, which are
    as many as partitions, however the messages of a conversation reply to each other.
    """
    order = ["depth", "branch", "turn", "role", "text", "n_quoted_lines"]
    ranged = stored(texts.repartitionByRange("conv", *order).withColumn("_range", F.spark_partition_id()), "quote-ranges")
    before = Window.partitionBy("conv").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("conv", "_range").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select(F.col("conv").alias("_a"), F.col("_range").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_low"))
    ranked = ranged.withColumn("_rank", F.row_number().over(Window.partitionBy("conv", "_range").orderBy(*order)))
    on = ranked["conv"].eqNullSafe(counts["_a"]) & (ranked["_range"] == counts["_b"])
    return ranked.join(counts, on).withColumn("place", (F.col("_low") + F.col("_rank")).cast("long")).drop("_a", "_b", "_low", "_rank", "_range")


def conversations(ordered: DataFrame, chunk: int = 1000) -> DataFrame:
    """(conv, part, messages): each conversation's messages in reply order, at most `chunk` of them to a row."""
    item = F.struct("place", "turn", "role", "text", "reply_to")
    grouped = ordered.withColumn("part", F.floor((F.col("place") - 1) / chunk)).groupBy("conv", "part")
    return grouped.agg(F.array_sort(F.collect_list(item)).alias("messages"))


def _digest(ordered: DataFrame) -> DataFrame:
    return ordered.select(
        F.col("conv").alias("conv_id"), "turn", "role", "reply_to", "by_quote", "branch", "depth", "place", "n_quoted_lines", "n_linked",
        F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(reply_order(table(spark, sf_dir, "conversations")))


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on the conversations with quotes planted: a message whose turn leaves 2 or 4 by 5 quotes the one 2 or 3 turns earlier, in which quotes may be quoted."""
    m = table(spark, sf_dir, "conversations")
    for rest, back in ((2, 2), (4, 3)):
        old = m.select(F.col("conv_id").alias("_c"), (F.col("turn") + back).alias("_t"), F.concat(F.lit("> "), F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit("\n> ")), F.lit("\n")).alias("_q"))
        quoted = F.when((F.pmod("turn", F.lit(5)) == rest) & F.col("_q").isNotNull(), F.concat("_q", F.coalesce("text", F.lit("")))).otherwise(F.col("text"))
        m = m.join(old, (m["conv_id"] == old["_c"]) & (m["turn"] == old["_t"]), "left").select("conv_id", "turn", "role", quoted.alias("text"))
    return _digest(reply_order(stored(m, "quote-planted")))


#: The same in DuckDB, with a recursive query for the depths. Turns are unique in a conversation of the tables.
SQL = r"""
WITH RECURSIVE m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
l AS (SELECT conv_id, turn, generate_subscripts(string_split_regex(text, '\r?\n'), 1) AS pos, unnest(string_split_regex(text, '\r?\n')) AS x FROM m),
l2 AS (SELECT conv_id, turn, pos, x, len(regexp_replace(regexp_extract(x, '^[ \t]*((?:>[ \t]*)*)', 1), '[^>]', '', 'g')) AS level,
    trim(regexp_replace(lower(regexp_replace(x, '^[ \t]*((?:>[ \t]*)*)', '')), '\s+', ' ', 'g')) AS norm FROM l),
f AS (SELECT *, CASE WHEN level = lag(level, 1, -1) OVER (PARTITION BY conv_id, turn ORDER BY pos) THEN 0 ELSE 1 END AS new FROM l2 WHERE norm <> ''),
g AS (SELECT *, sum(new) OVER (PARTITION BY conv_id, turn ORDER BY pos) AS run FROM f),
u AS (SELECT conv_id, turn, run, level, norm AS h, 1 AS weight FROM g
    UNION ALL SELECT conv_id, turn, run, level, string_agg(norm, chr(10) ORDER BY pos), count(*) + 1 FROM g GROUP BY conv_id, turn, run, level),
s AS (SELECT conv_id, h, min(turn) AS original FROM u WHERE level = 0 GROUP BY conv_id, h),
v AS (SELECT u.conv_id, u.turn, run, level, original, sum(weight) AS weight FROM u JOIN s ON u.conv_id = s.conv_id AND u.h = s.h AND s.original < u.turn
    WHERE level > 0 GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, run ORDER BY weight DESC, original) AS k FROM v),
k AS (SELECT conv_id, turn, count(*) AS n_linked, first(original ORDER BY level, run) AS original FROM b WHERE k = 1 GROUP BY conv_id, turn),
o AS (SELECT conv_id, turn, trim(string_agg(x, chr(10) ORDER BY pos) FILTER (level = 0)) AS text, count(*) FILTER (level > 0) AS n_quoted_lines FROM l2 GROUP BY conv_id, turn),
r AS (SELECT m.conv_id, m.turn, m.role, coalesce(o.text, '') AS text, n_quoted_lines, coalesce(n_linked, 0) AS n_linked, original,
    lag(m.turn) OVER (PARTITION BY m.conv_id ORDER BY m.turn) AS previous,
    max(CASE WHEN original IS NOT NULL THEN m.turn END) OVER (PARTITION BY m.conv_id ORDER BY m.turn) AS branch
    FROM m JOIN o USING (conv_id, turn) LEFT JOIN k USING (conv_id, turn)),
d(conv_id, branch, depth) AS (SELECT conv_id, turn, 1 FROM r a WHERE original IS NOT NULL
        AND (SELECT branch FROM r p WHERE p.conv_id = a.conv_id AND p.turn = a.original) IS NULL
    UNION ALL SELECT a.conv_id, a.turn, d.depth + 1 FROM r a JOIN r p ON p.conv_id = a.conv_id AND p.turn = a.original
        JOIN d ON d.conv_id = a.conv_id AND d.branch = p.branch WHERE a.original IS NOT NULL)
SELECT r.conv_id, r.turn, role, coalesce(original, previous) AS reply_to, original IS NOT NULL AS by_quote, r.branch, coalesce(depth, 0)::INTEGER AS depth,
    row_number() OVER (PARTITION BY r.conv_id ORDER BY coalesce(depth, 0), r.branch NULLS FIRST, r.turn) AS place,
    n_quoted_lines, n_linked, len(text)::BIGINT AS n_chars, md5(text) AS text_md5
FROM r LEFT JOIN d ON d.conv_id = r.conv_id AND d.branch = r.branch
"""

#: SQL on the table with planted quotes.
PLANTED_SQL = SQL.replace(
    "WITH RECURSIVE m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations)",
    """WITH RECURSIVE p1 AS (SELECT a.conv_id, a.turn, a.role, CASE WHEN a.turn % 5 = 2 AND b.turn IS NOT NULL
    THEN '> ' || replace(coalesce(b.text, ''), chr(10), chr(10) || '> ') || chr(10) || coalesce(a.text, '') ELSE a.text END AS text
    FROM conversations a LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn - 2),
p2 AS (SELECT a.conv_id, a.turn, a.role, CASE WHEN a.turn % 5 = 4 AND b.turn IS NOT NULL
    THEN '> ' || replace(coalesce(b.text, ''), chr(10), chr(10) || '> ') || chr(10) || coalesce(a.text, '') ELSE a.text END AS text
    FROM p1 a LEFT JOIN p1 b ON b.conv_id = a.conv_id AND b.turn = a.turn - 3),
m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM p2)""",
)
