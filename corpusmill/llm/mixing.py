"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern, the set of sources they belong
to. A flow network routes the words of each pattern to the quotas of its
sources; the first pass over a pattern's words costs nothing, each repetition
costs more than the one before (convex costs), so words are repeated only
where no fresh ones can fill a quota. The flow says how many words each
pattern gives to each source; documents are then selected in seeded order
until those words are reached.

A pattern of one source that no other pattern overlaps needs no flow: its
quota is its own. So only the overlapping patterns and what they touch come to
the driver, up to ``max_patterns`` of them; any number of sources, as one for each
host, is mixed by joins. The seeded order is never sorted as a whole: its
running sums are taken within hash cells and the cells' totals summed up, so
that a source with a third of all documents is spread like any other.

Defined cases: a null or empty text has size 0 and is never taken. A null
source is a source, the last. Documents without any source are not taken.
Rows that repeat a doc_id are documents of their own, null ids too. Equal rows
tie in the seeded order, so it doesn't matter which of them is taken. A very
long text counts whole. An empty table gives no rows. Columns of other names
are not read. Reruns agree: the order depends on the ids, sizes, texts and the
seed alone.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.llm.common import WORD, table
from corpusmill.session import stored


@dataclass(frozen=True)
class Params:
    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    share: float = 1.5
    repeats: int = 2
    seed: int = 11
    cells: int = 1024
    max_patterns: int = 20_000
    rounds: int = 3


def targets(sizes: dict[str | None, int], p: Params = Params()) -> dict[str | None, float]:
    """Each source's target: the share of all words by weight, no source above `repeats` times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: p.weights[i % len(p.weights)] for i, s in enumerate(order)}
    left, free, out = p.share * sum(sizes.values()), set(order), {}
    while free:
        total = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / total > p.repeats * sizes[s]]
        if not full:
            out |= {s: left * weight[s] / total for s in free}
            break
        for s in full:
            out[s] = float(p.repeats * sizes[s])
        left -= sum(out[s] for s in full)
        free -= set(full)
    return out


def min_cost_flow(patterns: list[tuple[tuple, int]], quota: dict, repeats: int) -> dict[tuple[int, object], float]:
    """Words that each pattern gives each source: {(pattern's index, source): words}.

    Successive shortest paths. Arcs run from the origin to a pattern, once for
    each pass over its words at the pass's number as cost, on to its sources,
    and from there to the sink within the quota. Costs are on the first arcs
    only, so a shortest path starts at the cheapest arc that still has a path.
    """
    sources = list(quota)
    node = {s: len(patterns) + i for i, s in enumerate(sources)}
    room = {node[s]: quota[s] for s in sources}
    given: dict[int, dict[int, float]] = {i: {node[s]: 0.0 for s in who} for i, (who, _) in enumerate(patterns)}
    takes: dict[int, set[int]] = {n: set() for n in node.values()}  # the patterns that give to a source
    eps = 1e-6
    for _ in range(repeats):  # passes in order of cost
        fresh = {i: float(size) for i, (_, size) in enumerate(patterns)}
        for start in range(len(patterns)):
            while fresh[start] > eps:
                came: dict[int, int | None] = {start: None}
                queue, end = deque([start]), None
                while queue and end is None:
                    u = queue.popleft()
                    near = given[u] if u < len(patterns) else takes[u]  # on to its sources, or back to who gave
                    for v in near:
                        if v in came or (u >= len(patterns) and given[v][u] <= eps):
                            continue
                        came[v] = u
                        if v >= len(patterns) and room[v] > eps:
                            end = v
                            break
                        queue.append(v)
                if end is None:
                    break
                path = [end]
                while came[path[-1]] is not None:
                    path.append(came[path[-1]])
                path.reverse()
                back = [given[path[k + 1]][path[k]] for k in range(1, len(path) - 1, 2)]
                words = min([fresh[start], room[end], *back])
                for k, (u, v) in enumerate(zip(path, path[1:])):
                    if k % 2 == 0:
                        given[u][v] += words
                        takes[v].add(u)
                    else:
                        given[v][u] -= words
                fresh[start] -= words
                room[end] -= words
    name = {n: s for s, n in node.items()}
    return {(i, name[n]): w for i, to in given.items() for n, w in to.items() if w > eps}


def sized(docs: DataFrame, members: Column, id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """(doc_id, members, pattern, size, h, th): pattern is the members in order, as JSON; h places the document; th is its text's hash."""
    who = F.array_sort(F.array_distinct(members.cast("array<string>")))
    text = F.col(text_col).cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), who.alias("members"), size.alias("size"), F.xxhash64(text).alias("th"))
    return rows.select("doc_id", "members", F.to_json("members").alias("pattern"), "size", F.xxhash64(F.lit(p.seed), "doc_id", "size").alias("h"), "th")


def _ranked(sources: DataFrame) -> DataFrame:
    """sources(source, size) with its place in code-point order from 0, null last: places within ranges, and the ranges' totals."""
    placed = stored(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("range", F.spark_partition_id()), "mix-sources")
    # a row for each range, of which there are as many as partitions
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("low"))
    own = F.row_number().over(Window.partitionBy("range").orderBy(F.col("source").asc_nulls_last())) - 1
    return placed.withColumn("own", own).join(F.broadcast(totals), "range").select("source", "size", (F.col("low") + F.col("own")).alias("place"))


def source_targets(sources: DataFrame, p: Params = Params()) -> DataFrame:
    """sources(source, size) with target, as targets() gives them, for any number of sources.

    A source is full if its bound by weight lies below the level at which words
    are shared out; the level rises until no more sources fill up.
    """
    weights = F.array(*(F.lit(float(w)) for w in p.weights))
    rows = stored(_ranked(sources).withColumn("weight", F.get(weights, F.pmod("place", F.lit(len(p.weights))).cast("int"))), "mix-weights")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    level, most = -1.0, p.repeats * F.col("size")
    while True:
        full = F.col("weight") * level > most
        got = rows.agg(F.sum(F.when(full, most).otherwise(0)).alias("spent"), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("free")).first()
        rise = (p.share * total - got.spent) / got.free if got.free else level
        if rise <= level or not got.free:
            return rows.select("source", "size", F.when(full, most.cast("double")).otherwise(F.col("weight") * max(level, 0.0)).alias("target"))
        level = rise


def _routes(rows: DataFrame, quota: dict | None, p: Params) -> tuple[DataFrame, bool]:
    """(pattern, source, pattern_size, source_size, target, low, high): stretches of each pattern's words, pass after pass, and whose they are.

    Also whether they are few enough to be broadcast.
    """
    spark = rows.sparkSession
    found = stored(rows.groupBy("pattern").agg(F.first("members").alias("members"), F.sum("size").alias("size")).filter(F.size("members") > 0), "mix-patterns")
    sources = found.select(F.explode("members").alias("source"), F.col("size").alias("s")).groupBy("source").agg(F.sum("s").alias("size"))
    if quota is None:
        goals = source_targets(sources, p)
    else:
        given = spark.createDataFrame([(k, float(v)) for k, v in quota.items()] or [(None, 0.0)], "_s string, target double")
        goals = sources.join(F.broadcast(given), sources["source"].eqNullSafe(given["_s"]), "left").select("source", "size", F.coalesce("target", F.lit(0.0)).alias("target"))
    goals = stored(goals, "mix-targets")
    n_sources = goals.count()
    mixed = found.filter(F.size("members") > 1).limit(p.max_patterns + 1).collect()
    if len(mixed) > p.max_patterns:
        raise ValueError(f"more than {p.max_patterns} patterns of several sources")
    touched = sorted({s for r in mixed for s in r.members}, key=lambda s: (s is None, s or ""))
    marks = spark.createDataFrame([(s,) for s in touched], "_s string")
    kinds = "pattern string, source string, pattern_size long, source_size long, target double, low double, high double"
    # patterns by themselves: their words up to the quota
    single = found.filter(F.size("members") == 1).select("pattern", F.get("members", F.lit(0)).alias("source"), F.col("size").alias("pattern_size"))
    alone = single.join(F.broadcast(marks), single["source"].eqNullSafe(marks["_s"]), "left_anti") if touched else single
    goal = goals.select(F.col("source").alias("_s"), F.col("size").alias("source_size"), "target")
    alone = alone.join(goal, alone["source"].eqNullSafe(goal["_s"])).select("pattern", "source", "pattern_size", "source_size", "target", F.lit(0.0).alias("low"), F.least("target", p.repeats * F.col("pattern_size")).cast("double").alias("high"))
    few = n_sources <= p.max_patterns
    if not touched:
        return stored(alone, "mix-routes"), few
    own = single.join(F.broadcast(marks), single["source"].eqNullSafe(marks["_s"]), "left_semi").collect()  # at most one for each that is touched
    flowing = sorted([(r.pattern, tuple(r.members), r.size) for r in mixed] + [(r.pattern, (r.source,), r.pattern_size) for r in own])
    here = goals.join(F.broadcast(marks), goals["source"].eqNullSafe(marks["_s"]), "left_semi").collect()
    size, wanted = {r.source: r.size for r in here}, {r.source: r.target for r in here}
    flow = min_cost_flow([(who, n) for _, who, n in flowing], wanted, p.repeats)
    routes = []
    for i, (pattern, who, n) in enumerate(flowing):
        at = 0.0
        for s in who:
            words = flow.get((i, s), 0.0)
            routes.append((pattern, s, n, size[s], wanted[s], at, at + words))
            at += words
    return stored(alone.union(spark.createDataFrame(routes, kinds)), "mix-routes"), few


def mix(docs: DataFrame, members: Column, id_col: str = "doc_id", text_col: str = "text", quota: dict | None = None, p: Params = Params()) -> DataFrame:
    """(doc_id, members, size, th, source, source_size, target, copies, taken): a row for each document and each of its sources.

    quota gives the words that each source shall have; by default targets().
    """
    rows = stored(sized(docs, members, id_col, text_col, p), "mix-sizes")
    routes, few = _routes(rows, quota, p)
    route = F.broadcast(routes) if few else routes  # few: at most max_patterns sources, and patterns times their sources

    cell = F.pmod(F.shiftrightunsigned("h", 33), F.lit(p.cells)).cast("int")
    rows = rows.withColumn("cell", cell)
    totals = rows.groupBy("pattern", "cell").agg(F.sum("size").alias("cell_size"))
    before = Window.partitionBy("pattern").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("pattern", "cell", F.coalesce(F.sum("cell_size").over(before), F.lit(0)).alias("cell_low"))
    order = Window.partitionBy("pattern", "cell").orderBy("h", "doc_id", "size", "th").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("cell_low") + F.sum("size").over(order) - F.col("size") / 2.0
    placed = rows.join(totals, ["pattern", "cell"]).select("doc_id", "members", "pattern", "size", "h", "th", middle.alias("middle"))
    # a pass takes a document where its middle falls into the stretch of a source
    passes = [((F.col("middle") + n * F.col("pattern_size") >= F.col("low")) & (F.col("middle") + n * F.col("pattern_size") < F.col("high"))).cast("int") for n in range(p.repeats)]
    copies = sum(passes[1:], passes[0])
    chosen = placed.join(route, "pattern", "left").withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0))
    chosen = chosen.select(F.monotonically_increasing_id().alias("row"), "doc_id", "members", "size", "h", "th", "source", "source_size", "target", F.coalesce("copies", F.lit(0)).alias("copies"))
    return _nearer(stored(chosen, "mix-chosen"), few, p).withColumn("taken", F.col("copies") * F.col("size")).drop("h", "row")


def _nearer(chosen: DataFrame, few: bool, p: Params) -> DataFrame:
    """Whole documents leave each source a part of a document off its target: add or drop the one that fits the gap best.

    Documents in several sources are left as they are, for what one source
    took another could not.
    """
    bounded = F.broadcast if few else lambda df: df  # a row for each source
    own = F.size("members") == 1
    for _ in range(p.rounds):
        gap = chosen.filter("target IS NOT NULL").groupBy("source", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("has"))
        gap = gap.select(F.col("source").alias("_s"), (F.col("target") - F.col("has")).alias("gap"))
        # the one of best fit: its move must bring the source nearer
        fits = chosen.filter(own & (F.col("size") > 0)).join(bounded(gap), chosen["source"].eqNullSafe(gap["_s"]))
        move = F.when((F.col("gap") > 0) & (F.col("copies") < p.repeats), 1).when((F.col("gap") < 0) & (F.col("copies") > 0), -1)
        left = F.abs(F.col("gap") - move * F.col("size"))
        fits = fits.select("source", "doc_id", "h", "size", "th", "row", move.alias("move"), left.alias("left"), "gap").filter("move IS NOT NULL AND left < abs(gap)")
        best = fits.groupBy("source").agg(F.min(F.struct("left", "h", "doc_id", "size", "th", "row", "move")).alias("b"))
        moves = stored(best.select(F.col("b.row").alias("_row"), F.col("b.move").alias("_move")), "mix-moves")
        if not moves.limit(1).count():
            break
        joined = chosen.join(bounded(moves), chosen["row"] == moves["_row"], "left")
        # a document of one source has one row, so its row names it
        copies = F.greatest(F.lit(0), F.least(F.lit(p.repeats), F.col("copies") + F.coalesce("_move", F.lit(0))))
        chosen = joined.select(*(copies.alias(c) if c == "copies" else chosen[c] for c in chosen.columns))
    return chosen


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mix(docs, F.array("source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def mixed_documents(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """docs with each document as often as the mix takes it, in the columns of docs.

    Rows are found again by id and text. Rows that share both share what was
    taken of them: all as often, and as many of them once more as are left over.
    """
    taken = mix(docs, F.array(source_col), id_col, text_col, p=p)
    by = taken.groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), F.col("source").alias("_source"))
    groups = by.agg(F.sum("copies").alias("_sum"), F.count(F.lit(1)).alias("_n")).filter("_sum > 0")
    even = F.col("_sum") % F.col("_n") == 0
    groups = stored(groups.withColumn("_even", even), "mix-copies")

    # a row of docs is one column here, so that no name clashes with its columns
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("th"), F.col(source_col).cast("string").alias("src"))

    def of(some: DataFrame) -> DataFrame:
        return rows.join(some, rows["id"].eqNullSafe(some["_id"]) & (rows["th"] == some["_th"]) & rows["src"].eqNullSafe(some["_source"]))

    def times(found: DataFrame, n: Column) -> DataFrame:
        copies = found.withColumn("n", n.cast("int")).filter("n > 0")
        return copies.select("doc", F.explode(F.sequence(F.lit(1), F.col("n")))).select("doc.*")

    out = times(of(groups.filter("_even")), F.col("_sum") / F.col("_n"))
    odd = groups.filter("NOT _even")
    if not odd.limit(1).count():
        return out
    # equal rows are counted, not gathered, and each takes its part of those left over
    keys = ["_id", "_th", "_source"]
    counted = of(odd).groupBy("doc", *keys, "_sum", "_n").agg(F.count(F.lit(1)).alias("equal"))
    before = F.coalesce(F.sum("equal").over(Window.partitionBy(*keys).orderBy(F.xxhash64("doc")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    over = F.greatest(F.lit(0), F.least(F.col("equal"), F.col("_sum") % F.col("_n") - before))
    return out.union(times(counted, F.col("equal") * F.floor(F.col("_sum") / F.col("_n")) + over))
