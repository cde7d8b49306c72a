"""Sources mixed to target weights: capped targets, then pivotal dependent rounding of the fractional copies in a reduction tree."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, WORD, forget, small_side, spare, text_or_empty, written

WEIGHTS = (5, 2, 1)
#: A document is taken at most so many times.
MOST = 3
#: Documents whose probabilities one node of the tree settles, about.
FAN_IN = 96
EPS = 1e-9


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size). Sources in code point order, null last, weigh weights in turn.

    All sizes together are shared out by weight; a target above most * source_size is cut to that and the excess shared among
    the others. With sources ordered by cap / weight, the cut ones come first, which gives the level for the rest at once. The
    windows run in one task, over a row for each source: up to some millions of sources, not one for each document.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("k", F.row_number().over(order) - 1).withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("k") % len(weights) + 1).cast("int")).cast("long"))
    per = per.withColumn("cap", F.col("source_size") * most)
    below = Window.orderBy(F.col("cap") / F.col("w"), "k").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    per = per.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(below), F.lit(0))).withColumn("w_left", F.sum("w").over(every) - F.coalesce(F.sum("w").over(below), F.lit(0)))
    per = per.withColumn("level", F.col("left") / F.col("w_left"))
    # From the first source on whose cap exceeds its share, all have that level.
    first = F.min(F.when(F.col("cap") >= F.col("level") * F.col("w"), F.struct(F.col("cap") / F.col("w"), "k", "level"))).over(every)
    return per.withColumn("first", first).select("source", "source_size", F.least(F.col("cap").cast("double"), F.coalesce(F.col("first.level"), F.lit(0.0)) * F.col("w")).alias("target"))


def _unit(*cols: Column) -> Column:
    """A number in [0, 1) that depends on cols alone."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _settle(units: Column, seed: int) -> Column:
    """Of an array of (size, h, p, ...), one after another: struct(taken: those that became 1, rest: the one still in between).

    A pair trades words, not copies: one gains d / size, the other loses d / size, up to where one is 0 or 1. Either direction
    is drawn so that each keeps its expectation; the expected words of the pair stay what they were in either case.
    """
    snap = lambda p: F.when(F.abs(p) < EPS, F.lit(0.0)).when(F.abs(p - 1) < EPS, F.lit(1.0)).otherwise(p)

    def trade(acc: Column, b: Column) -> Column:
        a = acc["rest"]
        up = F.least(a["size"] * (1 - a["p"]), b["size"] * b["p"])
        down = F.least(a["size"] * a["p"], b["size"] * (1 - b["p"]))
        rise = _unit(F.lit(seed), a["h"], b["h"]) * (up + down) < down
        now = F.when(rise, up).otherwise(-down)
        pair = F.array(a.withField("p", snap(a["p"] + now / a["size"])), b.withField("p", snap(b["p"] - now / b["size"])))
        inside = lambda x: (x["p"] > 0) & (x["p"] < 1)
        both = F.filter(pair, inside)
        return F.struct(F.concat(acc["taken"], F.transform(F.filter(pair, lambda x: x["p"] == 1), lambda x: x["h"])).alias("taken"), F.get(both, F.lit(0)).alias("rest"))

    def step(acc: Column, b: Column) -> Column:
        return F.when(acc["rest"].isNull(), F.struct(acc["taken"].alias("taken"), b.alias("rest"))).otherwise(trade(acc, b))

    first = F.struct(F.array().cast("array<bigint>").alias("taken"), F.get(units, F.lit(0)).alias("rest"))
    return F.aggregate(F.slice(units, 2, 1 << 30), first, step)


def same_source(left: str, right: str) -> Column:
    return F.col(f"{left}.source").eqNullSafe(F.col(f"{right}.source"))


def round_copies(units: DataFrame, seed: int = 0, fan_in: int = FAN_IN) -> DataFrame:
    """(source, h) of the units that are taken, of units (source, h, size, p) with 0 < p < 1 and h unique in its source.

    Level 0 settles units of like size in nodes of about fan_in; each node leaves one at most. What is left of a source is settled in the
    same way until one node holds it; the last unit, a small one since nodes go from large to small, is drawn. How many nodes a level
    needs follows from counts taken once. A node's size is bounded as h spreads the units; no task or driver sees a source as a whole.
    """
    band = F.floor(F.log2(F.col("size")) * 8).cast("int").alias("band")
    left = written(units.select("source", "h", F.col("size").cast("double").alias("size"), F.col("p").cast("double").alias("p"), band), "mix-units")
    counts = left.groupBy("source", "band").agg(F.ceil(F.count("*") / fan_in).alias("nodes"))
    counts = written(counts.withColumn("next", F.sum("nodes").over(Window.partitionBy("source"))), "mix-counts", most=F.max("next"))
    rows = left.alias("u").join(small_side(counts).alias("c"), same_source("u", "c") & (F.col("u.band") == F.col("c.band"))).select("u.*", "c.nodes", "c.next")
    most, level, found = counts.stored.found["most"] or 0, 0, []
    while True:
        node = F.pmod(F.xxhash64("h", F.lit(level)), F.col("nodes")).alias("node")
        nodes = rows.groupBy("source", "band", node, "next").agg(F.sort_array(F.collect_list(F.struct("size", "h", "p")), asc=False).alias("units"))
        done = written(nodes.select("source", "next", _settle(F.col("units"), seed).alias("s")).select("source", "next", "s.taken", "s.rest"), f"mix-{level}")
        found.append(done.select("source", F.explode("taken").alias("h")))
        rest = done.filter("rest is not null")
        if level and most <= fan_in:
            found.append(rest.select("source", "rest.*").filter(_unit(F.lit(seed), F.col("h")) < F.col("p")).select("source", "h"))
            break
        most = ceil(most / fan_in) if level else most
        nodes_now = F.ceil(F.col("next") / fan_in)
        rows = rest.select("source", "rest.h", "rest.size", "rest.p", F.lit(0).alias("band"), nodes_now.alias("nodes"), nodes_now.alias("next"))
        level += 1
    forget(left, counts)
    return reduce(DataFrame.unionByName, found)


def _hash(seed: int) -> Column:
    """What tells documents apart, also those whose doc_id is null or repeated."""
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"), F.col("text"))


def _copies(most: int) -> tuple[Column, Column]:
    """(whole, p) of the copies of rows that are alike: their source's ratio times their number, split at the decimal point."""
    ratio = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    want = F.round(ratio * F.col("rows"), 12)
    part = want - F.floor(want)
    return F.floor(want) + F.when(part >= 1 - EPS, 1).otherwise(0), F.when((part > EPS) & (part < 1 - EPS), part).otherwise(0.0)


def _settled(docs: DataFrame, weights: tuple[int, ...], most: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(units, goal), both stored. units: doc_id, source, size, h, rows (alike in doc_id, source and text), whole, copies (of all those rows)."""
    narrow = written(docs.select("doc_id", "source", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"), _hash(seed).alias("h")), "mix-sizes")
    goal = written(targets(narrow, weights, most), "mix-targets")
    units = narrow.groupBy("doc_id", "source", "size", "h").agg(F.count("*").alias("rows"))
    units = units.alias("u").join(small_side(goal).alias("g"), same_source("u", "g")).select("u.*", "source_size", "target")
    whole, p = _copies(most)
    words = F.col("size") > 0
    units = written(units.select("doc_id", "source", "size", "h", "rows", "source_size", "target", F.when(words, whole).otherwise(0).alias("whole"), F.when(words, p).otherwise(0.0).alias("p")), "mix-wanted")
    more = round_copies(units.filter("p > 0").select("source", "h", "size", "p"), seed).select(F.col("h").alias("more")).distinct()
    more = written(more, "mix-more")
    settled = units.join(small_side(more), F.col("h") == F.col("more"), "left").withColumn("copies", F.col("whole") + F.when((F.col("p") > 0) & F.col("more").isNotNull(), 1).otherwise(0))
    return settled.drop("p", "more"), goal


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (= size * copies), then source and copies.

    The expected copies of each document are its source's target / source_size; the copies drawn are that number rounded down or
    up, so that a source's words differ from its target by less than one document. Null texts and texts without words have size
    0 and no copies; a null source is a source of its own. Rows alike in doc_id, source and text are rounded as one and share
    the copies out. Other columns are ignored. No rows in, no rows out. The draw depends on seed, doc_id, source and text alone.
    """
    units, _ = _settled(docs, weights, most, seed)
    share = F.floor(F.col("copies") / F.col("rows")) + F.when(F.col("k") < F.col("copies") % F.col("rows"), 1).otherwise(0)
    each = units.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("rows").cast("int") - 1))).withColumn("copies", share.cast("long"))
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def take(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """docs as the mix takes them: each row as often as its copies say, in docs' own columns. Rows without words are not taken.

    A row's copies follow from its source alone, but for those that were rounded up and those that are alike with others: only these
    are joined. Of rows alike in doc_id, source and text, which must be alike in all columns, one stands for the others.
    """
    units, goal = _settled(docs, weights, most, seed)
    odd = written(units.filter("copies <> whole or rows > 1").select("h", F.col("copies").alias("own"), "rows"), "mix-odd", again=F.count_if(F.col("rows") > 1))
    whole, _ = _copies(most)
    base = goal.withColumn("rows", F.lit(1)).select("source", whole.alias("base"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("source"), _hash(seed).alias("h"), text_or_empty().rlike(f"[^{SPACE}]").alias("words"))
    rows = rows.alias("r").join(small_side(goal, base).alias("b"), same_source("r", "b")).select("row", "h", "words", "base").join(small_side(odd), "h", "left")
    rows = rows.withColumn("copies", F.when(F.col("words"), F.coalesce("own", "base")).otherwise(0).cast("int")).filter("copies > 0")
    if odd.stored.found["again"]:
        rows = rows.filter("rows is null or rows = 1").unionByName(rows.filter("rows > 1").dropDuplicates(["h"]))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
