"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Each document gets a rate: how many times the mix takes it. Among all rates that give every source its
target in words, with no rate above CAP, the ones of least relative entropy to "every document once"
are r = min(CAP, exp(lambda * size)), with one dual variable lambda for each source. The convex dual is
solved by Newton steps, kept inside a bracket, for all sources at once. Rates depend on a document only
through its source and size, so a step aggregates the (source, size) table, not the documents.

Rates then become copies: a cell of n equal documents takes round(n * rate) copies, the rest that a
source still lacks or has too much of goes to its cells by size, and a cell's copies are spread over its
documents by a hash of doc_id. All documents of a cell differ by one copy at most.

Defined results: a null text has size 0 and takes 0 words; a null source is one source, the last in
order; repeated rows are documents of their own; a source without words has target 0; without any words
all targets are 0; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import cut, discard, unused, words

WEIGHTS = (1, 2, 3)
CAP = 3
MAX_STEPS = 60
TOLERANCE = 1e-9
#: Rows of one (source, size) cell that are ranked together when its copies are spread.
SPREAD = 256


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    Weights repeat over the sources by code point, null last. A source's share above cap times its size
    goes to the others by weight, which is a water level: target = min(cap * size, weight * level).
    Sources meet in one task: one short row for each name, never the documents.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    s = sources.withColumn("w", w).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    # in order of the level at which a source is full, the level if all before are full and none after
    order = W.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weight = F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing))
    s = s.withColumn("level", rest / weight).withColumn("full", F.col("most") / F.col("w"))
    # the first source that is not full at its level has the final level; those before it are full
    final = F.min(F.when(F.col("level") <= F.col("full"), F.struct("full", "level"))).over(W.partitionBy())["level"]
    return s.select("source", "source_size", F.least(F.col("most"), F.col("w") * final).alias("target"))


def rate(lam: Column, x: Column, cap: int) -> Column:
    """min(cap, exp(lambda * x)) without overflow."""
    return F.exp(F.least(lam * x, F.log(F.lit(float(cap)))))


def solve(cells: DataFrame, goal: DataFrame, cap: int = CAP, steps: int = MAX_STEPS) -> DataFrame:
    """(source, scale, lam): the dual variables of (source, size, n) cells, sizes above 0, and goals.

    x = size / scale, with the source's mean size as scale. The step solves log(sum) = log(target) by
    Newton's method; one that leaves the bracket halves it. Sources whose target is cap times their size
    have no finite solution and take lam null: every rate is cap.
    """
    mean = cells.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("scale"), F.min("size").alias("least"))
    state = _join(goal.filter("target > 0"), mean)
    full = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    unit = F.col("scale") / F.col("least")
    # at lo every rate is below target / size; at hi every rate is cap
    state = state.select(
        "source", "scale", "target", full.alias("done"),
        F.when(~full, F.lit(0.0)).alias("lam"),
        (F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size"))) * unit).alias("lo"),
        (F.log(F.lit(float(cap))) * unit).alias("hi"),
    )
    state = cut(state, "dual")
    for _ in range(steps):
        open_ = state.filter(~F.col("done"))
        if open_.isEmpty():
            break
        x = F.col("size") / F.col("scale")
        mass = F.col("n") * F.col("size") * rate(F.col("lam"), x, cap)
        met = _join(cells, open_.select("source", "scale", "lam")).groupBy("source").agg(
            F.sum(mass).alias("got"),
            F.sum(F.when(F.col("lam") * x < F.log(F.lit(float(cap))), mass * x).otherwise(0.0)).alias("slope"),
        )
        gap = F.log(F.col("got") / F.col("target"))
        now = _join(open_, met).withColumn("lo", F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))).withColumn("hi", F.when(gap > 0, F.col("lam")).otherwise(F.col("hi")))
        newton = F.col("lam") - gap * F.col("got") / F.nullif(F.col("slope"), F.lit(0.0))
        inside = (newton > F.col("lo")) & (newton < F.col("hi"))
        ended = (F.abs(gap) <= TOLERANCE) | (F.col("hi") - F.col("lo") <= 1e-15 * (1 + F.abs(F.col("lam"))))
        now = now.select("source", "scale", "target", ended.alias("done"), F.when(ended, F.col("lam")).when(inside, newton).otherwise((F.col("lo") + F.col("hi")) / 2).alias("lam"), "lo", "hi")
        then = cut(state.filter("done").unionByName(now), "dual")
        discard(state)
        state = then
    return state.select("source", "scale", "lam")


def _join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on source, null equal to null."""
    right = right.withColumnRenamed("source", "__source")
    return left.join(right, F.col("source").eqNullSafe(F.col("__source")), how).drop("__source")


def copies(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """sized (id, tie, source, size and others) with source_size, target, rate and copies added.

    Rows of one size and source are told apart by id and tie, a hash of the text: which of them get a copy more does
    not depend on how rows are laid out, whatever their ids. Rows equal in both are the same document.
    """
    cells = cut(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    goal = cut(targets(cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, cap), "targets")
    lam = solve(cells.filter("size > 0"), goal, cap)
    r = F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("target") == 0, F.lit(0.0)).when(F.col("lam").isNull(), F.lit(float(cap))).otherwise(rate(F.col("lam"), F.col("size") / F.col("scale"), cap))
    plan = _join(_join(cells, goal), lam, "left").withColumn("rate", r)
    plan = plan.select("source", "size", "n", "source_size", "target", "rate", F.least(F.col("n") * cap, F.round(F.col("n") * F.col("rate")).cast("long")).alias("m"))
    # what a source lacks goes to its cells from the largest size that fits down; so does what it has too much of
    own = W.partitionBy("source")
    for _ in range(6):
        plan = plan.withColumn("lack", F.round(F.col("target") - F.sum(F.col("m") * F.col("size")).over(own)).cast("long"))
        room = F.when(F.col("size") == 0, 0).when((F.col("lack") > 0) & (F.col("size") <= F.col("lack")), F.col("n") * cap - F.col("m")).when((F.col("lack") < 0) & (F.col("size") <= -F.col("lack")), F.col("m")).otherwise(0)
        plan = plan.withColumn("room", room)
        before = F.coalesce(F.sum(F.col("room") * F.col("size")).over(own.orderBy(F.col("size").desc()).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        fits = F.greatest(F.lit(0), F.least(F.col("room"), F.expr("cast((abs(lack) - __before) div greatest(size, 1) as long)")))
        plan = plan.withColumn("__before", before).withColumn("m", F.col("m") + F.when(F.col("room") > 0, F.signum("lack").cast("long") * fits).otherwise(0)).drop("__before")
    plan = cut(plan.select(F.col("source").alias("__source"), F.col("size").alias("__size"), F.col("n").alias("__n"), "source_size", "target", "rate", F.col("m").alias("__m")), "plan")
    met = sized.join(plan, F.col("source").eqNullSafe(F.col("__source")) & (F.col("size") == F.col("__size")))
    # a large cell is spread by hash into groups that are ranked apart
    met = met.withColumn("__h", F.xxhash64("id", "tie", F.lit("copies"))).withColumn("__part", F.expr(f"pmod(__h, greatest(1, __n div {SPREAD}))"))
    rank = F.row_number().over(W.partitionBy("source", "size", "__part").orderBy("__h", "id", "tie"))
    met = met.withColumn("__k", rank).withColumn("__shift", F.expr("CASE WHEN __part = 0 THEN 0 ELSE pmod(xxhash64(__part), __n) END"))
    extra = F.expr("(__k * (__m % __n) + __shift) div __n - ((__k - 1) * (__m % __n) + __shift) div __n")
    met = met.withColumn("copies", (F.expr("__m div __n") + extra).cast("int"))
    return met.drop("__source", "__size", "__n", "__m", "__h", "__part", "__k", "__shift")


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken, rate, copies."""
    sized = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("tie"), F.col(source).alias("source"), F.size(words(F.col(text))).cast("long").alias("size"))
    out = copies(cut(sized, "sized"), weights, cap)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "rate", "copies")


def resample(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The rows of docs, all their columns, each as often as the mix takes it."""
    row = unused(docs, "__row")
    sized = docs.select(F.struct("*").alias(row), F.col(key).alias("id"), F.xxhash64(text).alias("tie"), F.col(source).alias("source"), F.size(words(F.col(text))).cast("long").alias("size"))
    picked = copies(sized, weights, cap).filter("copies > 0")
    return picked.select(row, F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("__copy")).select(f"{row}.*")
