"""Quality rules: a decision list of threshold conjunctions learned by sequential covering.

All of it is DataFrame work. One pass over the texts gives a narrow table of counts; the learner
sees labelled rows of that table only as a histogram over threshold bins, so each growing step
brings (features x bins) counts to the driver, whatever the size of the corpus.

Defined results: a null or blank text has zero words and so fails the base; a null label, or a
doc_id with conflicting labels, is not learned from; a null doc_id is judged like any other and never
joins a label; repeated rows are judged each; without labels the list is empty and only the base
decides; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import NONSPACE, SPACE, all_of, cut, discard, unused

#: Shares of labelled rows at which thresholds are taken, in each class.
QUANTILES = [0.0, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99, 1.0]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct_words", "n_upper", "n_letters", "n_marks"]
#: What the learner sees; each is a ratio of counts, so long and short texts compare.
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_lines_per_word": ("n_dup_lines", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "upper_share": ("n_upper", "n_letters"),
    "marks_per_word": ("n_marks", "n_words"),
    "word_length": ("word_chars", "n_words"),
}


def count_features(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """carry columns plus COUNTS for every whole text, without a shuffle."""
    t = docs.select(*carry, F.coalesce(F.col(text), F.lit("")).alias("__t"))
    t = t.withColumn("__w", F.array_remove(F.split("__t", SPACE), ""))
    t = t.withColumn("__lines", F.filter(F.split("__t", "\n"), lambda x: x.rlike(NONSPACE)))
    # a window of three words by its 64-bit hash
    t = t.withColumn("__g", F.expr("CASE WHEN size(__w) < 3 THEN cast(array() AS array<bigint>) ELSE transform(sequence(0, size(__w) - 3), i -> xxhash64(__w[i], __w[i + 1], __w[i + 2])) END"))
    t = t.withColumn("__again", F.size(F.array_distinct("__g")) < F.size("__g"))
    # texts with a repeated window: its sorted places, found beside an equal neighbour
    t = t.withColumn("__s", F.expr("CASE WHEN __again THEN array_sort(transform(__g, (x, i) -> struct(x AS x, i AS i))) END"))
    t = t.withColumn("__p", F.expr("array_sort(transform(filter(__s, (e, j) -> (j > 0 AND e.x = __s[j - 1].x) OR (j + 1 < size(__s) AND e.x = __s[j + 1].x)), e -> e.i))"))
    covered = F.expr("CASE WHEN __again THEN 3 + aggregate(transform(sequence(1, size(__p) - 1), k -> least(3, __p[k] - __p[k - 1])), 0, (a, x) -> a + x) ELSE 0 END")
    left = lambda pattern: F.length(F.regexp_replace("__t", pattern, ""))
    return t.select(
        *carry,
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        left("[^#*$%&|<>]+").cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size(F.array_distinct("__w")).cast("long").alias("n_distinct_words"),
        left("[^\\p{Lu}]+").cast("long").alias("n_upper"),
        left("[^\\p{L}]+").cast("long").alias("n_letters"),
        left("[^!?]+").cast("long").alias("n_marks"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))


def ratio(name: str) -> Column:
    top, bottom = RATIOS[name]
    return F.col(top) / F.greatest(F.col(bottom), F.lit(1))


@dataclass
class Condition:
    feature: str
    at_least: bool
    threshold: float
    bin: int

    def on_counts(self) -> Column:
        return ratio(self.feature) >= self.threshold if self.at_least else ratio(self.feature) < self.threshold

    def on_bins(self) -> Column:
        return F.col(self.feature) >= self.bin if self.at_least else F.col(self.feature) < self.bin

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Ordered rules; a text that meets all conditions of one is rejected."""

    rules: list[list[Condition]] = field(default_factory=list)

    def expression(self) -> Column:
        """The first rule met, as text; null if none is. One ordered CASE expression."""
        out = F.lit(None).cast("string")
        for rule in reversed(self.rules):
            out = F.when(all_of([c.on_counts() for c in rule]), F.lit(" and ".join(map(str, rule)))).otherwise(out)
        return out


def learn(rows: DataFrame, max_rules: int = 12, max_conditions: int = 4, min_precision: float = 0.98) -> DecisionList:
    """Learn from rows with COUNTS, `reject` (boolean) and `grow` (boolean; the rest prunes).

    Growing adds the condition of highest information gain until no kept row is covered; pruning cuts
    the tail of the rule that does not help on the other part. A rule stays if its precision on both
    parts is min_precision or more; the first that isn't ends the list. The list is a model of bounded size:
    it has max_rules rules of max_conditions conditions at most, whatever rejected rows are left uncovered.
    """
    names = list(RATIOS)
    quantiles = F.array(*[F.lit(q) for q in QUANTILES])
    picked = rows.groupBy("reject").agg(*[F.percentile_approx(ratio(n), quantiles, 10000).alias(n) for n in names]).collect()
    if {r["reject"] for r in picked} != {True, False}:
        return DecisionList()
    # thresholds lie midway between neighbouring quantiles of the two classes
    values = {n: sorted({v for r in picked for v in r[n]}) for n in names}
    steps = {n: [(a + b) / 2 for a, b in zip(v, v[1:], strict=False)] for n, v in values.items()}
    bins = [sum(((ratio(n) >= t).cast("int") for t in steps[n]), F.lit(0)).alias(n) for n in names]
    table = cut(rows.select("reject", "grow", *bins).groupBy("reject", "grow", *names).count(), "bins")

    def counts(rest: Column, part: bool) -> dict[tuple[str, int], tuple[int, int]]:
        pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in names]))
        got = table.filter((F.col("grow") == part) & rest).select("reject", "count", pairs.alias("x"))
        got = got.groupBy("x.f", "x.b").agg(F.sum(F.when(F.col("reject"), F.col("count")).otherwise(0)).alias("p"), F.sum(F.when(F.col("reject"), 0).otherwise(F.col("count"))).alias("n"))
        return {(r["f"], r["b"]): (r["p"], r["n"]) for r in got.collect()}

    def total(rest: Column, part: bool) -> tuple[int, int]:
        got = counts(rest, part)
        own = [v for (f, _), v in got.items() if f == names[0]]
        return sum(v[0] for v in own), sum(v[1] for v in own)

    done = DecisionList()
    left = F.lit(True)
    while len(done.rules) < max_rules:
        rule: list[Condition] = []
        inside = left
        while len(rule) < max_conditions:
            got = counts(inside, True)
            own = [v for (f, _), v in got.items() if f == names[0]]
            p0, n0 = sum(v[0] for v in own), sum(v[1] for v in own)
            if not p0 or not n0:
                break
            start, best = math.log2(p0 / (p0 + n0)), (1e-9, None)
            for n in names:
                for b in range(1, len(steps[n]) + 1):
                    over = [v for (f, at), v in got.items() if f == n and at >= b]
                    p1, n1 = sum(v[0] for v in over), sum(v[1] for v in over)
                    for up, p, q in ((True, p1, n1), (False, p0 - p1, n0 - n1)):
                        gain = p * (math.log2(p / (p + q)) - start) if p else 0.0
                        if gain > best[0]:
                            best = (gain, Condition(n, up, steps[n][b - 1], b))
            if best[1] is None:
                break
            rule.append(best[1])
            inside = inside & best[1].on_bins()
        if not rule:
            break
        worth = []
        for k in range(1, len(rule) + 1):
            p, n = total(left & all_of([c.on_bins() for c in rule[:k]]), False)
            worth.append(((p - n) / (p + n) if p + n else -1.0, -k))
        rule = rule[: -max(worth)[1]]
        met = left & all_of([c.on_bins() for c in rule])
        (gp, gn), (pp, pn) = total(met, True), total(met, False)
        if gp + pp == 0 or gp < min_precision * (gp + gn) or pp < min_precision * (pp + pn):
            break
        done.rules.append(rule)
        left = left & ~all_of([c.on_bins() for c in rule])
    discard(table)
    return done


def learned_from(counted: DataFrame, labels: DataFrame, key: str) -> DecisionList:
    """The list learned from counted rows (key and COUNTS) whose labels agree, of those that pass the base."""
    agreed = labels.filter(F.col("quality").isNotNull()).groupBy(key).agg(F.min("quality").alias("__lo"), F.max("quality").alias("__hi")).filter("__lo = __hi")
    rows = counted.filter(~base_failed()).join(agreed, key)
    return learn(rows.select(*COUNTS, (F.col("__lo") == 0).alias("reject"), (F.pmod(F.xxhash64(key), F.lit(3)) > 0).alias("grow")))


def quality_rules(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, COUNTS, base_failed, rule (the learned rule that rejects the text, else null), kept."""
    counted = cut(count_features(docs, text, (key,)), "counts")
    learned = learned_from(counted, labels, key)
    judged = counted.withColumn("base_failed", base_failed()).withColumn("rule", learned.expression())
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def keep_good(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of docs, all their columns, that quality_rules keeps.

    Labelled texts are counted twice, once to learn and once to judge, so that the texts that stay need
    no copy on disk; those without a label are counted once.
    """
    labelled = labels.filter(F.col("quality").isNotNull()).select(key).distinct()
    counted = cut(count_features(docs.select(key, text).join(labelled, key, "left_semi"), text, (key,)), "counts")
    learned = learned_from(counted, labels, key)
    discard(counted)
    row = unused(docs, "__row")
    judged = count_features(docs.select(F.struct("*").alias(row), text), text, (row,))
    # a generator between counts and filter: pushed below, the filter would repeat the counting in each of its terms
    judged = judged.select(row, F.inline(F.array(F.struct(*COUNTS))))
    return judged.filter(~base_failed() & learned.expression().isNull()).select(f"{row}.*")
