"""Quality rules: an ordered decision list learned from labelled statistics.

Sequential covering on Spark aggregates. A rule is grown one threshold at a time by the gain of Foil until it
covers no good row or nothing gains, pruned on the rows of another fold by (bad - good) / (bad + good), and
kept if precise enough on both folds; the rows it covers are then left out and the next rule is grown. A rule
that fails sets its rows aside for growing only. Covering ends when no further rule is precise on the growing
fold; neither rules nor conditions are limited. In the end every bound moves to the middle of the gap
between the labelled values around it. The list becomes one CASE expression whose first matching rule decides.

The best threshold is exact over all labelled values: counts per (statistic, bin) at quantiles give the gain at
every border between bins and the most that any threshold inside a bin could gain; bins that could beat the
best border are searched value by value in Spark. The driver sees counts per bin and the best value of each bin.

Defined cases: a null text has no words, so it fails the base. Labels that are null or belong
to no document are ignored; repeated labels of a document count once, the best of them. With
no labels, or none of one kind, no rule is learned and every document that passes the base is
kept. Equal rows are treated alike. Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.common import GAP, let, words
from visitlens.session import cut_lineage

MIN_WORDS = 50
STATISTICS = (
    "mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "digit_share",
    "mark_share", "words_per_line", "distinct_share", "log_words",
)


@dataclass(frozen=True)
class Condition:
    """``statistic > bound`` or ``statistic <= bound``."""

    statistic: str
    above: bool
    bound: float

    def column(self) -> Column:
        c = F.col(self.statistic)
        return c > F.lit(self.bound) if self.above else c <= F.lit(self.bound)

    def __str__(self) -> str:
        return f"{self.statistic} {'>' if self.above else '<='} {self.bound:.6g}"


@dataclass(frozen=True)
class Settings:
    bins: int = 256  # of the first look; the result does not depend on it
    min_covered: int = 5
    min_precision: float = 0.9


def repeated_words(found: Column) -> Column:
    """Words of an array that lie in a window of three that the array holds twice or more."""

    def windows(w: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        )
        return F.sort_array(each)

    def starts(s: Column) -> Column:
        """Places of windows whose hash stands next to an equal one in hash order."""
        equal = lambda x, j: F.get(s, j)["h"] == x["h"]
        twice = F.transform(s, lambda x, j: F.when(equal(x, j - 1) | equal(x, j + 1), x["i"]))
        return F.sort_array(F.array_compact(twice))

    def covered(p: Column) -> Column:
        new = F.transform(p, lambda x, j: F.least(F.lit(3), x - F.coalesce(F.get(p, j - 1), x - 3)))
        return F.aggregate(new, F.lit(0), lambda a, x: a + x)

    count = let(found, lambda w: let(windows(w), lambda s: let(starts(s), covered)))
    return F.when(F.size(found) >= 3, count).otherwise(0)


def base_columns(docs: DataFrame) -> DataFrame:
    """The documents with counts of words, characters in words, symbols, repeated lines and repeated words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    out = docs.withColumns({"_words": words(F.col("text")), "_lines": lines})
    return out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.regexp_replace(text, GAP, "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_words")).cast("long"),
            "_n_lines": F.size("_lines"),
            "_n_distinct": F.size(F.array_distinct("_words")),
            "_n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")),
            "_n_digits": F.regexp_count(text, F.lit("[0-9]")),
            "_n_marks": F.regexp_count(text, F.lit(r"[!?;:(){}\[\]=+/\\_~^@\"]")),
        }
    ).drop("_words", "_lines")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, base counts, ``base_failed`` and the statistics that rules are made of; stored, without texts."""
    out = cut_lineage(base_columns(docs.select("doc_id", "text")).drop("text"))
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    lines = F.greatest("_n_lines", F.lit(1))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumns(
        {
            "base_failed": failed,
            "mean_word": F.col("word_chars") / n,
            "symbols_per_word": F.col("n_symbols") / n,
            "dup_line_share": F.col("n_dup_lines") / lines,
            "repeat_share": F.col("n_repeat_words") / n,
            "upper_share": F.col("_n_upper") / chars,
            "digit_share": F.col("_n_digits") / chars,
            "mark_share": F.col("_n_marks") / chars,
            "words_per_line": F.col("n_words") / lines,
            "distinct_share": F.col("_n_distinct") / n,
            "log_words": F.log(n + F.lit(1.0)),
        }
    )


def labelled_statistics(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of documents that pass the base and carry a label (``bad`` 0 or 1)."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    best = known.groupBy("doc_id").agg((F.max("quality") == 0).cast("int").alias("bad"))
    rows = stats.where(~F.col("base_failed")).select("doc_id", *STATISTICS)
    return rows.join(best, "doc_id")


def foil_gain(p: float, n: float, before: float) -> float:
    return p * (math.log2(p / (p + n)) - before) if p else 0.0


class RuleLearner:
    """Grows and prunes rules over the stored rows of ``labelled``, with the bins of their statistics."""

    def __init__(self, labelled: DataFrame, settings: Settings = Settings()):
        self.settings = settings
        self.labelled = labelled = cut_lineage(labelled)
        marks = [i / settings.bins for i in range(1, settings.bins)]
        found = labelled.agg(*[F.percentile_approx(s, marks, 10_000).alias(s) for s in STATISTICS]).first()
        bins = []
        for s in STATISTICS:
            cuts = F.array(*[F.lit(c) for c in sorted(set(found[s] or []))]).cast("array<double>")
            bins.append(bin_of(F.col(s), cuts))
        fold = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
        self.rows = cut_lineage(labelled.select(*STATISTICS, F.array(*bins).alias("bins"), fold.alias("prune"), "bad", (1 - F.col("bad")).alias("good")))

    def learn(self) -> list[list[Condition]]:
        rules: list[list[Condition]] = []
        rest = growing = self.rows
        while True:
            grown, bad, good = self._grow(growing.where(~F.col("prune")))
            if not grown or bad < self.settings.min_precision * (bad + good):
                return self._centred(rules)
            rule = self._prune(rest, grown)
            growing = growing.where(~conjunction(rule))
            if self._good_enough(rest, rule):
                rules.append(rule)
                rest = rest.where(~conjunction(rule))

    def _centred(self, rules: list[list[Condition]]) -> list[list[Condition]]:
        """Move each bound into the middle of the gap between the labelled values next to it."""
        every = [c for rule in rules for c in rule]
        if not every:
            return rules
        sides = []
        for c in every:
            value = F.col(c.statistic)
            sides += [F.max(F.when(value <= F.lit(c.bound), value)), F.min(F.when(value > F.lit(c.bound), value))]
        found = self.labelled.agg(*sides).first()
        moved = {}
        for k, c in enumerate(every):
            low, high = found[2 * k], found[2 * k + 1]
            moved[c] = replace(c, bound=(low + high) / 2) if low is not None and high is not None else c
        return [[moved[c] for c in rule] for rule in rules]

    def _histogram(self, rows: DataFrame) -> dict[str, list[tuple[float, int, int, bool, int]]]:
        """Per statistic its bins in order: largest value, bad and good rows, whether there is more than one value, number."""
        value = F.get(F.array(*STATISTICS), F.col("s"))
        each = rows.select(*STATISTICS, F.posexplode("bins").alias("s", "bin"), "bad").withColumn("value", value)
        counts = each.groupBy("s", "bin").agg(
            F.max("value").alias("top"), F.sum("bad").alias("b"), F.sum(1 - F.col("bad")).alias("g"), (F.max("value") > F.min("value")).alias("mixed")
        )
        out: dict[str, list[tuple[float, int, int, bool, int]]] = {s: [] for s in STATISTICS}
        for r in sorted(counts.collect(), key=lambda r: (r["s"], r["bin"])):
            out[STATISTICS[r["s"]]].append((r["top"], r["b"], r["g"], r["mixed"], r["bin"]))
        return out

    def _grow(self, rows: DataFrame) -> tuple[list[Condition], int, int]:
        """Thresholds with the largest gain until no good row is covered or nothing gains; and the rows then covered."""
        rule: list[Condition] = []
        bad = good = 0
        while True:
            found = self._best(rows.where(conjunction(rule)) if rule else rows)
            if found is None:
                return rule, bad, good
            best, bad, good = found
            rule.append(best)
            if not good:
                return rule, bad, good

    def _best(self, rows: DataFrame) -> tuple[Condition, int, int] | None:
        """The threshold of the largest gain above 0 over all values, with the rows it covers.

        Of equal gains (to nine digits) the first statistic, the smallest bound, and <= before > win.
        """
        tops: list[tuple[tuple, int, int]] = []  # (rank of the threshold, bad, good)
        open_bins = []
        histogram = self._histogram(rows)
        for i, s in enumerate(STATISTICS):
            all_bad, all_good = (sum(x[k] for x in histogram[s]) for k in (1, 2))
            if not all_bad or not all_good:
                return None
            before = math.log2(all_bad / (all_bad + all_good))
            bad = good = 0
            for top, b, g, mixed, number in histogram[s]:
                if mixed:  # the most that a threshold inside could gain, on either side
                    most = max(foil_gain(bad + b, good, before), foil_gain(all_bad - bad, all_good - good - g, before))
                    open_bins.append((most, i, number, bad, good))
                bad, good = bad + b, good + g
                if (bad, good) != (all_bad, all_good):
                    tops += self._ranked(i, top, bad, good, all_bad, all_good, before)
        best = min(tops, default=None)
        least = -best[0][0] if best else 0.0
        wanted = [x for x in open_bins if round(x[0], 9) >= least and x[0] > 0]
        if wanted:
            for r in self._inside(rows, wanted, all_bad, all_good).collect():
                tops += self._ranked(r["s"], r["value"], r["bad"], r["good"], all_bad, all_good, before)
            best = min(tops, default=None)
        if best is None:
            return None
        (_, i, bound, above), bad, good = best
        return Condition(STATISTICS[i], bool(above), bound), bad, good

    def _ranked(self, i: int, bound: float, bad: int, good: int, all_bad: int, all_good: int, before: float) -> list:
        """Both sides of a threshold, as far as they cover enough rows and gain."""
        sides = ((0, bad, good), (1, all_bad - bad, all_good - good))
        gains = [(round(foil_gain(p, n, before), 9), above, p, n) for above, p, n in sides if p + n >= self.settings.min_covered]
        return [((-gain, i, bound, above), p, n) for gain, above, p, n in gains if gain > 0]

    def _inside(self, rows: DataFrame, wanted: list[tuple], all_bad: int, all_good: int) -> DataFrame:
        """For each wanted bin the values of the largest gains on either side, with the rows up to them."""
        spark = rows.sparkSession
        bins = spark.createDataFrame([(i, number, bad, good) for _, i, number, bad, good in wanted], "_s int, _bin int, bad0 long, good0 long")
        value = F.get(F.array(*STATISTICS), F.col("s"))
        each = rows.select(*STATISTICS, F.posexplode("bins").alias("s", "bin"), "bad").withColumn("value", value)
        met = each.join(F.broadcast(bins), (F.col("s") == F.col("_s")) & (F.col("bin") == F.col("_bin")))
        values = met.groupBy("s", "bin", "bad0", "good0", "value").agg(F.sum("bad").alias("b"), F.sum(1 - F.col("bad")).alias("g"))
        upto = Window.partitionBy("s", "bin").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = values.withColumns({"bad": F.col("bad0") + F.sum("b").over(upto), "good": F.col("good0") + F.sum("g").over(upto)})
        before = math.log2(all_bad / (all_bad + all_good))
        gain = lambda p, n: F.round(F.when(p > 0, p * (F.log2(p / (p + n)) - before)).otherwise(0.0), 9)
        enough = lambda p, n, x: F.when(p + n >= self.settings.min_covered, x)
        below = enough(F.col("bad"), F.col("good"), gain(F.col("bad"), F.col("good")))
        p, n = all_bad - F.col("bad"), all_good - F.col("good")
        above = enough(p, n, gain(p, n))
        kept = F.struct("value", "bad", "good")
        order = lambda g: F.struct(g, -F.col("value"))  # noqa: E731  of equal gains the smallest value
        best = sums.groupBy("s", "bin").agg(
            F.array(F.max_by(kept, F.when(below.isNotNull(), order(below))), F.max_by(kept, F.when(above.isNotNull(), order(above)))).alias("two")
        )
        return best.select("s", F.explode("two").alias("x")).where(F.col("x").isNotNull()).select("s", "x.*").distinct()

    def _prune(self, rest: DataFrame, rule: list[Condition]) -> list[Condition]:
        """The prefix of the rule with the best value on the pruning fold, the shorter one on ties."""
        if not rule:
            return rule
        rows, sums = rest.where("prune"), []
        for k in range(1, len(rule) + 1):
            hit = conjunction(rule[:k])
            sums += [F.sum(F.when(hit, F.col(c)).otherwise(0)) for c in ("bad", "good")]
        found = rows.agg(*sums).first()
        values = []
        for k in range(len(rule)):
            bad, good = found[2 * k] or 0, found[2 * k + 1] or 0
            values.append((bad - good) / (bad + good) if bad + good else -1.0)
        return rule[: values.index(max(values)) + 1]

    def _good_enough(self, rest: DataFrame, rule: list[Condition]) -> bool:
        hit = rest.where(conjunction(rule))
        folds = {r["prune"]: (r["b"], r["g"]) for r in hit.groupBy("prune").agg(F.sum("bad").alias("b"), F.sum("good").alias("g")).collect()}
        bad, good = (sum(v[i] for v in folds.values()) for i in (0, 1))
        precise = all(b >= self.settings.min_precision * (b + g) for b, g in folds.values())
        return bad + good >= self.settings.min_covered and precise


def bin_of(value: Column, cuts: Column) -> Column:
    """Number of cut points below the value."""
    return F.size(F.filter(cuts, lambda c: c < value))


def conjunction(rule: list[Condition]) -> Column:
    return reduce(Column.__and__, [c.column() for c in rule], F.lit(True))


def first_match(rules: list[list[Condition]]) -> Column:
    """Number of the first rule that holds (from 1), 0 if none does: the ordered decision list."""
    if not rules:
        return F.lit(0)
    out = F.when(conjunction(rules[0]), 1)
    for k, rule in enumerate(rules[1:], 2):
        out = out.when(conjunction(rule), k)
    return out.otherwise(0)


def judge(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per document doc_id, base counts, statistics, ``rule`` (0: none) and ``kept``."""
    stats = statistics(docs)
    rules = RuleLearner(labelled_statistics(stats, labels), settings).learn()
    out = stats.withColumn("rule", first_match(rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = judge(docs, labels)
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )
